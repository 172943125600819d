"""Pair operators against brute force on small tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymark.functions import geo, kernels as k
from waymark.operators import grid, pairs


def lines_frame(spark, n, seed, spread=0.05, wiggle=0.002):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        m = int(rng.integers(3, 6))
        start = np.round(rng.integers(0, 4, 2) * spread, 3)
        pts = start + np.cumsum(np.column_stack([np.full(m, 0.01), rng.normal(0, wiggle, m)]), axis=0)
        rows.append((i, [(float(x), float(y)) for x, y in pts]))
    return spark.createDataFrame(rows, "o bigint, p array<struct<x: double, y: double>>"), rows


def distance(a, b):
    a, b = np.array(a), np.array(b)
    return max(k.point_to_segments(a, b)[0].min(axis=1).max(), k.point_to_segments(b, a)[0].min(axis=1).max())


def greedy(rows, d, p):
    free, seeds, taken = set(o for o, _ in rows), [], {}
    for i, (o, pts) in enumerate(rows):
        if o not in free:
            continue
        seeds.append(o)
        for o2, pts2 in rows[i + 1 :]:
            if o2 in free and abs(len(pts) - len(pts2)) <= p and distance(pts, pts2) <= d:
                free.discard(o2)
                taken[o2] = o
    return taken


@pytest.mark.parametrize("limit", [128, 3])
def test_near_duplicates_equal_the_row_by_row_pass(spark, limit):
    df, rows = lines_frame(spark, 120, 5)
    want = greedy(rows, 0.004, 1)
    got = {r["o"]: r["seed"] for r in pairs.near_duplicates(df, "o", "p", 0.004, 1, pair_limit=limit).collect()}
    assert len(want) > 20
    assert set(got) == set(want)


def test_near_duplicates_without_any(spark):
    df, _ = lines_frame(spark, 5, 1)
    assert pairs.near_duplicates(df, "o", "p", 1e-9, 1).count() == 0


def test_components_and_clusters(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (7, 9), (9, 8), (3, 10)], "a bigint, b bigint")
    got = {r["id"]: r["component"] for r in pairs.components(edges).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 10: 1, 7: 7, 8: 7, 9: 7}
    df, rows = lines_frame(spark, 60, 9)
    link = {o: {o} for o, _ in rows}
    for i, (a, pa) in enumerate(rows):
        for b, pb in rows[i + 1 :]:
            if distance(pa, pb) <= 0.004:
                merged = link[a] | link[b]
                for o in merged:
                    link[o] = merged
    want = {o: min(s) for o, s in link.items() if len(s) > 1}
    got = {r["o"]: r["cluster"] for r in pairs.trace_clusters(df, "o", "p", 0.004).collect()}
    assert got == want


def test_intersecting_lines_flat_ends_and_salting(spark):
    a = spark.createDataFrame([(1, "LINESTRING (0 0, 0 3)"), (2, "LINESTRING (5 5, 6 6)")], "aid int, w string")
    b = spark.createDataFrame([(1, "LINESTRING (0 1, 0 2)"), (2, "LINESTRING (0 2, 0 3)")], "bid int, v string")
    a = a.select("aid", geo.points_of_wkt("w").alias("pa"))
    b = b.select("bid", geo.points_of_wkt("v").alias("pb"))
    got = pairs.intersecting_lines(a, b, "aid", "bid", "pa", "pb", 0.00003).select("aid", "bid", "spans").collect()
    found = {(r["aid"], r["bid"]): [(round(s["s"], 9), round(s["e"], 9)) for s in r["spans"]] for r in got}
    assert found == {(1, 1): [(1.0, 2.0)], (1, 2): [(2.0, 3.0)]}
    many = spark.range(50).select(F.col("id").alias("aid"), F.expr("array(named_struct('x', 0D, 'y', 0D), named_struct('x', 0D, 'y', 3D))").alias("pa"))
    salted = pairs.cell_join(many, b, "aid", "pa", "pb", 0.5, 0.001, salt_above=7)
    assert salted.count() == 100
    assert salted.select("aid", "bid").distinct().count() == 100


def test_remove_contained(spark):
    df = spark.createDataFrame(
        [(1, "LINESTRING (0 0, 0 1)"), (2, "LINESTRING (0 0.2, 0 0.8)"), (3, "LINESTRING (1 0, 1 1)"), (4, "LINESTRING (1 0, 1 1)")],
        "id int, w string",
    ).select("id", geo.points_of_wkt("w").alias("p"))
    assert sorted(r["id"] for r in pairs.remove_contained(df, "id", "p").collect()) == [1, 3]
    assert sorted(r["id"] for r in pairs.remove_contained(df, "id", "p", literal=True).collect()) == [1]


def test_near_duplicates_keep_the_first_values(spark):
    from waymark.plans.inspection import dedup_near, dedup_tables

    lines = ["LINESTRING (0 0, 1 0, 2 0)", "LINESTRING (0 0.001, 1 0, 2 0)", "LINESTRING (0 0, 1 0.002, 2 0)", "LINESTRING (9 9, 8 8, 7 9)"]
    rows = [(i, line, note, str(i)) for i, (line, note) in enumerate(zip(lines, [None, "b", "c", None]))]
    df = spark.createDataFrame(rows, "o bigint, stretch string, note string, case_id string")
    got = {r["o"]: (r["stretch"], r["note"], r["case_id"]) for r in dedup_near(df, "o").collect()}
    assert got == {0: (lines[0], "b", "0"), 3: (lines[3], None, "3")}
    # Two runs that share a case id are told apart.
    runs = df.drop("o").withColumn("run_id", F.lit("r1")).union(df.drop("o").withColumn("run_id", F.lit("r2")))
    assert dedup_tables({"log": runs})["log"].count() == 2


def test_contained_lines_go_without_a_list_of_their_pairs(spark, monkeypatch):
    """120 lines within each other, of which some are equal: one witness each, then what is left against all."""
    rows = [(i, [(0.0, 0.0), (0.0005 * (1 + i % 40), 0.0)]) for i in range(120)] + [(200 + i, [(0.0001 * i, 0.0), (0.03, 0.0)]) for i in range(3)]
    df = spark.createDataFrame(rows, "id bigint, p array<struct<x: double, y: double>>")
    asked, plain = [], grid.Leaves.pairs
    monkeypatch.setattr(grid.Leaves, "pairs", lambda self, without=None, where=None: asked.append(plain(self, without, where)) or asked[-1])
    inside = {(r.a, r.b): (r.a_in_b, r.b_in_a) for r in pairs.contained_lines(df, "id", "p", 0.00001).collect()}
    asked.clear()
    for literal in (False, True):
        gone = {a for (a, b), (x, y) in inside.items() if x and (literal or not y)} | {b for (a, b), (_, y) in inside.items() if y}
        assert {r.id for r in pairs.remove_contained(df, "id", "p", literal=literal).collect()} == {i for i, _ in rows} - gone
        first, rest = (x.count() for x in asked)
        assert rest < 10 < 1000 < first
        asked.clear()
