"""Pieces of lines along partner lines, square by square, against the pair operators that list every pair."""

import random

import pytest
from pyspark.sql import functions as F

from waymark.functions import geo, kernels as k
from waymark.operators import matching, pairs
from waymark.operators.barrier import explode_once, keep_where
from waymark.plans import mapdata as md

LINES = "array<struct<x: double, y: double>>"


def road(own, x, y, n=4, step=0.0004, shake=0.00001):
    """A line that runs east from about (x, y), sometimes west or with a bend."""
    turn = 0.0002 if own.random() < 0.2 else 0.0
    out = [(x + step * i + own.uniform(-shake, shake), y + turn * (i % 2) + own.uniform(-shake, shake)) for i in range(n)]
    return out[::-1] if own.random() < 0.2 else out


def listed(a, b, radius, min_metres, inside, on):
    """Every pair of lines that meet, its longest piece, then without contained pieces."""
    met = pairs.intersecting_lines(a, b, "feature_a", "feature_b", "line_a", "line_b", radius, on).filter(geo.same_direction("line_a", "line_b"))
    pieces = explode_once(met, "spans", "_span").withColumn("piece", k.substring("line_a", F.col("_span.s"), F.col("_span.e")))
    pieces = keep_where(pieces, F.col("piece_metres") > min_metres, {"piece_metres": k.geodesic_length("piece")})
    keys = [*on, "feature_a", "feature_b"]
    longest = pieces.groupBy(*keys).agg(F.max_by(F.struct("tag", "piece", "piece_metres"), F.struct("piece_metres", geo.first("piece"), geo.last("piece"))).alias("r"))
    longest = longest.select(*keys, "r.*").withColumn("_id", F.concat_ws("|", "feature_a", "feature_b"))
    return longest if inside is None else pairs.remove_contained(longest, "_id", "piece", inside, on)


def rows_of(df, on):
    return sorted((*(r[c] for c in on), r.feature_a, r.feature_b, r.tag, round(r.piece_metres, 6), *(round(v, 9) for p in r.piece for v in p)) for r in df.collect())


@pytest.mark.parametrize("case", ["plain", "split", "groups", "twice", "bars", "all"])
def test_same_pieces_as_listed(spark, case):
    own = random.Random(f"matching {case}")
    on = ["g"] if case == "groups" else []
    bar = "|" if case == "bars" else "-"
    spots = [(own.uniform(-0.01, 0.01), own.uniform(-0.001, 0.001)) for _ in range(12)]
    one = [(own.choice("xy"), f"a{bar}{i % (45 if case == 'twice' else 1000)}", i, road(own, *own.choice(spots), own.randint(2, 6))) for i in range(90)]
    two = [(own.choice("xy"), f"b{bar}{i % (40 if case == 'twice' else 1000)}", road(own, *own.choice(spots), own.randint(2, 6))) for i in range(60)]
    if case == "twice":
        one += one[:10]
    one += [("x", None, -1, one[0][3]), (None, "n", -2, one[0][3]), ("x", "short", -3, one[0][3][:1]), ("x", "none", -4, None)]
    # Without the place of a vertex: no segment, so the listing operators leave it out too.
    one += [("x", "part", -5, [(0.0, 0.0), (None, 0.0)]), ("y", "parts", -6, [(0.0, 0.0), None])]
    two += [("x", "part", [(0.0, 0.0), (None, 0.0)]), ("y", "b", [(None, None), (0.0, 0.0)])]
    a = spark.createDataFrame(one, f"g string, feature_a string, tag int, line_a {LINES}")
    b = spark.createDataFrame(two, f"g string, feature_b string, line_b {LINES}")
    if not on:
        a, b = a.drop("g"), b.drop("g")
    inside = None if case == "all" else 0.00001
    start, limit = (2, 8) if case == "split" else (None, matching.PAIRS)
    got = matching.matched_pieces(a, b, "feature_a", "feature_b", "line_a", "line_b", 0.00003, 1.0, inside, on, start, limit)
    assert got.columns == [*on, "feature_a", "feature_b", "tag", "line_a", "line_b", "piece", "piece_metres"]
    want = rows_of(listed(a, b, 0.00003, 1.0, inside, on), on)
    assert rows_of(got, on) == want and len(want) > 20
    lines = {i: p for _, n, i, p in one if n and p}
    assert not {r.tag for r in got.collect()} & {-1 if case == "groups" else -5, -5, -6}
    assert all([tuple(v) for v in r.line_a] == lines[r.tag] for r in got.collect())


def test_lines_are_shuffled_not_their_pairs(spark, monkeypatch):
    """200 x 50 lines on each other: no row of a pair leaves a task, and the pieces that stay are told apart there."""
    a = spark.createDataFrame([(f"a{i:03}", [(0.0, 0.0), (0.001 + 0.0001 * (i % 17), 0.0)]) for i in range(200)], f"feature_a string, line_a {LINES}")
    b = spark.createDataFrame([(f"b{i:02}", [(0.0, 0.0), (0.001 + 0.0001 * (i % 13), 0.0)]) for i in range(50)], f"feature_b string, line_b {LINES}")
    counted = []
    plain = matching._dealt
    monkeypatch.setattr(matching, "_dealt", lambda *x: counted.append(plain(*x)) or counted[-1])
    got = md.match_features(a, b).collect()
    assert [(r.feature_a, r.feature_b) for r in got] == [("a012", "b12")]
    assert max(df.count() for df in counted) <= 200 * 4
    assert not hasattr(md, "remove_contained")


def test_a_square_in_slices_and_cells(spark, monkeypatch):
    """Slices of few pairs give what large ones do."""
    own = random.Random(8)
    one = [(f"a{i}", road(own, own.uniform(0, 0.004), 0.0, 3)) for i in range(80)]
    two = [(f"b{i}", road(own, own.uniform(0, 0.004), 0.0, 3)) for i in range(40)]
    import pyarrow as pa

    def table(rows, name):
        xs, ys = ([[p[x] for p in line] for _, line in rows] for x in (0, 1))
        return pa.table({name: [n for n, _ in rows], "_level": pa.array([2] * len(rows), pa.int32()), "_square": pa.array([0] * len(rows), pa.int64()), "_x": xs, "_y": ys})

    def run():
        ia, ib, xy, at, metres = matching._decided(table(one, "a"), table(two, "b"), ["a", "b"], [], 0.00003, 1.0, 0.00001)
        return sorted((int(i), int(j), round(m, 6)) for i, j, m in zip(ia, ib, metres))

    want = run()
    monkeypatch.setattr(matching, "SLICE", 50)
    assert run() == want and len(want) > 3
