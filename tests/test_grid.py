"""Spatial pairs from the adaptive grid against all pairs of segments."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymark.operators import grid, pairs


def lines(n, seed, hot=0.0, spread=3.0):
    """Walks of two to six points; a share of ``hot`` of them in one spot."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        start = rng.uniform(-0.0005, 0.0005, 2) if rng.random() < hot else rng.uniform(-spread, spread, 2)
        step = 0.0004 if abs(start).max() < 0.001 else rng.choice([0.001, 0.05, 2.5])
        out.append((i, (start + np.concatenate([[[0, 0]], np.cumsum(rng.normal(0, step, (int(rng.integers(1, 6)), 2)), axis=0)])).round(7).tolist()))
    return out


def frame(spark, rows, name, line):
    return spark.createDataFrame([(i, [tuple(p) for p in pts]) for i, pts in rows], f"{name} long, {line} array<struct<x: double, y: double>>")


def segment_distance(p, q):
    """Least distance of two segments."""

    def to_segment(x, a, b):
        d = b - a
        t = 0.0 if not d.any() else np.clip((x - a) @ d / (d @ d), 0, 1)
        return np.hypot(*(x - a - t * d))

    (a, b), (c, d) = p, q
    cross = lambda u, v: u[0] * v[1] - u[1] * v[0]
    if cross(b - a, c - a) * cross(b - a, d - a) < 0 and cross(d - c, a - c) * cross(d - c, b - c) < 0:
        return 0.0
    return min(to_segment(a, c, d), to_segment(b, c, d), to_segment(c, a, b), to_segment(d, a, b))


def near(left, right, pad):
    found = set()
    for i, p in left:
        for j, q in right:
            p_, q_ = np.array(p), np.array(q)
            if (p_.min(0) > q_.max(0) + pad).any() or (q_.min(0) > p_.max(0) + pad).any():
                continue
            if min(segment_distance(p_[k : k + 2], q_[m : m + 2]) for k in range(len(p_) - 1) for m in range(len(q_) - 1)) <= pad:
                found.add((i, j))
    return found


@pytest.mark.parametrize("hot, limit, pad", [(0.0, 8, 0.01), (0.5, 8, 0.00003), (0.5, 200, 0.3)])
def test_no_near_pair_is_missing(spark, hot, limit, pad):
    """Sparse and dense grids, with half of all rows in one square of the last level, and a padding wider than most squares."""
    left, right = lines(160, 1, hot), lines(160, 2, hot)
    a = grid.line_segments(frame(spark, left, "i", "p"), "i", "p", [], "_a", 0.0)
    b = grid.line_segments(frame(spark, right, "j", "q"), "j", "q", [], "_b", pad)
    rows = [(r._a, r._b) for r in grid.near_pairs(a, b, pad, limit=limit).collect()]
    want = near(left, right, pad)
    assert len(rows) == len(set(rows)) and want <= set(rows) and len(want) > 50
    # What is found too much has boxes of segments that are near.
    assert all(any(((p[k : k + 2].min(0) <= q[m : m + 2].max(0) + pad + 1e-9) & (q[m : m + 2].min(0) <= p[k : k + 2].max(0) + pad + 1e-9)).all() for k in range(len(p) - 1) for m in range(len(q) - 1)) for p, q in ((np.array(left[i][1]), np.array(right[j][1])) for i, j in set(rows) - want))


def test_long_lines_take_the_squares_they_cross(spark):
    """A diagonal of one degree crosses some 2 x n squares of a side's n, not n x n."""
    df = frame(spark, [(1, [(0.001, 0.0007), (1.0, 0.99)])], "i", "p")
    parts = grid._descend(grid.line_segments(df, "i", "p", [], "_a", 0.0), grid.ROOT, inside=False)
    for level in range(1, 5):
        parts = grid._descend(parts, grid.ROOT / grid.FAN**level)
        side = grid.FAN**level / grid.ROOT
        assert side * 0.99 <= parts.count() <= 2 * side + 2
    rows = {(r["_cx"], r["_cy"]) for r in parts.collect()}
    size = grid.ROOT / grid.FAN**4
    t = np.linspace(0, 1, 100_000)
    assert {(int(x // size), int(y // size)) for x, y in zip(0.001 + t * 0.999, 0.0007 + t * 0.9893)} <= rows


def test_equality_keys_and_edges(spark):
    """Other keys must be equal; lines of one point and lines with null coordinates meet nothing; nor do empty tables."""
    rows = [(1, "x", [(0.0, 0.0), (1.0, 0.0)]), (2, "y", [(0.0, 0.0), (1.0, 0.0)]), (3, "x", [(0.0, 0.0)]), (4, "x", []), (5, "x", None), (6, "x", [(None, 0.0), (1.0, 0.0)]), (7, None, [(0.0, 0.0), (1.0, 0.0)])]
    df = spark.createDataFrame(rows, "i long, g string, p array<struct<x: double, y: double>>")
    other = df.select(F.col("i").alias("j"), "g", F.col("p").alias("q"))
    a, b = grid.line_segments(df, "i", "p", ["g"], "_a", 0.0), grid.line_segments(other, "j", "q", ["g"], "_b", 0.1)
    assert {(r.g, r._a, r._b) for r in grid.near_pairs(a, b, 0.1, ["g"]).collect()} == {("x", 1, 1), ("y", 2, 2)}
    assert grid.near_pairs(a.filter("false"), b, 0.1, ["g"]).count() == 0 and grid.near_pairs(a.filter("false"), b.filter("false"), 0.1, ["g"]).count() == 0


def test_intersections_of_a_hot_square(spark):
    """Half of all lines lie on each other: every pair of them is found once, whatever the limit."""
    one = [(i, [(0.0, 0.0), (0.0, 3.0)]) for i in range(60)] + [(100 + i, [(i * 0.1 + 1, 0.0), (i * 0.1 + 1, 1.0)]) for i in range(60)]
    two = [(i, [(0.0, 1.0), (0.0, 2.0)]) for i in range(40)] + [(100 + i, [(i * 0.1 + 1, 0.5), (i * 0.1 + 1, 2.0)]) for i in range(40)]
    got = pairs.intersecting_lines(frame(spark, one, "i", "p"), frame(spark, two, "j", "q"), "i", "j", "p", "q", 0.00003, limit=10)
    spans = {(r["i"], r["j"]): [(round(s["s"], 9), round(s["e"], 9)) for s in r["spans"]] for r in got.collect()}
    assert spans == {(i, j): [(1.0, 2.0)] for i in range(60) for j in range(40)} | {(100 + i, 100 + i): [(0.5, 1.0)] for i in range(40)}


def test_contained_lines_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(90):
        x, y, n = float(rng.integers(0, 3)) / 10, float(rng.integers(0, 4)) / 10, int(rng.integers(2, 5))
        rows.append((i, [(x, y + 0.01 * k) for k in range(n)][:: rng.choice([1, -1])]))
    got = {(r.a, r.b): (r.a_in_b, r.b_in_a) for r in pairs.contained_lines(frame(spark, rows, "i", "p"), "i", "p", 0.00001, limit=6).collect()}

    def inside(p, q):
        return p[0][0] == q[0][0] and min(c[1] for c in q) - 1e-5 <= min(c[1] for c in p) and max(c[1] for c in p) <= max(c[1] for c in q) + 1e-5

    want = {(i, j): (inside(p, q), inside(q, p)) for i, p in rows for j, q in rows if i < j and (inside(p, q) or inside(q, p))}
    assert got == want and len(want) > 100
