"""Small numpy helpers for planar and geodesic line geometry, run by Spark in Arrow batches.

A line is ``array<struct<x: double, y: double>>``; positions along a line are planar, in degrees.
Spark partitions, joins and shuffles the work; a helper only sees the rows of one batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F, types as T

DOUBLE = T.DoubleType()
POINT = T.StructType([T.StructField("x", DOUBLE), T.StructField("y", DOUBLE)])
POINTS = T.ArrayType(POINT)
SPANS = T.ArrayType(T.StructType([T.StructField("s", DOUBLE), T.StructField("e", DOUBLE)]))
_PA_POINTS = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))
_PA_SPANS = pa.list_(pa.struct([("s", pa.float64()), ("e", pa.float64())]))
EPS = 1e-12


# ---- Arrow in and out -----------------------------------------------------------------------


def _coords(column: pa.Array):
    """All vertices of a batch as one (n, 2) array, and the row offsets."""
    lengths = np.array(column.value_lengths().fill_null(0)).astype(np.int64)
    flat = column.flatten()
    xy = np.column_stack(
        [np.asarray(flat.field(i).to_numpy(zero_copy_only=False), dtype=float) for i in range(2)]
    ) if len(flat) else np.empty((0, 2))
    return xy, np.concatenate([[0], np.cumsum(lengths)])


def _doubles(column: pa.Array):
    return np.asarray(column.to_numpy(zero_copy_only=False), dtype=float)


def _list_of_structs(rows, kind, names):
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate(rows) if rows and offsets[-1] else np.empty((0, len(names)))
    fields = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(len(names))], names=names)
    return pa.ListArray.from_arrays(pa.array(offsets), fields).cast(kind)


# ---- geodesic -------------------------------------------------------------------------------

# WGS84 ellipsoid.
_A, _F = 6378137.0, 1 / 298.257223563
_B = _A * (1 - _F)


def geodesic_inverse(lon1, lat1, lon2, lat2):
    """Distance in metres and forward azimuth in degrees on WGS84 (Vincenty's published inverse iteration)."""
    lon1, lat1, lon2, lat2 = (np.radians(np.asarray(v, dtype=float)) for v in (lon1, lat1, lon2, lat2))
    u1, u2 = np.arctan((1 - _F) * np.tan(lat1)), np.arctan((1 - _F) * np.tan(lat2))
    su1, cu1, su2, cu2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    big_l = (lon2 - lon1 + np.pi) % (2 * np.pi) - np.pi
    lam = big_l.copy()
    with np.errstate(all="ignore"):
        for _ in range(200):
            sl, cl = np.sin(lam), np.cos(lam)
            ss = np.hypot(cu2 * sl, cu1 * su2 - su1 * cu2 * cl)
            cs = su1 * su2 + cu1 * cu2 * cl
            sigma = np.arctan2(ss, cs)
            sa = np.where(ss == 0, 0.0, cu1 * cu2 * sl / ss)
            c2a = 1 - sa**2
            c2m = np.where(c2a == 0, 0.0, cs - 2 * su1 * su2 / c2a)
            c = _F / 16 * c2a * (4 + _F * (4 - 3 * c2a))
            new = big_l + (1 - c) * _F * sa * (sigma + c * ss * (c2m + c * cs * (2 * c2m**2 - 1)))
            moved, lam = np.abs(new - lam), new
            if np.nanmax(moved, initial=0.0) < 1e-13:
                break
        # Row by row: only nearly antipodal points fail, and take the distance on a sphere.
        converged = (moved < 1e-10) & (np.abs(lam) <= np.pi)
        usq = c2a * (_A**2 - _B**2) / _B**2
        big_a = 1 + usq / 16384 * (4096 + usq * (-768 + usq * (320 - 175 * usq)))
        big_b = usq / 1024 * (256 + usq * (-128 + usq * (74 - 47 * usq)))
        ds = big_b * ss * (
            c2m + big_b / 4 * (cs * (2 * c2m**2 - 1) - big_b / 6 * c2m * (4 * ss**2 - 3) * (4 * c2m**2 - 3))
        )
        dist = _B * big_a * (sigma - ds)
        azimuth = np.degrees(np.arctan2(cu2 * np.sin(lam), cu1 * su2 - su1 * cu2 * np.cos(lam)))
        h = np.sin((lat2 - lat1) / 2) ** 2 + np.cos(lat1) * np.cos(lat2) * np.sin(big_l / 2) ** 2
        sphere = 2 * 6371008.8 * np.arcsin(np.minimum(1.0, np.sqrt(h)))
    dist = np.where(converged & np.isfinite(dist), dist, sphere)
    return np.where(ss == 0, 0.0, dist), azimuth


def batch_metres(xy, at_):
    """Sum of WGS84 segment lengths of each line."""
    total = np.zeros(len(at_) - 1)
    if len(xy) > 1:
        row = np.repeat(np.arange(len(at_) - 1), np.diff(at_))
        inner = np.flatnonzero(row[1:] == row[:-1])
        if len(inner):
            d, _ = geodesic_inverse(xy[inner, 0], xy[inner, 1], xy[inner + 1, 0], xy[inner + 1, 1])
            total = np.bincount(row[inner], weights=np.nan_to_num(d), minlength=len(at_) - 1)
    return total


@F.arrow_udf(DOUBLE)
def geodesic_length(line: pa.Array) -> pa.Array:
    """Sum of WGS84 segment lengths in metres; 0 for NULL, empty and single points."""
    return pa.array(batch_metres(*_coords(line)), pa.float64())


@F.arrow_udf(DOUBLE)
def geodesic_distance(x1: pa.Array, y1: pa.Array, x2: pa.Array, y2: pa.Array) -> pa.Array:
    """WGS84 distance of two points in metres; 0 when it cannot be computed."""
    d, _ = geodesic_inverse(*(_doubles(v) for v in (x1, y1, x2, y2)))
    return pa.array(np.nan_to_num(d), pa.float64())


@F.arrow_udf(DOUBLE)
def geodesic_azimuth(x1: pa.Array, y1: pa.Array, x2: pa.Array, y2: pa.Array) -> pa.Array:
    """Forward azimuth in degrees, in (-180, 180]."""
    _, azimuth = geodesic_inverse(*(_doubles(v) for v in (x1, y1, x2, y2)))
    return pa.array(azimuth, pa.float64(), from_pandas=True)


# ---- planar helpers on one line -------------------------------------------------------------


def point_to_segments(points, xy):
    """Distance (p, s) of points to the segments of a line, and the foot parameter on each segment."""
    a, d = xy[:-1], np.diff(xy, axis=0)
    sq = (d**2).sum(axis=1)
    rel = points[:, None, :] - a[None, :, :]
    t = np.where(sq > 0, (rel * d).sum(axis=2) / np.where(sq > 0, sq, 1), 0.0).clip(0, 1)
    foot = rel - t[:, :, None] * d[None, :, :]
    return np.hypot(foot[:, :, 0], foot[:, :, 1]), t


def _segments(xy, at_):
    """Index of the first vertex of every segment of a batch, and segments per row with their offsets."""
    row = np.repeat(np.arange(len(at_) - 1), np.diff(at_))
    first = np.flatnonzero(row[1:] == row[:-1]) if len(row) else np.empty(0, dtype=np.int64)
    per_row = np.maximum(np.diff(at_) - 1, 0)
    return first, row[first] if len(row) else first, np.concatenate([[0], np.cumsum(per_row)])


def batch_stations(xy, at_):
    """Planar distance of every vertex of a batch from the start of its own line, and total lengths."""
    first, row, offsets = _segments(xy, at_)
    step = np.zeros(len(xy))
    step[first + 1] = np.hypot(*(xy[first + 1] - xy[first]).T) if len(first) else 0.0
    run = np.cumsum(step)
    starts = np.minimum(at_[:-1], max(len(xy) - 1, 0))
    base = run[starts] if len(xy) else np.zeros(len(at_) - 1)
    station = run - np.repeat(base, np.diff(at_))
    ends = np.maximum(at_[1:] - 1, 0)
    total = np.where(np.diff(at_) > 0, station[ends] if len(xy) else 0.0, 0.0)
    return station, total


def _point_segment_pairs(rows, seg_offsets, budget=2_000_000):
    """Slices (begin, stop, point index, segment index, starts) pairing points with all segments of their row."""
    count = np.diff(seg_offsets)[rows]
    cum = np.concatenate([[0], np.cumsum(count)])
    begin = 0
    while begin < len(rows):
        stop = max(begin + 1, int(np.searchsorted(cum, cum[begin] + budget, side="right")) - 1)
        c = count[begin:stop]
        starts = cum[begin:stop] - cum[begin]
        ip = np.repeat(np.arange(begin, stop), c)
        js = np.arange(len(ip)) - np.repeat(starts, c) + np.repeat(seg_offsets[rows[begin:stop]], c)
        yield begin, stop, ip, js, starts
        begin = stop


def batch_locate(xy, at_, points, rows):
    """Position and distance of the nearest place on the line of its row for each point (the first on ties).

    Every row must have at least two vertices.
    """
    first, _, offsets = _segments(xy, at_)
    station, _ = batch_stations(xy, at_)
    position, nearest = np.zeros(len(points)), np.zeros(len(points))
    for begin, stop, ip, js, starts in _point_segment_pairs(rows, offsets):
        a = xy[first[js]]
        d = xy[first[js] + 1] - a
        sq = (d**2).sum(axis=1)
        rel = points[ip] - a
        t = np.where(sq > 0, (rel * d).sum(axis=1) / np.where(sq > 0, sq, 1), 0.0).clip(0, 1)
        dist = np.hypot(*(rel - t[:, None] * d).T)
        best = np.minimum.reduceat(dist, starts)
        counts = np.diff(np.concatenate([starts, [len(ip)]]))
        pick = np.minimum.reduceat(np.where(dist == np.repeat(best, counts), np.arange(len(ip)), len(ip)), starts)
        s0, s1 = station[first[js[pick]]], station[first[js[pick]] + 1]
        position[begin:stop] = s0 + t[pick] * (s1 - s0)
        nearest[begin:stop] = best
    return position, nearest


def batch_at(xy, at_, position, rows):
    """Point at a position (clamped) along the line of its row; every row must have vertices."""
    station, total = batch_stations(xy, at_)
    p = np.clip(position, 0, total[rows])
    big = (total.max() if len(total) else 0.0) + 1.0
    vertex_row = np.repeat(np.arange(len(at_) - 1), np.diff(at_))
    i = np.searchsorted(station + vertex_row * big, p + rows * big, side="right") - 1
    i = np.clip(i, at_[rows], np.maximum(at_[rows + 1] - 2, at_[rows]))
    j = np.minimum(i + 1, at_[rows + 1] - 1)
    step = station[j] - station[i]
    w = np.where(step > 0, (p - station[i]) / np.where(step > 0, step, 1), 0.0).clip(0, 1)[:, None]
    return np.where(w >= 1, xy[j], xy[i] + w * (xy[j] - xy[i]))


def batch_cut(xy, at_, start, end):
    """Part of each line between two positions: end points and the vertices strictly between."""
    station, total = batch_stations(xy, at_)
    n = len(at_) - 1
    rows = np.flatnonzero(np.diff(at_) >= 2)
    s, e = np.clip(start, 0, total), np.clip(end, 0, total)
    vertex_row = np.repeat(np.arange(n), np.diff(at_))
    inside = (station > s[vertex_row] + EPS) & (station < e[vertex_row] - EPS) & (np.diff(at_) >= 2)[vertex_row]
    count = np.bincount(vertex_row[inside], minlength=n)
    count[rows] += 2
    offsets = np.concatenate([[0], np.cumsum(count)])
    out = np.empty((offsets[-1], 2))
    middle = np.ones(offsets[-1], dtype=bool)
    middle[offsets[rows]] = middle[offsets[rows + 1] - 1] = False
    out[middle] = xy[inside]
    if len(rows):
        out[offsets[rows]] = batch_at(xy, at_, s[rows], rows)
        out[offsets[rows + 1] - 1] = batch_at(xy, at_, e[rows], rows)
    return out, offsets


def batch_near_spans(a, a_at, b, b_at, radius, flat_ends=False, budget=2_000_000):
    """Merged spans of positions along each line ``a`` within ``radius`` of its partner ``b``.

    On one segment of ``a`` the positions near one segment of ``b`` are a single span, because the set
    of points near a segment is convex: the hull of the parts in its two end discs and its slab. All
    pairs of segments of a batch go through numpy together, in slices of at most ``budget`` pairs.
    With ``flat_ends`` the neighbourhood of ``b`` stops square at its two ends; at a vertex between it is the sector on the
    outside of the bend, so that a wide neighbourhood does not reach round a vertex and beyond an end.
    Returns (row, start, end) arrays.
    """
    pa_first, pa_row, _ = _segments(a, a_at)
    pb_first, pb_row, pb_off = _segments(b, b_at)
    station, _ = batch_stations(a, a_at)
    rows, starts, ends = [], [], []
    # Most pairs are told apart by their boxes, one axis after the other.
    pad = radius[pb_row]
    boxes = [
        (np.minimum(p[pa_first], p[pa_first + 1]), np.maximum(p[pa_first], p[pa_first + 1]), np.minimum(q[pb_first], q[pb_first + 1]) - pad, np.maximum(q[pb_first], q[pb_first + 1]) + pad)
        for p, q in zip(a.T, b.T)
    ]

    def add(ia, lo, hi):
        ok = lo <= hi
        seg = ia[ok]
        s0, s1 = station[pa_first[seg]], station[pa_first[seg] + 1]
        rows.append(pa_row[seg])
        starts.append(s0 + lo[ok] * (s1 - s0))
        ends.append(np.where(hi[ok] >= 1, s1, s0 + hi[ok] * (s1 - s0)))

    for ia, ib in _row_pairs(pa_row, pb_off, budget):
        for low, high, from_, to in boxes:
            near = (low[ia] <= to[ib]) & (high[ia] >= from_[ib])
            ia, ib = ia[near], ib[near]
        p0, p1 = a[pa_first[ia]], a[pa_first[ia] + 1]
        q0, q1 = b[pb_first[ib]], b[pb_first[ib] + 1]
        add(ia, *_segment_spans(p0, p1, q0, q1, radius[pa_row[ia]], discs=not flat_ends))
    if flat_ends:
        inner = np.maximum(np.diff(pb_off) - 1, 0)
        bend_off = np.concatenate([[0], np.cumsum(inner)])
        bend = np.arange(bend_off[-1]) - np.repeat(bend_off[:-1], inner) + np.repeat(b_at[:-1], inner) + 1
        for ia, ib in _row_pairs(pa_row, bend_off, budget):
            v = bend[ib]
            add(ia, *_sector_spans(a[pa_first[ia]], a[pa_first[ia] + 1], b[v - 1], b[v], b[v + 1], radius[pa_row[ia]]))
    if not rows:
        return np.empty(0, dtype=np.int64), np.empty(0), np.empty(0)
    return _merge(np.concatenate(rows), np.concatenate(starts), np.concatenate(ends))


def _row_pairs(row, off, budget):
    """All pairs (item, partner) of a row, in slices: ``row`` of each item, ``off`` of each row's partners."""
    count = np.diff(off)[row]
    cum = np.concatenate([[0], np.cumsum(count)])
    begin = 0
    while begin < len(row):
        stop = max(begin + 1, int(np.searchsorted(cum, cum[begin] + budget, side="right")) - 1)
        n = count[begin:stop]
        item = np.repeat(np.arange(begin, stop), n)
        yield item, np.arange(len(item)) - np.repeat(cum[begin:stop] - cum[begin], n) + np.repeat(off[row[begin:stop]], n)
        begin = stop


def _between(value, slope, low, high):
    """Where low <= value + t * slope <= high: first and last t, and whether any."""
    flat = slope == 0
    safe = np.where(flat, 1.0, slope)
    t1, t2 = np.where(flat, -np.inf, (low - value) / safe), np.where(flat, np.inf, (high - value) / safe)
    return np.minimum(t1, t2), np.maximum(t1, t2), ~flat | ((value >= low) & (value <= high))


def _dot(p, q):
    return p[:, 0] * q[:, 0] + p[:, 1] * q[:, 1]


def _in_disc(rel, d, r):
    """The same for |rel + t * d| <= r."""
    a, b, c = _dot(d, d), _dot(rel, d), _dot(rel, rel) - r**2
    still, disc = a == 0, b * b - a * c
    safe, root = np.where(still, 1.0, a), np.sqrt(np.maximum(disc, 0))
    return np.where(still, 0.0, (-b - root) / safe), np.where(still, 1.0, (-b + root) / safe), np.where(still, c <= 0, disc >= 0)


def _sector_spans(p0, p1, before, at, after, r):
    """Parameter span of each segment p inside the disc round a vertex, ahead of what leads to it and behind what leaves it."""
    d, rel = p1 - p0, p0 - at
    parts = [_in_disc(rel, d, r)]
    for way, low, high in ((at - before, 0.0, np.inf), (after - at, -np.inf, 0.0)):
        parts.append(_between((rel * way).sum(axis=1), (d * way).sum(axis=1), low, high))
    lo = np.maximum.reduce([np.zeros(len(p0)), *(x[0] for x in parts)])
    hi = np.minimum.reduce([np.ones(len(p0)), *(x[1] for x in parts)])
    ok = np.logical_and.reduce([x[2] for x in parts])
    return np.where(ok, lo, np.inf), np.where(ok, hi, -np.inf)


def _segment_spans(p0, p1, q0, q1, r, discs=True):
    """Parameter span [lo, hi] of each segment p inside the r-neighbourhood of its segment q, with or without end discs; lo > hi if none."""
    d = p1 - p0
    lo, hi = np.full(len(p0), np.inf), np.full(len(p0), -np.inf)

    def add(start, end, ok):
        ok = ok & (end >= 0) & (start <= 1)
        start, end = np.clip(start, 0, 1), np.clip(end, 0, 1)
        ok = ok & (start <= end)
        np.minimum(lo, np.where(ok, start, np.inf), out=lo)
        np.maximum(hi, np.where(ok, end, -np.inf), out=hi)

    for centre in (q0, q1) if discs else ():
        add(*_in_disc(p0 - centre, d, r))
    q = q1 - q0
    length = np.hypot(q[:, 0], q[:, 1])
    unit = q / np.where(length > 0, length, 1.0)[:, None]
    normal = np.column_stack([-unit[:, 1], unit[:, 0]])
    rel = p0 - q0
    along = _between(_dot(rel, unit), _dot(d, unit), 0.0, length)
    across = _between(_dot(rel, normal), _dot(d, normal), -r, r)
    start, end = np.maximum(along[0], across[0]), np.minimum(along[1], across[1])
    add(start, end, along[2] & across[2] & (start <= end) & (length > 0))
    return lo, hi


def _merge(row, start, end):
    """Union of spans per row; spans that touch join."""
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], end[order]
    if not len(row):
        return row, start, end
    lift = row * (end.max() - min(start.min(), 0.0) + 1.0)
    reach = np.maximum.accumulate(end + lift)
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (start[1:] + lift[1:] > reach[:-1] + 1e-11)])
    first = np.flatnonzero(new)
    return row[first], start[first], np.maximum.reduceat(end, first)


def _gaps(n_rows, row, start, end, total, tiny=1e-10):
    """What merged spans leave free of [0, total] of each row."""
    all_rows = np.arange(n_rows)
    rows = np.concatenate([row, all_rows])
    free_from = np.concatenate([end, np.zeros(n_rows)])
    begins = np.concatenate([row, all_rows])
    free_to = np.concatenate([start, total])
    o1, o2 = np.lexsort((free_from, rows)), np.lexsort((free_to, begins))
    rows, s, e = rows[o1], free_from[o1], free_to[o2]
    keep = e - s > tiny
    return rows[keep], s[keep], e[keep]


def batch_simplify(xy, at_, tolerance):
    """Douglas-Peucker on all lines of a batch, one split level at a time; returns the vertices to keep."""
    keep = np.zeros(len(xy), dtype=bool)
    filled = np.flatnonzero(np.diff(at_) > 0)
    i, j, t = at_[filled], at_[filled + 1] - 1, tolerance[filled]
    keep[i] = keep[j] = True
    while True:
        open_ = j - i >= 2
        i, j, t = i[open_], j[open_], t[open_]
        if not len(i):
            return keep
        n = j - i - 1
        begin = np.concatenate([[0], np.cumsum(n)[:-1]])
        inner = np.repeat(i + 1 - begin, n) + np.arange(n.sum())
        a = xy[np.repeat(i, n)]
        d = xy[np.repeat(j, n)] - a
        sq = (d**2).sum(axis=1)
        rel = xy[inner] - a
        u = np.where(sq > 0, (rel * d).sum(axis=1) / np.where(sq > 0, sq, 1), 0.0).clip(0, 1)
        dist = np.hypot(*(rel - u[:, None] * d).T)
        worst = np.maximum.reduceat(dist, begin)
        k = np.minimum.reduceat(np.where(dist == np.repeat(worst, n), inner, len(xy)), begin)
        split = worst > t
        i, j, k, t = i[split], j[split], k[split], t[split]
        keep[k] = True
        i, j, t = np.concatenate([i, k]), np.concatenate([k, j]), np.concatenate([t, t])


# ---- Arrow UDFs over lines ------------------------------------------------------------------


@F.arrow_udf(DOUBLE)
def hausdorff(a: pa.Array, b: pa.Array) -> pa.Array:
    """Discrete Hausdorff distance: vertices of each line against the segments of the other."""
    one, one_at = _coords(a)
    two, two_at = _coords(b)
    ok = (np.diff(one_at) >= 2) & (np.diff(two_at) >= 2)
    worst = np.zeros(len(ok))
    for p, p_at, q, q_at in ((one, one_at, two, two_at), (two, two_at, one, one_at)):
        row = np.repeat(np.arange(len(ok)), np.diff(p_at))
        use = ok[row]
        _, near = batch_locate(q, q_at, p[use], row[use])
        np.maximum.at(worst, row[use], near)
    return pa.array(worst, pa.float64(), mask=~ok)


def _spans_column(n_rows, row, start, end):
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n_rows))]).astype(np.int32)
    fields = pa.StructArray.from_arrays([pa.array(start, pa.float64()), pa.array(end, pa.float64())], names=["s", "e"])
    return pa.ListArray.from_arrays(pa.array(offsets), fields)


def _near(a, b, radius, flat_ends=False):
    xy, a_at = _coords(a)
    other, b_at = _coords(b)
    return xy, a_at, b_at, batch_near_spans(xy, a_at, other, b_at, _doubles(radius), flat_ends)


@F.arrow_udf(T.BooleanType())
def inside_buffer(a: pa.Array, b: pa.Array, radius: pa.Array) -> pa.Array:
    """True when all of ``a`` lies within ``radius`` of ``b``; empty lines never do."""
    xy, a_at, b_at, spans = _near(a, b, radius)
    n = len(a_at) - 1
    free, _, _ = _gaps(n, *spans, batch_stations(xy, a_at)[1])
    ok = (np.diff(a_at) >= 2) & (np.diff(b_at) >= 2)
    ok[free] = False
    return pa.array(ok)


@F.arrow_udf(SPANS)
def spans_near(a: pa.Array, b: pa.Array, radius: pa.Array) -> pa.Array:
    """Spans of positions along ``a`` within ``radius`` of ``b``."""
    _, a_at, _, spans = _near(a, b, radius)
    return _spans_column(len(a_at) - 1, *spans)


@F.arrow_udf(SPANS)
def spans_near_flat(a: pa.Array, b: pa.Array, radius: pa.Array) -> pa.Array:
    """The same with a neighbourhood that stops square at the ends of ``b``."""
    _, a_at, _, spans = _near(a, b, radius, flat_ends=True)
    return _spans_column(len(a_at) - 1, *spans)


@F.arrow_udf(SPANS)
def spans_away(a: pa.Array, b: pa.Array, radius: pa.Array) -> pa.Array:
    """Spans of positions along ``a`` farther than ``radius`` from ``b`` (all of it when ``b`` is empty)."""
    xy, a_at, _, spans = _near(a, b, radius)
    n = len(a_at) - 1
    return _spans_column(n, *_gaps(n, *spans, batch_stations(xy, a_at)[1]))


@F.arrow_udf(SPANS)
def project_spans(line: pa.Array, other: pa.Array, spans: pa.Array) -> pa.Array:
    """Ends of spans along ``other``, projected on ``line``, in increasing order."""
    xy, at_ = _coords(line)
    o, o_at = _coords(other)
    ends, s_at = _coords(spans)
    row = np.repeat(np.arange(len(s_at) - 1), np.diff(s_at))
    use = (np.diff(at_) >= 2)[row] & (np.diff(o_at) >= 2)[row]
    ends, row = ends[use], row[use]
    rows = np.repeat(row, 2)
    places, _ = batch_locate(xy, at_, batch_at(o, o_at, ends.ravel(), rows), rows) if len(rows) else (np.empty(0), None)
    places = np.sort(places.reshape(-1, 2), axis=1)
    return _spans_column(len(s_at) - 1, row, places[:, 0], places[:, 1])


@F.arrow_udf(DOUBLE)
def project(line: pa.Array, x: pa.Array, y: pa.Array) -> pa.Array:
    """Position along the line of the place nearest to the point; NULL for an empty line or point."""
    xy, at_ = _coords(line)
    points = np.column_stack([_doubles(x), _doubles(y)])
    ok = (np.diff(at_) >= 2) & np.isfinite(points).all(axis=1)
    out = np.zeros(len(ok))
    out[ok], _ = batch_locate(xy, at_, points[ok], np.flatnonzero(ok))
    return pa.array(out, pa.float64(), mask=~ok)


@F.arrow_udf(POINT)
def interpolate(line: pa.Array, position: pa.Array) -> pa.Array:
    """Point at a position along the line, clamped to its ends."""
    xy, at_ = _coords(line)
    p = _doubles(position)
    ok = (np.diff(at_) >= 2) & np.isfinite(p)
    out = np.zeros((len(ok), 2))
    rows = np.flatnonzero(ok)
    if len(rows):
        out[ok] = batch_at(xy, at_, p[ok], rows)
    fields = [pa.array(out[:, i], pa.float64(), mask=~ok) for i in range(2)]
    return pa.StructArray.from_arrays(fields, names=["x", "y"])


@F.arrow_udf(POINTS)
def substring(line: pa.Array, start: pa.Array, end: pa.Array) -> pa.Array:
    """Part of the line between two positions."""
    xy, at_ = _coords(line)
    return _points_column(*batch_cut(xy, at_, np.nan_to_num(_doubles(start)), np.nan_to_num(_doubles(end))))


def _points_column(xy, at_):
    fields = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], names=["x", "y"])
    return pa.ListArray.from_arrays(pa.array(at_.astype(np.int32)), fields)


def _kept(xy, at_, keep):
    return xy[keep], np.concatenate([[0], np.cumsum(keep)])[at_]


@F.arrow_udf(POINTS)
def simplify(line: pa.Array, tolerance: pa.Array) -> pa.Array:
    """Douglas-Peucker with a tolerance per row."""
    xy, at_ = _coords(line)
    return _points_column(*_kept(xy, at_, batch_simplify(xy, at_, _doubles(tolerance))))


@F.arrow_udf(POINTS)
def simplify_to(line: pa.Array, max_points: pa.Array) -> pa.Array:
    """Simplify with a tolerance doubled from 1e-7 until the line has at most that many vertices."""
    xy, at_ = _coords(line)
    limit, tolerance = np.maximum(_doubles(max_points), 2), 1e-7
    while (np.diff(at_) > limit).any():
        # Lines that are short enough keep every vertex.
        rows = np.where(np.diff(at_) > limit, tolerance, -1.0)
        xy, at_ = _kept(xy, at_, batch_simplify(xy, at_, rows))
        tolerance *= 2
    return _points_column(xy, at_)


@F.arrow_udf(SPANS)
def circle_span(line: pa.Array, x: pa.Array, y: pa.Array, radius: pa.Array) -> pa.Array:
    """First and last position along the line inside a circle, as zero or one span."""
    xy, at_ = _coords(line)
    n = len(at_) - 1
    centre = np.repeat(np.column_stack([_doubles(x), _doubles(y)]), 2, axis=0)
    row, start, end = batch_near_spans(xy, at_, centre, 2 * np.arange(n + 1), _doubles(radius))
    if not len(row):
        return _spans_column(n, row, start, end)
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    last = np.concatenate([first[1:] - 1, [len(row) - 1]])
    return _spans_column(n, row[first], start[first], end[last])


def batch_spans_in_polygon(xy, at_, poly, r_at, budget=2_000_000):
    """Merged spans of positions along each line inside its ring, by cuts at all crossings and a test of each piece's middle.

    All pairs of segments and edges of a batch go through numpy together, in slices of at most ``budget`` pairs.
    """
    ok = (np.diff(at_) >= 2) & (np.diff(r_at) >= 3)
    station, _ = batch_stations(xy, at_)
    first, row, _ = _segments(xy, at_)
    first, row = first[ok[row]], row[ok[row]]
    after = np.arange(1, len(poly) + 1)
    some = np.diff(r_at) > 0
    after[r_at[1:][some] - 1] = r_at[:-1][some]
    vertex_row = np.repeat(np.arange(len(ok)), np.diff(at_))
    rows, cuts = [vertex_row[ok[vertex_row]]], [station[ok[vertex_row]]]
    for seg, corner in _row_pairs(row, r_at, budget):
        begin = first[seg]
        d, edge, rel = xy[begin + 1] - xy[begin], poly[after[corner]] - poly[corner], poly[corner] - xy[begin]
        cross = d[:, 0] * edge[:, 1] - d[:, 1] * edge[:, 0]
        safe = np.where(cross == 0, 1.0, cross)
        t = (rel[:, 0] * edge[:, 1] - rel[:, 1] * edge[:, 0]) / safe
        u = (rel[:, 0] * d[:, 1] - rel[:, 1] * d[:, 0]) / safe
        hit = (cross != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
        begin = begin[hit]
        rows.append(row[seg[hit]])
        cuts.append(station[begin] + t[hit] * (station[begin + 1] - station[begin]))
    rows, cuts = np.concatenate(rows), np.concatenate(cuts)
    order = np.lexsort((cuts, rows))
    rows, cuts = rows[order], cuts[order]
    piece = np.flatnonzero((rows[1:] == rows[:-1]) & (cuts[1:] != cuts[:-1]))
    rows, start, end = rows[piece], cuts[piece], cuts[piece + 1]
    middle = batch_at(xy, at_, (end + start) / 2, rows) if len(rows) else np.empty((0, 2))
    crossed = np.zeros(len(rows), dtype=np.int64)
    for at_middle, corner in _row_pairs(rows, r_at, budget):
        e, f, m = poly[corner], poly[after[corner]], middle[at_middle]
        above = (e[:, 1] > m[:, 1]) != (f[:, 1] > m[:, 1])
        with np.errstate(all="ignore"):
            x_at = e[:, 0] + (m[:, 1] - e[:, 1]) * (f[:, 0] - e[:, 0]) / (f[:, 1] - e[:, 1])
        crossed += np.bincount(at_middle[above & (m[:, 0] < x_at)], minlength=len(rows))
    inside = crossed % 2 == 1
    return _merge(rows[inside], start[inside], end[inside])


@F.arrow_udf(SPANS)
def spans_in_polygon(line: pa.Array, ring: pa.Array) -> pa.Array:
    """Spans of positions along the line inside a polygon, even-odd rule; the ring need not be closed or valid."""
    xy, at_ = _coords(line)
    return _spans_column(len(at_) - 1, *batch_spans_in_polygon(xy, at_, *_coords(ring)))


@F.arrow_udf(POINTS)
def decode_polyline(text: pa.Array) -> pa.Array:
    """Points of precision-6 polyline text: 5-bit groups, zig-zag steps, latitude before longitude."""
    out = []
    for value in text.to_pylist():
        code = np.frombuffer((value or "").encode("latin-1"), dtype=np.uint8).astype(np.int64) - 63
        if not len(code):
            out.append(np.empty((0, 2)))
            continue
        last = np.flatnonzero(code < 32)
        first = np.concatenate([[0], last[:-1] + 1])
        group = np.repeat(np.arange(len(last)), last - first + 1)
        shift = 5 * (np.arange(len(group)) - first[group])
        raw = np.zeros(len(last), dtype=np.int64)
        np.add.at(raw, group, (code[: len(group)] & 31) << shift)
        step = np.where(raw & 1, ~(raw >> 1), raw >> 1)
        step = step[: len(step) // 2 * 2].reshape(-1, 2).cumsum(axis=0)
        out.append(np.round(step[:, ::-1] / 1e6, 6))
    return _list_of_structs(out, _PA_POINTS, ["x", "y"])


@F.arrow_udf(POINTS)
def points_of_wkb(data: pa.Array) -> pa.Array:
    """Vertices of a WKB point or line string (both byte orders; extra ordinates are dropped)."""
    out = []
    for value in data.to_pylist():
        if not value:
            out.append(np.empty((0, 2)))
            continue
        order = "<" if value[0] == 1 else ">"
        kind = int(np.frombuffer(value, order + "u4", 1, 1)[0])
        skip = 9 if kind & 0x20000000 else 5
        flags = bool(kind & 0x80000000) + bool(kind & 0x40000000) + {0: 0, 1: 1, 2: 1, 3: 2}[(kind & 0xFFFF) // 1000]
        base, dims = (kind & 0xFFFF) % 1000, 2 + min(flags, 2)
        if base == 1:
            n, skip = 1, skip
        elif base == 2:
            n, skip = int(np.frombuffer(value, order + "u4", 1, skip)[0]), skip + 4
        else:
            raise ValueError(f"WKB type {base} is not a point or a line")
        out.append(np.frombuffer(value, order + "f8", n * dims, skip).reshape(n, dims)[:, :2].astype(float))
    return _list_of_structs(out, _PA_POINTS, ["x", "y"])
