"""Geometry as column expressions over ``array<struct<x, y>>``: no Python at run time."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from waymark.functions import kernels as k
from waymark.values import EARTH_RADIUS_M


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _at(array: Column, index) -> Column:
    """Element counted from 1 (or from the end); NULL beyond the ends, so empty lines give NULL."""
    return F.try_element_at(array, F.lit(index) if isinstance(index, int) else index)


def point(x, y) -> Column:
    return F.struct(_c(x).cast("double").alias("x"), _c(y).cast("double").alias("y"))


def _points_of_text(inner: Column) -> Column:
    pairs = F.filter(F.split(inner, ","), lambda p: F.length(F.trim(p)) > 0)
    # Two steps: within one, the text of a vertex would be split for x and again for y.
    numbers = F.transform(pairs, lambda p: F.split(F.trim(p), r"\s+"))
    return F.transform(numbers, lambda n: F.struct(_at(n, 1).cast("double").alias("x"), _at(n, 2).cast("double").alias("y")))


def points_of_wkt(wkt: Column | str) -> Column:
    """Vertices of POINT / LINESTRING / MULTI... text; parts are concatenated, EMPTY gives an empty array."""
    inner = F.regexp_replace(F.regexp_extract(_c(wkt), r"^[A-Z ]*?\s*(\(.*\))\s*$", 1), r"[()]", "")
    return F.when(_c(wkt).isNotNull(), _points_of_text(inner))


def lines_of_wkt(wkt: Column | str) -> Column:
    """Array of lines: one for LINESTRING, one per part of MULTILINESTRING."""
    inner = F.regexp_extract(_c(wkt), r"\((.*)\)", 1)
    parts = F.filter(F.split(inner, r"\)\s*,\s*\("), lambda p: F.length(F.trim(p)) > 0)
    return F.transform(parts, lambda p: _points_of_text(F.regexp_replace(p, r"[()]", "")))


def parse_geometry(text: Column | str) -> Column:
    """WKT by its first four letters, anything else as hexadecimal WKB."""
    is_wkt = F.substring(_c(text), 1, 4).isin("LINE", "POIN", "MULT", "POLY")
    wkb = k.points_of_wkb(F.when(~is_wkt, F.unhex(_c(text))))
    return F.when(is_wkt, points_of_wkt(text)).when(_c(text).isNotNull(), wkb)


def wkt_of_points(points: Column | str, kind: str = "LINESTRING") -> Column:
    body = F.array_join(F.transform(_c(points), lambda p: F.concat_ws(" ", p["x"], p["y"])), ", ")
    return F.when(F.size(_c(points)) == 0, F.lit(f"{kind} EMPTY")).otherwise(
        F.concat(F.lit(f"{kind} ("), body, F.lit(")"))
    )


def is_empty(wkt: Column | str) -> Column:
    return F.coalesce(_c(wkt).rlike(r"EMPTY\s*$"), F.lit(True))


def is_valid_line(wkt: Column | str) -> Column:
    """A line is valid when it has at least two different vertices."""
    return F.size(F.array_distinct(points_of_wkt(wkt))) >= 2


def first(points) -> Column:
    return _at(_c(points), 1)


def last(points) -> Column:
    return _at(_c(points), -1)


def segments(points: Column | str) -> Column:
    """Consecutive vertex pairs as ``struct<a, b>``."""
    p = _c(points)
    n = F.greatest(F.size(p) - 1, F.lit(0))
    return F.arrays_zip(F.slice(p, 1, n).alias("a"), F.slice(p, 2, n).alias("b"))


def haversine_m(a: Column, b: Column) -> Column:
    lat = F.radians(b["y"] - a["y"]) / 2
    lon = F.radians(b["x"] - a["x"]) / 2
    h = F.sin(lat) * F.sin(lat) + F.cos(F.radians(a["y"])) * F.cos(F.radians(b["y"])) * F.sin(lon) * F.sin(lon)
    return F.lit(2 * EARTH_RADIUS_M) * F.atan2(F.sqrt(h), F.sqrt(F.lit(1.0) - h))


def haversine_length(points: Column | str) -> Column:
    return F.aggregate(segments(points), F.lit(0.0), lambda acc, s: acc + haversine_m(s["a"], s["b"]))


def planar_length(points: Column | str) -> Column:
    return F.aggregate(
        segments(points), F.lit(0.0), lambda acc, s: acc + F.hypot(s["b"]["x"] - s["a"]["x"], s["b"]["y"] - s["a"]["y"])
    )


def planar_distance(a: Column, b: Column) -> Column:
    return F.hypot(b["x"] - a["x"], b["y"] - a["y"])


def heading(a: Column, b: Column) -> Column:
    """Great-circle heading in degrees, clockwise from north, in (-180, 180]."""
    lon = F.radians(b["x"] - a["x"])
    lat_a, lat_b = F.radians(a["y"]), F.radians(b["y"])
    return F.degrees(
        F.atan2(
            F.cos(lat_b) * F.sin(lon), F.cos(lat_a) * F.sin(lat_b) - F.sin(lat_a) * F.cos(lat_b) * F.cos(lon)
        )
    )


def line_heading(points) -> Column:
    return heading(first(points), last(points))


def planar_angle(a: Column, b: Column) -> Column:
    """Angle of a vector against the north axis, in [0, 360)."""
    return F.pmod(F.degrees(F.atan2(b["y"] - a["y"], b["x"] - a["x"])) - 90, F.lit(360.0))


def angle_difference(a: Column, b: Column) -> Column:
    """Signed difference in [-180, 180)."""
    return F.pmod(a - b + 180, F.lit(360.0)) - 180


def bearing(points) -> Column:
    """Geodesic azimuth from the first to the last vertex."""
    a, b = first(points), last(points)
    return k.geodesic_azimuth(a["x"], a["y"], b["x"], b["y"])


def trace_seconds(trace) -> Column:
    """Last minus first time stamp of a trace ``array<struct<x, y, t>>``."""
    return last(trace)["t"] - first(trace)["t"]


def trace_speed(trace, length_m: Column) -> Column:
    """Mean speed; 0 when the time span is at most one millisecond."""
    return F.when(F.abs(trace_seconds(trace)) <= 0.001, F.lit(0.0)).otherwise(length_m / trace_seconds(trace))


def bbox(points: Column | str, pad: float = 0.0) -> Column:
    p = _c(points)
    xs, ys = F.transform(p, lambda q: q["x"]), F.transform(p, lambda q: q["y"])
    return F.struct(
        (F.array_min(xs) - pad).alias("min_x"), (F.array_min(ys) - pad).alias("min_y"),
        (F.array_max(xs) + pad).alias("max_x"), (F.array_max(ys) + pad).alias("max_y"),
    )


def subroute(points, start: Column, end: Column) -> Column:
    """Vertices from index ``start`` to ``end`` (both counted from 0, inclusive)."""
    return F.slice(_c(points), start + 1, end - start + 1)


def round_points(points, digits: int = 2) -> Column:
    """Vertices rounded half-up; adding 0.0 turns -0.0 into 0.0 so that keys compare equal."""
    return F.transform(
        _c(points), lambda p: F.struct((F.round(p["x"], digits) + 0.0).alias("x"), (F.round(p["y"], digits) + 0.0).alias("y"))
    )


def flatten_lines(lines) -> Column:
    return F.flatten(_c(lines))


def combine_lines(a, b) -> Column:
    """One line out of two: joined without the shared vertex when ends touch, else one after the other."""
    a, b = _c(a), _c(b)
    tail_b, tail_a = F.slice(b, 2, F.greatest(F.size(b) - 1, F.lit(0))), F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0)))
    return (
        F.when(last(a) == first(b), F.concat(a, tail_b))
        .when(last(b) == first(a), F.concat(b, tail_a))
        .otherwise(F.concat(a, b))
    )


def merge_lines(lines) -> Column:
    """Chain a sequence of lines: a line that starts where the chain ends (or ends where it starts) joins it."""
    lines = _c(lines)
    rest = F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))
    return F.aggregate(rest, _at(lines, 1), lambda acc, line: combine_lines(acc, line))


def join_nearest_ends(a, b) -> Column:
    """Turn two lines so that their nearest ends meet, then concatenate."""
    a, b = _c(a), _c(b)
    options = F.array(
        F.struct(planar_distance(first(a), first(b)).alias("d"), F.lit(0).alias("k")),
        F.struct(planar_distance(first(a), last(b)).alias("d"), F.lit(1).alias("k")),
        F.struct(planar_distance(last(a), first(b)).alias("d"), F.lit(2).alias("k")),
        F.struct(planar_distance(last(a), last(b)).alias("d"), F.lit(3).alias("k")),
    )
    kind = F.array_min(options)["k"]
    return F.concat(
        F.when(kind.isin(0, 1), F.reverse(a)).otherwise(a), F.when(kind.isin(1, 3), F.reverse(b)).otherwise(b)
    )


def merge_spans(spans: Column | str) -> Column:
    """Union of the spans ``array<struct<s, e>>`` of one row, sorted; touching spans join."""
    ordered = F.array_sort(_c(spans))
    empty = F.slice(ordered, 1, 0)

    def step(acc, span):
        top = _at(acc, -1)
        joined = F.concat(
            F.slice(acc, 1, F.size(acc) - 1),
            F.array(F.struct(top["s"].alias("s"), F.greatest(top["e"], span["e"]).alias("e"))),
        )
        return F.when((F.size(acc) > 0) & (_at(acc, -1)["e"] >= span["s"]), joined).otherwise(
            F.concat(acc, F.array(span))
        )

    return F.aggregate(ordered, empty, step)


def curvature_radius_m(points: Column | str) -> Column:
    """Chord and sagitta radius x 1e6: how far the middle vertex lies from the line's own interpolation at its x."""
    p = _c(points)
    n = F.size(p)
    # Python rounds half to even: round(n / 2).
    mid = _at(p, (F.bround(n / 2.0, 0)).cast("int") + 1)
    a, b = first(p), last(p)
    dx, dy = b["x"] - a["x"], a["y"] - b["y"]
    chord = F.hypot(dx, dy)
    # Linear interpolation of y at mid.x over the vertices in order (x increasing): right-most vertex with x <= mid.x.
    before = F.filter(p, lambda q: q["x"] <= mid["x"])
    after = F.filter(p, lambda q: q["x"] > mid["x"])
    left, right = last(before), first(after)
    # A line that runs west has no such vertices: beyond its last or before its first x the end's own y counts.
    beyond = F.when((F.size(after) == 0) | (mid["x"] > b["x"]), b["y"]).when(mid["x"] < a["x"], a["y"])
    y_at = beyond.otherwise(
        left["y"] + (right["y"] - left["y"]) * (mid["x"] - left["x"]) / (right["x"] - left["x"])
    )
    sagitta = dx / chord * (y_at - mid["y"])
    radius = F.abs(chord * chord / 8 / sagitta + sagitta / 2) * 1e6
    return F.when(n < 2, F.lit(0.0)).when(sagitta == 0, F.lit(float("inf"))).otherwise(radius)


# ---- expressions on top of the helpers -------------------------------------------------------


def following_point(line, p: Column, share: float | None = 0.1, absolute: float | None = None) -> Column:
    """The point a share of the line's length (or a fixed distance) after the projection of ``p``."""
    step = F.lit(float(absolute)) if absolute is not None else planar_length(line) * share
    return k.interpolate(_c(line), k.project(_c(line), p["x"], p["y"]) + step)


def point_bearing(p: Column, line, own_heading: Column | None = None) -> Column:
    """Heading from ``p`` to the following point; a line that is one point returns the given heading."""
    value = heading(p, following_point(line, p))
    return value if own_heading is None else F.when(F.size(_c(line)) < 2, own_heading).otherwise(value)


def direction_segment(p: Column, line, offsets=(0.0, 0.00001)) -> Column:
    """Two-point line between two forward offsets from the projection of ``p``."""
    return F.array(
        following_point(line, p, absolute=offsets[0]), following_point(line, p, absolute=offsets[1])
    )


def is_continuous(before, after, limit: float = 5.0) -> Column:
    """The last segment of ``before`` and the first of ``after`` differ by less than ``limit`` degrees."""
    before, after = _c(before), _c(after)
    out = planar_angle(_at(before, -2), last(before))
    into = planar_angle(first(after), _at(after, 2))
    return F.abs(angle_difference(out, into)) < limit


def same_direction(a, b) -> Column:
    """The ends of ``a`` projected on ``b`` increase; equal projections fall back to continuity either way."""
    a, b = _c(a), _c(b)
    start = k.project(b, first(a)["x"], first(a)["y"])
    end = k.project(b, last(a)["x"], last(a)["y"])
    return (
        F.when((F.size(a) < 2) | (F.size(b) < 2) | a.isNull() | b.isNull(), F.lit(False))
        .when(start == end, is_continuous(a, b) | is_continuous(b, a))
        .otherwise(start < end)
    )


def equal_within(a, b, radius: float) -> Column:
    """Each line lies inside the buffer of the other; empty lines never match."""
    return k.inside_buffer(_c(a), _c(b), F.lit(radius)) & k.inside_buffer(_c(b), _c(a), F.lit(radius))


def touches_within(a, b, radius: float) -> Column:
    """Some of ``a`` lies within ``radius`` of ``b``."""
    return F.size(k.spans_near(_c(a), _c(b), F.lit(radius))) > 0


def lines_in_polygon(df, line: str, ring: str, out: str = "part"):
    """One row per piece of the line inside the polygon; a row whose line does not enter keeps one empty line."""
    empty = F.slice(F.col(line), 1, 0)
    rows = df.withColumn("_spans", k.spans_in_polygon(line, ring)).withColumn("_s", F.explode_outer("_spans"))
    cut = k.substring(line, F.coalesce("_s.s", F.lit(0.0)), F.coalesce("_s.e", F.lit(0.0)))
    return rows.withColumn(out, F.when(F.col("_s").isNull(), empty).otherwise(cut)).drop("_spans", "_s")


def merge_group_lines(df, keys: list[str], seq: str, line: str):
    """The lines of each group chained in order of ``seq``; a group is the parts of one feature."""
    parts = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(seq, line))).alias("_p"))
    return parts.select(*keys, merge_lines(F.transform("_p", lambda p: p[line])).alias(line))
