"""Features of critical sections: driving side, geometry, vehicle traces, road signs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from waymark import values as v
from waymark.functions import geo, kernels as k
from waymark.operators.barrier import explode_once, keep_where
from waymark.operators.pairs import cell_join


def general_features(country: Column, metric: Column) -> Column:
    left = F.when(F.coalesce(country.isin(*v.LEFT_DRIVING), F.lit(False)), F.lit(1.0)).otherwise(F.lit(0.0))
    return F.struct(
        F.when(metric == v.METRIC_DEFAULT, 1).otherwise(0).alias("is_tbt"),
        F.when(metric == v.METRIC_LONG, 1).otherwise(0).alias("is_hdr"),
        left.alias("drive_left_side"), (1.0 - left).alias("drive_right_side"),
    )


# ---- geometry --------------------------------------------------------------------------------


def _gradient(values: Column) -> Column:
    """Central differences, one-sided at the ends."""
    n = F.size(values)
    return F.transform(
        values,
        lambda x, i: F.when(i == 0, F.get(values, F.lit(1)) - x)
        .when(i == n - 1, x - F.get(values, n - 2))
        .otherwise((F.get(values, i + 1) - F.get(values, i - 1)) / 2),
    )


def _turn(u: Column, w: Column) -> Column:
    """Angle between unit vectors; the sign is the dot product with the reversed first vector, as defined."""
    dot = F.least(F.greatest(u["x"] * w["x"] + u["y"] * w["y"], F.lit(-1.0)), F.lit(1.0))
    return F.signum(u["y"] * w["x"] + u["x"] * w["y"]) * F.degrees(F.acos(dot))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


GEOMETRIC = [
    "right_turns", "route_length", "stretch_length", "stretch_start_position_in_route", "stretch_end_position_in_route",
    "stretch_starts_at_the_route_start", "stretch_ends_at_the_route_end", "heading_stretch", "left_turns", "straight_turns",
    "total_right_angle", "max_right_angle", "total_left_angle", "max_left_angle", "absolute_angle", "has_left_turns",
    "has_right_turns", "min_curvature", "max_curvature", "mean_curvature", "distance_start_end_stretch", "route_coverage",
    "stretch_covers_route", "tortuosity", "sinuosity", "density",
]
_MAX_DOUBLE = 1.7976931348623157e308


def turn_features(df: DataFrame, stretch: str) -> DataFrame:
    """Turn, angle, tortuosity and curvature columns of a line column; expressions only, no Python."""
    df = df.withColumn("_xs", F.transform(stretch, lambda p: p["x"])).withColumn("_ys", F.transform(stretch, lambda p: p["y"]))
    unit = F.transform(
        geo.segments(stretch),
        lambda s: F.struct(
            (s["b"]["x"] - s["a"]["x"]).alias("x"), (s["b"]["y"] - s["a"]["y"]).alias("y"),
        ),
    )
    unit = F.transform(
        unit,
        lambda d: F.when(
            F.hypot(d["x"], d["y"]) > 1e-8,
            F.struct((d["x"] / F.hypot(d["x"], d["y"])).alias("x"), (d["y"] / F.hypot(d["x"], d["y"])).alias("y")),
        ).otherwise(d),
    )
    out = df.withColumn("_u", unit).withColumn("_gx", _gradient(F.col("_xs"))).withColumn("_gy", _gradient(F.col("_ys")))
    m = F.greatest(F.size("_u") - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice("_u", 1, m).alias("u"), F.slice("_u", 2, m).alias("w"))
    out = out.withColumn("_angles", F.transform(pairs, lambda z: _turn(z["u"], z["w"])))
    out = out.withColumn("_hx", _gradient(F.col("_gx"))).withColumn("_hy", _gradient(F.col("_gy")))

    def bend(z):
        top = F.abs(z["hx"] * z["gy"] - z["gx"] * z["hy"])
        base = F.pow(z["gx"] * z["gx"] + z["gy"] * z["gy"], 1.5)
        return F.when(base > 0, top / base).when(top == 0, F.lit(0.0)).otherwise(F.lit(_MAX_DOUBLE))

    zipped = F.arrays_zip(F.col("_gx").alias("gx"), F.col("_gy").alias("gy"), F.col("_hx").alias("hx"), F.col("_hy").alias("hy"))
    out = out.withColumn("_bend", F.transform(zipped, bend))
    right, left = F.filter("_angles", lambda a: a > 45), F.filter("_angles", lambda a: a < -45)
    wide = lambda arr: F.transform(arr, lambda a: F.abs(a))
    out = out.withColumn("_right", wide(right)).withColumn("_left", wide(left))
    columns = {
        "right_turns": F.size("_right"),
        "left_turns": F.size("_left"),
        "straight_turns": F.size("_angles") - F.size("_right") - F.size("_left"),
        "total_right_angle": _sum(F.col("_right")),
        "max_right_angle": F.coalesce(F.array_max("_right"), F.lit(0.0)),
        "total_left_angle": _sum(F.col("_left")),
        "max_left_angle": F.coalesce(F.array_max("_left"), F.lit(0.0)),
        "absolute_angle": _sum(F.col("_angles")),
        "has_left_turns": (F.size("_left") > 0).cast("double"),
        "has_right_turns": (F.size("_right") > 0).cast("double"),
        "heading_stretch": _turn(F.try_element_at("_u", F.lit(1)), F.try_element_at("_u", F.lit(-1))),
        "min_curvature": F.array_min("_bend"),
        "max_curvature": F.array_max("_bend"),
        "mean_curvature": _sum(F.col("_bend")) / F.size("_bend"),
        "tortuosity": _sum(F.transform("_angles", lambda a: F.abs(a))) / (F.size("_u") * 180),
    }
    helpers = ["_xs", "_ys", "_u", "_gx", "_gy", "_hx", "_hy", "_angles", "_bend", "_right", "_left"]
    return out.withColumns(columns).drop(*helpers)


def geometric_features(df: DataFrame, route: str = "route", stretch: str = "stretch") -> DataFrame:
    """All geometric features of rows with route and stretch lines (point arrays)."""
    a, b = geo.first(stretch), geo.last(stretch)
    out = turn_features(df, stretch).withColumns(
        {
            "route_length": k.geodesic_length(route),
            "stretch_length": k.geodesic_length(stretch),
            "_start": k.project(route, a["x"], a["y"]),
            "_end": k.project(route, b["x"], b["y"]),
            "_planar": geo.planar_length(route),
            "distance_start_end_stretch": k.geodesic_distance(a["x"], a["y"], b["x"], b["y"]),
        }
    )
    share = lambda c: F.coalesce(F.try_divide(F.col(c), F.col("_planar")), F.lit(0.0))
    length = F.col("stretch_length")
    out = out.withColumns({"stretch_start_position_in_route": share("_start"), "stretch_end_position_in_route": share("_end")})
    out = out.withColumns(
        {
            "stretch_starts_at_the_route_start": (F.col("stretch_start_position_in_route") < 1e-8).cast("double"),
            "stretch_ends_at_the_route_end": (F.col("stretch_end_position_in_route") > 0.9999999).cast("double"),
            "route_coverage": F.when(F.col("route_length") == 0, F.lit(0.0)).otherwise(length / F.nullif(F.col("route_length"), F.lit(0.0))),
            "sinuosity": F.when(length == 0, F.lit(0.0)).otherwise(F.col("distance_start_end_stretch") / F.nullif(length, F.lit(0.0))),
            "density": F.when(length == 0, F.lit(0.0)).otherwise(F.size(stretch) / F.nullif(length, F.lit(0.0))),
        }
    ).withColumn("stretch_covers_route", (F.col("route_coverage") == 1).cast("double"))
    return out.drop("_start", "_end", "_planar")


# ---- traces ----------------------------------------------------------------------------------

TRACE_FEATURES = [
    "tot_new", "pra_new", "prb_new", "pra_not_b", "prb_not_a", "pra_and_b", "pra_to_b", "prb_to_a", "tot_contained",
    "pra_to_b_contained", "prb_to_a_contained", "pra_to_b_not_contained", "prb_to_a_not_contained", "traffic_direction",
    "traffic_direction_contained", "ab_intersect",
]
# Fewer traces than this give no shares; checks use a circle this much wider; ends closer than this are one place.
MIN_TRACES = 6
CHECK_FACTOR = 1.1
SAME_PLACE_FACTOR = 2.05
WINDOW_DAYS = 14
_PERIOD = WINDOW_DAYS + 1


def checked_dates(df: DataFrame, date: str, today: Column) -> DataFrame:
    """``date_end`` from the column; a date in the future is an error."""
    bad = F.raise_error(F.concat(F.lit("date in the future: "), F.col(date).cast("string")))
    return df.withColumn("date_end", F.when(F.col(date) > today, bad.cast("date")).otherwise(F.col(date)))


def trace_pairs(sections: DataFrame, traces: DataFrame, radius: float = v.TRACE_BUFFER, size: float = 0.005) -> DataFrame:
    """(section, trace) rows: traces of the two weeks up to ``date_end`` that come into the section's corridor.

    The join key is a grid cell and a 15-day period: a trace has one period, a section one or two.
    """
    day = F.unix_date("date_end")
    s = explode_once(sections, F.sequence(F.floor((day - WINDOW_DAYS) / _PERIOD), F.floor(day / _PERIOD)), "_period")
    t = traces.select("trace_id", "trace_date", F.col("line").alias("trace"), F.floor(F.unix_date("trace_date") / _PERIOD).alias("_period"))
    in_window = (F.col("trace_date") <= F.col("date_end")) & (F.col("trace_date") >= F.date_sub("date_end", WINDOW_DAYS))
    pairs = cell_join(t, s, "trace_id", "trace", "stretch", size, radius, on=["_period"], extra=in_window)
    return keep_where(pairs, F.size("near") > 0, {"near": k.spans_near("trace", "stretch", F.lit(radius))})


def trace_flags(pairs: DataFrame, radius: float = v.TRACE_BUFFER) -> DataFrame:
    """What each trace does at the two ends of its section."""
    a, b = geo.first("stretch"), geo.last("stretch")
    r, wide = F.lit(radius), F.lit(CHECK_FACTOR * radius)
    rows = pairs.select("case_id", "trace_id", "trace", "near", a.alias("pa"), b.alias("pb"))
    rows = rows.withColumn("sa", F.get(k.circle_span("trace", F.col("pa.x"), F.col("pa.y"), r), F.lit(0)))
    rows = rows.withColumn("sb", F.get(k.circle_span("trace", F.col("pb.x"), F.col("pb.y"), r), F.lit(0)))
    one = (F.size("near") == 1) & (F.get("near", F.lit(0))["e"] > F.get("near", F.lit(0))["s"])
    rows = rows.withColumn("piece", k.substring("trace", F.get("near", F.lit(0))["s"], F.get("near", F.lit(0))["e"]))
    touches_a = F.size(k.circle_span("piece", F.col("pa.x"), F.col("pa.y"), wide)) > 0
    touches_b = F.size(k.circle_span("piece", F.col("pb.x"), F.col("pb.y"), wide)) > 0
    in_a, in_b = F.col("sa").isNotNull(), F.col("sb").isNotNull()
    # Only traces at both ends need the places where they first enter and last leave the two circles.
    both = F.when(in_a & in_b, F.col("trace"))
    rows = rows.withColumn("start", k.interpolate(both, F.least("sa.s", "sb.s"))).withColumn("stop", k.interpolate(both, F.greatest("sa.e", "sb.e")))

    def within(p, centre):
        return F.coalesce(geo.planar_distance(p, F.col(centre)) <= wide, F.lit(False))

    rows = rows.withColumn("contained", one & touches_a & touches_b)
    return rows.select(
        "case_id", "trace_id", in_a.alias("in_a"), in_b.alias("in_b"),
        (in_a & in_b & within(F.col("start"), "pa") & within(F.col("stop"), "pb")).alias("a_to_b"),
        (in_a & in_b & within(F.col("start"), "pb") & within(F.col("stop"), "pa")).alias("b_to_a"),
        "contained",
        (F.col("contained") & within(geo.first("piece"), "pa") & within(geo.last("piece"), "pb")).alias("a_to_b_contained"),
        (F.col("contained") & within(geo.first("piece"), "pb") & within(geo.last("piece"), "pa")).alias("b_to_a_contained"),
    )


def trace_features(sections: DataFrame, traces: DataFrame, radius: float = v.TRACE_BUFFER, size: float = 0.005) -> DataFrame:
    """The trace features of every section (case_id, stretch as points, date_end); defaults where traces are too few."""
    a, b = geo.first("stretch"), geo.last("stretch")
    marked = sections.select("case_id", "stretch", "date_end", (geo.planar_distance(a, b) < SAME_PLACE_FACTOR * radius).alias("_one_place"))
    flags = trace_flags(trace_pairs(marked.filter(~F.col("_one_place")).drop("_one_place"), traces, radius, size), radius)
    n = lambda c: F.count_if(c)
    sums = flags.groupBy("case_id").agg(
        F.count("*").alias("tot"), n(F.col("in_a")).alias("a"), n(F.col("in_b")).alias("b"),
        n(F.col("in_a") & ~F.col("in_b")).alias("a_only"), n(F.col("in_b") & ~F.col("in_a")).alias("b_only"),
        n(F.col("in_a") & F.col("in_b")).alias("ab"), n(F.col("a_to_b")).alias("fwd"), n(F.col("b_to_a")).alias("back"),
        n(F.col("contained")).alias("cont"), n(F.col("a_to_b_contained")).alias("fwd_c"), n(F.col("b_to_a_contained")).alias("back_c"),
    )
    rows = marked.select("case_id", "_one_place").join(sums, "case_id", "left")
    tot, cont = F.coalesce("tot", F.lit(0)), F.coalesce("cont", F.lit(0))
    enough = tot >= MIN_TRACES
    enough_c = enough & (cont >= MIN_TRACES)

    def share(top, base, ok):
        return F.when(ok & (base > 0), top.cast("double") / base).otherwise(F.lit(-2.0))

    c = F.col
    return rows.select(
        "case_id", tot.alias("tot_new"),
        share(c("a"), tot, enough).alias("pra_new"), share(c("b"), tot, enough).alias("prb_new"),
        share(c("a_only"), tot, enough).alias("pra_not_b"), share(c("b_only"), tot, enough).alias("prb_not_a"),
        share(c("ab"), tot, enough).alias("pra_and_b"), share(c("fwd"), tot, enough).alias("pra_to_b"),
        share(c("back"), tot, enough).alias("prb_to_a"), F.when(enough, cont).otherwise(F.lit(0)).alias("tot_contained"),
        share(c("fwd_c"), cont, enough_c).alias("pra_to_b_contained"), share(c("back_c"), cont, enough_c).alias("prb_to_a_contained"),
        share(c("fwd") - c("fwd_c"), tot - cont, enough_c).alias("pra_to_b_not_contained"),
        share(c("back") - c("back_c"), tot - cont, enough_c).alias("prb_to_a_not_contained"),
        share(c("fwd") - c("back"), tot, enough).alias("traffic_direction"),
        share(c("fwd_c") - c("back_c"), cont, enough_c).alias("traffic_direction_contained"),
        c("_one_place").cast("int").alias("ab_intersect"),
    )


# ---- signs -----------------------------------------------------------------------------------

_SIGN_SCHEMA = "struct<features: array<struct<properties: struct<sign: string, CLUSTER_SIZE: double>>>>"


def sign_features(df: DataFrame, response: str, min_occurrences: int = 2, signs: list[str] | None = None) -> DataFrame:
    """One 0/1 column per sign: seen more than ``min_occurrences`` times; bad or empty JSON gives zeros.

    The response is parsed once and the columns come from it in the same row: no explode, no pivot.
    """
    parsed = F.from_json(F.col(response), _SIGN_SCHEMA)["features"]
    often = F.filter(parsed, lambda f: F.coalesce(f["properties"]["CLUSTER_SIZE"], F.lit(1.0)) > min_occurrences)
    seen = F.coalesce(F.transform(often, lambda f: f["properties"]["sign"]), F.array().cast("array<string>"))
    out = df.withColumn("_seen", seen)
    return out.withColumns(
        {s: F.coalesce(F.array_contains("_seen", s), F.lit(False)).cast("int") for s in signs or v.SIGNS}
    ).drop("_seen")
