"""Errors per hour and kilometre, failed routes, levels, bootstrap intervals, extrapolated rates.

A table of routes has one row per (route, finding). Time and length belong to the route, so every
metric first reduces to one row per route (map-side combined) and then sums: one shuffle on the route
key, no distinct, no self join. A metric is a function that returns aggregate columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from waymark import values
from waymark.operators.order import hash_key, value_counts_cumulative


def is_error(col: str | Column, non_errors=("discard",)) -> Column:
    """Reviewed and not one of the values that mean 'no error'."""
    col = F.col(col) if isinstance(col, str) else col
    return col.isNotNull() & ~col.isin(*non_errors)


def _true(filter_: Column | None) -> Column:
    return F.lit(True) if filter_ is None else F.coalesce(filter_, F.lit(False))


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def all_of(*filters: Column | None) -> Column | None:
    """AND of the filters that are given; None when none is."""
    given = [f for f in filters if f is not None]
    return reduce(lambda a, b: a & b, given) if given else None


def deduplicated_sum(
    df: DataFrame, column: str, key: str = "route_id", filter_: Column | None = None, order_by=(), out: str = "total"
) -> DataFrame:
    """Sum of ``column`` over the first matching row of each key."""
    require_columns(df, column, key)
    rows = df if filter_ is None else df.filter(filter_)
    order = F.struct(*[F.col(c) if isinstance(c, str) else c for c in (order_by or [column])])
    per_key = rows.groupBy(key).agg(F.min_by(column, order).alias("_v"))
    return per_key.agg(F.coalesce(F.sum("_v"), F.lit(0.0)).alias(out))


def value_counts(df: DataFrame, column: str, filter_: Column | None = None) -> DataFrame:
    require_columns(df, column)
    rows = df if filter_ is None else df.filter(filter_)
    return rows.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def error_count(column: str, filter_: Column | None = None, non_errors=("discard",)) -> Column:
    return F.count_if(is_error(column, non_errors) & _true(filter_))


def route_count(df: DataFrame, key: str = "route_id", filter_: Column | None = None, out: str = "routes") -> DataFrame:
    """Distinct keys; NULL counts as one route."""
    rows = df if filter_ is None else df.filter(filter_)
    return rows.select(key).distinct().agg(F.count("*").alias(out))


def per_route(
    df: DataFrame,
    error_col: str,
    filter_: Column | None = None,
    groups: list[str] | None = None,
    key: str = "route_id",
    measures: dict[str, str] | None = None,
    non_errors=("discard",),
) -> DataFrame:
    """One row per (groups, route): each measure once, errors and rows that pass the filter."""
    measures = measures or {}
    keep = _true(filter_)
    return df.groupBy(*(groups or []), key).agg(
        *[F.min(c).alias(n) for n, c in measures.items()],
        F.count_if(is_error(error_col, non_errors) & keep).alias("errors"),
        F.count_if(keep).alias("kept_rows"),
        F.max(is_error(error_col, non_errors) & keep).alias("failed"),
    )


def _rate(errors: Column, base: Column, kept: Column) -> Column:
    """errors / base, 0 when nothing passes the filter or the base is 0."""
    return F.when((kept == 0) | (F.coalesce(base, F.lit(0.0)) == 0), F.lit(0.0)).otherwise(
        errors.cast("double") / base
    )


def errors_per(
    df: DataFrame,
    error_col: str,
    measure_col: str,
    scale: float,
    filter_: Column | None = None,
    groups: list[str] | None = None,
    key: str = "route_id",
    out: str = "rate",
    measure_out: str = "base",
) -> DataFrame:
    """Errors that pass the filter over the unfiltered measure (seconds/3600, metres/1000), per group."""
    require_columns(df, error_col, measure_col, key, *(groups or []))
    routes = per_route(df, error_col, filter_, groups, key, {"_m": measure_col})
    summed = routes.groupBy(*(groups or [])).agg(
        F.sum("errors").alias("errors"), (F.sum("_m") / F.lit(scale)).alias(measure_out), F.sum("kept_rows").alias("_k")
    )
    return summed.withColumn(out, _rate(F.col("errors"), F.col(measure_out), F.coalesce("_k", F.lit(0)))).drop("_k")


def errors_per_hour(df, error_col, seconds_col, **kw) -> DataFrame:
    return errors_per(df, error_col, seconds_col, 3600.0, out="eph", measure_out="hours", **kw)


def errors_per_km(df, error_col, metres_col, **kw) -> DataFrame:
    return errors_per(df, error_col, metres_col, 1000.0, out="epk", measure_out="km", **kw)


def failed_routes(
    df: DataFrame, error_col: str, filter_: Column | None = None, groups: list[str] | None = None, key="route_id"
) -> DataFrame:
    """Share of routes with at least one error that passes the filter."""
    require_columns(df, error_col, key, *(groups or []))
    routes = per_route(df, error_col, filter_, groups, key)
    return (
        routes.groupBy(*(groups or []))
        .agg(
            F.count_if("failed").alias("failed"),
            F.count("*").alias("routes"),
            F.coalesce(F.sum("kept_rows"), F.lit(0)).alias("_k"),
        )
        .withColumn("failed_routes", _rate(F.col("failed"), F.col("routes").cast("double"), F.col("_k")))
        .drop("_k")
    )


def weighted_average(
    per_group: DataFrame, group: str, value: str, weights: DataFrame | None, weight: str = "weight", out: str = "value"
) -> DataFrame:
    """Sum(value * weight) / sum(weight) over the groups that occur; a NULL value keeps its weight.

    ``weights`` is a table of groups, joined like any other; AQE broadcasts it when it is small.
    """
    if weights is None:
        raise ValueError("weights must be given with a grouping column")
    return per_group.join(weights, group).agg((F.sum(F.col(value) * F.col(weight)) / F.sum(weight)).alias(out))


def weighted_errors_per_hour(
    df: DataFrame,
    error_col: str,
    seconds_col: str,
    group: str,
    weights: DataFrame | None,
    filter_: Column | None = None,
    key: str = "route_id",
) -> DataFrame:
    """Errors per hour of each group, averaged with group weights; 0 when no row passes the filter."""
    require_columns(df, group)
    if weights is None:
        raise ValueError("weights must be given with a grouping column")
    routes = per_route(df, error_col, filter_, [group], key, {"_m": seconds_col})
    grouped = routes.groupBy(group).agg(
        F.sum("errors").alias("errors"), (F.sum("_m") / 3600.0).alias("hours"), F.sum("kept_rows").alias("kept")
    )
    # A group without filtered rows has no value but keeps its weight.
    value = F.when(F.col("kept") > 0, F.try_divide(F.col("errors").cast("double"), F.col("hours")))
    joined = grouped.withColumn("_v", value).join(weights.select(group, "weight"), group, "left")
    return joined.agg(
        F.when(F.coalesce(F.sum("kept"), F.lit(0)) == 0, F.lit(0.0))
        .otherwise(F.sum(F.col("_v") * F.col("weight")) / F.sum("weight"))
        .alias("eph")
    )


def code_table(spark, codes, families) -> DataFrame:
    """(code, family) rows as a table; a code may be in several families."""
    return spark.createDataFrame(values.code_families(codes, families), "code string, family string")


def metric_levels(
    df: DataFrame,
    error_col: str,
    seconds_col: str,
    metres_col: str,
    levels: dict[str, tuple[str, dict[str, list]]],
    filter_: Column | None = None,
    key: str = "route_id",
) -> DataFrame:
    """Long table (level, level_value, metric, value): metrics and stats of every named value list.

    A level filters rows by ``column in values`` (and-ed with the metric's own filter); rates divide by
    the unfiltered base. All levels come out of one aggregation over one row per route.
    """
    cases = [("all", "all", F.lit(True))]
    for level, (column, lists) in levels.items():
        require_columns(df, column)
        cases += [(level, name, F.coalesce(F.col(column).isin(list(vals)), F.lit(False))) for name, vals in lists.items()]
    keep = _true(filter_)
    err = is_error(error_col)
    aggs = [F.min(seconds_col).alias("_s"), F.min(metres_col).alias("_m")]
    for i, (_, _, cond) in enumerate(cases):
        aggs += [
            F.count_if(err & keep & cond).alias(f"_e{i}"),
            F.min(F.when(keep & cond, F.col(seconds_col))).alias(f"_s{i}"),
            F.max(keep & cond).alias(f"_r{i}"),
        ]
    routes = df.groupBy(key).agg(*aggs)
    sums = [(F.sum("_s") / 3600.0).alias("_hours"), (F.sum("_m") / 1000.0).alias("_km")]
    for i in range(len(cases)):
        sums += [
            F.sum(f"_e{i}").cast("double").alias(f"errors{i}"),
            (F.coalesce(F.sum(f"_s{i}"), F.lit(0.0)) / 3600.0).alias(f"hours{i}"),
            F.count_if(F.col(f"_r{i}")).cast("double").alias(f"routes{i}"),
            F.count_if(F.col(f"_e{i}") > 0).cast("double").alias(f"failed{i}"),
        ]
    one = routes.agg(*sums, F.count("*").alias("_routes"))
    rows = []
    for i, (level, name, _) in enumerate(cases):
        e, n = F.col(f"errors{i}"), F.col(f"routes{i}")

        def share(base):
            return F.when((n == 0) | (base == 0), F.lit(0.0)).otherwise(e / base)

        metrics = {
            "errors": e,
            "hours": F.col(f"hours{i}"),
            "routes": n,
            "eph": share(F.col("_hours")),
            "epk": share(F.col("_km")),
            "failed_routes": F.when((n == 0) | (F.col("_routes") == 0), F.lit(0.0)).otherwise(
                F.col(f"failed{i}") / F.col("_routes")
            ),
        }
        rows += [
            F.struct(
                F.lit(level).alias("level"), F.lit(name).alias("level_value"), F.lit(m).alias("metric"), v.alias("value")
            )
            for m, v in metrics.items()
        ]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def levels_as_json(long: DataFrame) -> DataFrame:
    """One JSON object per level: {value: {metric: number}}; the long table has a fixed, small size."""
    per_value = long.groupBy("level", "level_value").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "value")))).alias("m")
    )
    per_level = per_value.groupBy("level").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("level_value", F.to_json("m").alias("j"))))).alias("m")
    )
    body = F.transform(
        F.map_entries("m"), lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), e["value"])
    )
    return per_level.select("level", F.concat(F.lit("{"), F.array_join(body, ","), F.lit("}")).alias("metrics"))


def draw(seed: Column, i: Column, n: Column) -> Column:
    """Index in [0, n) drawn for position ``i`` of resample ``seed``: a 60-bit hash, so every row of any table can be drawn."""
    return hash_key(seed.cast("bigint"), i.cast("bigint")) % n


def bootstrap_interval(resampled: DataFrame, metrics: list[str], quantiles=(0.05, 0.95), by: list[str] | None = None) -> DataFrame:
    """One row (per ``by``) with ``<metric>_lower`` and ``<metric>_upper`` (linear); input has one row per seed."""
    if len(quantiles) != 2:
        raise ValueError(f"quantiles must be two values, got {len(quantiles)}")
    lo, hi = min(quantiles), max(quantiles)
    return resampled.groupBy(*(by or [])).agg(
        *[F.percentile(m, F.lit(lo)).alias(f"{m}_lower") for m in metrics],
        *[F.percentile(m, F.lit(hi)).alias(f"{m}_upper") for m in metrics],
    )


def support_weight(seconds: Column | str, amplitude: float, steepness: float, centre: float) -> Column:
    """Logistic weight of an error by its duration; the parameters are given, not fitted."""
    t = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.lit(amplitude) / (1.0 + F.exp(-F.lit(steepness) * (t - F.lit(centre))))


def _finite(col: Column) -> Column:
    return F.when(col.isNull() | F.isnan(col) | (F.abs(col) == F.lit(float("inf"))), F.lit(0.0)).otherwise(col)


def extrapolated_rates(
    all_rows: DataFrame,
    reviewed: DataFrame,
    groups: list[str],
    error_col: str,
    seconds_col: str,
    parameters: tuple[float, float, float],
    km_col: str,
) -> DataFrame:
    """Error hours, km and weighted error counts of the reviewed rows, scaled to all rows, per (group, type).

    A group without errors keeps one 'no error' row; groups missing on one side count 0 there.
    """
    base = (F.sum(seconds_col) / 3600.0, F.sum(km_col))
    seen = reviewed.groupBy(*groups).agg(base[0].alias("gtd_hours"), base[1].alias("gtd_km"))
    total = all_rows.groupBy(*groups).agg(base[0].alias("all_hours"), base[1].alias("all_km"))
    time = seen.join(total, groups, "full").na.fill(0.0, ["gtd_hours", "gtd_km", "all_hours", "all_km"])
    errors = (
        reviewed.filter(F.col(error_col).isNotNull())
        .groupBy(*groups, error_col)
        .agg(
            base[0].alias("error_hours"),
            base[1].alias("error_km"),
            F.sum(support_weight(seconds_col, *parameters)).alias("error_weight"),
        )
    )
    rows = errors.join(time, groups, "right").na.fill({error_col: "no error"}).na.fill(
        0.0, ["error_hours", "error_km", "error_weight"]
    )

    def scaled(part, seen_, all_):
        return F.coalesce(F.try_divide(F.col(part), F.col(seen_)) * F.col(all_), F.lit(0.0))

    return rows.select(
        *groups, error_col, "gtd_hours", "all_hours", "gtd_km", "all_km", "error_hours", "error_km",
        scaled("error_hours", "gtd_hours", "all_hours").alias("estimated_error_hours"),
        scaled("error_km", "gtd_km", "all_km").alias("estimated_error_km"),
        scaled("error_weight", "gtd_hours", "all_hours").alias("estimated_errors"),
    )


def extrapolated_totals(rates: DataFrame, groups: list[str], reviewed_errors: DataFrame) -> DataFrame:
    """One row of totals: hours and km counted once per group, estimates summed over types."""
    per_group = rates.groupBy(*groups).agg(
        *[F.max(c).alias(c) for c in ("gtd_hours", "all_hours", "gtd_km", "all_km")],
        *[
            F.sum(c).alias(c)
            for c in ("error_hours", "error_km", "estimated_error_hours", "estimated_error_km", "estimated_errors")
        ],
    )
    total = per_group.agg(*[F.sum(c).alias(c) for c in per_group.columns if c not in groups])
    count = reviewed_errors.agg(F.count("*").alias("gtd_errors"))
    return total.crossJoin(count).select(  # one row each
        "*",
        F.try_divide(F.col("estimated_error_hours"), F.col("all_hours")).alias("error_hours_share"),
        F.try_divide(F.col("estimated_errors"), F.col("all_hours")).alias("total_eph"),
        F.try_divide(F.col("estimated_error_km"), F.col("all_km")).alias("error_km_share"),
        F.try_divide(F.col("estimated_errors"), F.col("all_km")).alias("total_epkm"),
    )


def empirical_cdf(df: DataFrame, column: str, out: str = "share") -> DataFrame:
    """Share of values <= x for every distinct x."""
    ranked = value_counts_cumulative(df, column, {"_n": F.lit(1)})
    total = ranked.agg(F.max("cum__n").alias("_total"))
    return ranked.crossJoin(F.broadcast(total)).select(  # one row
        column, (F.col("cum__n").cast("double") / F.col("_total")).alias(out)
    )


def run_totals(routes: DataFrame, keys: list[str]) -> DataFrame:
    """Hours, kilometres and routes per run, both sides."""
    return routes.groupBy(*keys).agg(
        F.count("*").alias("routes"),
        (F.sum("provider_route_time") / 3600.0).alias("provider_hours"),
        (F.sum("provider_route_length") / 1000.0).alias("provider_km"),
        (F.sum("competitor_route_time") / 3600.0).alias("competitor_hours"),
        (F.sum("competitor_route_length") / 1000.0).alias("competitor_km"),
    )


def world_rate(
    current: DataFrame, base: DataFrame, weights: DataFrame, scope: str = "WorldWide", pessimistic: float | None = None
) -> DataFrame:
    """Country-weighted rate: current runs first, a base aggregation for the other countries.

    WorldWide charges uncovered weight with ``pessimistic``; a top list renormalises over what is covered.
    """
    if scope == "WorldWide" and pessimistic is None:
        raise ValueError("the WorldWide scope needs the value that uncovered weight is charged with")
    joined = (
        weights.select("country", "weight")
        .join(current.select("country", F.col("eph").alias("_now")), "country", "left")
        .join(base.select("country", F.col("eph").alias("_base")), "country", "left")
        .withColumn("_v", F.coalesce("_now", "_base"))
    )
    if scope == "WorldWide":
        joined = joined.withColumn("_v", F.coalesce("_v", F.lit(float(pessimistic))))
    return joined.agg(
        F.count("_v").alias("countries"),
        (F.sum(F.col("_v") * F.col("weight")) / F.sum(F.when(F.col("_v").isNotNull(), F.col("weight")))).alias("eph"),
    )
