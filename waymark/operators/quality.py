"""Quality checks of a run: counts in one aggregation, findings as columns and JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from waymark.functions import geo
from waymark.values import METRIC_LONG

# Thresholds of the checks.
MISSING_SHARE = 0.1
EMPTY_SHARE = 0.05
LONG_SHARE = 0.20
NOT_COMPUTED_SHARE = 0.05
LENGTH_CEILING = {"long": 1_000_000.0, "default": 10_000.0}
RELATIVE_SHARE = 0.5

# Keys and texts of the findings.
TEXT_MISSING_LENGTH = "No route length saved in inspection_routes on {n} routes. {p} percent"
TEXT_MISSING_TIME = "No route time saved in inspection_routes on {n} routes. {p} percent"
TEXT_NO_ROWS = "WARNING: There are no routes on dataframe"
TEXT_EMPTY = "WARNING: Too high number of empty routes in inspection_routes = {p}"
TEXT_LONG_SHARE = "WARNING: Too high percent of long routes in inspection_routes = {p}"
TEXT_LONG_COUNT = "INFO: Too long routes in inspection_routes = {n}"
TEXT_NOT_COMPUTED = "WARNING: Too high percentage of not calculated competitor routes = {p}"
TEXT_EXTRA_DISTANCE = "WARNING: Extra distance provider-competitor/competitor = {p}"
TEXT_LESS_DISTANCE = "WARNING: Less distance in provider than competitor: competitor-provider/competitor = {p}"
TEXT_EXTRA_TIME = "WARNING: Extra time provider-competitor/competitor = {p}"
TEXT_LESS_TIME = "WARNING: Less time in provider than competitor: competitor-provider/competitor = {p}"
TEXT_OUTCOME = "WARNING: Too high percent of {o} routes in inspection_routes = {p}"


def _fill(text: str, **parts: Column) -> Column:
    """The text with its ``{name}`` places filled by columns."""
    out, rest = [], text
    while "{" in rest:
        head, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        out += [F.lit(head), parts[name].cast("string")]
    return F.concat(*out, F.lit(rest))


def _percent(share: Column) -> Column:
    return F.format_string("%.2f%%", share * 100)


def finding(level: Column, key: Column | str, text: Column) -> Column:
    key = F.lit(key) if isinstance(key, str) else key
    return F.struct(level.alias("level"), key.alias("key"), text.alias("text"))


def missing_value(n: Column, value: Column, key: str, text: str, threshold: float = 0.01) -> Column:
    """Rows with a geometry but 0 for the value: too many is a warning, some is information."""
    level = F.when(value > n * threshold, F.lit("WARNING")).when(value > 0, F.lit("INFO")).otherwise(F.lit("OK"))
    body = F.concat(level, F.lit(": "), _fill(text, n=value, p=_percent(F.try_divide(value.cast("double"), n))))
    return finding(level, key, F.when(level != "OK", body).otherwise(F.lit("")))


def empty_routes(n: Column, empty: Column, threshold: float = EMPTY_SHARE) -> Column:
    share = F.try_divide(empty.cast("double"), n)
    level = F.when((n == 0) | (share > threshold), F.lit("WARNING")).otherwise(F.lit("OK"))
    body = F.when(n == 0, F.lit(TEXT_NO_ROWS)).when(share > threshold, _fill(TEXT_EMPTY, p=_percent(share))).otherwise(F.lit(""))
    return finding(level, "Empty_routes", body)


def long_routes(n: Column, long_: Column, threshold: float) -> Column:
    share = F.try_divide(long_.cast("double"), n)
    too_many = share > threshold
    level = F.when((n == 0) | too_many, F.lit("WARNING")).when(long_ > 0, F.lit("INFO")).otherwise(F.lit("OK"))
    key = F.when(F.coalesce(too_many, F.lit(False)), F.lit("Long_routes_percentage")).otherwise(F.lit("Long_routes_count"))
    body = (
        F.when(n == 0, F.lit(TEXT_NO_ROWS)).when(too_many, _fill(TEXT_LONG_SHARE, p=_percent(share)))
        .when(long_ > 0, _fill(TEXT_LONG_COUNT, n=long_)).otherwise(F.lit(""))
    )
    return finding(level, key, body)


def not_computed(n: Column, sampled: Column, threshold: float = NOT_COMPUTED_SHARE) -> Column:
    share = F.when(sampled == 0, F.lit(0.0)).otherwise(1 - n.cast("double") / sampled)
    bad = share > threshold
    return finding(
        F.when(bad, F.lit("WARNING")).otherwise(F.lit("OK")), "tb_vs_real",
        F.when(bad, _fill(TEXT_NOT_COMPUTED, p=_percent(share))).otherwise(F.lit("")),
    )


def against_competitor(own: Column, other: Column, key: str, more: str, less: str, threshold: float = RELATIVE_SHARE) -> Column:
    high, low = own > (1 + threshold) * other, own < (1 - threshold) * other
    body = (
        F.when(high, _fill(more, p=_percent(F.try_divide(own, other) - 1)))
        .when(low, _fill(less, p=_percent(1 - F.try_divide(own, other)))).otherwise(F.lit(""))
    )
    return finding(F.when(high | low, F.lit("WARNING")).otherwise(F.lit("OK")), key, body)


def outcome_share(routes: DataFrame, outcome: str, threshold: float, column: str = "route_outcome") -> DataFrame:
    """Finding about the share of one route outcome."""
    one = routes.agg(F.count("*").alias("n"), F.count_if(F.col(column) == outcome).alias("c"))
    share = F.try_divide(F.col("c").cast("double"), F.col("n"))
    bad = share > threshold
    level = F.when((F.col("n") == 0) | bad, F.lit("WARNING")).otherwise(F.lit("OK"))
    key = F.when(F.col("n") == 0, F.lit(f"{outcome}_count")).otherwise(F.lit(f"{outcome}_route_percentage"))
    body = F.when(F.col("n") == 0, F.lit(TEXT_NO_ROWS)).when(
        bad, _fill(TEXT_OUTCOME, o=F.lit(outcome), p=_percent(share))
    ).otherwise(F.lit(""))
    return one.select(finding(level, key, body).alias("f")).select("f.*")


def _side_counts(side: str, ceiling: Column) -> list[Column]:
    wkt, length, time = F.col(f"{side}_route"), F.col(f"{side}_route_length"), F.col(f"{side}_route_time")
    filled = ~geo.is_empty(wkt)
    usable = filled & geo.is_valid_line(wkt)
    return [
        F.count_if(usable & (length == 0)).alias(f"{side}_no_length"),
        F.count_if(usable & (time == 0)).alias(f"{side}_no_time"),
        F.count_if(~filled).alias(f"{side}_empty"),
        F.count_if(length > ceiling).alias(f"{side}_long"),
        F.coalesce(F.sum(length), F.lit(0.0)).alias(f"{side}_metres"),
        F.coalesce(F.sum(time), F.lit(0.0)).alias(f"{side}_seconds"),
    ]


def sanity_counts(routes: DataFrame, groups: list[str], metric: Column) -> DataFrame:
    """All numbers the checks need, per run, in one aggregation over the routes."""
    ceiling = F.when(metric == METRIC_LONG, F.lit(LENGTH_CEILING["long"])).otherwise(F.lit(LENGTH_CEILING["default"]))
    return routes.groupBy(*groups).agg(
        F.count("*").alias("n"), *_side_counts("provider", ceiling), *_side_counts("competitor", ceiling)
    )


def sanity_check(
    routes: DataFrame, samples: DataFrame, groups: list[str], metric: Column, sample_key: str = "sample_id"
) -> DataFrame:
    """Per run: ``sanity_fail`` and ``sanity_msg`` (JSON of warnings and information by side)."""
    counts = sanity_counts(routes, groups, metric)
    sampled = samples.groupBy(sample_key).agg(F.count("*").alias("sampled"))
    counts = counts.join(sampled, sample_key, "left").withColumn("sampled", F.coalesce("sampled", F.lit(0)))
    n = F.col("n")

    def side(name):
        c = lambda what: F.col(f"{name}_{what}")
        return F.array(
            missing_value(n, c("no_length"), "Missing length", TEXT_MISSING_LENGTH, MISSING_SHARE),
            missing_value(n, c("no_time"), "Missing time", TEXT_MISSING_TIME, MISSING_SHARE),
            empty_routes(n, c("empty")),
            long_routes(n, c("long"), LONG_SHARE),
            not_computed(n, F.col("sampled")),
        )

    relative = F.array(
        against_competitor(
            F.col("provider_metres"), F.col("competitor_metres"), "route_length_vs_competitor", TEXT_EXTRA_DISTANCE, TEXT_LESS_DISTANCE
        ),
        against_competitor(
            F.col("provider_seconds"), F.col("competitor_seconds"), "route_time_vs_competitor", TEXT_EXTRA_TIME, TEXT_LESS_TIME
        ),
    )

    def pick(findings: Column, level: str) -> Column:
        found = F.filter(findings, lambda f: f["level"] == level)
        return F.map_from_entries(F.transform(found, lambda f: F.struct(f["key"].alias("key"), f["text"].alias("value"))))

    rows = counts.withColumn("_p", side("provider")).withColumn("_c", side("competitor")).withColumn("_r", relative)

    def both(name):
        return F.struct(pick(F.col(name), "WARNING").alias("warnings"), pick(F.col(name), "INFO").alias("info"))

    message = F.to_json(
        F.struct(
            both("_p").alias("provider"), both("_c").alias("competitor"),
            F.struct(pick(F.col("_r"), "WARNING").alias("warnings")).alias("provider_vs_competitor"),
        )
    )
    fail = F.exists(F.concat("_p", "_c", "_r"), lambda f: f["level"] == "WARNING")
    return rows.select(*groups, "n", "sampled", fail.alias("sanity_fail"), message.alias("sanity_msg"))


def raise_on_failure(metadata: DataFrame) -> bool:
    """Gate after the exports: error when any run failed its checks; one row is looked at."""
    if metadata.filter("sanity_fail").limit(1).count():
        raise AssertionError("Sanity check failed")
    return False


def validate_run(metadata: DataFrame, routes: DataFrame, api_names: list[str]) -> DataFrame:
    """Calls per service, tasks and route seconds of each run."""
    seconds = routes.groupBy("run_id").agg(F.sum("provider_route_time").alias("route_seconds"), F.count("*").alias("routes"))
    calls = [F.coalesce(F.get_json_object("api_calls", f"$.{a}").cast("bigint"), F.lit(0)).alias(f"calls_{a}") for a in api_names]
    return metadata.select("run_id", "mcp_tasks", *calls).join(seconds, "run_id", "left")
