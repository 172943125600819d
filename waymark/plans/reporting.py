"""Views and scheduled scoring of finished runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from waymark import values as v
from waymark.functions import text as tx
from waymark.operators import metrics as mt, resample as rs
from waymark.operators.order import first_per_key, newest_first


def latest_inspections(metadata: DataFrame) -> DataFrame:
    return first_per_key(metadata, ["sample_id"], [newest_first("inspection_date"), "run_id"])


def route_summary(routes: DataFrame) -> DataFrame:
    """Routes, states and mean lengths per run."""
    return routes.groupBy("run_id").agg(
        F.count("*").alias("total_routes"),
        F.count_if(F.col("rac_state") == v.OPTIMAL).alias("optimal"),
        F.count_if(F.col("rac_state") == v.POTENTIAL_ERROR).alias("potential_error"),
        F.count_if(F.col("rac_state") == v.ROUTING_ISSUE).alias("routing_issue"),
        F.avg("provider_route_length").alias("avg_provider_length"),
        F.avg("competitor_route_length").alias("avg_competitor_length"),
    )


def section_summary(sections: DataFrame, share: str = "prab", lift: str = "lift") -> DataFrame:
    state = tx.normal_state("fcd_state")
    return sections.groupBy("run_id").agg(
        F.count("*").alias("total_critical_sections"),
        F.count_if(state == v.POTENTIAL_ERROR).alias("potential_error"),
        F.count_if(state == v.NO_ERROR).alias("no_error"),
        F.avg(share).alias(f"avg_{share}"), F.avg(lift).alias(f"avg_{lift}"),
    )


def inspection_results(metadata: DataFrame, samples: DataFrame, metrics: DataFrame, services: list[str] | None = None) -> DataFrame:
    """Runs with their sample and scheduled metrics; calls per service out of the JSON column."""
    meta = metadata
    for s in services or []:
        meta = meta.withColumn(f"{s.lower()}_api_calls", F.get_json_object("api_calls", f"$.{s}").cast("int"))
    out = meta.join(samples, "sample_id", "left").join(metrics, "run_id", "left")
    if "metric" in out.columns:
        out = out.withColumn("sample_metric", F.coalesce("metric", F.lit("TbT 3 (legacy)"))).drop("metric")
    return out


def json_metric(column: Column | str, group: str, name: str, cast: str, digits: int | None = None) -> Column:
    """One number of a nested metrics object, rounded half-up like a decimal."""
    value = F.get_json_object(column, f"$.{group}.{name}").cast(cast)
    return value if digits is None else F.round(value, digits)


def published_view(metrics: DataFrame, metadata: DataFrame, samples: DataFrame, weights: DataFrame, families=("turnrest", "oneway", "nonnav")) -> DataFrame:
    """Published runs with rounded figures, the month of their map and per-family figures out of JSON."""
    joined = (
        metrics.filter("publish_value_stream")
        .join(metadata, "run_id", "left").join(samples, "sample_id", "left").join(weights, "country", "left")
    )
    cols = [
        "run_id", "country", "ranking", "product", F.trunc("mapdate", "month").alias("mapdate"), "routes",
        F.round("provider_hours", 2).alias("hours"), F.round("provider_km", 2).alias("km"), F.round("eph", 3).alias("eph"), "errors",
    ]
    for f in families:
        cols.append(json_metric("metrics_per_error_type", f, "eph", "double", 3).alias(f"{f}_eph"))
        cols.append(json_metric("metrics_per_error_type", f, "errors", "int").alias(f"{f}_errors"))
    return joined.filter(F.col("mapdate").isNotNull()).select(*cols)


def json_records(df: DataFrame, column: str, wanted: dict[str, str]) -> DataFrame:
    """Rows of a JSON document table whose fields have the wanted values."""
    for field, value in wanted.items():
        df = df.filter(F.get_json_object(column, f"$.{field}") == value)
    return df


def records_per(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def runs_to_score(metadata: DataFrame, scored: DataFrame) -> DataFrame:
    """Completed runs that have no scheduled metrics yet."""
    return metadata.filter("completed").select("run_id").distinct().join(scored.select("run_id"), "run_id", "left_anti")


def finished_routes(routes: DataFrame, reviewed: DataFrame, metadata: DataFrame, scored: DataFrame, more: list[Column]) -> DataFrame:
    """run_id, route_id, s (seconds), m (metres), e (errors) and ``more`` aggregates of the runs that are to be scored."""
    todo = runs_to_score(metadata, scored)
    base = routes.join(todo, "run_id", "left_semi")
    logs = reviewed.join(todo, "run_id", "left_semi").select("run_id", "route_id", "error_type")
    joined = base.select("run_id", "route_id", "provider_route_time", "provider_route_length").join(logs, ["run_id", "route_id"], "left")
    return joined.groupBy("run_id", "route_id").agg(
        F.min("provider_route_time").alias("s"), F.min("provider_route_length").alias("m"), F.count_if(mt.is_error("error_type")).alias("e"), *more
    )


def finished_run_intervals(
    routes: DataFrame, reviewed: DataFrame, metadata: DataFrame, scored: DataFrame, resamples: int = 1000, quantiles: tuple[float, float] = (0.05, 0.95)
) -> DataFrame:
    """Per finished run that was not scored before: interval of errors per hour and of failed routes over resamples of its routes."""
    rows = finished_routes(routes, reviewed, metadata, scored, []).select(
        "run_id", "route_id", (F.col("s") / 3600).alias("hours"), F.col("e").cast("double").alias("errors"), F.when(F.col("e") > 0, 1.0).otherwise(0.0).alias("failed")
    )
    metrics = {"eph": F.sum("errors") / F.sum("hours"), "failed_routes": F.sum("failed") / F.sum("draws")}
    drawn = rs.bootstrap(rows, ["hours", "errors", "failed"], metrics, resamples, keys=["run_id"], by=["run_id"])
    return mt.bootstrap_interval(drawn, list(metrics), quantiles, by=["run_id"])


def score_finished_runs(routes: DataFrame, reviewed: DataFrame, metadata: DataFrame, scored: DataFrame) -> DataFrame:
    """Metrics of every finished run that was not scored before, one row per run.

    Families come out of one conditional aggregation; the per-family object is JSON text.
    """
    fam = {name: F.count_if(F.col("error_type").isin(*codes)).alias(name) for name, codes in v.ERROR_FAMILIES.items()}
    per_route = finished_routes(routes, reviewed, metadata, scored, list(fam.values()))
    per_run = per_route.groupBy("run_id").agg(
        F.count("*").cast("int").alias("routes"), F.sum("e").cast("int").alias("errors"), (F.sum("m") / 1000).alias("provider_km"),
        (F.sum("s") / 3600).alias("provider_hours"), (F.count_if(F.col("e") > 0) / F.count("*")).alias("failed_routes"),
        *[F.sum(f).alias(f) for f in fam],
    )
    eph = lambda n: F.coalesce(F.try_divide(F.col(n).cast("double"), F.col("provider_hours")), F.lit(0.0))
    body = F.to_json(F.struct(*[F.struct(F.col(f).alias("errors"), eph(f).alias("eph")).alias(f) for f in fam]))
    return per_run.withColumn("eph", eph("errors")).withColumn("metrics_per_error_type", body).drop(*fam)
