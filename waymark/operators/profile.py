"""Table profiles, drift, shares and duplicate census."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from waymark.operators.order import exact_quantiles


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row, one count per column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns or df.columns])


def null_ratios(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.agg(
        *[F.try_divide(F.count_if(F.col(c).isNull()).cast("double"), F.count("*")).alias(c) for c in columns or df.columns]
    )


def category_rates(df: DataFrame, column: str) -> DataFrame:
    """Count and share of every value; the total comes from the counted rows, not from a second scan."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_total"))
    return counts.crossJoin(F.broadcast(total)).select(  # one row
        column, "n", (F.col("n").cast("double") / F.col("_total")).alias("rate")
    )


def error_share(df: DataFrame, segment: str, error: Column) -> DataFrame:
    """Errors, rows and percentage per segment; segments without errors show 0."""
    return df.groupBy(segment).agg(
        F.count_if(error).alias("errors"),
        F.count("*").alias("total"),
        (F.count_if(error).cast("double") / F.count("*") * 100).alias("error_percent"),
    )


def date_span(df: DataFrame, column: str, today: Column) -> DataFrame:
    """First and last date, and rows dated after ``today``."""
    return df.agg(
        F.min(column).alias("first_date"),
        F.max(column).alias("last_date"),
        F.count_if(F.col(column) > today).alias("future_rows"),
    )


def long_form(df: DataFrame, columns: list[str], ids: list[str] | None = None) -> DataFrame:
    """(ids, feature, value) rows: one pass, each row replicated once per column."""
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]
    return df.select(*(ids or []), F.explode(F.array(*pairs)).alias("_p")).select(*(ids or []), "_p.*")


def _stack(one_row: DataFrame, columns: list[str], stats: list[str]) -> DataFrame:
    """Turn ``<stat>_<column>`` columns of a one-row table into one row per column."""
    rows = [
        F.struct(F.lit(c).alias("feature"), *[F.col(f"{s}_{c}").cast("double").alias(s) for s in stats]) for c in columns
    ]
    return one_row.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, standard deviation, min, quartiles, max per feature; quartiles are exact."""
    aggs = []
    for c in columns:
        v = F.col(c).cast("double")
        aggs += [
            F.count(v).alias(f"n_{c}"), F.avg(v).alias(f"mean_{c}"), F.stddev_samp(v).alias(f"std_{c}"),
            F.min(v).alias(f"min_{c}"), F.max(v).alias(f"max_{c}"),
        ]
    moments = _stack(df.agg(*aggs), columns, ["n", "mean", "std", "min", "max"])
    quartiles = exact_quantiles(
        long_form(df, columns), "value", [0.25, 0.5, 0.75], ["q25", "median", "q75"], keys=["feature"]
    )
    return moments.join(quartiles, "feature", "left")


def drift(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Difference and relative change of mean and median between two tables, per feature."""
    a = describe(left, columns).select("feature", F.col("mean").alias("mean_left"), F.col("median").alias("median_left"))
    b = describe(right, columns).select(
        "feature", F.col("mean").alias("mean_right"), F.col("median").alias("median_right")
    )
    return a.join(b, "feature").select(
        "*",
        (F.col("mean_right") - F.col("mean_left")).alias("mean_diff"),
        (F.col("median_right") - F.col("median_left")).alias("median_diff"),
        F.try_divide(F.col("mean_right") - F.col("mean_left"), F.col("mean_left")).alias("mean_change"),
        F.try_divide(F.col("median_right") - F.col("median_left"), F.col("median_left")).alias("median_change"),
    )


def feature_statistics(df: DataFrame, columns: list[str], max_null_share: float = 0.9) -> DataFrame:
    """Distinct values, variance, nulls per feature, and whether the feature is unusable."""
    # Distinct counts in long form: partial distinct per (feature, value), no expand of the wide row.
    distinct = long_form(df, columns).groupBy("feature").agg(F.countDistinct("value").alias("n_unique"))
    aggs = []
    for c in columns:
        v = F.col(c).cast("double")
        aggs += [
            F.var_samp(v).alias(f"variance_{c}"), F.count_if(v.isNull()).alias(f"nulls_{c}"),
            F.try_divide(F.count_if(v.isNull()).cast("double"), F.count("*")).alias(f"null_share_{c}"),
        ]
    wide = _stack(df.agg(*aggs), columns, ["variance", "nulls", "null_share"])
    return wide.join(distinct, "feature").withColumn(
        "excluded", (F.coalesce(F.col("variance"), F.lit(0.0)) == 0) | (F.col("null_share") > max_null_share)
    )


def duplicate_census(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def duplicates_per_date(df: DataFrame, keys: list[str], date_col: str) -> DataFrame:
    """Rows per date whose key occurs more than once; counted before they are joined back."""
    per_key_date = df.groupBy(*keys, date_col).agg(F.count("*").alias("_n"))
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_c")).filter("_c > 1").select(*keys)
    return per_key_date.join(repeated, keys, "left_semi").groupBy(date_col).agg(F.sum("_n").alias("duplicates"))


def threshold_shares(df: DataFrame, feature: str, error: Column, thresholds: list[float]) -> DataFrame:
    """Rows and error share: all, value = -2, value = 0 and above each threshold; one aggregation."""
    v = F.col(feature)
    cases = [("total", F.lit(True)), ("= -2", v == -2), ("= 0", v == 0)]
    cases += [(f"> {t:g}", v > F.lit(t)) for t in thresholds]
    aggs = []
    for i, (_, cond) in enumerate(cases):
        aggs += [F.count_if(cond).alias(f"n{i}"), F.count_if(cond & error).alias(f"e{i}")]
    rows = [
        F.struct(
            F.lit(name).alias("case"), F.col(f"n{i}").alias("n"),
            F.try_divide(F.col(f"e{i}").cast("double"), F.col(f"n{i}")).alias("error_share"),
        )
        for i, (name, _) in enumerate(cases)
    ]
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pairwise Pearson correlation as (feature_a, feature_b, r): one aggregation over the table."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    rows = [
        F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"c{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
    ]
    return wide.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def run_difference(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Right minus left per key and feature."""
    other = right.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    return left.join(other, key).select(key, *[(F.col(f"_{c}") - F.col(c)).alias(f"{c}_diff") for c in columns])


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """nunique per column: distinct values are reduced per column before they are counted."""
    pairs = [F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns]
    return (
        df.select(F.explode(F.array(*pairs)).alias("p"))
        .select("p.*")
        .filter("v is not null")
        .distinct()
        .groupBy(F.col("c").alias("column_name"))
        .agg(F.count("*").alias("n_unique"))
    )


def discard_rate_over_time(log: DataFrame, date_col: str, state_col: str, prab_col: str) -> DataFrame:
    """Discarded / classified rows per date for rows scored by the model (share of both ends = -1)."""
    state = F.regexp_replace(F.col(state_col), " ", "_")
    rows = log.filter(F.col(prab_col) == -1).select(date_col, state.alias("_s"))
    return rows.groupBy(date_col).agg(
        F.count_if(F.col("_s") == "no_error").alias("no_error"),
        F.count_if(F.col("_s") == "potential_error").alias("potential_error"),
        F.try_divide(
            F.count_if(F.col("_s") == "no_error").cast("double"),
            F.count_if(F.col("_s").isin("no_error", "potential_error")),
        ).alias("discard_rate"),
    )


def false_negative_rate(reviewed: DataFrame, column: str) -> DataFrame:
    """Share of reviewed discards that turn out to be errors."""
    return reviewed.filter(F.col(column).isNotNull()).agg(
        F.count_if(F.col(column) != "discard").alias("errors"),
        F.count("*").alias("reviewed"),
        F.try_divide(F.count_if(F.col(column) != "discard").cast("double"), F.count("*")).alias("false_negative_rate"),
    )


def rows_with_any_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns or df.columns]))
