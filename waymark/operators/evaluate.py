"""Classifier evaluation: sweeps, curves, matrices and model comparison in one or two aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from waymark.operators.order import numbered, numbered_by_value, split_by_weights, value_counts_cumulative


def _ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def threshold_sweep(
    df: DataFrame, truth: str, probability: str, steps: int, saved: float = 2.0, missed: float = 10.0, stop: float = 1.0
) -> DataFrame:
    """Confusion counts and rates for evenly spaced thresholds on [0, stop].

    Rows are reduced to distinct (threshold bin, truth) counts, so the table is not copied per
    threshold. A row is positive above the threshold; at the threshold it is positive unless 0.
    """
    p = F.col(probability).cast("double")
    step = F.lit(stop / (steps - 1)) if steps > 1 else F.lit(1.0)
    # Last threshold index for which the row is positive: thresholds 0..k, -1 when none.
    grid = F.array(*[F.lit(stop * i / (steps - 1) if i < steps - 1 else stop) for i in range(steps)])
    guess = F.least(F.greatest(F.floor(p / step).cast("int"), F.lit(0)), F.lit(steps - 1))

    def positive_at(i):
        t = F.element_at(grid, i + 1)
        return (p > t) | ((p == t) & (p != 0))

    last = (
        F.when((guess + 1 <= steps - 1) & positive_at(F.least(guess + 1, F.lit(steps - 1))), guess + 1)
        .when(positive_at(guess), guess)
        .otherwise(guess - 1)
    )
    binned = df.filter(p.isNotNull()).groupBy(last.alias("_k")).agg(
        F.count_if(F.col(truth)).alias("_pos"), F.count_if(~F.col(truth)).alias("_neg")
    )
    # At most steps + 1 rows from here on.
    thresholds = df.sparkSession.range(steps).select(
        F.col("id").cast("int").alias("_i"), F.element_at(grid, F.col("id").cast("int") + 1).alias("threshold")
    )
    counted = thresholds.crossJoin(F.broadcast(binned)).groupBy("_i", "threshold").agg(
        F.sum(F.when(F.col("_k") >= F.col("_i"), F.col("_pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("_k") >= F.col("_i"), F.col("_neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(F.col("_k") < F.col("_i"), F.col("_neg")).otherwise(0)).alias("tn"),
        F.sum(F.when(F.col("_k") < F.col("_i"), F.col("_pos")).otherwise(0)).alias("fn"),
    )
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    return counted.select(
        F.col("_i").alias("step"), "threshold", "tp", "fp", "tn", "fn",
        _ratio(tp + tn, n).alias("accuracy"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(tn, tn + fn).alias("negative_precision"),
        _ratio(tn, tn + fp).alias("negative_recall"),
        _ratio(tp + fp, n).alias("kept_rate"),
        _ratio(tn + fn, n).alias("discard_rate"),
        ((tn + fn) * F.lit(float(saved)) - fn * F.lit(float(missed))).alias("saving"),
    )


def nearest_target(sweep: DataFrame, metric: str, targets: list[float]) -> DataFrame:
    """For each target the sweep row whose metric is nearest (first threshold on ties)."""
    aggs = []
    for i, t in enumerate(targets):
        key = F.struct(F.abs(F.col(metric) - F.lit(t)), F.col("step"))
        aggs.append(
            F.min_by(
                F.struct("threshold", F.col(metric).alias("reached")), F.when(F.col(metric).isNotNull(), key)
            ).alias(f"r{i}")
        )
    rows = [F.struct(F.lit(t).alias("target"), F.col(f"r{i}.threshold").alias("threshold"), F.col(f"r{i}.reached").alias("reached")) for i, t in enumerate(targets)]
    return sweep.agg(*aggs).select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def last_before_drop(sweep: DataFrame, metric: str = "recall", floor: float = 0.98) -> DataFrame:
    """The last threshold before the metric first falls below ``floor``."""
    first_bad = sweep.agg(F.min(F.when(F.col(metric) < floor, F.col("step"))).alias("_bad"))
    return (
        sweep.crossJoin(F.broadcast(first_bad))  # one row
        .filter(F.col("_bad").isNull() | (F.col("step") < F.col("_bad")))
        .agg(F.max_by("threshold", "step").alias("threshold"), F.max_by(metric, "step").alias(metric))
    )


def sweep_columns(df: DataFrame, truth: str, columns: list[str], steps: int = 2000, stop: float = 0.1) -> DataFrame:
    """(column, step, threshold, recall, specificity) of many probability columns over evenly spaced thresholds on [0, stop].

    A row is positive from the threshold on; nulls count for no column. One scan: each row gives its bin in every column, (column, bin) is
    summed on the map side, and the thresholds follow as suffix sums over at most ``steps`` + 1 rows of a column.
    """
    step = stop / (steps - 1)

    def bin_of(p):
        # Rounding may put the quotient one bin off; the thresholds decide.
        k = F.least(F.greatest(F.floor(p / F.lit(step)).cast("int"), F.lit(-1)), F.lit(steps - 1))
        at = lambda i: F.when(i == steps - 1, F.lit(stop)).otherwise(i * F.lit(step))
        k = F.when((k < steps - 1) & (p >= at(k + 1)), k + 1).when((k >= 0) & (p < at(k)), k - 1).otherwise(k)
        return F.when(p.isNotNull(), k)  # least and greatest pass over nulls

    cells = F.array(*(F.struct(F.lit(c).alias("column"), bin_of(F.col(c).cast("double")).alias("bin")) for c in columns))
    counted = df.select(F.col(truth).alias("t"), F.explode(cells).alias("x")).filter("x.bin is not null and t is not null")
    counted = counted.groupBy("x.column", "x.bin").agg(F.count_if("t").alias("pos"), F.count_if(~F.col("t")).alias("neg"))
    grid = df.sparkSession.range(-1, steps).select(F.col("id").cast("int").alias("bin"))
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    every = grid.crossJoin(F.broadcast(names)).join(counted, ["column", "bin"], "left").na.fill(0, ["pos", "neg"])
    above = W.partitionBy("column").orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, 0)
    whole = W.partitionBy("column")
    sums = every.select("column", "bin", F.sum("pos").over(above).alias("tp"), F.sum("neg").over(above).alias("fp"), F.sum("pos").over(whole).alias("p"), F.sum("neg").over(whole).alias("n"))
    threshold = F.when(F.col("bin") == steps - 1, F.lit(stop)).otherwise(F.col("bin") * F.lit(step))
    return sums.filter("bin >= 0").select(
        "column", F.col("bin").alias("step"), threshold.alias("threshold"), _ratio(F.col("tp"), F.col("p")).alias("recall"), _ratio(F.col("n") - F.col("fp"), F.col("n")).alias("specificity")
    )


def last_before_drop_by_column(sweep: DataFrame, floor: float = 0.98) -> DataFrame:
    """Per column the last threshold before the recall first falls below ``floor``."""
    # Recall falls with the threshold, so these are the steps before the drop.
    kept = sweep.filter(F.col("recall") >= floor)
    return kept.groupBy("column").agg(*(F.max_by(c, "step").alias(c) for c in ("threshold", "recall", "specificity")))


def classifier_rates(df: DataFrame, truth: Column, predicted: Column) -> DataFrame:
    tp, fp = F.count_if(truth & predicted), F.count_if(~truth & predicted)
    tn, fn = F.count_if(~truth & ~predicted), F.count_if(truth & ~predicted)
    return df.agg(
        tp.alias("tp"), fp.alias("fp"), tn.alias("tn"), fn.alias("fn"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(tn, tn + fp).alias("negative_recall"),
        _ratio(tn + fn, F.count("*")).alias("discard_rate"),
        _ratio(tp + fp, F.count("*")).alias("kept_rate"),
    )


def roc_curve(df: DataFrame, truth: str, score: str) -> DataFrame:
    """One point per distinct score, from the highest down: rows at or above it."""
    neg = df.withColumn("_neg_score", -F.col(score).cast("double"))
    ranked = value_counts_cumulative(
        neg, "_neg_score", {"_up": F.col(truth).cast("int"), "_over": (~F.col(truth)).cast("int")}
    )
    total = ranked.agg(F.max("cum__up").alias("_p"), F.max("cum__over").alias("_q"))
    return ranked.crossJoin(F.broadcast(total)).select(  # one row
        (-F.col("_neg_score")).alias("score"),
        _ratio(F.col("cum__up"), F.col("_p")).alias("tpr"),
        _ratio(F.col("cum__over"), F.col("_q")).alias("fpr"),
    )


def auc(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Rank-sum area under the curve; ties take the average rank."""
    ranked = value_counts_cumulative(df, score, {"_up": F.col(truth).cast("int"), "_n": F.lit(1)})
    mean_rank = F.col("cum__n") - (F.col("_n") - 1) / 2.0
    return ranked.agg(
        F.sum(F.col("_up") * mean_rank).alias("_r"), F.sum("_up").alias("_p"), F.sum("_n").alias("_n")
    ).select(
        F.try_divide(
            F.col("_r") - F.col("_p") * (F.col("_p") + 1) / 2.0, (F.col("_p") * (F.col("_n") - F.col("_p"))).cast("double")
        ).alias("auc")
    )


def cross_table(df: DataFrame, rows: str, columns: str, column_values: list) -> DataFrame:
    """Counts of (row value, column value) with the column values as columns."""
    counted = df.groupBy(rows).pivot(columns, column_values).agg(F.count(F.lit(1)))
    return counted.na.fill(0, [str(v) for v in column_values])


def two_model_cells(df: DataFrame, truth: Column, first: Column, second: Column) -> DataFrame:
    """Eight cells (truth x first right x second right) and the agreement probabilities."""
    cells = {}
    for t, t_cond in (("error", truth), ("clean", ~truth)):
        for a, a_cond in (("first_hit", first == truth), ("first_miss", first != truth)):
            for b, b_cond in (("second_hit", second == truth), ("second_miss", second != truth)):
                cells[f"{t}_{a}_{b}"] = F.count_if(t_cond & a_cond & b_cond)
    hit1, hit2 = first == truth, second == truth
    return df.agg(
        *[c.alias(n) for n, c in cells.items()],
        _ratio(F.count_if(hit1 & hit2), F.count_if(hit1)).alias("p_second_hit_given_first_hit"),
        _ratio(F.count_if(~hit1 & hit2), F.count_if(~hit1)).alias("p_second_hit_given_first_miss"),
        _ratio(F.count_if(first & second), F.count_if(first)).alias("p_second_positive_given_first_positive"),
        _ratio(F.count_if(~first & second), F.count_if(~first)).alias("p_second_positive_given_first_negative"),
    )


def calibration_table(df: DataFrame, truth: str, probability: str, ids: list[str], bins: int = 20) -> DataFrame:
    """Equal-count bins by probability: mean probability against the observed rate."""
    rows = numbered_by_value(df.filter(F.col(probability).isNotNull()), probability, ids, "_rank")
    total = rows.agg(F.count("*").alias("_n"))
    binned = rows.crossJoin(F.broadcast(total)).withColumn(  # one row
        "bin", F.floor(F.col("_rank") * bins / F.col("_n")).cast("int")
    )
    return binned.groupBy("bin").agg(
        F.count("*").alias("n"),
        F.avg(F.col(probability).cast("double")).alias("mean_probability"),
        F.avg(F.col(truth).cast("double")).alias("observed_rate"),
    )


def split_sums(df: DataFrame, truth: str, probability: str, ids: list[str], splits: int = 20) -> DataFrame:
    """Sum of probabilities and number of errors in random splits of equal expected size."""
    parts = split_by_weights(df, {str(i): 1.0 for i in range(splits)}, ids, seed=7, out="split")
    return parts.groupBy(F.col("split").cast("int").alias("split")).agg(
        F.sum(F.col(probability).cast("double")).alias("probability_sum"), F.count_if(F.col(truth)).alias("errors")
    )


def linear_fit(points: DataFrame, x: str, y: str) -> DataFrame:
    return points.agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2")
    )


def ratio_resamples(
    df: DataFrame, truth: str, probability: str, ids: list[str], ratios: list[float], size: int
) -> DataFrame:
    """For each error ratio draw with replacement from each class; sum of probabilities and errors.

    Draw i of a class picks row ``hash mod class size``: a join on the row number, no collection.
    """
    from waymark.operators.metrics import draw

    base = df.select(*ids, F.col(truth).alias("_t"), F.col(probability).cast("double").alias("_p"))
    ids_numbered = numbered(base, ids, "_pos", keys=["_t"])
    sizes = ids_numbered.groupBy("_t").agg(F.count("*").alias("_n"))  # two rows
    spark = df.sparkSession
    plan = [(i, float(r), True, round(r * size)) for i, r in enumerate(ratios)]
    plan += [(i, float(r), False, size - round(r * size)) for i, r in enumerate(ratios)]
    wanted = spark.createDataFrame(plan, "seed int, ratio double, _t boolean, _draws bigint").filter("_draws > 0")
    slots = wanted.join(F.broadcast(sizes), "_t").withColumn(
        "_i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_draws") - 1))
    )
    drawn = slots.withColumn("_pos", draw(F.col("seed"), F.col("_i"), F.col("_n")))
    return drawn.join(ids_numbered.select("_t", "_pos", "_p"), ["_t", "_pos"]).groupBy("ratio").agg(
        F.count("*").alias("n"), F.count_if(F.col("_t")).alias("errors"), F.sum("_p").alias("probability_sum")
    )
