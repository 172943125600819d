"""Training tables, the classifier as a Spark ML pipeline, and scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from waymark import values as v
from waymark.operators.forest import counted
from waymark.operators.order import first_per_key
from waymark.session import cut_lineage


def error_label(state: Column | str) -> Column:
    """'no_error' for discarded cases; NULL falls to 'error' by three-valued logic."""
    state = F.col(state) if isinstance(state, str) else state
    return F.when(state.isin(v.DISCARD, None), F.lit("no_error")).otherwise(F.lit("error"))


def reviewed_cases(history: DataFrame, state: str = "error_type") -> DataFrame:
    return history.filter(F.col(state).isNotNull() & (F.col(state) != "no source"))


def training_rows(history: DataFrame, metadata: DataFrame, on: list[str]) -> DataFrame:
    """Reviewed cases with their run's metadata, one row per case."""
    rows = reviewed_cases(history).join(metadata, on, "left")
    others = [c for c in rows.columns if c != "case_id"]
    return first_per_key(rows, ["case_id"], sorted(others))


def fill_routes(cases: DataFrame, routes: DataFrame, keys: list[str]) -> DataFrame:
    """Missing ``route`` text filled from the stored inspection routes."""
    known = first_per_key(routes.select(*keys, F.col("provider_route").alias("_route")), keys, ["_route"])
    return cases.join(known, keys, "left").withColumn("route", F.coalesce("route", "_route")).drop("_route")


def feature_table(internal: DataFrame, trace_features: DataFrame, sign_features: DataFrame, required: list[str]) -> DataFrame:
    """Cases with trace and sign features, one row per case, without rows that miss a required feature."""
    trace = first_per_key(trace_features, ["case_id"], sorted(c for c in trace_features.columns if c != "case_id"))
    sign = first_per_key(sign_features, ["case_id"], sorted(c for c in sign_features.columns if c != "case_id"))
    return internal.join(trace, "case_id", "left").join(sign, "case_id", "left").na.drop(subset=required)


def fill_missing(df: DataFrame, columns: list[str], value: float = -1) -> DataFrame:
    """NULL and NaN to the sentinel."""
    return df.select(
        *[
            F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(float(value))).alias(c)
            if c in columns else F.col(c)
            for c in df.columns
        ]
    )


def clean_trace_features(df: DataFrame, all_features: list[str], contained_features: list[str]) -> DataFrame:
    """Without traces all shares are -2; with fewer than six contained traces the contained shares are -2."""
    out = df
    for c in all_features:
        out = out.withColumn(c, F.when(F.col("tot_new") == 0, F.lit(-2.0)).otherwise(F.col(c)))
    for c in contained_features:
        out = out.withColumn(c, F.when(F.col("tot_contained") < 6, F.lit(-2.0)).otherwise(F.col(c)))
    return out


def redirect_references(cases: DataFrame, predictions: DataFrame) -> DataFrame:
    """Predictions joined by the referenced case where there is one."""
    keyed = cases.select("case_id", F.coalesce("reference_case_id", "case_id").alias("joined_case_id"))
    return keyed.join(predictions.withColumnRenamed("case_id", "joined_case_id"), "joined_case_id", "left")


# ---- classifier ------------------------------------------------------------------------------


def standardise(features: list[str]):
    """Mean imputation and standardisation as pipeline stages."""
    from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler

    filled = [f"{c}_filled" for c in features]
    return [
        Imputer(strategy="mean", inputCols=features, outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="raw_features", handleInvalid="keep"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
    ]


def train_classifier(df: DataFrame, features: list[str], label: str = "label", trees: int = 50, depth: int = 8, seed: int = 7):
    """Random forest on imputed, standardised features; ``label`` is 0 / 1. The rows are read several times: pass stored ones if they are costly.

    Many rows are counted by the bins of their features, and the trees are grown on the counts (``operators/forest.py``).
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier

    if (grown := counted(df, features, label, trees, depth, seed)) is not None:
        return grown
    forest = RandomForestClassifier(labelCol=label, featuresCol="features", probabilityCol="class_probability",
                                    rawPredictionCol="class_raw", predictionCol="class_prediction", numTrees=trees, maxDepth=depth, seed=seed)
    return Pipeline(stages=[*standardise(features), forest]).fit(df)


def calibrate(scored: DataFrame, label: str = "label", score: str = "probability_error"):
    """Isotonic calibration of scores. Rows with the same score and label are one with their number as weight."""
    from pyspark.ml.regression import IsotonicRegression

    isotonic = IsotonicRegression(featuresCol=score, labelCol=label, weightCol="_n", predictionCol="calibrated")
    return isotonic.fit(scored.groupBy(score, label).agg(F.count("*").cast("double").alias("_n")))


def cross_calibrated(df: DataFrame, features: list[str], label: str = "label", key: str = "case_id", folds: int = 5, **forest) -> list:
    """Per fold (rows by the hash of ``key``) the classifier of the other rows and the isotonic calibration of its scores of the fold's rows.

    Each fold reads its rows about ten times, so they are written once.
    """
    rows = cut_lineage(df.select(key, *features, label, F.pmod(F.xxhash64(key), F.lit(folds)).cast("int").alias("_fold")))
    models = []
    for k in range(folds):
        classifier = train_classifier(rows.filter(F.col("_fold") != k), features, label, **forest)
        models.append((classifier, calibrate(score(classifier, rows.filter(F.col("_fold") == k), 0.5), label)))
    return models


def calibrated_scores(models: list, df: DataFrame, out: str = "calibrated") -> DataFrame:
    """Mean of the calibrated scores of all folds."""
    rows, parts = df, [f"_calibrated_{k}" for k in range(len(models))]
    for part, (classifier, isotonic) in zip(parts, models, strict=True):
        known = rows.columns
        rows = isotonic.transform(score(classifier, rows, 0.5)).select(*known, F.col("calibrated").alias(part))
    return rows.withColumn(out, sum((F.col(p) for p in parts), F.lit(0.0)) / len(parts)).select(*df.columns, out)


def score(model, df: DataFrame, threshold: float, out: str = "probability_error") -> DataFrame:
    """Probability of an error and the state: potential error only above the threshold."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(df)
    plain = isinstance(scored.schema["class_probability"].dataType, T.ArrayType)
    scored = scored.withColumn(out, (F.col("class_probability") if plain else vector_to_array("class_probability")).getItem(1))
    kept = [*df.columns, out]
    return scored.select(*kept).withColumn(
        "error_label", F.when(F.col(out) > threshold, F.lit(v.POTENTIAL_ERROR)).otherwise(F.lit(v.NO_ERROR))
    )


def score_at_least(df: DataFrame, probability: str, threshold: float, out: str = "prediction") -> DataFrame:
    """0/1 prediction of a stored probability; here the threshold itself counts as positive."""
    return df.withColumn(out, (F.col(probability) >= threshold).cast("int"))


def classify(models: dict[str, tuple[object, float]], df: DataFrame, metric: str = "metric") -> DataFrame:
    """Score every row with the model of its sample metric; other metrics use the combined model."""
    parts = None
    special = [m for m in models if m != "combined"]
    for name, (model, threshold) in models.items():
        rows = df.filter(~F.coalesce(F.col(metric).isin(*special), F.lit(False))) if name == "combined" else df.filter(F.col(metric) == name)
        part = score(model, rows, threshold)
        parts = part if parts is None else parts.unionByName(part)
    return parts
