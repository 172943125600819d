"""Calibration of the classifier."""

import random

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from waymark.operators import forest
from waymark.plans import training as tr


def test_calibrated_on_rows_that_the_forest_has_not_seen(spark, monkeypatch):
    own = random.Random(3)
    df = spark.createDataFrame([(i, own.random(), float(own.random() < 0.4)) for i in range(200)], "case_id long, x double, label double").cache()
    seen, train, calibrate = [], tr.train_classifier, tr.calibrate
    ids = lambda rows: {r.case_id for r in rows.select("case_id").collect()}
    monkeypatch.setattr(tr, "train_classifier", lambda rows, *a, **b: seen.append([ids(rows)]) or train(rows, *a, **b))
    monkeypatch.setattr(tr, "calibrate", lambda rows, *a: seen[-1].append(ids(rows)) or calibrate(rows, *a))
    models = tr.cross_calibrated(df, ["x"], trees=2, depth=3)
    assert len(seen) == 5 and all(not a & b and a | b == set(range(200)) for a, b in seen)
    assert sorted(i for _, b in seen for i in b) == list(range(200))
    out = tr.calibrated_scores(models, df)
    assert out.columns == ["case_id", "x", "label", "calibrated"]
    one = [{r.case_id: r.calibrated for r in m.transform(tr.score(c, df, 0.5)).collect()} for c, m in models]
    assert all(abs(r.calibrated - sum(o[r.case_id] for o in one) / 5) < 1e-12 for r in out.collect())
    assert 0.3 < out.agg(F.avg("calibrated")).first()[0] < 0.5


def test_folds_read_stored_rows(spark, monkeypatch):
    """The query that makes the rows runs once, not at each pass of each fold."""
    df = spark.range(60).select(F.col("id").alias("case_id"), (F.col("id") % 7).cast("double").alias("x")).join(
        spark.range(60).select(F.col("id").alias("case_id"), (F.col("id") % 2).cast("double").alias("label")), "case_id"
    )
    plans, train = [], tr.train_classifier
    monkeypatch.setattr(tr, "train_classifier", lambda rows, *a, **b: plans.append(rows._jdf.queryExecution().optimizedPlan().toString()) or train(rows, *a, **b))
    tr.cross_calibrated(df, ["x"], folds=2, trees=2, depth=2)
    assert len(plans) == 2 and not any("Join" in p for p in plans)


def labelled(spark, n=20000, values=60):
    """Rows with missing values whose label depends on x and y; w is the same in all."""
    rows = spark.range(n, numPartitions=4).select(
        F.col("id").alias("case_id"), (F.pmod(F.xxhash64("id"), F.lit(values)) / 3).alias("x"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(7))).cast("double").alias("y"),
        F.lit(2.0).alias("w"), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1000)).alias("u"),
    )
    share = F.when(F.col("x") > 12, 0.8).otherwise(0.3) + F.when(F.col("y") > 4, 0.15).otherwise(-0.15)
    rows = rows.withColumn("label", (F.col("u") < share * 1000).cast("double"))
    return rows.select("case_id", F.when(F.col("u") % 10 != 3, F.col("x")).alias("x"), F.when(F.col("u") % 10 == 4, F.lit(float("nan"))).otherwise(F.col("y")).alias("y"), "w", "label").cache()


def test_forest_of_many_rows_grows_on_counts(spark, monkeypatch):
    """With more rows than cells no tree reads the rows, and the probabilities are those of a forest that does."""
    df, features = labelled(spark), ["x", "y", "w"]
    assert isinstance(tr.train_classifier(df, features, trees=2), PipelineModel)  # few rows
    by_rows = {r.case_id: r.probability_error for r in tr.score(tr.train_classifier(df, features), df, 0.5).collect()}
    monkeypatch.setattr(forest, "CELLS", 1000)
    grown = tr.train_classifier(df, features)
    assert isinstance(grown, forest.CountedForest) and len(grown.roots) == 50
    scored = tr.score(grown, df, 0.5)
    assert scored.columns == [*df.columns, "probability_error", "error_label"]
    by_counts = {r.case_id: r.probability_error for r in scored.collect()}
    off = [abs(by_counts[i] - p) for i, p in by_rows.items()]
    assert len(off) == 20000 and sum(off) / len(off) < 0.02 and max(off) < 0.1
    # Without the table the trees are walked.
    table, grown.table = grown.table, None
    assert {r.case_id: r.probability_error for r in tr.score(grown, df, 0.5).collect()} == by_counts and table is not None
    # More combinations than cells: the rows are read.
    monkeypatch.setattr(forest, "CELLS", 100)
    assert isinstance(tr.train_classifier(df, features, trees=2), PipelineModel)


def test_trees_of_counts_are_drawn_as_from_rows(spark):
    """Each tree holds a Poisson number of rows, cuts where Gini gains most, and merges leaves that say the same."""
    own = np.random.default_rng(5)
    bins = np.array([(a, b) for a in range(4) for b in range(3)])
    counts = np.stack([own.integers(50, 200, 12), own.integers(50, 200, 12) + 400 * (bins[:, 1] > 0)], 1)
    feature, last, child, total = forest.grow(bins, [4, 3], counts, 200, 1, 2, own)
    n = total[:200].sum(1)
    assert abs(n.mean() / counts.sum() - 1) < 0.01 and 0.8 < n.var() / counts.sum() < 1.2
    assert (np.isin(feature[:200], (-1, 1))).all() and (last[:200][feature[:200] == 1] == 0).all()
    for i in np.flatnonzero(feature[:200] >= 0):
        assert (total[child[i]] + total[child[i] + 1] == total[i]).all()
        assert (total[child[i]].argmax() != total[child[i] + 1].argmax())
    assert list(forest.cuts(np.array([1.0, 1.0, 2.0, 4.0]), np.ones(4))) == [1.5, 3.0]
    assert len(forest.cuts(np.arange(1000.0), np.ones(1000))) == 31
    assert list(forest.cuts(np.array([1.0, 2.0, 3.0, 4.0]), np.array([1, 9, 1, 1]), 2)) == [2.5]


def test_calibration_counts_equal_scores(spark, monkeypatch):
    """Rows of one score and label reach the regression as one row with a weight; what it says is that of the rows."""
    df = spark.createDataFrame([(i % 5 / 5, float(i % 7 < i % 5)) for i in range(700)], "probability_error double, label double")
    seen, fit = [], IsotonicRegression.fit
    monkeypatch.setattr(IsotonicRegression, "fit", lambda self, rows: seen.append(rows.count()) or fit(self, rows))
    got = {r.probability_error: r.calibrated for r in tr.calibrate(df).transform(df).collect()}
    assert seen[0] <= 10
    assert all(abs(got[k / 5] - k / 7) < 1e-12 for k in range(5))


def test_each_metric_is_scored_by_its_forest_of_counts(spark, monkeypatch):
    """Forests of all metrics grow on counts; every row is scored once, those without a metric by the combined one."""
    df = labelled(spark).withColumn("metric", F.when(F.col("case_id") % 5 < 3, "TbT").when(F.col("case_id") % 5 == 3, "HDR"))
    monkeypatch.setattr(forest, "CELLS", 1000)
    models = {m: (tr.train_classifier(df.filter(F.col("metric") == m), ["x", "y", "w"], trees=5), 0.6) for m in ("TbT", "HDR")}
    models["combined"] = (tr.train_classifier(df, ["x", "y", "w"], trees=5), 0.6)
    assert all(isinstance(m, forest.CountedForest) for m, _ in models.values())
    out = {r.case_id: r for r in tr.classify(models, df).collect()}
    assert len(out) == 20000 == tr.classify(models, df).count()
    for name, (model, _) in models.items():
        own = df.filter(F.col("metric").isNull() if name == "combined" else F.col("metric") == name)
        for r in tr.score(model, own, 0.6).collect():
            assert out[r.case_id].probability_error == r.probability_error and out[r.case_id].error_label == r.error_label
            assert r.error_label == ("potential_error" if r.probability_error > 0.6 else "no_error")
