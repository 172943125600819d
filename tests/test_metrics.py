import numpy as np
import pytest
from pyspark.sql import functions as F

from waymark.operators import evaluate as ev, metrics as mt, order as od, quality as ql


def weights(spark, **w):
    return spark.createDataFrame(list(w.items()), "g string, weight double")


def test_weighted_average(spark):
    values = spark.createDataFrame([("g_1", 1.0), ("g_2", 2.0), ("g_3", 3.0)], "g string, v double")
    w = weights(spark, g_1=0.5, g_2=0.4, g_3=0.1, other=9.0)
    assert mt.weighted_average(values, "g", "v", w).first()["value"] == pytest.approx(1.6)
    w = weights(spark, g_1=0.5, g_2=0.5, g_3=0.5)
    assert mt.weighted_average(values, "g", "v", w).first()["value"] == pytest.approx(2.0)
    with pytest.raises(ValueError):
        mt.weighted_average(values, "g", "v", None)


@pytest.fixture(scope="module")
def routes(spark):
    rows = [("r1", "A", 3600.0, "WDTRF"), ("r1", "A", 3600.0, "discard"), ("r2", "A", 3600.0, None), ("r3", "B", 7200.0, "MBP")]
    return spark.createDataFrame(rows, "route_id string, country string, s double, e string")


def test_rates_and_filters(spark, routes):
    assert mt.errors_per_hour(routes, "e", "s").first()["eph"] == pytest.approx(2 / 4)
    only_a = mt.errors_per_hour(routes, "e", "s", filter_=F.col("country") == "A").first()
    assert (only_a["errors"], only_a["eph"]) == (1, pytest.approx(1 / 4))  # hours stay unfiltered
    assert mt.errors_per_hour(routes, "e", "s", filter_=F.col("country") == "Z").first()["eph"] == 0
    assert mt.failed_routes(routes, "e").first()["failed_routes"] == pytest.approx(2 / 3)
    with pytest.raises(ValueError):
        mt.errors_per_hour(routes, "missing", "s")


def test_group_without_filtered_rows_keeps_its_weight(spark, routes):
    w = spark.createDataFrame([("A", 1.0), ("B", 3.0)], "country string, weight double")
    got = mt.weighted_errors_per_hour(routes, "e", "s", "country", w, F.col("country") == "A").first()["eph"]
    assert got == pytest.approx((1 / 2) * 1.0 / 4.0)
    assert mt.weighted_errors_per_hour(routes, "e", "s", "country", w, F.col("e") == "none").first()["eph"] == 0


def test_running_totals_with_hot_key_and_ties(spark):
    df = spark.range(500).select(F.col("id"), F.when(F.col("id") < 300, 7).otherwise(F.col("id") % 5).alias("v"), F.lit("k").alias("key"))
    ranked = od.numbered_by_value(df, "v", ["id"], "rank", chunks=8).collect()
    assert sorted(r["rank"] for r in ranked) == list(range(500))
    order = [r["v"] for r in sorted(ranked, key=lambda r: r["rank"])]
    assert order == sorted(order)
    q = od.exact_quantiles(df, "v", [0.0, 0.25, 0.5, 1.0], ["a", "b", "c", "d"], ["key"]).first()
    values = sorted([7] * 300 + [i % 5 for i in range(300, 500)])
    assert (q["a"], q["d"], q["c"]) == (values[0], values[-1], (values[249] + values[250]) / 2)


@pytest.mark.parametrize("chunks", [1, 3, 40])
def test_order_by_ranges(spark, chunks):
    """Ranks, running counts and quantiles by key, with nulls, NaN, hot values and keys that span several ranges."""
    rng = np.random.default_rng(2)
    rows = [(i, f"k{min(3, i % 9)}", None if i % 50 == 0 else (float("nan") if i % 70 == 1 else float(rng.choice([5.0, rng.normal()], p=[0.4, 0.6])))) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, key string, v double").repartition(7)
    place = lambda v: (v is not None, v is not None and v != v, 0.0 if v is None or v != v else v)
    ranked = {r["rank"]: r for r in od.numbered_by_value(df, "v", ["id"], "rank", chunks=chunks).collect()}
    assert sorted(ranked) == list(range(2000)) and len({r["id"] for r in ranked.values()}) == 2000
    assert [place(ranked[i]["v"]) for i in range(2000)] == sorted(place(v) for _, _, v in rows)
    again = {r["rank"]: r["id"] for r in od.numbered_by_value(df.repartition(3), "v", ["id"], "rank", chunks=chunks + 1).collect()}
    assert again == {k: r["id"] for k, r in ranked.items()}
    clean = df.filter("not isnan(v)")
    got = {(r["key"], r["v"]): (r["n"], r["cum_n"]) for r in od.value_counts_cumulative(clean, "v", {"n": F.lit(1)}, ["key"], chunks).collect()}
    quantiles = {r["key"]: [r[c] for c in "abc"] for r in od.exact_quantiles(clean, "v", [0.1, 0.5, 0.9], list("abc"), ["key"], chunks).collect()}
    for key in {k for _, k, _ in rows}:
        own = np.sort([v for _, k, v in rows if k == key and v is not None and v == v])
        assert {v: x for (k, v), x in got.items() if k == key} == {v: (int((own == v).sum()), int((own <= v).sum())) for v in own.tolist()}
        assert quantiles[key] == pytest.approx(np.quantile(own, [0.1, 0.5, 0.9]).tolist())


def test_a_hot_value_is_cut(spark):
    """Nine of ten rows have one value: no chunk holds more than twice its share, and the input is scanned once."""
    df = spark.range(20_000).select(F.col("id"), F.when(F.col("id") % 10 > 0, 7).otherwise(F.col("id")).alias("v"))
    made = od.by_range(df.withColumn("h", od.hash_key("id")), ["v", "h"], 10)
    sizes = [r["count"] for r in made.groupBy("_chunk").count().collect()]
    assert len(sizes) == 10 and max(sizes) <= 4000
    plan = od.numbered_by_value(df, "v", ["id"], "rank")._jdf.queryExecution().optimizedPlan().toString()
    assert "Range (0, 20000" not in plan


def test_island_runs_across_blocks(spark):
    df = spark.range(40).select(F.lit("t").alias("t"), F.col("id").alias("seq"), F.floor(F.col("id") / 7).alias("a"))
    got = {r["seq"]: r["run_no"] for r in od.island_runs(df, "t", "seq", ["a"], block=4).collect()}
    assert got == {i: i // 7 + 1 for i in range(40)}


def test_bootstrap_interval_needs_two_quantiles(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 3.0)], "seed int, m double")
    row = mt.bootstrap_interval(df, ["m"]).first()
    assert (row["m_lower"], row["m_upper"]) == (pytest.approx(1.1), pytest.approx(2.9))
    with pytest.raises(ValueError):
        mt.bootstrap_interval(df, ["m"], (0.5,))


def test_sweep_at_the_threshold(spark):
    df = spark.createDataFrame([(True, 0.5), (False, 0.0), (True, 1.0), (False, 0.25)], "t boolean, p double")
    rows = {r["step"]: r for r in ev.threshold_sweep(df, "t", "p", 5).collect()}
    assert [(rows[i]["tp"], rows[i]["fp"], rows[i]["tn"], rows[i]["fn"]) for i in range(5)] == [
        (2, 1, 1, 0), (2, 1, 1, 0), (2, 0, 2, 0), (1, 0, 2, 1), (1, 0, 2, 1)
    ]
    assert rows[3]["saving"] == 3 * 2 - 10


def test_sweep_of_columns(spark):
    """Thresholds hit exactly, values outside the range, NULLs and a column without any."""
    steps, stop = 2000, 0.1
    grid = np.linspace(0, stop, steps)
    rng = np.random.default_rng(7)
    rows = [(bool(rng.random() < 0.4), float(rng.choice([grid[rng.integers(0, steps)], rng.uniform(-0.02, 0.12)])), None if i % 3 else float(grid[i % steps]), None) for i in range(900)]
    df = spark.createDataFrame(rows, "t boolean, probability_1 double, probability_2 double, probability_3 double")
    got = {(r["column"], r["step"]): r for r in ev.sweep_columns(df, "t", ["probability_1", "probability_2", "probability_3"], steps, stop).collect()}
    assert len(got) == 3 * steps and got["probability_3", 5]["recall"] is None
    for c, i in (("probability_1", 1), ("probability_2", 2)):
        own = [(r[0], r[i]) for r in rows if r[i] is not None]
        for k in [*range(0, steps, 37), 1, steps - 1]:
            t = got[c, k]["threshold"]
            assert t == pytest.approx(grid[k], abs=1e-15)
            assert got[c, k]["recall"] == pytest.approx(sum(p >= t for y, p in own if y) / sum(y for y, _ in own))
            assert got[c, k]["specificity"] == pytest.approx(sum(p < t for y, p in own if not y) / sum(not y for y, _ in own))


def test_quality_texts(spark):
    one = spark.range(1)
    f = lambda c: one.select(c.alias("f")).select("f.*").first()
    n = F.lit(3)
    warn = f(ql.missing_value(n, F.lit(1), "Missing length", ql.TEXT_MISSING_LENGTH))
    assert warn["level"] == "WARNING" and warn["text"].endswith("on 1 routes. 33.33% percent")
    assert f(ql.missing_value(n, F.lit(1), "Missing length", ql.TEXT_MISSING_LENGTH, 0.4))["level"] == "INFO"
    assert f(ql.missing_value(n, F.lit(0), "Missing length", ql.TEXT_MISSING_LENGTH))["level"] == "OK"
    assert f(ql.empty_routes(F.lit(0), F.lit(0)))["text"] == ql.TEXT_NO_ROWS
    assert f(ql.long_routes(n, F.lit(1), 0.2))["key"] == "Long_routes_percentage"
    assert f(ql.long_routes(n, F.lit(1), 0.5))["level"] == "INFO"
    assert f(ql.not_computed(F.lit(0), F.lit(0)))["level"] == "OK"


def test_sanity_gate(spark):
    with pytest.raises(AssertionError):
        ql.raise_on_failure(spark.createDataFrame([(True,)], "sanity_fail boolean"))
    assert ql.raise_on_failure(spark.createDataFrame([(False,)], "sanity_fail boolean")) is False


def test_island_runs_of_short_keys_need_no_further_shuffle(spark):
    rows = [(t, s, a) for t in ("x", "y", None) for s, a in enumerate([1, 1, None, None, 2, 1])] + [("x", None, 1)]
    df = spark.createDataFrame(rows, "t string, seq int, a int").repartition(3, "t")
    out = od.island_runs(df, "t", "seq", ["a"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan  # the caller's
    got = {(r["t"], r["seq"]): r["run_no"] for r in out.collect()}
    assert got == {(t, s): n for t in ("x", "y", None) for s, n in enumerate([1, 1, 2, 2, 3, 4])}
    assert got == {(r["t"], r["seq"]): r["run_no"] for r in od.island_runs(df, "t", "seq", ["a"], block=4).collect()}
    empty = od.island_runs(df.limit(0), "t", "seq", ["a"])
    assert empty.count() == 0


def test_the_order_alone_is_kept_when_it_is_the_row(spark):
    df = spark.createDataFrame([("k", 2, "a"), ("k", 1, "b"), ("k", 1, None), (None, 3, "c")], "k string, n int, t string")
    out = od.first_per_key(df, ["k"], ["n", "t"])
    assert sorted(map(tuple, out.collect()), key=str) == [("k", 1, None), (None, 3, "c")]
    assert "min_by" not in out._jdf.queryExecution().optimizedPlan().toString()
