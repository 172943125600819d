"""Bootstrap by multinomial splitting against plain resampling and against the moments that follow from the rows."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymark.operators import metrics as mt, resample as rs

ROWS = [(f"r{i}", f"k{i % 3}" if i % 10 else None, "a" if i % 4 else None, float(i % 7), None if i % 9 == 0 else 1.0 + i % 5) for i in range(600)]


@pytest.fixture(scope="module")
def routes(spark):
    return spark.createDataFrame(ROWS, "route_id string, k string, lv string, errors double, hours double").repartition(7)


def test_moments_and_draws(routes):
    """Every resample has as many draws as routes; sums have n times the mean and n times the variance of a route's."""
    made = rs.bootstrap(routes, ["errors", "hours"], {c: F.sum(c) for c in ("draws", "errors", "hours")}, resamples=1000).toPandas()
    assert sorted(made.seed) == list(range(1000)) and (made.draws == 600).all()
    for c, i in (("errors", 3), ("hours", 4)):
        x = np.array([r[i] or 0.0 for r in ROWS])
        assert abs(made[c].mean() - x.sum()) < 6 * np.sqrt(600 * x.var() / 1000)
        assert abs(made[c].var() / (600 * x.var()) - 1) < 6 * np.sqrt(2 / 1000)
    # Both sums of a resample come from the same draws.
    e, h = (np.array([r[i] or 0.0 for r in ROWS]) for i in (3, 4))
    assert abs(np.corrcoef(made.errors, made.hours)[0, 1] - np.corrcoef(e, h)[0, 1]) < 0.15


def test_intervals_like_plain_resampling(routes):
    rng = np.random.default_rng(1)
    e, h = (np.array([r[i] or 0.0 for r in ROWS]) for i in (3, 4))
    plain = []
    for _ in range(4000):
        pick = rng.integers(0, 600, 600)
        plain.append(e[pick].sum() / h[pick].sum())
    made = rs.bootstrap(routes, ["errors", "hours"], {"eph": F.sum("errors") / F.sum("hours")})
    row = mt.bootstrap_interval(made, ["eph"]).first()
    lo, hi = np.quantile(plain, (0.05, 0.95))
    assert abs(row.eph_lower - lo) < 0.1 * (hi - lo) and abs(row.eph_upper - hi) < 0.1 * (hi - lo)


@pytest.mark.parametrize("chunk", [8192, 16])
def test_each_route_is_drawn_like_every_other(spark, chunk):
    """Counts per route over all resamples: binomial, whatever the chunks; two routes are negatively correlated as multinomials are."""
    n, resamples = 64, 500
    df = spark.range(n).select(F.col("id").cast("string").alias("route_id"), *(F.when(F.col("id") == i, 1.0).otherwise(0.0).alias(f"c{i}") for i in range(n)))
    names = [f"c{i}" for i in range(n)]
    sums = rs.resampled_sums(df, names, resamples, chunk=chunk)
    assert sums.groupBy("seed").count().filter(f"`count` <> {1 if chunk > n else 'null'}").count() == 0
    made = sums.groupBy("seed").agg(*(F.sum(c).alias(c) for c in names)).select(*names).toPandas().to_numpy()
    assert (made.sum(1) == n).all() and (made == made.round()).all()
    totals, p = made.sum(0), 1 / n
    chi = ((totals - resamples) ** 2 / (resamples * (1 - p))).sum()
    assert abs(chi - (n - 1)) < 6 * np.sqrt(2 * (n - 1))
    values = collections.Counter(made.ravel().astype(int).tolist())
    for k, expected in enumerate(n * resamples * np.array([0.3651, 0.3709, 0.1855, 0.0608])):
        assert abs(values[k] - expected) < 6 * np.sqrt(expected)
    cov = np.cov(made.T)
    assert abs(cov[~np.eye(n, dtype=bool)].mean() + p) < 0.01


def test_keys_fractions_and_levels(routes):
    """Groups keep their own number of draws, a null key is a group; levels split every resample without a rest."""
    fraction = F.when(F.col("k") == "k0", 0.5).when(F.col("k") == "k1", 1.5).otherwise(1.0)
    made = rs.bootstrap(routes, ["errors"], {"draws": F.sum("draws")}, resamples=60, keys=["k"], fraction=fraction, by=["k"])
    size = collections.Counter(r[1] for r in ROWS)
    want = {k: round(n * {"k0": 0.5, "k1": 1.5}.get(k, 1.0)) for k, n in size.items()}
    assert {(r.k, r.seed): r.draws for r in made.collect()} == {(k, s): d for k, d in want.items() for s in range(60)}
    made = rs.bootstrap(routes, ["errors", "hours"], {c: F.sum(c) for c in ("draws", "errors", "hours")}, resamples=60, levels=["k", "lv"])
    rows = collections.defaultdict(dict)
    for r in made.collect():
        rows[r.seed, r.level][r.level_value] = np.array([r.draws, r.errors, r.hours])
    assert len(rows) == 180
    for seed in range(60):
        whole = rows[seed, "all"][None]
        assert whole[0] == 600 and set(rows[seed, "k"]) == set(size) and set(rows[seed, "lv"]) == {"a", None}
        for level in ("k", "lv"):
            assert np.allclose(sum(rows[seed, level].values()), whole)


def test_same_draws_whatever_the_partitions(spark, routes):
    def drawn(df):
        made = rs.bootstrap(df, ["errors", "hours"], {c: F.sum(c) for c in ("draws", "errors", "hours")}, resamples=70, keys=["k"], by=["k"])
        return {(r.k, r.seed): (r.draws, round(r.errors, 6), round(r.hours, 6)) for r in made.collect()}

    first = drawn(routes)
    assert first == drawn(routes.repartition(3, "errors")) and len({v for (k, _), v in first.items() if k == "k1"}) > 50


def test_no_routes(routes):
    assert rs.bootstrap(routes.filter("false"), ["errors"], {"errors": F.sum("errors")}, resamples=10).count() == 0
    assert rs.bootstrap(routes.filter("false"), ["errors"], {"errors": F.sum("errors")}, resamples=10, keys=["k"], by=["k"]).count() == 0
