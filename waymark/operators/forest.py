"""A random forest of two classes grown on counts instead of rows.

A tree only asks in which of ``BINS`` bins a feature lies, so rows with the same bins and label are one cell with a count. A bootstrap gives
each row a Poisson(1) weight, hence each cell of n rows a Poisson(n) weight: the trees are drawn as from the rows. Two passes over the rows
are left, whatever the number and depth of the trees. Cells lie on the driver, ``CELLS`` of them at most; beyond, ``counted`` gives none.

As in Spark's forest: Gini, the root of the features tried at each node, cuts between neighbouring values, leaves of one parent
that predict the same class merged, the mean of the leaves' shares as probability.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, functions as F

BINS = 32
CELLS = 1 << 17
POINTS = 1024  # quantiles of a feature that its cuts are chosen from
TABLE = 1 << 18  # a forest of at most so many combinations of bins answers from a table
ENTRIES = 1 << 20  # cells x trees that grow at a time


def _known(name: str) -> Column:
    x = F.col(name).cast("double")
    return F.when(~F.isnan(x), x)


def cuts(points: np.ndarray, weights: np.ndarray, bins: int = BINS) -> np.ndarray:
    """At most ``bins`` - 1 cuts, midway between neighbours of the sorted values: all of them, or those nearest to equal shares of the weight."""
    value, at = np.unique(points, return_inverse=True)
    middle, passed = (value[:-1] + value[1:]) / 2, np.bincount(at, weights).cumsum()
    if len(value) > bins:
        stride, chosen = passed[-1] / bins, []
        target = stride
        for i in range(len(middle)):
            if abs(passed[i] - target) < abs(passed[i + 1] - target):
                chosen.append(i)
                target += stride
        middle = middle[chosen[: bins - 1]]
    return np.unique(middle)


def counted(df: DataFrame, features: list[str], label: str, trees: int, depth: int, seed: int, cells: int | None = None) -> CountedForest | None:
    """The forest of ``df``'s rows; None where counts don't serve: no more rows than ``cells``, more cells than that, or not two labels, 0 and 1."""
    cells = CELLS if cells is None else cells
    grid = ", ".join(f"{i / POINTS}d" for i in range(POINTS + 1))
    rows = df.select(F.col(label).alias("_y"), *(_known(f).alias(f"_{i}") for i, f in enumerate(features)))
    asked = [F.count("*").alias("n"), F.count_if(F.col("_y") == 0).alias("no"), F.count_if(F.col("_y") == 1).alias("yes")]
    for i in range(len(features)):
        asked += [F.count(f"_{i}").alias(f"n{i}"), F.avg(f"_{i}").alias(f"m{i}"), F.var_pop(f"_{i}").alias(f"v{i}"), F.expr(f"percentile_approx(_{i}, array({grid}), {2 * POINTS})").alias(f"p{i}")]
    s = rows.agg(*asked).first()
    if s.n <= cells or not s.no or not s.yes or s.no + s.yes < s.n or any(not s[f"n{i}"] or not math.isfinite(s[f"v{i}"]) for i in range(len(features))):
        return None
    means = [s[f"m{i}"] for i in range(len(features))]
    # The deviation is that of the imputed values; a feature without any is 0 for all rows.
    deviations = [math.sqrt(s[f"v{i}"] * s[f"n{i}"] / (s.n - 1)) for i in range(len(features))]
    edges = []
    for i, (m, d) in enumerate(zip(means, deviations, strict=True)):
        # Rows without the value lie at the mean, which is 0.
        points, missing = np.array(s[f"p{i}"]), s.n - s[f"n{i}"]
        weights = [*[s[f"n{i}"] / len(points)] * len(points), *([missing] if missing else [])]
        edges.append(cuts(np.append((points - m) / d, [0.0] if missing else []), np.array(weights)) if d else np.empty(0))
    cut, names = [i for i, e in enumerate(edges) if len(e)], {f"_{i}": F.lit(0.0) for i, e in enumerate(edges) if not len(e)}
    rows = rows.withColumns({f"_{i}": (F.coalesce(f"_{i}", F.lit(means[i])) - means[i]) / deviations[i] for i in cut} | names)
    if cut:
        # A bucket begins at its lower bound; a value at a cut belongs below it.
        bounds = [[-math.inf, *np.nextafter(edges[i], math.inf).tolist(), math.inf] for i in cut]
        rows = Bucketizer(splitsArray=bounds, inputCols=[f"_{i}" for i in cut], outputCols=[f"_b{i}" for i in cut]).transform(rows)
    held = [f"_b{i}" if i in cut else f"_{i}" for i in range(len(features))]
    found = rows.groupBy(*held).agg(F.count_if(F.col("_y") == 0).alias("no"), F.count_if(F.col("_y") == 1).alias("yes")).limit(cells + 1).toArrow()
    if found.num_rows > cells:
        return None
    found = np.stack([c.to_numpy() for c in found.columns], 1).astype(np.int64)
    found = found[np.lexsort(found.T[::-1])]  # the same draws whatever the order of the groups
    own = np.random.default_rng(seed)
    subset = len(features) if trees == 1 else math.ceil(math.sqrt(len(features)))
    widths = [len(e) + 1 for e in edges]
    some = max(1, ENTRIES // len(found))
    grown = [grow(found[:, :-2], widths, found[:, -2:], min(some, trees - at), depth, subset, own) for at in range(0, trees, some)]
    return CountedForest(features, means, deviations, edges, grown)


def _gini(n: np.ndarray) -> np.ndarray:
    return 1 - ((n / np.maximum(n.sum(-1, keepdims=True), 1)) ** 2).sum(-1)


def grow(bins: np.ndarray, widths: list[int], counts: np.ndarray, trees: int, depth: int, subset: int, own: np.random.Generator) -> list[np.ndarray]:
    """(feature or -1, last bin to the left, left child, counts of both classes) by node; the first ``trees`` nodes are roots."""
    features = bins.shape[1]
    weight = own.poisson(counts, (trees, *counts.shape))
    node, cell = np.nonzero(weight.any(axis=2))
    weight = weight[node, cell].astype(float)
    levels, first, m = [], 0, trees
    for level in range(depth + 1):
        total = np.stack([np.bincount(node, weight[:, c], m) for c in (0, 1)], 1)
        best, feature, last = np.zeros(m), np.full(m, -1), np.zeros(m, np.int64)
        tried = own.random((m, features)).argsort(1) if level < depth else None
        for f, width in enumerate(widths):
            if level == depth or width < 2:
                continue
            at = node * width + bins[cell, f]
            left = np.stack([np.bincount(at, weight[:, c], m * width).reshape(m, width) for c in (0, 1)], 2).cumsum(1)[:, :-1]
            right = total[:, None] - left
            n, nl, nr = np.maximum(total.sum(1), 1)[:, None], left.sum(2), right.sum(2)
            gain = _gini(total)[:, None] - nl / n * _gini(left) - nr / n * _gini(right)
            gain[(nl < 1) | (nr < 1)] = 0
            gain[~(tried[:, :subset] == f).any(1)] = 0
            top = gain.argmax(1)
            gain = gain[np.arange(m), top]
            better = gain > best
            best[better], feature[better], last[better] = gain[better], f, top[better]
        split = feature >= 0
        child = np.where(split, first + m + 2 * (split.cumsum() - 1), -1)
        levels.append([feature, last, child, total])
        held = split[node]
        node, cell, weight = node[held], cell[held], weight[held]
        node = child[node] - first - m + (bins[cell, feature[node]] > last[node])
        first, m = first + m, 2 * int(split.sum())
        if not m:
            break
    out = [np.concatenate(x) for x in zip(*levels, strict=True)]
    feature, _, child, total = out
    says = total[:, 1] > total[:, 0]
    at = len(feature)
    for found in reversed(levels):
        at -= len(found[0])
        i = at + np.flatnonzero(feature[at : at + len(found[0])] >= 0)
        c = child[i]
        feature[i[(feature[c] < 0) & (feature[c + 1] < 0) & (says[c] == says[c + 1])]] = -1
    return out


class CountedForest:
    """Scores rows as a fitted Spark pipeline does: ``transform`` adds ``class_probability``, here an array."""

    def __init__(self, features: list[str], means: list[float], deviations: list[float], edges: list[np.ndarray], grown: list[list[np.ndarray]]):
        self.features, self.means, self.deviations, self.edges = features, means, deviations, edges
        starts = np.cumsum([0, *(len(g[0]) for g in grown)])
        # A batch has its nodes behind those of the batches before. Its roots come first: the nodes before the first child.
        self.feature, self.last = (np.concatenate([g[i] for g in grown]) for i in (0, 1))
        self.child = np.concatenate([g[2] + s for g, s in zip(grown, starts, strict=False)])
        total = np.concatenate([g[3] for g in grown])
        self.share = total[:, 1] / np.maximum(total.sum(1), 1)
        self.roots = np.concatenate([s + np.arange(int(min([*g[2][g[2] >= 0], len(g[2])]))) for g, s in zip(grown, starts, strict=False)])
        self.widths = [len(e) + 1 for e in edges]
        self.table = self.shares(np.indices(self.widths).reshape(len(edges), -1).T) if math.prod(self.widths) <= TABLE else None

    def shares(self, bins: np.ndarray) -> np.ndarray:
        """The mean share of class 1 in the leaves of each row of bins."""
        out = np.empty(len(bins))
        for at in range(0, len(bins), 1 << 14):
            some = bins[at : at + (1 << 14)]
            rows, node = np.arange(len(some))[:, None], np.tile(self.roots, (len(some), 1))
            while (inner := self.feature[node] >= 0).any():
                beyond = some[rows, np.maximum(self.feature[node], 0)] > self.last[node]
                node = np.where(inner, self.child[node] + beyond, node)
            out[at : at + (1 << 14)] = self.share[node].mean(1)
        return out

    def probability(self, columns: list[np.ndarray]) -> np.ndarray:
        """Class 1 by standardised values, NaN where they are missing."""
        bins = []
        for x, mean, deviation, edges in zip(columns, self.means, self.deviations, self.edges, strict=True):
            bins.append(np.searchsorted(edges, (np.where(np.isnan(x), mean, x) - mean) / deviation) if len(edges) else np.zeros(len(x), np.int64))
        if self.table is not None:
            return self.table[np.ravel_multi_index(bins, self.widths)]
        some, place = np.unique(np.stack(bins, 1), axis=0, return_inverse=True)
        return self.shares(some)[place.reshape(-1)]

    def transform(self, df: DataFrame) -> DataFrame:
        forest = self

        @F.arrow_udf("double")
        def share(*columns: pa.Array) -> pa.Array:
            return pa.array(forest.probability([np.asarray(c.cast(pa.float64()).fill_null(math.nan)) for c in columns]))

        p = share(*(F.col(f).cast("double") for f in self.features))
        return df.withColumn("_p", p).withColumn("class_probability", F.array(1 - F.col("_p"), F.col("_p"))).drop("_p")
