"""Bootstrap by multinomial splitting: resamples of any number of routes without a row for each draw.

Drawing n rows with replacement is the same as first drawing how many of the draws fall into each chunk of rows, and then drawing inside
the chunks. The first is a multinomial over the chunks' sizes, a small table; the second is local to a chunk. What leaves a chunk are sums
over its draws, one row for each resample, level and value, which add up over the chunks. Routes are shuffled once, to their chunks.

Every draw depends on the seed, the key group and the chunk only, and a chunk's rows are sorted by their id first: a lost task that runs
again, and a run with other partitions, draw the same.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from waymark.operators.order import hash_key

CHUNK = 8192  # routes of a chunk, more if there would be over MOST_CHUNKS of them in a group
MOST_CHUNKS = 1 << 16
BLOCK = 50  # resamples that are drawn together


def generator(*parts) -> np.random.Generator:
    words = np.frombuffer(hashlib.blake2b(repr(parts).encode(), digest_size=16).digest(), np.uint64)
    return np.random.Generator(np.random.Philox(key=words))


def split_draws(draws: int, sizes: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """``n`` times: how many of the draws fall into each chunk (conditional binomials, one chunk after the other)."""
    return rng.multinomial(draws, sizes / sizes.sum(), size=n)


def drawn_weights(draws: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    """For each of ``draws`` a row of ``size`` numbers: how often each row of the chunk is drawn."""
    seed = np.repeat(np.arange(len(draws)), draws)
    return np.bincount(seed * size + rng.integers(0, size, len(seed)), minlength=len(draws) * size).reshape(len(draws), size)


def resampled_sums(
    routes: DataFrame, sums: list[str], resamples: int = 1000, keys: list[str] | None = None, key: str = "route_id",
    fraction: Column | None = None, levels: list[str] | None = None, chunk: int = CHUNK,
) -> DataFrame:
    """(``keys``, seed, level, level_value, draws, ``sums``): sums over the routes drawn in each resample, for part of the routes.

    Rows of equal keys, seed and level add up. ``level`` is ``all`` (level_value null) and each of ``levels``, a column of the
    routes. ``fraction`` scales the draws of a key group. A null in ``sums`` counts as 0; null keys are a group of their own.
    """
    keys, levels = keys or [], levels or []
    names = [f"_k{i}" for i in range(len(keys))]
    rows = routes.select(
        *(F.col(k).alias(n) for k, n in zip(keys, names)), F.col(key).cast("string").alias("_id"),
        *(F.col(v).cast("string").alias(f"_l{i}") for i, v in enumerate(levels)), *(F.coalesce(F.col(s).cast("double"), F.lit(0.0)).alias(s) for s in sums),
    )
    factor = F.lit(1.0) if fraction is None else fraction
    groups = routes.groupBy(*(F.col(k).alias(n) for k, n in zip(keys, names))).agg(F.count("*").alias("_n"))
    groups = groups.withColumns({k: F.col(n) for k, n in zip(keys, names)}).withColumn("_draws", F.round(factor * F.col("_n")).cast("long")).drop(*keys)
    wide = F.greatest(F.lit(chunk), F.ceil(F.col("_n") / MOST_CHUNKS))
    groups = groups.withColumn("_chunks", F.ceil(F.col("_n") / wide))

    def with_group(df: DataFrame) -> DataFrame:
        if not names:
            return df.crossJoin(F.broadcast(groups))  # one row
        other = groups.select(*(F.col(n).alias(f"_g{n}") for n in names), "_n", "_draws", "_chunks")
        on = reduce(lambda a, b: a & b, (F.col(n).eqNullSafe(F.col(f"_g{n}")) for n in names))
        return df.join(other, on).drop(*(f"_g{n}" for n in names))

    rows = with_group(rows).withColumn("_chunk", F.pmod(hash_key("_id", seed=1), F.col("_chunks")))
    sizes = rows.groupBy(*names, "_draws", "_chunk").agg(F.count("*").alias("_size"))
    listed = sizes.groupBy(*names, "_draws").agg(F.array_sort(F.collect_list(F.struct("_chunk", "_size"))).alias("_sizes"))
    blocks = -(-resamples // BLOCK)
    todo = listed.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).repartition(*names, "_block")
    kinds = {f.name: f.dataType for f in rows.schema}
    split_schema = T.StructType([*(T.StructField(n, kinds[n]) for n in names), T.StructField("_chunk", T.LongType()), T.StructField("_block", T.IntegerType()), T.StructField("_counts", T.ArrayType(T.LongType()))])

    def split(batches):
        for batch in batches:
            for row in batch.to_pylist():
                own = [str(row[n]) for n in names]
                parts = np.array([(x["_chunk"], x["_size"]) for x in row["_sizes"]], np.int64)
                n = min(BLOCK, resamples - row["_block"] * BLOCK)
                counts = split_draws(row["_draws"], parts[:, 1], n, generator("split", own, row["_block"])).T
                out = {n: [row[n]] * len(parts) for n in names}
                out |= {"_chunk": parts[:, 0], "_block": np.full(len(parts), row["_block"], np.int32)}
                yield pa.RecordBatch.from_pydict(out | {"_counts": pa.array(list(counts), pa.list_(pa.int64()))}, pa.schema([*(batch.schema.field(n) for n in names), ("_chunk", pa.int64()), ("_block", pa.int32()), ("_counts", pa.list_(pa.int64()))]))

    splits = todo.mapInArrow(split, split_schema)
    fields = [("seed", T.IntegerType()), ("level", T.StringType()), ("level_value", T.StringType()), ("draws", T.LongType()), *((s, T.DoubleType()) for s in sums)]
    schema = T.StructType([*(T.StructField(n, kinds[n]) for n in names), *(T.StructField(n, t) for n, t in fields)])

    def draw(key, left, right):
        # One column more counts the draws.
        left = left.sort_by([("_id", "ascending"), *((s, "ascending") for s in sums)])
        values = np.column_stack([np.ones(left.num_rows), *(left.column(s).to_numpy() for s in sums)])
        masks = [("all", None, slice(None))]
        for i, level in enumerate(levels):
            codes = left.column(f"_l{i}").combine_chunks().dictionary_encode(null_encoding="encode")
            index = codes.indices.to_numpy()
            masks += [(level, value, index == k) for k, value in enumerate(codes.dictionary.to_pylist())]
        own, chunk_no = [str(k.as_py()) for k in key[:-1]], key[-1].as_py()
        out = {name: [] for name, _ in fields}
        for block, counts in sorted(zip(right.column("_block").to_pylist(), right.column("_counts").to_pylist())):
            weights = drawn_weights(np.array(counts), len(values), generator("draw", own, chunk_no, block)).astype(float)
            for level, value, mask in masks:
                got = weights[:, mask] @ values[mask]
                out["seed"] += range(block * BLOCK, block * BLOCK + len(counts))
                out["level"] += [level] * len(counts)
                out["level_value"] += [value] * len(counts)
                out["draws"].append(got[:, 0].round().astype(np.int64))
                for i, s in enumerate(sums):
                    out[s].append(got[:, i + 1])
        n = len(out["seed"])
        columns = [pa.array([k.as_py()] * n, k.type) for k in key[:-1]]
        columns += [pa.array(out["seed"], pa.int32()), pa.array(out["level"], pa.string()), pa.array(out["level_value"], pa.string())]
        columns += [pa.array(np.concatenate(out[c])) for c in ("draws", *sums)]
        return pa.Table.from_arrays(columns, [*names, *(f for f, _ in fields)])

    on = [*names, "_chunk"]
    kept = rows.drop("_n", "_draws", "_chunks")
    made = kept.groupBy(*on).cogroup(splits.groupBy(*on)).applyInArrow(draw, schema)
    return made.select(*(F.col(n).alias(k) for k, n in zip(keys, names)), *(f for f, _ in fields))


def bootstrap(
    routes: DataFrame, sums: list[str], metrics: dict[str, Column], resamples: int = 1000, keys: list[str] | None = None, key: str = "route_id",
    fraction: Column | None = None, by: list[str] | None = None, levels: list[str] | None = None,
) -> DataFrame:
    """Resample routes with replacement (per ``keys``) and recompute the metrics for each seed (and ``by``, some of the keys).

    ``routes`` has one row per route with partial sums. ``metrics`` are aggregates of the columns ``sums`` and ``draws`` (routes drawn).
    With ``levels`` there is a row for each level and value too.
    """
    made = resampled_sums(routes, sums, resamples, keys, key, fraction, levels)
    return made.groupBy(*(by or []), "seed", *(["level", "level_value"] if levels else [])).agg(*[c.alias(n) for n, c in metrics.items()])
