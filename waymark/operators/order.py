"""Order-dependent operators that stay distributed when one key holds a large share of the rows.

Window functions sort a whole key group in one task. Everything here either aggregates with
map-side combine (picks) or cuts the order into chunks first (running totals, ranks, quantiles).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window as W

from waymark.session import cut_lineage


def newest_first(col: Column | str) -> Column:
    """Ascending sort key that puts the latest date or timestamp first and NULL last."""
    col = F.col(col) if isinstance(col, str) else col
    return F.struct(col.isNull(), -F.unix_micros(col.cast("timestamp")))


def largest_first(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.struct(col.isNull(), -col.cast("double"))


def first_per_key(df: DataFrame, keys: list[str], order_by: list[Column | str]) -> DataFrame:
    """The row of each key that sorts first; NULL is a key value like any other.

    One aggregate with partial results on the map side, so a hot key sends one row per task.
    """
    order = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"o{i}") for i, c in enumerate(order_by)])
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    if all(isinstance(c, str) for c in order_by) and set(rest) <= set(order_by):
        # The order is the row: it needs no second copy of its columns.
        least = df.groupBy(*keys).agg(F.min(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)])).alias("_row"))
        return least.select(*[F.col(c) if c in keys else F.col(f"_row.o{order_by.index(c)}").alias(c) for c in df.columns])
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def hash_key(*cols: Column | str, seed: int = 0) -> Column:
    """60-bit repeatable pseudo-random BIGINT from the md5 of the columns and a seed."""
    text = F.concat_ws("|", F.lit(str(seed)), *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


HASH_SPAN = 1 << 60


def hash_unit(*cols: Column | str, seed: int = 0) -> Column:
    """The same hash on [0, 1)."""
    return hash_key(*cols, seed=seed).cast("double") / F.lit(float(HASH_SPAN))


def chunk_count(most: int = 1 << 16) -> int:
    """How many chunks an order is cut into: four per shuffle partition, 64 at least. Results do not depend on it."""
    spark = SparkSession.getActiveSession()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions")) if spark else 0
    return max(64, min(most, 4 * partitions))


def hash_chunk(key: Column, chunks: int | None = None) -> Column:
    """Order-preserving chunk number of a 60-bit hash: uniform by construction."""
    chunks = chunks or chunk_count()
    return F.floor(key.cast("double") / F.lit(float(HASH_SPAN)) * chunks).cast("int")


def by_range(df: DataFrame, order_by: list[Column | str], chunks: int | None = None) -> DataFrame:
    """``df`` with ``_chunk``, a number that grows with the order: the partition of a range shuffle.

    There are as many chunks as shuffle partitions, and Spark draws their bounds from the rows, so that chunks keep their size when the
    table grows. With a hash behind the value in ``order_by`` the rows of a hot value are cut by the hash. The rows are written to the
    checkpoint folder: what comes after reads them there, and a task that runs again finds the same chunks.
    """
    parts = chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(df.repartitionByRange(parts, *order_by).withColumn("_chunk", F.spark_partition_id()))


def running_totals(
    df: DataFrame, order_by: list[Column | str], totals: dict[str, Column], chunk: Column, keys: list[str] | None = None
) -> DataFrame:
    """Inclusive running sums per key in the given order.

    ``chunk`` must grow with the order. Sums inside a chunk come from a window over (keys, chunk);
    the sum of the chunks before comes from one small row per (keys, chunk).
    """
    keys = keys or []
    names = list(totals)
    work = df.withColumn("_chunk", chunk)
    for name in names:
        work = work.withColumn(f"_v_{name}", totals[name])
    per_chunk = work.groupBy(*keys, "_chunk").agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in names])
    before = W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_chunk.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_chunk").alias("_c"),
        *[F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in names],
    )
    on = reduce(
        lambda a, b: a & b,
        [F.col("_chunk") == F.col("_c")] + [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys],
    )
    inside = W.partitionBy(*keys, "_chunk").orderBy(*order_by).rowsBetween(W.unboundedPreceding, 0)
    joined = work.join(offsets, on)
    return joined.select(
        *df.columns, *[(F.sum(f"_v_{n}").over(inside) + F.col(f"_b_{n}")).alias(n) for n in names]
    )


def numbered(
    df: DataFrame, id_cols: list[str], out: str = "row_id", seed: int = 0, chunks: int | None = None, keys: list[str] | None = None
) -> DataFrame:
    """Consecutive numbers from 0 (per key) in hash order of the ids: no single-task sort."""
    work = df.withColumn("_h", hash_key(*id_cols, seed=seed))
    ranked = running_totals(
        work, ["_h", *id_cols], {out: F.lit(1).cast("bigint")}, hash_chunk(F.col("_h"), chunks), keys
    )
    return ranked.withColumn(out, F.col(out) - 1).drop("_h")


def numbered_by_value(
    df: DataFrame, value: str, tie_break: list[str], out: str = "row_id", chunks: int | None = None
) -> DataFrame:
    """Consecutive numbers from 0 by value; rows with the same value follow their hash, then the tie-break."""
    order = [value, "_h", *tie_break]
    work = by_range(df.withColumn("_h", hash_key(*tie_break)), order, chunks)
    ranked = running_totals(work, order, {out: F.lit(1).cast("bigint")}, F.col("_chunk"))
    return ranked.withColumn(out, F.col(out) - 1).drop("_h", "_chunk")


def value_counts_cumulative(
    df: DataFrame, value: str, counts: dict[str, Column], keys: list[str] | None = None, chunks: int | None = None
) -> DataFrame:
    """One row per (keys, value) with counts ``name`` and inclusive running counts ``cum_name``.

    Rows are reduced to distinct values before anything is ordered.
    """
    keys = keys or []
    per_value = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        *[F.sum(expr).cast("bigint").alias(name) for name, expr in counts.items()]
    )
    ranged = by_range(per_value, [*keys, value], chunks)
    return running_totals(ranged, [value], {f"cum_{n}": F.col(n) for n in counts}, F.col("_chunk"), keys).drop("_chunk")


def exact_quantiles(
    df: DataFrame, value: str, quantiles: list[float], names: list[str], keys: list[str] | None = None, chunks: int | None = None
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per key, by distributed rank selection."""
    keys = keys or []
    ranked = value_counts_cumulative(df, value, {"_n": F.lit(1)}, keys, chunks)
    total = ranked.groupBy(*keys).agg(F.max("cum__n").alias("_total"))
    if keys:
        on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys])
        total = total.select(*[F.col(k).alias(f"_t_{k}") for k in keys], "_total")
        ranked = ranked.join(total, on).drop(*[f"_t_{k}" for k in keys])
    else:
        ranked = ranked.crossJoin(F.broadcast(total))  # one row
    aggs = []
    for q, name in zip(quantiles, names):
        pos = F.lit(q) * (F.col("_total") - 1)
        lo, hi = F.floor(pos), F.ceil(pos)

        def at(rank):
            inside = (F.col("cum__n") - F.col("_n") <= rank) & (rank < F.col("cum__n"))
            return F.max(F.when(inside, F.col(value).cast("double")))

        frac = F.max(pos - lo)
        aggs.append((at(lo) + (at(hi) - at(lo)) * frac).alias(name))
    return ranked.groupBy(*keys).agg(*aggs)


def exact_sample(df: DataFrame, n: int, id_cols: list[str], seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows, repeatable: the ``n`` smallest hashes (Spark keeps n rows per task)."""
    return df.withColumn("_h", hash_key(*id_cols, seed=seed)).orderBy("_h", *id_cols).limit(n).drop("_h")


def fraction_sample(df: DataFrame, fraction: float, id_cols: list[str], seed: int = 0) -> DataFrame:
    """Repeatable share of the rows: a filter, no shuffle."""
    return df.filter(hash_unit(*id_cols, seed=seed) < F.lit(fraction))


def split_by_weights(
    df: DataFrame, weights: dict[str, float], id_cols: list[str], seed: int = 0, out: str = "split"
) -> DataFrame:
    """Label every row with a named share by its hash; labels partition the table."""
    total = float(sum(weights.values()))
    u = hash_unit(*id_cols, seed=seed)
    label, edge = None, 0.0
    names = list(weights)
    for name in names[:-1]:
        edge += weights[name] / total
        cond = u < F.lit(edge)
        label = F.when(cond, F.lit(name)) if label is None else label.when(cond, F.lit(name))
    last = F.lit(names[-1])
    return df.withColumn(out, last if label is None else label.otherwise(last))


def island_runs(
    df: DataFrame, key: str, seq: str, same_cols: list[str], block: int = 10000
) -> DataFrame:
    """Number the runs of consecutive rows (dense ``seq`` per key) that agree on ``same_cols``.

    A long key is cut into blocks of ``seq``; the last row of a block is copied into the next one, so
    the comparison with the row before never needs the whole key in one task. Where every key lies in
    one block, which one pass over ``seq`` tells, a window per key is all: no totals of blocks, no join.
    """
    number = F.floor(F.col(seq) / block)
    rows = df.filter(F.col(seq).isNotNull())
    first_block, last_block = rows.agg(F.min(number), F.max(number)).first()

    def flagged(part, w):
        part = part.withColumn("_first", F.lag(F.lit(1)).over(w).isNull()).withColumn("_prev", F.lag("_attrs").over(w))
        return part.withColumn("_new", F.when(F.col("_first") | ~F.col("_prev").eqNullSafe(F.col("_attrs")), 1).otherwise(0).cast("bigint"))

    if first_block == last_block:
        w = W.partitionBy(key).orderBy(seq)
        own = flagged(rows.withColumn("_attrs", F.struct(*same_cols)), w)
        return own.select(*df.columns, F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)).alias("run_no"))
    is_last = F.pmod(F.col(seq), F.lit(block)) == block - 1
    copies = F.when(is_last, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    both = rows.withColumn("_edge", F.explode(copies)).withColumn("_attrs", F.struct(*same_cols))
    both = both.withColumn("_block", number + F.col("_edge").cast("int"))
    own = flagged(both, W.partitionBy(key, "_block").orderBy(seq)).filter(~F.col("_edge"))
    numbered_runs = running_totals(own, [seq], {"run_no": F.col("_new")}, F.col("_block"), [key])
    return numbered_runs.select(*df.columns, "run_no")
