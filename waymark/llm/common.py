"""Helpers of the operators: tables, written intermediate results, and words of Arrow text columns as numpy arrays."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.session import ensure_checkpoint_dir

# Bytes of text that one numpy step handles; a longer text is a step of its own.
STEP_BYTES = 2 << 20
# The largest Bloom filter of ids that is sent to the tasks.
FILTER_BITS = 1 << 28

# The separators of words: space and the bytes 9 to 13. All are ASCII, so UTF-8 can be cut at them.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[32, *range(9, 14)]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_scratch: list[list[str]] = []  # for each open block, the folders that go at its end


def shared_path(spark: SparkSession, keep: bool = False) -> str:
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table_{uuid.uuid4().hex}"
    if _scratch and not keep:
        _scratch[-1].append(path)
    return path


def materialise(df: DataFrame, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder once and read it again: cuts the lineage and survives a lost executor."""
    path = shared_path(df.sparkSession, keep)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is written inside the block goes at its end, but for tables written with ``keep``."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def bucketed(df: DataFrame, column: str) -> Iterator[DataFrame]:
    """``df`` written to the shared folder in buckets of ``column``: joins on it shuffle the other side only.

    The table leaves the catalog at the end of the block; what needs it is written by then.
    """
    spark = df.sparkSession
    path, count = shared_path(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = path.rpartition("/")[2]
    df.repartition(count, column).write.bucketBy(count, column).sortBy(column).option("path", path).saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@contextmanager
def small_batches(spark: SparkSession, size: str = "12m") -> Iterator[None]:
    """Arrow batches of at most ``size`` for what is written inside the block: rows that carry whole sets are large."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
# The same with A-Z read as a-z.
LOWER_VALUES = BYTE_VALUES.copy()
LOWER_VALUES[65:91] = BYTE_VALUES[97:123]

BASE = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2^64
INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        step = np.full(max(n, 1 << 16), base, np.uint64)
        step[0] = 1
        known = np.cumprod(step, dtype=np.uint64)
        if n <= 4 * STEP_BYTES:
            _powers[base] = known
    return known[:n]


class SpanHash:
    """Hashes of any byte spans of ``data``; equal bytes give equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray, values: np.ndarray | None = BYTE_VALUES):
        """``values``: the number that stands for each byte; None if ``data`` holds such numbers already."""
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data if values is None else values[data]) * powers(BASE, len(data)), out=self.sums[1:])
        self.inverse = powers(INVERSE, len(data) + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix(raw + (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and the offset of each text and of the end. A null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, bytes_ = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(where, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(bytes_, np.uint8)[offsets[0] : offsets[-1]] if bytes_ is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def steps(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``limit`` bytes of text and at least one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = utf8(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def word_spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the index of each text's first word (and of the end)."""
    inside = ~separator[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = False
    after[edges - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's long."""
    return x.view(np.int64)


class HashTable:
    """Places of known 64-bit keys, looked up for whole arrays at once; -1 for other keys."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.asarray(keys, np.uint64)
        self.bits = max(10, int(np.ceil(np.log2(8 * len(self.keys) + 1))))
        self.slots = np.full(1 << self.bits, -1, np.int32)
        left, step = np.arange(len(self.keys)), 0
        while len(left):
            at = self.home(self.keys[left], step)
            free = np.flatnonzero(self.slots[at] < 0)
            _, one = np.unique(at[free], return_index=True)
            taken = free[one]
            self.slots[at[taken]] = left[taken]
            left, step = np.delete(left, taken), step + 1

    def home(self, keys: np.ndarray, step: int) -> np.ndarray:
        return ((keys >> np.uint64(64 - self.bits)).astype(np.int64) + step) & ((1 << self.bits) - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int32)
        if not len(self.keys):
            return out
        left, step = np.arange(len(keys)), 0
        while len(left):
            own = keys[left]
            got = self.slots[self.home(own, step)]
            full = got >= 0
            hit = full & (self.keys[got] == own)
            out[left[hit]] = got[hit]
            left, step = left[full & ~hit], step + 1
        return out


class Ids:
    """A Bloom filter of ids: what it lets through may be more than the ids, never less."""

    SHIFTS = (0, 18, 36)

    def __init__(self, ids: DataFrame, count: int, hashed: Column | None = None):
        """``hashed``: the 64-bit hash that stands for a row of ``ids``; that of its doc_id if not given."""
        self.mask = min(FILTER_BITS, max(1 << 15, 1 << (16 * count).bit_length())) - 1
        hashed = F.xxhash64("doc_id") if hashed is None else hashed
        bit = F.explode(F.array(*(F.shiftrightunsigned(hashed, k).bitwiseAND(self.mask) for k in self.SHIFTS)))
        rows = ids.select(bit.alias("bit")).groupBy(F.shiftright("bit", 15).alias("part")).agg(F.bitmap_construct_agg(F.col("bit").bitwiseAND(32767)).alias("bits")).collect()
        self.bits = np.zeros((self.mask + 1) // 8, np.uint8)
        for row in rows:
            self.bits[row.part << 12 : (row.part + 1) << 12] = np.frombuffer(row.bits, np.uint8)

    def hold(self, hashes: pa.Array) -> np.ndarray:
        return self.holds(hashes.to_numpy(zero_copy_only=False).view(np.uint64))

    def holds(self, h: np.ndarray) -> np.ndarray:
        ok = np.ones(len(h), bool)
        for k in self.SHIFTS:
            bit = (h >> np.uint64(k)) & np.uint64(self.mask)
            ok &= (self.bits[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return ok


def only(docs: DataFrame, ids: DataFrame, keep: bool = False) -> tuple[DataFrame, object]:
    """Rows of ``docs`` (doc_id, text, ...) with the hash of their id, and a filter for tasks that holds ``ids`` (distinct doc_id).

    Up to 2^24 ids it is a Bloom filter of bounded size, so that texts need not be shuffled. Beyond, there is no filter, and the rows are
    those of a semi-join, or all rows if ``keep``.
    """
    count = ids.count()
    hashed = docs.withColumn("h", F.xxhash64("doc_id"))
    if 16 * count <= FILTER_BITS:
        return hashed, docs.sparkSession.sparkContext.broadcast(Ids(ids, count))
    return hashed if keep else hashed.join(ids, "doc_id", "left_semi"), None


def passed(batches, shared, limit: int = STEP_BYTES):
    """The steps of what the filter lets through."""
    for batch in batches:
        if shared is not None:
            batch = batch.filter(pa.array(shared.value.hold(batch.column("h"))))
        yield from steps(iter([batch]), limit=limit)
