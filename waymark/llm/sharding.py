"""Consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations.

The ring has ``PLACES`` places. Each shard owns ``vnodes`` points of it; a document stands at the place of its id's hash, by the
hash within the place, and belongs to the next point clockwise. A shard's bound is its even share: the total over the shards, the
first ones taking one more if it does not divide. First every shard takes its own documents clockwise up to its
bound; what overflows then walks on clockwise, in ring order, and fills the next shards that have room. So counts differ by one
at most, and another number of shards moves little more than the new share.

Only the counts of the places (``PLACES`` rows, whatever the input) reach the driver, and as many rows go back as a table to
be broadcast. Documents are ranked within their place; hashing spreads them evenly, whatever their source or text. Null
ids stand by the hash of their text. Rows with equal ids are ordered by a hash of the whole row; equal rows are interchangeable.
An empty table gives an empty result; the other columns are kept, but for those named like the results.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SHARDS = 16
VNODES = 64
PLACES = 1 << 13


def owners(spark: SparkSession, shards: int, vnodes: int = VNODES) -> list[int]:
    """The shard that each place belongs to. Of several points at one place the one with the least hash counts."""
    nodes = spark.range(shards * vnodes).select((F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).alias("vnode"))
    nodes = nodes.withColumn("h", F.xxhash64(F.lit("node"), "shard", "vnode"))
    rows = nodes.groupBy(F.pmod("h", F.lit(PLACES)).alias("place")).agg(F.min_by("shard", F.struct("h", "shard")).alias("shard")).collect()
    points = {r.place: r.shard for r in rows}
    out, shard = [0] * PLACES, points[min(points)]  # after the last point the ring begins again
    for place in reversed(range(PLACES)):
        shard = points.get(place, shard)
        out[place] = shard
    return out


def quotas(total: int, shards: int) -> list[int]:
    return [total // shards + (s < total % shards) for s in range(shards)]


def dealt(counts: dict[int, int], owner: list[int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (place, from, to, shard, first slot) of the ranks in each place."""
    room, used, pieces, over = quotas(sum(counts.values()), shards), [0] * shards, [], {}

    def take(place: int, at: int, end: int, shard: int) -> int:
        n = min(end - at, room[shard] - used[shard])
        if n:
            pieces.append((place, at, at + n, shard, used[shard]))
            used[shard] += n
        return at + n

    for place, shard in enumerate(owner):
        n = counts.get(place, 0)
        at = take(place, 0, n, shard)
        if at < n:
            over[place] = (at, n)
    waiting: deque[tuple[int, int, int]] = deque()
    for turn in range(2):
        for place, shard in enumerate(owner):
            if not turn and place in over:
                waiting.append((place, *over[place]))
            while waiting and used[shard] < room[shard]:
                came, at, end = waiting.popleft()
                at = take(came, at, end, shard)
                if at < end:
                    waiting.appendleft((came, at, end))
    return pieces


def text_size() -> Column:
    """UTF-8 bytes of the text and one more."""
    return (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")


def text_crc32() -> Column:
    """CRC-32 of the text's UTF-8 bytes; a null text counts as empty."""
    return F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))


def ring_hash() -> Column:
    return F.xxhash64(F.lit("row"), "doc_id", F.when(F.col("doc_id").isNull(), F.col("text")))


def assign(docs: DataFrame, shards: int = SHARDS, vnodes: int = VNODES) -> DataFrame:
    """``docs`` (doc_id, text, ...) with shard (int) and slot (long, gapless from 0 in every shard)."""
    spark = docs.sparkSession
    docs = docs.select(*(c for c in docs.columns if c not in ("shard", "slot")))
    place = F.pmod(ring_hash(), F.lit(PLACES))
    counts = {r.place: r.n for r in docs.groupBy(place.alias("place")).agg(F.count("*").alias("n")).collect()}
    pieces = dealt(counts, owners(spark, shards, vnodes), shards)
    cells = F.split("piece", ",")
    table = spark.range(1).select(F.explode(F.split(F.lit(";".join(",".join(map(str, p)) for p in pieces)), ";")).alias("piece"))
    table = table.select(*(cells[i].cast(kind).alias(name) for i, (name, kind) in enumerate((("_place", "long"), ("_from", "long"), ("_to", "long"), ("shard", "int"), ("_first", "long")))))
    order = Window.partitionBy("_place").orderBy("_h", F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns if "map<" not in dict(docs.dtypes)[c])))
    ranked = docs.withColumn("_h", ring_hash()).withColumn("_place", place).withColumn("_rank", F.row_number().over(order).cast("long") - 1)
    # At most PLACES + shards rows: the size is bounded by construction.
    placed = ranked.join(F.broadcast(table), "_place").filter("_rank >= _from and _rank < _to")
    return placed.select(*(f"`{c}`" for c in docs.columns), "shard", (F.col("_first") + F.col("_rank") - F.col("_from")).alias("slot"))
