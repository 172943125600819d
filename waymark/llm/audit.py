"""Audit of filters: what each removes, repeats or catches alone, under every order of application.

A row's failures are a mask with a bit for each filter and each mark. Every mask stands for a big integer whose 64-bit fields hold
the outcome of every step of every order (with five filters 120 orders of five steps: 600 fields for each kind of outcome). The
integers of a part's rows are summed: in each task, then over salted groups of tasks, then over the parts. No field can overflow
into the next, since no count of rows reaches 2^64; the sums are cut into their fields at the end.

1. ``failures`` reads each text once: words by a split at the separators, capital letters and symbols by Arrow's functions, and a
   SHA-256 of the text. Identical texts are told by it; the least id of each hash, found with a map-side combine, is joined back
   on (id, hash), a key that no large group of copies makes hot.
2. ``interactions`` sums the integers.

A null or empty text has no words, code points or symbols. A row with a null id is identical to no smaller id's text. Rows that share
an id and a text do not fail by each other, since neither id is smaller. A null part is the empty string. A document with several labels
has a mark if any label gives it; null labels give none. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import materialise

# Fields of the big integers, in bytes.
FIELD = 8
# Sums that a task holds at once; beyond, they are sent on as they are and meet in the next step.
HELD = 256
# Partial sums of a part meet in at most this many groups first, so that no task reads those of all tasks.
GROUPS = 256
MOST_FILTERS = 6

FEW_WORDS = 50
DISTINCT_PERCENT = 65
CAPITAL_PERCENT = 5
SYMBOLS = "[#$%&*|]"
# The words of texts beyond this many bytes are read one after another, not as a list.
LONG = 1 << 20
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class Outcomes:
    """The big integers of all masks. Bits of a mask: the filters first, then the marks."""

    def __init__(self, filters: Sequence[str], marks: Sequence[str] = ()):
        if not 1 <= len(filters) <= MOST_FILTERS or len({*filters, *marks}) < len(filters) + len(marks):
            raise ValueError(f"1 to {MOST_FILTERS} filters and marks with different names are needed")
        self.filters, self.marks = list(filters), list(marks)
        self.orders = list(itertools.permutations(range(len(filters))))
        self.kinds = ["kept", "removed", "redundant", "unique_fails", *(f"{m}_lost" for m in marks)]
        self.shape = (len(self.kinds), len(self.orders), len(filters))
        self.bytes = int(np.prod(self.shape)) * FIELD
        self.words = [self.word(mask) for mask in range(1 << (len(filters) + len(marks)))]

    def word(self, mask: int) -> int:
        """The integer of one row with this mask."""
        k, fields = len(self.filters), np.zeros(self.shape, "<u8")
        fails, marked = mask & ((1 << k) - 1), mask >> k
        for o, order in enumerate(self.orders):
            gone = False
            for s, f in enumerate(order):
                hit = fails >> f & 1
                removed = hit and not gone
                gone = gone or removed
                lost = [removed and marked >> m & 1 for m in range(len(self.marks))]
                fields[:, o, s] = [not gone, removed, hit and not removed, fails == 1 << f, *lost]
        return int.from_bytes(fields.tobytes(), "little")

    def packed(self, total: int) -> bytes:
        return total.to_bytes(self.bytes, "little")

    def table(self, part: str, total: int) -> pa.RecordBatch:
        """The fields of a part's sum: a row for each order and step."""
        fields = np.frombuffer(self.packed(total), "<u8").reshape(self.shape).astype(np.int64)
        orders = np.array(self.orders)
        removed = fields[self.kinds.index("removed")]
        shapley = np.array([removed[orders == f].sum() for f in range(len(self.filters))])[orders]
        rows, steps = orders.size, orders.shape[1]
        names = ["".join(self.filters[f] for f in order) for order in self.orders]
        columns = {"part": [part] * rows, "filter_order": np.repeat(names, steps), "step": np.tile(np.arange(1, steps + 1, dtype=np.int32), len(orders))}
        return pa.RecordBatch.from_pydict(columns | {kind: fields[i].ravel() for i, kind in enumerate(self.kinds)} | {"shapley": shapley.ravel()})


def interactions(rows: DataFrame, filters: Sequence[str], marks: Sequence[str] = (), part: str = "part") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, ``<mark>_lost`` ..., shapley.

    ``filters`` and ``marks`` are boolean columns of ``rows`` (null: false). A row for each part, order of the filters and step.
    """
    made = Outcomes(filters, marks)
    bits = [F.coalesce(F.col(f"`{c}`").cast("boolean"), F.lit(False)).cast("int") * F.lit(1 << i) for i, c in enumerate([*filters, *marks])]
    masks = rows.select(F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), sum(bits[1:], bits[0]).alias("mask"))
    cell = pa.schema([("part", pa.string()), ("total", pa.binary())])

    def batch(sums: list[tuple[str, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"part": [p for p, _ in sums], "total": [made.packed(x) for _, x in sums]}, cell)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums by part of the integers of the masks."""
        sums: dict[str, int] = {}
        for b in batches:
            parts = b.column("part").dictionary_encode()
            code = parts.indices.to_numpy().astype(np.int64) * len(made.words) + b.column("mask").to_numpy()
            for c, n in zip(*(x.tolist() for x in np.unique(code, return_counts=True))):
                name = parts.dictionary[c // len(made.words)].as_py()
                sums[name] = sums.get(name, 0) + n * made.words[c % len(made.words)]
            if len(sums) > HELD:
                yield from (batch([x]) for x in sums.items())
                sums = {}
        yield from (batch([x]) for x in sums.items())

    def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[str, int]]:
        """Sums of consecutive rows with equal keys."""
        at, total = None, 0
        for b in batches:
            for *key, word in zip(*(b.column(k).to_pylist() for k in [*keys, "total"])):
                if key != at:
                    if at:
                        yield at[0], total
                    at, total = key, 0
                total += int.from_bytes(word, "little")
        if at:
            yield at[0], total

    first = masks.mapInArrow(summed, "part string, total binary").withColumn("salt", F.spark_partition_id() % GROUPS)
    second = first.repartition("part", "salt").sortWithinPartitions("part", "salt")
    second = second.mapInArrow(lambda batches: (batch([x]) for x in runs(batches, ["part", "salt"])), "part string, total binary")
    last = second.repartition("part").sortWithinPartitions("part")
    counts = "".join(f", `{c}` long" for c in [*made.kinds, "shapley"])
    return last.mapInArrow(lambda batches: (made.table(*x) for x in runs(batches, ["part"])), f"part string, filter_order string, step int{counts}")


def word_counts(text: bytes) -> tuple[int, int]:
    """Words and distinct words. ``bytes.split()`` cuts at the same six bytes as ``WORD``."""
    if len(text) <= LONG:
        words = text.split()
        return len(words), len(set(words))
    n, seen = 0, set()
    for m in WORD.finditer(text):
        n += 1
        seen.add(m.group())
    return n, len(seen)


def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """part, doc_id, A to D and the text's hash."""
    for b in batches:
        text = pc.fill_null(b.column("text"), "")
        raw = [x.as_buffer().to_pybytes() for x in text.cast(pa.binary())]
        words, distinct = np.array([word_counts(x) for x in raw], np.int64).reshape(-1, 2).T
        points = pc.utf8_length(text).to_numpy().astype(np.int64)
        capitals = pc.count_substring_regex(text, "[A-Z]").to_numpy().astype(np.int64)
        yield pa.RecordBatch.from_pydict(
            {
                "part": b.column("part"), "doc_id": b.column("doc_id"), "A": words < FEW_WORDS, "B": 100 * distinct < DISTINCT_PERCENT * words,
                "C": 100 * capitals > CAPITAL_PERCENT * points, "D": pc.match_substring_regex(text, SYMBOLS), "digest": [hashlib.sha256(x).digest() for x in raw],
            }
        )


FILTERS = ["A", "B", "C", "D", "E"]


def failures(docs: DataFrame, part: str = "source") -> DataFrame:
    """doc_id, part and a boolean for each of ``FILTERS``: few words, few distinct words, capitals, symbols, identical to an earlier text."""
    texts = docs.select(F.col(f"`{part}`").cast("string").alias("part"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = materialise(texts.mapInArrow(judged, "part string, doc_id long, A boolean, B boolean, C boolean, D boolean, digest binary"))
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).filter("doc_id is not null").withColumn("first", F.lit(True))
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return rows.join(first, ["doc_id", "digest"], "left").select("doc_id", "part", "A", "B", "C", "D", copy.alias("E"))


def audited(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """Interactions of ``FILTERS`` on ``docs`` (doc_id, text, ``part``), and what they lose of documents that ``labels`` call good or toxic."""
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    return interactions(failures(docs, part).join(marks, "doc_id", "left"), FILTERS, ["good", "toxic"])
