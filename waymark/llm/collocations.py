"""Phrase collocations: frequent runs of words whose words meet far more often than apart.

A-Z are read as a-z; texts are cut into pieces at ``. , ; : ! ?`` and line breaks, pieces into words at spaces and tabs. Everything is
counted for each language; f(phrase) counts all runs of consecutive words of a piece.

1. Prefix polynomials over the bytes give each word's hash, prefix polynomials over these the Rabin-Karp fingerprint of every n-gram, the
   language included. One scan for each number of words sends (fingerprint, count), summed in the task and then by a shuffle. A
   phrase can only be frequent if both phrases of one word less in it are, so the frequent fingerprints of one scan, as a
   Bloom filter of bounded size, thin out the next; what the filter lets through too much is counted, and costs nothing else.
2. A last scan takes the n-grams whose fingerprint is frequent and verifies them against the text: equal word hashes are compared byte by
   byte, n-grams by the numbers of their words, so that fingerprints that only collide fall apart. Only these phrases become
   text. They are summed by language and phrase, with a pointer to their first occurrence (document, byte).
3. Each candidate (two words or more, frequent) is cut behind each of its words; the lowest score floor(1e6 a a / (l r)) counts, the
   first of equal ones. Candidates inside a longer one that is at least half as frequent are dropped. Products are decimals of
   38 digits: exact up to 10^13 occurrences.

A null text has no words; a null language is ``und``, together with the language of that name. Rows that share an id or a text are counted
each. A null id gives no pointer. An empty table gives an empty result. A long text is read in slices that end where a piece ends. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.common import LOWER_VALUES, Ids, SpanHash, materialise, mix, signed, steps, utf8, word_spans

LONGEST = 3
LEAST = 10
TOP = 2000
# A candidate goes if a longer one that holds it has this share of its occurrences.
INSIDE_PERCENT = 50
SCALE = 1_000_000
# Bytes of text that one numpy step handles, if a piece ends there.
SLICE = 4 << 20
# Fingerprints that a task holds before it sums them.
HELD = 4 << 20
# Candidates of a language are ranked in so many groups before the best of all are.
RANK_GROUPS = 64
# A pointer is the document's id times 2^POINTER_BITS plus the byte.
POINTER_BITS = 40

PIECE_END = np.zeros(256, bool)
PIECE_END[[*b".,;:!?", *range(10, 14)]] = True
WORD_END = PIECE_END.copy()
WORD_END[[9, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def slices(data: np.ndarray, offsets: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Bytes, offsets of the texts (an end too) and place in ``data``, of about ``limit`` bytes each. Cut only where a piece ends."""
    at = 0
    while at < len(data):
        end = at + limit
        while end < len(data):
            found = np.flatnonzero(PIECE_END[data[end : end + limit]])
            if len(found):
                end += int(found[0])
                break
            end += limit
        end = min(end, len(data))
        yield data[at:end], np.clip(offsets - at, 0, end - at), at
        at = end


def gathered(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of spans one after another."""
    ends = np.cumsum(lengths)
    return data[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


def numbered(hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word, equal for equal bytes only, and for each number a place where the word stands."""
    _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    like = first[number]
    if (lengths == lengths[like]).all() and (gathered(data, starts, lengths) == gathered(data, starts[like], lengths)).all():
        return number, first
    known: dict[bytes, int] = {}
    number = np.array([known.setdefault(data[s : s + n].tobytes(), len(known)) for s, n in zip(starts, lengths)], np.int64)
    return number, np.unique(number, return_index=True)[1]


class Grams:
    """Words and n-gram fingerprints of a slice."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray, bits: int = 64):
        """``langs``: the hash of each text's language. ``bits`` of a fingerprint are used."""
        self.data, self.mask = data, np.uint64((1 << bits) - 1)
        self.starts, self.ends, first = word_spans(data, offsets, WORD_END)
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        self.hashes = SpanHash(data, LOWER_VALUES)(self.starts, self.ends)
        self.lang = langs[self.text]
        self.spans = SpanHash(self.hashes, None)
        breaks = np.concatenate(([0], np.cumsum(PIECE_END[data])))[self.starts]
        self.piece = np.cumsum((np.diff(breaks, prepend=-1) != 0) | (np.diff(self.text, prepend=-1) != 0))

    def places(self, n: int) -> np.ndarray:
        """Where the n-grams begin: the first word of each."""
        if len(self.piece) < n:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.piece[n - 1 :] == self.piece[: len(self.piece) - n + 1])

    def prints(self, at: np.ndarray, n: int) -> np.ndarray:
        return mix((self.spans(at, at + n) ^ self.lang[at]) & self.mask)


def lang_hash(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")


def grams(batches: Iterator[pa.RecordBatch], limit: int, bits: int) -> Iterator[tuple[Grams, pa.RecordBatch, np.ndarray]]:
    """Slices with the rows they come from and the byte where the slice begins in each text."""
    for b in steps(batches, limit=limit):
        data, offsets = utf8(b.column("text"))
        langs = b.column("lang").dictionary_encode()
        hashes = np.array([lang_hash(x) for x in langs.dictionary.to_pylist()], np.uint64)[langs.indices.to_numpy()]
        for part, inside, at in slices(data, offsets, limit):
            yield Grams(part, inside, hashes, bits), b, np.maximum(at - offsets[:-1], 0) - inside[:-1]


def counted(docs: DataFrame, n: int, below, limit: int = SLICE, bits: int = 64) -> DataFrame:
    """fp, n: the fingerprints of n-grams and their counts. ``below``: broadcast filter of the frequent (n - 1)-grams."""

    def count(batches):
        held, size = [], 0
        for g, _, _ in grams(batches, limit, bits):
            at = g.places(n)
            if below is not None:
                known = np.zeros(len(g.starts), bool)
                shorter = g.places(n - 1)
                known[shorter] = below.value.holds(g.prints(shorter, n - 1))
                at = at[known[at] & known[at + 1]]
            held.append(g.prints(at, n))
            size += len(at)
            if size >= HELD:
                yield from summed(held)
                held, size = [], 0
        yield from summed(held)

    def summed(held):
        fp, times = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
        for k in range(0, len(fp), 1 << 18):
            yield pa.RecordBatch.from_pydict({"fp": signed(fp[k : k + (1 << 18)]), "n": times[k : k + (1 << 18)].astype(np.int64)})

    return docs.select("text", "lang").mapInArrow(count, "fp long, n long").groupBy("fp").agg(F.sum("n").alias("n"))


def frequent(docs: DataFrame, longest: int, least: int, **how) -> list:
    """For each number of words the broadcast filter of its frequent fingerprints."""
    filters: list = []
    for n in range(1, longest + 1):
        found = materialise(counted(docs, n, filters[-1] if filters else None, **how).filter(F.col("n") >= least).select("fp"))
        filters.append(docs.sparkSession.sparkContext.broadcast(Ids(found, found.count(), F.col("fp"))))
    return filters


def pointers(doc_id: pa.Array, byte: np.ndarray) -> pa.Array:
    """Decimals of 128 bits: the id shifted by ``POINTER_BITS``, and the byte."""
    ids = pc.fill_null(doc_id, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    both = np.stack([(ids << POINTER_BITS) | byte, ids >> (64 - POINTER_BITS)], axis=1)
    out = pa.Array.from_buffers(pa.decimal128(38, 0), len(ids), [None, pa.py_buffer(np.ascontiguousarray(both))])
    return pc.if_else(doc_id.is_valid(), out, pa.scalar(None, pa.decimal128(38, 0)))


def phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, limit: int = SLICE, bits: int = 64) -> DataFrame:
    """lang, words (int), phrase, n, pointer: all phrases of at most ``longest`` words that occur ``least`` times; words = 0: all words of the language.

    ``limit``: bytes of a slice. ``bits``: of a fingerprint; with fewer more of them collide, and the result is the same.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    filters = frequent(docs, longest, least, limit=limit, bits=bits)

    def materialised(batches):
        for g, rows, begin in grams(batches, limit, bits):
            number, where = numbered(g.hashes, LOWER[g.data], g.starts, g.ends - g.starts)
            lengths = (g.ends - g.starts)[where]
            offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
            words = pa.StringArray.from_buffers(len(where), pa.py_buffer(offsets), pa.py_buffer(LOWER[gathered(g.data, g.starts[where], lengths)]))
            langs, lang = np.unique(g.lang, return_inverse=True)
            many = np.int64(max(1, len(where)))
            # For each place a number of the language and the n - 1 words from there on; -1 if these are not frequent.
            key = lang
            for n in range(1, longest + 1):
                at = g.places(n)
                at = at[(key[at] >= 0) & filters[n - 1].value.holds(g.prints(at, n))]
                whole = np.full(len(number), -1, np.int64)
                whole[at] = np.unique(key[at] * many + number[at + n - 1], return_inverse=True)[1]
                _, first, times = np.unique(whole[at], return_index=True, return_counts=True)
                key, first = whole, at[first]
                text = pa.array(g.text[first])
                phrase = pc.binary_join_element_wise(*(words.take(pa.array(number[first + k])) for k in range(n)), " ") if n > 1 else words.take(pa.array(number[first]))
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": rows.column("lang").take(text), "words": np.full(len(first), n, np.int32), "phrase": phrase, "n": times.astype(np.int64),
                        "pointer": pointers(rows.column("doc_id").take(text), g.starts[first] + begin[g.text[first]]),
                    }
                )
            names = rows.column("lang").dictionary_encode()
            times = np.bincount(names.indices.to_numpy()[g.text], minlength=len(names.dictionary))
            yield pa.RecordBatch.from_pydict(
                {"lang": names.dictionary, "words": np.zeros(len(times), np.int32), "phrase": [""] * len(times), "n": times, "pointer": pa.nulls(len(times), pa.decimal128(38, 0))}
            )

    rows = docs.mapInArrow(materialised, "lang string, words int, phrase string, n long, pointer decimal(38,0)")
    sums = rows.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"), F.min("pointer").alias("pointer"))
    return sums.filter((F.col("n") >= least) | (F.col("words") == 0))


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, **how) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score, first_doc_id, first_byte."""
    known = materialise(phrases(docs, longest, least, **how))
    candidates = known.filter("words >= 2").select("lang", "words", "phrase", F.col("n").alias("a"), "pointer")
    # The runs of fewer words in each candidate, with the count of the most frequent one that holds them.
    words = F.split("phrase", " ", -1)
    size, start = F.explode(F.sequence(F.lit(2), F.col("words") - 1)), F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1))
    inside = candidates.filter("words > 2").select("lang", "words", "a", words.alias("w"), size.alias("size")).select("lang", "a", "w", "size", start.alias("start"))
    held = inside.select("lang", F.array_join(F.slice("w", F.col("start"), F.col("size")), " ").alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = candidates.join(held, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("longer") < INSIDE_PERCENT * F.col("a"), F.lit(True)))
    cuts = kept.select("lang", "phrase", "words", "a", "pointer", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"), words.alias("w"))
    cuts = cuts.withColumns({"left": F.array_join(F.slice("w", F.lit(1), F.col("k")), " "), "right": F.array_join(F.slice("w", F.col("k") + 1, F.col("words")), " ")}).drop("w")
    counts = known.filter("words >= 1")
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    score = F.expr(f"(cast({SCALE} * a as decimal(19,0)) * cast(a as decimal(18,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(19,0)))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "pointer").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    rows = best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", "pointer")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    near = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANK_GROUPS))).orderBy(*order)
    rows = rows.withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    rows = rows.join(known.filter("words = 0").select("lang", F.col("n")), "lang")
    byte, unit = F.expr(f"pmod(pointer, cast({1 << POINTER_BITS} as decimal(38,0)))"), f"cast({1 << POINTER_BITS} as decimal(38,0))"
    rows = rows.withColumn("first_byte", byte).withColumn("first_doc_id", F.expr(f"(pointer - first_byte) div {unit}"))
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "first_doc_id", F.col("first_byte").cast("long"))
