"""Language identification: known words by their log frequency per language, unseen words by ever shorter character n-grams.

The model is fitted on at most ``SAMPLE_ROWS`` labelled rows of each language (those with the least hash of their id), so its size does
not depend on the corpus, and a language is learned however few of all rows it has. A word is a run of letters of the lower-cased text. A word seen at least ``MIN_COUNT`` times in training
scores its log frequency in each language. Any other word scores the mean over its characters: at each one the 4-gram that
starts there (word ends included), if unknown the 3-gram, then the 2-gram, then the letter; each step down costs the same in every language.
The text's language has the highest sum; the score is its share of exp(sum) over all languages.

Null texts and texts without a letter are ``und`` with score 0, as is everything if there is no training row. Ties go to the
language first in alphabetical order. Rows are judged one by one, so repeated rows and ids get the same answer.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.common import HashTable, SpanHash, mix, signed, steps

SAMPLE_ROWS = 4000  # per language
HASH_BITS = 14  # classes of hashes that are counted to find the least ones
MIN_COUNT = 3
GRAMS = (4, 3, 2, 1)
WORDS = 0  # kind of the word rows; the others are the lengths in GRAMS


@cache
def letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


class Letters:
    """Words and n-grams of a column of texts."""

    def __init__(self, column: pa.Array):
        texts = [t.lower() if t else "" for t in column.to_pylist()]
        joined = "\n" + "\n".join(texts) + "\n\n\n\n"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        alpha = letters()[points]
        self.values = mix(np.where(alpha, points, 0).astype(np.uint64) + np.uint64(1))
        edge = np.flatnonzero(alpha[1:] != alpha[:-1]) + 1
        self.starts, self.ends = edge[::2], edge[1::2]
        offsets = np.cumsum([1, *(len(t) + 1 for t in texts)])
        self.first = np.searchsorted(self.starts, offsets)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def words(self) -> np.ndarray:
        return SpanHash(self.values, None)(self.starts, self.ends)

    def places(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each character of the chosen words and the place before it: word, place."""
        sizes = self.ends[chosen] - self.starts[chosen] + 1
        word = np.repeat(chosen, sizes)
        return word, np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + self.starts[word] - 1

    def grams(self, n: int, word: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which places begin an n-gram of their word, its ends included, and the hashes of these n-grams."""
        ok = np.flatnonzero(place + n <= self.ends[word] + 1) if n > 1 else np.flatnonzero(place >= self.starts[word])
        h = np.full(len(ok), n, np.uint64)
        for k in range(n):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + self.values[place[ok] + k])
        return ok, h


def counted(batches):
    """Counts of words and n-grams by language in each batch of (text, lang)."""
    for batch in steps(batches):
        langs = np.array(batch.column("lang").to_pylist(), object)
        text = Letters(batch.column("text"))
        word, place = text.places(np.arange(len(text.starts)))
        found = [(WORDS, text.doc, text.words())]
        for n in GRAMS:
            ok, h = text.grams(n, word, place)
            found.append((n, text.doc[word[ok]], h))
        for kind, doc, h in found:
            for lang in sorted(set(langs)):
                key, count = np.unique(h[(langs == lang)[doc]], return_counts=True)
                if len(key):
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key)), pa.array([kind] * len(key), pa.int32()), pa.array(signed(key)), pa.array(count.astype(np.int64))], ["lang", "kind", "h", "c"])


class Model:
    def __init__(self, rows: list):
        self.langs = sorted({r.lang for r in rows})
        at = {lang: i for i, lang in enumerate(self.langs)}
        self.tables, self.logs = {}, {}
        for kind in (WORDS, *GRAMS):
            own = [r for r in rows if r.kind == kind]
            keys = sorted({r.h for r in own})
            place = {h: i for i, h in enumerate(keys)}
            counts = np.zeros((len(keys), len(self.langs)))
            for r in own:
                counts[place[r.h], at[r.lang]] = r.c
            self.tables[kind] = HashTable(np.array(keys, np.int64).view(np.uint64))
            self.logs[kind] = np.log((counts + 0.5) / (counts.sum(0) + 0.5 * max(1, len(keys))))

    def predict(self, column: pa.Array) -> tuple[list[str], list[float]]:
        text = Letters(column)
        n, k = len(column), len(self.langs)
        if not k:
            return ["und"] * n, [0.0] * n
        at = self.tables[WORDS].find(text.words())
        scores = np.zeros((len(at), k))
        scores[at >= 0] = self.logs[WORDS][at[at >= 0]]
        word, place = text.places(np.flatnonzero(at < 0))
        got, best = np.full(len(word), -1), np.zeros((len(word), k))
        for size in GRAMS:
            left = np.flatnonzero(got < 0)
            ok, h = text.grams(size, word[left], place[left])
            found = self.tables[size].find(h)
            hit = left[ok[found >= 0]]
            got[hit] = size
            best[hit] = self.logs[size][found[found >= 0]]
        seen = np.bincount(word[got > 0], minlength=len(at))
        totals = np.zeros((n, k))
        for j in range(k):
            scores[:, j] += np.bincount(word, best[:, j], len(at)) / np.maximum(seen, 1)
            totals[:, j] = np.bincount(text.doc, scores[:, j], n)
        top = totals.argmax(1)
        share = 1 / np.exp(totals - totals.max(1, keepdims=True)).sum(1)
        any_word = np.diff(text.first) > 0
        return [self.langs[i] if w else "und" for i, w in zip(top, any_word, strict=True)], np.where(any_word, share, 0.0).tolist()


def sampled(rows: DataFrame, sample_rows: int) -> DataFrame:
    """Of each lang the ``sample_rows`` rows (doc_id, text, lang) with the least hash of their id.

    Counts by class of the hash tell first which classes are needed, so that only a few more rows than these are sorted.
    """
    rows = rows.withColumn("h", F.xxhash64("doc_id")).withColumn("class", F.shiftright("h", 64 - HASH_BITS))
    counts = rows.groupBy("lang", "class").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("class")) - F.col("n")
    needed = counts.select("lang", "class", before.alias("before")).filter(F.col("before") < sample_rows).groupBy("lang").agg(F.max("class").alias("bound"))
    near = rows.join(F.broadcast(needed), "lang").filter(F.col("class") <= F.col("bound"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id", F.xxhash64("text")))
    return near.withColumn("r", rank).filter(F.col("r") <= sample_rows).select("doc_id", "text", "lang")


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from the rows of ``labelled`` (doc_id, text, lang) with both text and lang, at most ``sample_rows`` of each lang."""
    rows = sampled(labelled.filter("text is not null and lang is not null").select("doc_id", "text", "lang"), sample_rows)
    counts = rows.select("text", "lang").mapInArrow(counted, "lang string, kind int, h long, c long").groupBy("lang", "kind", "h").agg(F.sum("c").alias("c"))
    return Model(counts.filter(F.col("c") >= MIN_COUNT).collect())


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score in place of columns of these names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = docs.select(*rest).schema.add("lang_pred", "string").add("score", "double")

    def judge(batches):
        for batch in steps(batches):
            lang, score = shared.value.predict(batch.column("text"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], [*batch.schema.names, "lang_pred", "score"])

    return docs.select(*rest).mapInArrow(judge, schema)


def held_out(column: str = "doc_id"):
    """Rows kept out of training."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
