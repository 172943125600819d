"""Quality: counts of words, symbols and repeats, and a calibrated logistic regression on hashed words and character n-grams.

Features are shares: of a text's words and of its character 2- and 4-grams (bytes of the UTF-8 text, A-Z kept apart from a-z), each
kind hashed into ``SLOTS`` slots. The model is fitted on at most ``SAMPLE_ROWS`` labelled rows (those with the least hash of their
id) by gradient descent with weight decay; rows of both labels weigh the same in total. Its scores are calibrated by Platt's method on
``FOLDS`` held-out folds: each row is scored by the model of the other folds, and a logistic curve of these scores, weighed like the
rows themselves, gives the probability. A text is kept if it passes the base rules and its probability of good quality
reaches ``THRESHOLD``.

Nulls and empty texts have no words and fail the base rules. Without labelled rows of both labels the model has no opinion
(probability 1). Labels that are null, and labels without a document, are not used; a document with several labels counts with each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import SpanHash, mix, steps, utf8, word_spans

SAMPLE_ROWS = 2000
SLOTS = 1 << 15
GRAMS = (2, 4)
FOLDS = 4
ROUNDS = 40
THRESHOLD = 0.2
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


class Texts:
    """Words, lines and n-grams of a column of texts."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = utf8(column)
        self.spans = SpanHash(self.data)
        self.starts, self.ends, self.first = word_spans(self.data, self.offsets)
        self.words = self.spans(self.starts, self.ends)

    def per_text(self, at: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        """Count or sum of what stands at byte positions, for each text."""
        text = np.searchsorted(self.offsets, at, "right") - 1
        return np.bincount(text, weights, len(self.offsets) - 1)

    def counts(self) -> dict[str, np.ndarray]:
        """The base figures of each text."""
        n = len(self.offsets) - 1
        points = np.concatenate(([0], np.cumsum((self.data & 0xC0) != 0x80)))
        chars = np.concatenate(([0], np.cumsum(points[self.ends] - points[self.starts])))
        words = np.diff(self.first)
        out = {"n_words": words, "word_chars": chars[self.first[1:]] - chars[self.first[:-1]]}
        symbols = np.concatenate(([0], np.cumsum(SYMBOLS[self.data])))
        out["n_symbols"] = symbols[self.offsets[1:]] - symbols[self.offsets[:-1]]
        out["n_dup_lines"] = self.dup_lines(n)
        out["n_repeat_words"] = self.repeat_words(n)
        return {k: v.astype(np.int64) for k, v in out.items()}

    def dup_lines(self, n: int) -> np.ndarray:
        """Lines with a word that are equal to an earlier line of their text."""
        breaks = np.flatnonzero(self.data == 10)
        begin = np.unique(np.concatenate((self.offsets[:-1], breaks + 1)))
        begin = begin[begin < len(self.data)]
        end = np.concatenate((begin[1:], [len(self.data)])) if len(begin) else begin
        text = np.searchsorted(self.offsets, begin, "right") - 1
        # A line ends before its line feed; the last of a text has none.
        closed = self.data[end - 1] == 10 if len(end) else np.zeros(0, bool)
        has_word = np.searchsorted(self.starts, end) > np.searchsorted(self.starts, begin)
        key = mix(self.spans(begin, end - closed) ^ mix(text.astype(np.uint64) + np.uint64(1)))[has_word]
        text = text[has_word]
        _, where = np.unique(key, return_index=True)
        return np.bincount(text, minlength=n) - np.bincount(text[where], minlength=n)

    def repeat_words(self, n: int) -> np.ndarray:
        """Words in windows of three words that the text holds twice or more."""
        text = np.repeat(np.arange(n, dtype=np.uint64), np.diff(self.first))
        size = max(0, len(self.words) - 2)
        windows = np.zeros(size, np.uint64)
        for k, factor in enumerate(mix(np.arange(31, 34, dtype=np.uint64)) | np.uint64(1)):
            windows += self.words[k : k + size] * factor
        whole = text[:size] == text[2:]
        windows = mix(mix(windows) ^ mix(text[:size] + np.uint64(1)))
        order = np.argsort(windows[whole])
        place = np.flatnonzero(whole)[order]
        key = windows[place]
        twin = np.zeros(len(key), bool)
        same = key[1:] == key[:-1]
        twin[1:] |= same
        twin[:-1] |= same
        marked = np.zeros(len(self.words), bool)
        for k in range(3):
            marked[place[twin] + k] = True
        return np.bincount(text[marked].astype(np.int64), minlength=n)

    def features(self):
        """For each kind: slot of each feature, its text, and how many features each text has."""
        n = len(self.offsets) - 1
        count = np.diff(self.first)
        yield (self.words & np.uint64(SLOTS - 1)).astype(np.int64), np.repeat(np.arange(n), count), count
        text = np.repeat(np.arange(n), np.diff(self.offsets))
        for kind, size in enumerate(GRAMS, 1):
            at = np.arange(max(0, len(self.data) - size + 1))
            at = at[text[: len(at)] == text[size - 1 :]] if len(at) else at
            slots = (self.spans(at, at + size) & np.uint64(SLOTS - 1)).astype(np.int64) + kind * SLOTS
            yield slots, text[at], np.bincount(text[at], minlength=n)


class Model:
    """Weights of the slots, bias, and the line of the calibration."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float, shift: float):
        self.weights, self.bias, self.slope, self.shift = weights, bias, slope, shift

    def probability(self, texts: Texts) -> np.ndarray:
        score = np.full(len(texts.offsets) - 1, self.bias)
        for slots, text, count in texts.features():
            score += np.bincount(text, self.weights[slots], len(score)) / np.maximum(count, 1)
        return 1 / (1 + np.exp(-np.clip(self.slope * score + self.shift, -50, 50)))


def featured(batches):
    """Slots and shares of each labelled text: bounded by the number of slots, however long the text."""
    for batch in steps(batches):
        shares = [{} for _ in range(batch.num_rows)]
        for slots, text, count in Texts(batch.column("text")).features():
            keys, times = np.unique(text.astype(np.int64) * (4 * SLOTS) + slots, return_counts=True)
            for k, c in zip(keys.tolist(), times.tolist(), strict=True):
                shares[k // (4 * SLOTS)][k % (4 * SLOTS)] = c / count[k // (4 * SLOTS)]
        slots = [np.array(list(s), np.int32).tobytes() for s in shares]
        values = [np.array(list(s.values()), np.float32).tobytes() for s in shares]
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(slots, pa.binary()), pa.array(values, pa.binary())], ["label", "slots", "shares"])


class Rows:
    """A sparse matrix of the sample."""

    def __init__(self, rows: list):
        self.slots = np.concatenate([np.frombuffer(r.slots, np.int32) for r in rows])
        self.shares = np.concatenate([np.frombuffer(r.shares, np.float32) for r in rows])
        self.row = np.repeat(np.arange(len(rows)), [len(r.slots) // 4 for r in rows])
        self.label = np.array([r.label for r in rows], np.float64)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.shares * weights[self.slots], len(self.label))

    def fitted(self, use: np.ndarray) -> tuple[np.ndarray, float]:
        """Weights and bias for the rows in ``use``, by gradient steps scaled by each slot's running square (AdaGrad)."""
        size = (1 + len(GRAMS)) * SLOTS
        weights, bias, square, bias_square = np.zeros(size), 0.0, np.full(size, 1e-12), 1e-12
        good = use & (self.label == 1)
        importance = np.where(good, 0.5 / max(1, good.sum()), 0) + np.where(use & (self.label == 0), 0.5 / max(1, (use & (self.label == 0)).sum()), 0)
        for _ in range(ROUNDS):
            wrong = importance * (1 / (1 + np.exp(-np.clip(self.scores(weights) + bias, -50, 50))) - self.label)
            slope = np.bincount(self.slots, self.shares * wrong[self.row], size) + 1e-7 * weights
            square += slope**2
            weights -= 2.0 * slope / np.sqrt(square)
            bias_square += wrong.sum() ** 2
            bias -= 0.1 * wrong.sum() / np.sqrt(bias_square)
        return weights, bias


def calibrated(scores: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of Platt's curve by Newton steps, with his smoothed targets."""
    good, bad = label.sum(), (1 - label).sum()
    target = np.where(label == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    scale = max(1e-9, np.abs(scores).max())
    x = np.stack([scores / scale, np.ones(len(scores))], 1)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -50, 50)))
        curve = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, x.T @ (p - target))
        at = at - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return at[0] / scale, at[1]


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """A model from the labelled rows; None without rows of both labels. ``labels``: doc_id, quality."""
    own = labels.filter("doc_id is not null and quality is not null").select("doc_id", (F.col("quality") > 0).cast("int").alias("label"))
    # At most sample_rows rows: the size is bounded.
    chosen = F.broadcast(own.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample_rows))
    rows = docs.filter("text is not null").select("doc_id", "text").join(chosen, "doc_id")
    rows = rows.select("text", "label").mapInArrow(featured, "label int, slots binary, shares binary").orderBy("label", "slots", "shares").collect()
    if len({r.label for r in rows}) < 2:
        return None
    sample = Rows(rows)
    fold = np.arange(len(rows)) % FOLDS
    scores = np.zeros(len(rows))
    for k in range(FOLDS):
        weights, bias = sample.fitted(fold != k)
        scores[fold == k] = (sample.scores(weights) + bias)[fold == k]
    weights, bias = sample.fitted(fold >= 0)
    return Model(weights, bias, *calibrated(scores, sample.label))


def judged(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and the figures, probability and verdict of every row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def judge(batches):
        for batch in steps(batches):
            texts = Texts(batch.column("text"))
            counts = texts.counts()
            failed = (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])
            p = shared.value.probability(texts) if shared.value else np.ones(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(counts[c]) for c in names), pa.array(failed), pa.array(p), pa.array(~failed & (p >= THRESHOLD))],
                ["doc_id", *names, "base_failed", "p_good", "kept"],
            )

    schema = docs.select("doc_id").schema
    for name in names:
        schema = schema.add(name, "long")
    return docs.select("doc_id", "text").mapInArrow(judge, schema.add("base_failed", "boolean").add("p_good", "double").add("kept", "boolean"))
