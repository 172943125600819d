"""Benchmark passages in documents: SimHash of item-sized windows, a Hamming multi-index, exact weighted similarity.

Words are cut at white space, A-Z lower-cased. A word weighs 0 to 3 by how few items hold it (3: under 8 %, or in none).

1. Item lengths fall into classes that grow by a fifth. For each class windows of its length slide over every text in steps of
   an eighth of it (each text's first and last window included; a shorter text is one window if it could still match).
2. Window and item have 64-bit SimHashes of their weighted words. Four blocks of 16 bits index the items: if two fingerprints
   differ in at most 16 bits, some block differs in at most 4 (the first) or 3 (the others). Every key within that
   distance of an item's block lists the item, so no fingerprint within the radius is missed.
   A window that lies further off is found by shingles instead: a run of the similarity holds one of any shingles that are over a
   quarter of the item's weight, so those that the fewest items hold are looked up at every word of every text. Nothing is missed.
3. Candidates that pass are placed exactly: runs of every length near the window are compared with the item by
   weighted five-word shingles (an item of fewer words is one shingle); a shingle weighs one more than its words do,
   repeats count, and similarity is common weight over united weight. From 0.75 on it is a hit. A run of that similarity weighs at
   most the item's weight / 0.75, which bounds how far from the window it can reach; its first and last shingle are the item's.

The items are dealt into groups of bounded size, all with the same weights of words; each group is sent to the tasks and meets all documents, so memory does not
depend on the number of items. Null or empty texts and items match nothing. Each row of the documents is searched on its own;
repeated item ids count as one item with the best of its texts. Ties: the earliest place, then the shortest run.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import LOWER_VALUES, HashTable, SpanHash, mix, signed, steps, utf8, word_spans

RADIUS = 16
BLOCKS = ((0, 4), (16, 3), (32, 3), (48, 3))  # first bit, largest distance
CLASS_GROWTH = 1.2
STEPS_PER_WINDOW = 8
SHINGLE = 5
THRESHOLD = 0.75
COMMON = 0.08  # the least share of items of words that weigh less than 3
GROUP_BYTES = 4 << 20  # item text sent to the tasks at once
WEIGHT_SLOTS = 1 << 18
STEP_BYTES = 1 << 20
PAIRS = 1 << 21  # places and items that are looked at together
CELLS = 1 << 18  # starts and ends of runs that are compared at once
FACTORS = mix(np.arange(101, 101 + SHINGLE, dtype=np.uint64)) | np.uint64(1)


def runs_of(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words."""
    out = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        out += words[k : k + len(out)] * FACTORS[k]
    return mix(out + np.uint64(size))


def hashed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and the index of each text's first word (and of the end)."""
    data, offsets = utf8(column)
    starts, ends, first = word_spans(data, offsets)
    return SpanHash(data, LOWER_VALUES)(starts, ends), first


def distinct(column: pa.Array) -> np.ndarray:
    """Hashes of the distinct words of each text."""
    words, first = hashed(column)
    return np.concatenate([np.zeros(0, np.uint64), *(np.unique(words[a:b]) for a, b in zip(first[:-1], first[1:], strict=True))])


def word_weights(held, total: int) -> np.ndarray:
    """Weight of each slot of the hash, from words and the numbers of items that hold them: words that share a slot share the weight."""
    out = np.full(WEIGHT_SLOTS, 3, np.int8)
    for h, n in held:
        share, at = n / max(16, total), int(h) & (WEIGHT_SLOTS - 1)
        out[at] = min(out[at], 0 if share >= 0.3 else 1 if share >= 0.15 else 2 if share >= COMMON else 3)
    return out


def shared_weights(items: DataFrame) -> np.ndarray:
    """word_weights over all items. Only words of a share of COMMON or more are collected: at most 1 / COMMON times the words of a mean item."""

    def count(batches):
        for batch in steps(batches):
            yield pa.RecordBatch.from_arrays([pa.array(signed(distinct(batch.column("text"))))], ["h"])

    total = items.count()
    held = items.select("text").mapInArrow(count, "h long").groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") >= COMMON * max(16, total))
    return word_weights(held.collect(), total)


class Votes:
    """SimHashes of any windows of up to ``longest`` words, from running sums of the weighted bits.

    Several bits share one 64-bit number. A window's sums fit their lanes, so the difference of two running sums holds
    them exactly, whatever has overflowed before.
    """

    def __init__(self, words: np.ndarray, weights: np.ndarray, longest: int):
        self.lane = np.uint8 if 3 * longest < 1 << 8 else np.uint16 if 3 * longest < 1 << 16 else np.uint32
        bits = np.unpackbits(words.view(np.uint8).reshape(-1, 8), axis=1)
        votes = (bits * weights.view(np.uint8)[:, None]).astype(self.lane, copy=False).view(np.uint64)
        self.sums = np.zeros((votes.shape[1], len(words) + 1), np.uint64)
        np.cumsum(votes.T, axis=1, out=self.sums[:, 1:])
        self.weight = np.concatenate(([0], np.cumsum(weights, dtype=np.int64)))

    def fingerprint(self, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A bit is set if over half of the window's weight votes for it."""
        votes = np.ascontiguousarray((self.sums[:, end] - self.sums[:, at]).T).view(self.lane)
        half = ((self.weight[end] - self.weight[at]) // 2).astype(self.lane)
        return np.packbits(votes > half[:, None], axis=1).view(np.uint64).ravel()


class Items:
    """A group of items and its index."""

    def __init__(self, rows: list, weights: np.ndarray | None = None):
        """``weights``: see word_weights; None if the rows are all items."""
        column = pa.array([r.text or "" for r in rows], pa.string())
        words, first = hashed(column)
        own = [words[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
        self.weights = word_weights(zip(*np.unique(distinct(column), return_counts=True), strict=True), len(rows)) if weights is None else weights
        self.ids, self.words, self.sizes, self.shingles = [], [], [], []
        by_class = defaultdict(list)
        for r, w in zip(rows, own, strict=True):
            if len(w):
                by_class[self.class_of(len(w))].append(len(self.ids))
                self.ids.append(r.item_id)
                self.words.append(w)
                self.sizes.append(min(SHINGLE, len(w)))
                keys, place, count = np.unique(runs_of(w, self.sizes[-1]), return_index=True, return_counts=True)
                self.shingles.append((keys, count, self.run_weights(w, self.sizes[-1])[place]))
        self.known = {size: HashTable(np.unique(np.concatenate([s[0] for s, k in zip(self.shingles, self.sizes, strict=True) if k == size]))) for size in set(self.sizes)}
        self.totals = np.array([(count * weight).sum() for _, count, weight in self.shingles], np.int64)
        self.reach = np.floor(self.totals / THRESHOLD).astype(np.int64)  # the greatest weight of a run that can pass
        self.rare = {size: self.by_shingle(size) for size in self.known}
        self.longest = max([1, *map(len, self.words), *by_class])
        prints = [Votes(w, self.weight(w), self.longest).fingerprint(np.array([0]), np.array([len(w)]))[0] for w in self.words]
        self.classes = {size: self.indexed(np.array(members), np.array([prints[m] for m in members], np.uint64)) for size, members in by_class.items()}

    def by_shingle(self, size: int) -> tuple[HashTable, np.ndarray, np.ndarray]:
        """Shingles of which every run that passes holds one, and for each the items it stands for: offsets and items."""
        own = [i for i, k in enumerate(self.sizes) if k == size]
        held = np.bincount(self.known[size].find(np.concatenate([self.shingles[i][0] for i in own])))
        listed = []
        for i in own:
            keys, counts, weights = self.shingles[i]
            order = np.lexsort((keys, held[self.known[size].find(keys)]))
            before = np.cumsum((counts * weights)[order]) - (counts * weights)[order]
            # Without the shingles before this one a run can still reach the threshold, so this one is listed too.
            listed.append(keys[order[self.totals[i] - before >= THRESHOLD * self.totals[i]]])
        items = np.repeat(np.array(own), [len(k) for k in listed])
        keys, place = np.unique(np.concatenate(listed), return_inverse=True)
        return HashTable(keys), np.concatenate(([0], np.cumsum(np.bincount(place)))), items[np.argsort(place, kind="stable")]

    @staticmethod
    def class_of(n: int) -> int:
        """The nominal length of the class that holds ``n`` words; exact up to nine words."""
        if n < 10:
            return n
        step = round(np.log(n / 10) / np.log(CLASS_GROWTH))
        return max(10, round(10 * CLASS_GROWTH**step))

    def weight(self, words: np.ndarray) -> np.ndarray:
        return self.weights[(words & np.uint64(WEIGHT_SLOTS - 1)).astype(np.int64)]

    def run_weights(self, words: np.ndarray, size: int) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(self.weight(words), dtype=np.int64)))
        return sums[size:] - sums[:-size] + 1

    @staticmethod
    def indexed(members: np.ndarray, prints: np.ndarray):
        """For each block, the items listed under each 16-bit key: offsets and members."""
        blocks = []
        for shift, reach in BLOCKS:
            own = (prints >> np.uint64(shift)).astype(np.int64) & 0xFFFF
            flips = np.array([sum(1 << i for i in c) for d in range(reach + 1) for c in combinations(range(16), d)])
            keys = (own[:, None] ^ flips).ravel()
            order = np.argsort(keys, kind="stable")
            blocks.append((shift, np.searchsorted(keys[order], np.arange(65537)), (order // len(flips)).astype(np.int32)))
        return members, prints, blocks

    def search(self, column: pa.Array):
        """(row, item, similarity, first word, words) of the best place of each item in each text."""
        words, first = hashed(column)
        if not len(words) or not self.ids:
            return
        votes = Votes(words, self.weight(words), self.longest)
        shingles = {size: self.shingles_of(words, size) for size in self.known}
        regions = []
        for size, (members, prints, blocks) in self.classes.items():
            step = max(1, round(size / STEPS_PER_WINDOW))
            at, end = self.windows(first, size, step)
            if not len(at):
                continue
            own = votes.fingerprint(at, end)
            pairs = []
            for shift, where, listed in blocks:
                key = (own >> np.uint64(shift)).astype(np.int64) & 0xFFFF
                begin = where[key]
                count = where[key + 1] - begin
                window = np.repeat(np.arange(len(at)), count)
                place = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin, count)
                item = listed[place]
                near = np.bitwise_count(own[window] ^ prints[item]) <= RADIUS
                pairs.append(window[near].astype(np.int64) * len(members) + item[near])
            pairs = np.unique(np.concatenate(pairs))
            window, item = pairs // len(members), members[pairs % len(members)]
            regions.append(self.regions(first, shingles[min(size, SHINGLE)], min(size, SHINGLE), at[window], at[window], end[window], item))
        for size, own in shingles.items():
            regions.extend(self.by_rare_shingles(first, own, size))
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        for d, i, lo, hi in merged(regions):
            got = self.placed(*shingles[self.sizes[i]][:2], lo, hi, i)
            if got and ((d, i) not in best or got[0] > best[d, i][0]):
                best[d, i] = got
        for (d, i), (similarity, begin, end) in sorted(best.items()):
            yield d, i, similarity, begin - int(first[d]), end - begin + self.sizes[i] - 1

    def by_rare_shingles(self, first: np.ndarray, shingles: tuple, size: int):
        """The regions around the listed shingles in the texts."""
        table, where, listed = self.rare[size]
        key = table.find(shingles[0])
        at = np.flatnonzero(key >= 0)
        begin = where[key[at]]
        count = where[key[at] + 1] - begin
        pairs = np.cumsum(count)
        for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(pairs // PAIRS)) + 1):
            each = count[part]
            place = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + np.repeat(begin[part], each)
            word = np.repeat(at[part], each)
            yield self.regions(first, shingles, size, word, word + 1, word, listed[place])

    def shingles_of(self, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of ``size`` words, running sums of their weights, and of the weights of those that some item holds."""
        runs = runs_of(words, size)
        weights = self.run_weights(words, size)
        known = self.known[size].find(runs) >= 0
        return runs, np.concatenate(([0], np.cumsum(weights))), np.concatenate(([0], np.cumsum(weights * known)))

    def regions(self, first: np.ndarray, shingles: tuple, size: int, word: np.ndarray, begin: np.ndarray, end: np.ndarray, item: np.ndarray):
        """doc, item, and the first shingle and end of where a run can lie that passes and overlaps the shingles from ``begin`` to ``end``.

        ``word``: a word of the text. Left out are regions in which all shingles that any item holds weigh too little.
        """
        runs, sums, known = shingles
        doc = np.searchsorted(first, word, "right") - 1
        lo = np.searchsorted(sums, sums[np.minimum(begin, len(runs))] - self.reach[item])
        hi = np.searchsorted(sums, sums[np.minimum(end, len(runs))] + self.reach[item], "right") - 1
        lo, hi = np.maximum(lo, first[doc]), np.minimum(hi, first[doc + 1] - size + 1)
        ok = np.flatnonzero(hi > lo)
        ok = ok[known[hi[ok]] - known[lo[ok]] >= THRESHOLD * self.totals[item[ok]]]
        return doc[ok], item[ok], lo[ok], hi[ok]

    @staticmethod
    def windows(first: np.ndarray, size: int, step: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and end of the windows of every text: each ``step`` words, and the last; a short text is one window."""
        begin, sizes = first[:-1], np.diff(first)
        long, short = sizes >= size, (sizes < size) & (sizes * CLASS_GROWTH**0.5 >= size * THRESHOLD) & (sizes > 0)
        count = np.where(long, (sizes - size) // step + 1, 0)
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        at = np.repeat(begin, count) + at * step
        at = np.concatenate((at, (begin + sizes - size)[long & ((sizes - size) % step > 0)]))
        return np.concatenate((at, begin[short])), np.concatenate((at + size, (begin + sizes)[short]))

    def placed(self, runs: np.ndarray, sums: np.ndarray, lo: int, hi: int, i: int) -> tuple[float, int, int] | None:
        """Similarity, first shingle and end of the best run of any length in the region, if it reaches the threshold.

        ``sums``: running sums of the weights of ``runs``. A shingle of a run counts unless as many of its kind as the item has precede it in the run.
        """
        keys, counts, key_weights = self.shingles[i]
        place = np.searchsorted(keys, runs[lo:hi])
        place[place == len(keys)] = 0
        at = np.flatnonzero(keys[place] == runs[lo:hi])
        key = place[at]
        gain, at, total = key_weights[key], at + lo, int(self.totals[i])
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.arange(len(at)) - np.searchsorted(ordered, ordered)
        full = np.flatnonzero(rank >= counts[ordered])
        before = np.full(len(at), -1)
        before[order[full]] = order[full - counts[ordered[full]]]
        last = np.searchsorted(sums[at + 1], sums[at] + self.reach[i], "right")
        gained = np.concatenate(([0], np.cumsum(gain)))
        starts = np.flatnonzero(gained[last] - gained[:-1] >= THRESHOLD * total)
        if not len(starts):
            return None
        widest = int((last - np.arange(len(at)))[starts].max())
        step = max(1, min(widest, CELLS // widest))
        best = None
        for part in np.split(starts, np.flatnonzero(np.diff(starts // step)) + 1):
            begin, end = part[:, None], np.arange(part[0], last[part].max())
            common = np.cumsum(np.where((end >= begin) & (before[end] < begin), gain[end], 0), axis=1)
            united = total + sums[at[end] + 1] - sums[at[begin]] - common
            similarity = common / np.maximum(united, 1)
            a, b = divmod(int(similarity.argmax()), len(end))
            if similarity[a, b] >= THRESHOLD and (best is None or similarity[a, b] > best[0]):
                best = float(similarity[a, b]), int(at[part[a]]), int(at[end[b]]) + 1
        return best


def merged(regions: list) -> list[tuple[int, int, int, int]]:
    """doc, item, first shingle and end of the regions, overlapping ones of one text and item as one."""
    out: list = []
    for d, i, lo, hi in sorted(row for r in regions for row in zip(*(c.tolist() for c in r), strict=True)):
        if out and out[-1][:2] == (d, i) and lo <= out[-1][3]:
            out[-1] = d, i, out[-1][2], max(hi, out[-1][3])
        else:
            out.append((d, i, lo, hi))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity, first_word, n_words: each item found in a document, at its best place."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = 1 + total // GROUP_BYTES
    weights = shared_weights(items)
    schema = "doc_id long, item_id long, similarity double, first_word long, n_words long"
    parts = []
    for g in range(groups):
        group = Items(items.filter(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == g).orderBy("item_id", "text").collect(), weights)
        parts.append(docs.mapInArrow(searcher(spark.sparkContext.broadcast(group)), schema))
    out = reduce(DataFrame.union, parts)
    best = F.max_by(F.struct("similarity", "first_word", "n_words"), F.struct("similarity", -F.col("first_word")))
    return out.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.similarity", "b.first_word", "b.n_words")


def searcher(shared):
    def search(batches):
        group = shared.value
        for batch in steps(batches, limit=STEP_BYTES):
            ids = batch.column("doc_id").to_pylist()
            rows = [(ids[d], group.ids[i], s, p, n) for d, i, s, p, n in group.search(batch.column("text"))]
            doc, item, similarity, place, count = zip(*rows, strict=True) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(item, pa.int64()), pa.array(similarity, pa.float64()), pa.array(place, pa.int64()), pa.array(count, pa.int64())],
                ["doc_id", "item_id", "similarity", "first_word", "n_words"],
            )

    return search
