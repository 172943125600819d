"""Repeated byte strings by sharded suffix arrays: every 100-byte string that also starts earlier is removed.

Texts are UTF-8 bytes. Places are ordered by (doc_id, start); a null id comes first. Matches never cross documents.

1. A text equal to an earlier one is removed whole. The first ones go on.
2. Each 100-byte window has a key: the least hash of its 24-byte grams. Equal windows have equal keys, so windows can only match inside
   the group of their key. Neighbouring windows with one key form a run (39 on average); a run whose key is unique in the corpus, and
   does not recur inside it, has no match and leaves. So nearly all text leaves as a few numbers per run.
3. The bytes under the other runs are dealt to shards by key; a key with more than ``SHARD_RUNS`` runs is dealt over several. A
   shard's suffix array is built by Larsson-Sadakane refinement: sort by eight bytes, then sort groups that are still equal by the
   ranks 8, 16, 32 .. bytes on. Kasai's common prefixes, for many runs side by side, cut it into classes of equal windows;
   all windows of a class but the earliest are repeats.
4. The earliest ones of keys that were dealt over several shards are merged: sorted fingerprints of the shards' classes are
   found in each other by binary search, and all but the earliest are repeats.
5. The repeats' bytes are united per document and cut out.

Rows with equal id and text are one document; rows with equal ids and different texts are ordered by start only. Texts under
100 bytes, empty and null ones lose nothing. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.common import BYTE_VALUES, SpanHash, materialise, mix, only, passed, signed, small_batches, steps, utf8

SPAN = 100
GRAM = 24
PER_WINDOW = SPAN - GRAM + 1
SHARD_RUNS = 20_000
CHUNK_BYTES = 1 << 20
LANE = 512
OTHER_VALUES = mix(BYTE_VALUES)
FIRST_ID = -(1 << 63)


def place_id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST_ID))


def tag() -> Column:
    """Tells texts with one id apart."""
    return F.pmod(F.xxhash64("text"), F.lit(65536)).cast("int")


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """Least of x[i : i + size] for each i, from running minima of blocks."""
    n = len(x) - size + 1
    if n <= 0:
        return np.zeros(0, x.dtype)
    rows = np.full(-(-len(x) // size) * size, np.iinfo(x.dtype).max, x.dtype)
    rows[: len(x)] = x
    rows = rows.reshape(-1, size)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[size - 1 : size - 1 + n])


def runs_of(column: pa.Array):
    """key, text number, first window, number of windows, whether the key recurs inside; for every run of every text."""
    data, offsets = utf8(column)
    if len(data) < SPAN:
        return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3, np.zeros(0, bool))
    at = np.arange(len(data) - GRAM + 1)
    grams = SpanHash(data)(at, at + GRAM)
    keys = sliding_min(grams, PER_WINDOW)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    whole = np.flatnonzero(doc[: len(keys)] == doc[SPAN - 1 :])
    if not len(whole):
        return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3, np.zeros(0, bool))
    own, text = keys[whole], doc[whole]
    new = np.ones(len(whole), bool)
    new[1:] = (own[1:] != own[:-1]) | (text[1:] != text[:-1])
    # The key's gram has left, yet the key is the same: it recurs.
    left = np.zeros(len(whole), bool)
    left[1:] = ~new[1:] & (grams[whole[1:] - 1] == own[1:])
    first = np.flatnonzero(new)
    count = np.diff(np.concatenate((first, [len(whole)])))
    return own[first], text[first], whole[first] - offsets[text[first]], count, np.logical_or.reduceat(left, first)


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The next eight bytes at each place as one number; zeros follow the end."""
    padded = np.concatenate((data, np.zeros(8, np.uint8))).astype(np.uint64)
    out = np.zeros(len(data), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k : k + len(data)]
    return out


def suffix_array(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the place of each in this order. Kasai's bound needs the order to be complete."""
    n = len(data)
    key = eight_bytes(data)
    order = np.argsort(key, kind="stable")
    head = np.ones(n, bool)
    head[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    known = 8
    while True:
        # Only groups of several suffixes are refined, each within its own places.
        alone = head & np.concatenate((head[1:], [True]))
        slots = np.flatnonzero(~alone)
        if not len(slots):
            break
        members = order[slots]
        further = np.where(members + known < n, rank[np.minimum(members + known, n - 1)], -1)
        group = rank[members]
        sort = np.lexsort((further, group))
        order[slots] = members = members[sort]
        group, further = group[sort], further[sort]
        fresh = np.ones(len(slots), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (further[1:] != further[:-1])
        head[slots] = fresh
        rank[members] = np.maximum.accumulate(np.where(fresh, slots, 0))
        known *= 2
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    return order, place


def common_prefixes(data: np.ndarray, order: np.ndarray, place: np.ndarray, starts: np.ndarray, cap: int = SPAN) -> np.ndarray:
    """Kasai: for each suffix the common prefix with the one before it in the order, up to ``cap``.

    The text is walked in lanes that begin at ``starts``: the next suffix of a lane shares at least one byte less than the last one.
    """
    n = len(data)
    key = eight_bytes(data)
    out = np.zeros(n, np.int64)
    ends = np.concatenate((starts[1:], [n]))
    cuts = -(-(ends - starts) // LANE)
    begin = np.repeat(starts, cuts) + LANE * (np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts))
    end = np.minimum(begin + LANE, np.repeat(ends, cuts))
    sort = np.argsort(begin - end, kind="stable")  # longest lanes first: those that still run are a prefix
    begin, size = begin[sort], (end - begin)[sort]
    shared = np.zeros(len(begin), np.int64)
    for step in range(int(size.max(initial=0))):
        live = int(np.searchsorted(-size, -step, "left"))
        at = begin[:live] + step
        slot = place[at]
        other = order[slot - 1]  # the first has none before it; set to 0 below
        h = np.maximum(shared[:live] - 1, 0)
        going = np.arange(live)
        while len(going):
            a, b = at[going] + h[going], other[going] + h[going]
            ok = np.maximum(a, b) < n
            going, a, b = going[ok], a[ok], b[ok]
            apart = key[a] ^ key[b]
            same = np.full(len(going), 8)
            for k in range(8):
                same -= apart >= np.uint64(1) << np.uint64(8 * k)
            h[going] = np.minimum(h[going] + same, np.minimum(cap, n - np.maximum(at[going], other[going])))
            going = going[(same == 8) & (h[going] < cap)]
        h[slot == 0] = 0
        shared[:live] = h
        out[at] = h
    return out


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, .. counts[0] numbers, then the next."""
    return np.arange(counts.sum()) + np.repeat(starts - np.cumsum(counts) + counts, counts)


def shard_repeats(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Repeats among the runs of ``batch``, sorted by key, shard, bytes and place; and the earliest windows of keys in several shards.

    Spans have f1 null; windows of several shards have their fingerprint f1, f2 and their start in ``begin``.
    """
    key, shard, ids, tags, at, count, several = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "shard", "id", "tag", "at", "windows", "several"))
    data, offsets = utf8(batch.column("bytes"))
    same_bytes = SpanHash(data)(offsets[:-1], offsets[1:])
    copy = np.zeros(len(key), bool)
    copy[1:] = (key[1:] == key[:-1]) & (shard[1:] == shard[:-1]) & (same_bytes[1:] == same_bytes[:-1])
    # Rows of one document that stand twice in the table are one place, not copies.
    again = np.zeros(len(key), bool)
    again[1:] = copy[1:] & (ids[1:] == ids[:-1]) & (at[1:] == at[:-1])
    head = np.maximum.accumulate(np.where(copy, 0, np.arange(len(key))))
    spans = [(ids[c], tags[c], at[c], at[c] + count[c] + SPAN - 1) for c in [np.flatnonzero(copy & ~(again & (ids == ids[head]) & (at == at[head])))]]
    own = np.flatnonzero(~copy)
    data, offsets = utf8(batch.column("bytes").take(pa.array(own)))
    order, place = suffix_array(data)
    prefix = common_prefixes(data, order, place, offsets[:-1])
    classes = np.cumsum(prefix[order] < SPAN)[place]
    windows = ragged(offsets[:-1], count[own])
    run = np.repeat(np.arange(len(own)), count[own])
    start = at[own][run] + windows - offsets[run]
    _, rank = np.unique(ids[own], return_inverse=True)
    where = (rank[run].astype(np.int64) << 40) | start
    group = classes[windows]
    least = np.full(classes.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, group, where)
    repeat = where > least[group]
    edge = np.flatnonzero(repeat & ~np.concatenate(([False], repeat[:-1] & (run[1:] == run[:-1]))))
    last = np.flatnonzero(repeat & ~np.concatenate((repeat[1:] & (run[1:] == run[:-1]), [False])))
    spans.append((ids[own][run[edge]], tags[own][run[edge]], start[edge], start[last] + SPAN))
    merge = np.flatnonzero(~repeat & several[own][run])
    f1, f2 = SpanHash(data)(windows[merge], windows[merge] + SPAN), SpanHash(data, OTHER_VALUES)(windows[merge], windows[merge] + SPAN)
    n_spans = sum(len(s[0]) for s in spans)
    spans.append((ids[own][run[merge]], tags[own][run[merge]], start[merge], start[merge] + SPAN))
    columns = [np.concatenate(c) for c in zip(*spans, strict=True)]
    prints = [pa.concat_arrays([pa.nulls(n_spans, pa.int64()), pa.array(signed(f))]) for f in (f1, f2)]
    arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)]
    return pa.RecordBatch.from_arrays([*arrays, *prints], ["id", "tag", "begin", "end", "f1", "f2"])


def by_groups(batches, column: str, work, limit: int = CHUNK_BYTES):
    """Apply ``work`` to chunks of whole groups of a sorted column, of about ``limit`` bytes."""
    waiting: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        at = 0
        step = max(1, batch.num_rows * limit // max(1, batch.nbytes))
        while at < batch.num_rows:
            part = batch.slice(at, step)
            at += step
            waiting.append(part)
            size += part.nbytes
            if size >= limit:
                joined = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                keys = joined.column(column).to_numpy(zero_copy_only=False)
                cut = int(np.searchsorted(keys, keys[-1], "left"))
                if cut:
                    yield work(joined.slice(0, cut))
                waiting = [joined.slice(cut)]
                size = waiting[0].nbytes if cut else 0  # a group larger than the limit is looked at again after another limit
    if waiting:
        joined = pa.Table.from_batches(waiting).combine_chunks().to_batches()
        if joined:
            yield work(joined[0])


def merged_repeats(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Repeats among windows (f1, f2) of several shards: each shard's windows find their class by binary search."""
    ids, start, tags = (batch.column(c).to_numpy() for c in ("id", "begin", "tag"))
    prints = mix(batch.column("f1").to_numpy().view(np.uint64)) ^ batch.column("f2").to_numpy().view(np.uint64)
    known = np.unique(prints)
    group = np.searchsorted(known, prints)
    _, rank = np.unique(ids, return_inverse=True)
    where = (rank.astype(np.int64) << 40) | start
    least = np.full(len(known), np.iinfo(np.int64).max)
    np.minimum.at(least, group, where)
    repeat = np.flatnonzero(where > least[group])
    return pa.RecordBatch.from_arrays([pa.array(ids[repeat]), pa.array(tags[repeat], pa.int32()), pa.array(start[repeat]), pa.array(start[repeat] + SPAN)], ["id", "tag", "begin", "end"])


def first_texts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct doc_id of the first documents of each text of SPAN bytes or more; spans (id, tag, begin, end) of the other documents."""
    rows = docs.filter(F.octet_length("text") >= SPAN).select(place_id().alias("id"), tag().alias("tag"), F.octet_length("text").alias("size"), F.xxhash64("text").alias("b1"), F.xxhash64(F.lit(7), "text").alias("b2"))
    rows = materialise(rows)
    first = rows.groupBy("b1", "b2", "size").agg(F.min("id").alias("first"))
    copies = rows.join(first, ["b1", "b2", "size"]).filter("id > first").select("id", "tag", F.lit(0).cast("long").alias("begin"), F.col("size").cast("long").alias("end")).distinct()
    return first.select(F.col("first").alias("doc_id")).distinct(), copies


def repeated_spans(docs: DataFrame, shard_runs: int = SHARD_RUNS) -> DataFrame:
    """id, tag, spans: what is removed of each document that loses anything; spans overlap. ``docs``: doc_id (never null), text."""
    firsts, copies = first_texts(docs)
    texts = docs.filter(F.octet_length("text") >= SPAN).withColumn("tag", tag())
    rows, own = only(texts, materialise(firsts))

    def runs(batches):
        for batch in passed(batches, own):
            for part in steps(iter([batch]), limit=CHUNK_BYTES):
                key, text, at, count, recurs = runs_of(part.column("text"))
                row = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(key)), part.column("doc_id").take(row), part.column("tag").take(row), pa.array(at, pa.int64()), pa.array(count, pa.int32()), pa.array(recurs)],
                    ["key", "id", "tag", "at", "windows", "recurs"],
                )

    found = rows.mapInArrow(runs, "key long, id long, tag int, at long, windows int, recurs boolean")
    found = found.withColumn("n", F.count("*").over(Window.partitionBy("key"))).filter("n > 1 or recurs").drop("recurs")
    found = materialise(found)
    rows, own = only(texts, materialise(found.select(F.col("id").alias("doc_id")).distinct()))

    def kept(batches):
        for batch in passed(batches, own):
            yield batch.select(["doc_id", "tag", "text"])

    held = rows.mapInArrow(kept, "doc_id long, tag int, text string").dropDuplicates(["doc_id", "tag"])
    listed = found.groupBy(F.col("id").alias("doc_id"), "tag").agg(F.collect_list(F.struct("key", "at", "windows", "n")).alias("runs"))

    def contexts(batches):
        for batch in batches:
            for part in steps(iter([batch]), limit=CHUNK_BYTES):
                data, offsets = utf8(part.column("text"))
                lists = part.column("runs")
                doc = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
                key, at, count, n = (c.to_numpy(zero_copy_only=False) for c in lists.flatten().flatten())
                size = count.astype(np.int64) + SPAN - 1
                picked = data[ragged(offsets[doc] + at, size)]
                ends = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
                bytes_ = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(picked)])
                row = pa.array(doc)
                yield pa.RecordBatch.from_arrays([pa.array(key), part.column("doc_id").take(row), part.column("tag").take(row), pa.array(at), pa.array(count), pa.array(n), bytes_], ["key", "id", "tag", "at", "windows", "n", "bytes"])

    cut = held.join(listed, ["doc_id", "tag"]).select("doc_id", "tag", "text", "runs").mapInArrow(contexts, "key long, id long, tag int, at long, windows int, n long, bytes binary")
    parts = F.ceil(F.col("n") / shard_runs)
    cut = cut.withColumn("shard", F.pmod(F.xxhash64("id", "at"), parts)).withColumn("several", parts > 1).drop("n")
    dealt = cut.repartition("key", "shard").sortWithinPartitions("key", "shard", "bytes", "id", "at")
    shape = "id long, tag int, begin long, end long, f1 long, f2 long"
    own_spans = materialise(dealt.mapInArrow(lambda batches: by_groups(batches, "key", shard_repeats), shape))
    across = own_spans.filter("f1 is not null").repartition("f1").sortWithinPartitions("f1")
    across = across.mapInArrow(lambda batches: by_groups(batches, "f1", merged_repeats), "id long, tag int, begin long, end long")
    spans = own_spans.filter("f1 is null").select("id", "tag", "begin", "end").union(across).union(copies)
    return spans.groupBy("id", "tag").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))


def united(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Maximal runs of the union."""
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(end, out[-1][1])
        else:
            out.append([begin, end])
    return out


def without_repeats(docs: DataFrame, shard_runs: int = SHARD_RUNS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes that are left, null if that is the whole text)."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    placed = rows.select(place_id().alias("doc_id"), "text")
    with small_batches(docs.sparkSession, "16m"):
        spans = materialise(repeated_spans(placed, shard_runs))
        texts, own = only(rows.select(F.col("doc_id").alias("own_id"), place_id().alias("doc_id"), "text").withColumn("tag", tag()), materialise(spans.select(F.col("id").alias("doc_id")).distinct()), keep=True)

    def split(batches):
        for batch in batches:
            for part in steps(iter([batch])):
                hit = own.value.hold(part.column("h")) if own is not None else np.ones(part.num_rows, bool)
                texts = part.column("text").to_pylist()
                raw = [(t or "").encode() for t in texts]
                # Texts that lose nothing are done here and need not be shuffled.
                sha = [None if h else hashlib.sha256(r).hexdigest() for r, h in zip(raw, hit, strict=True)]
                held = [r if h else None for r, h in zip(raw, hit, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("own_id"), part.column("doc_id"), part.column("tag"), pa.array([len(r) for r in raw], pa.int64()), pa.array(sha, pa.string()), pa.array(held, pa.binary())], ["own_id", "id", "tag", "n_bytes", "sha", "raw"])

    def finish(batches):
        for batch in batches:
            out = []
            for raw, sha, spans in zip(batch.column("raw").to_pylist(), batch.column("sha").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                if raw is None or not spans:
                    out.append((0, 0, sha if raw is None else hashlib.sha256(raw).hexdigest(), None))
                    continue
                runs = united([(s["begin"], s["end"]) for s in spans])
                edges = [0, *(e for r in runs for e in r), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out.append((len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept))
            removed, count, sha, kept = zip(*out, strict=True) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("own_id"), batch.column("n_bytes"), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    cut = texts.mapInArrow(split, "own_id long, id long, tag int, n_bytes long, sha string, raw binary")
    joined = cut.join(spans, ["id", "tag"], "left").select("own_id", "n_bytes", "sha", "raw", "spans")
    return joined.mapInArrow(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
