"""Similarity join of documents on their sets of five-word shingles, with prefix filtering.

The set of a text: lower-case A-Z, words, all distinct runs of five words; a text of one to four words is one shingle, a text
without words (or null) has an empty set. Two documents link when 100 * |common| >= 75 * |united|.

1. One pass counts all shingles in a sketch of fixed size, which orders them rare first, and gives each text its set's size, hash,
   and whether the sizes of 1024 ranges of the set are odd.
2. Documents with equal sets become one node. A node's prefix is its first n - ceil(0.75 n) + 1 shingles in that order: two
   nodes that link share a prefix shingle, and the first they share stands among the first n / 7 + 1 of the smaller one. Prefix
   shingles are counted, and only those of several nodes that stand that early in one are listed with their nodes.
3. Candidates pass the length filter, the positional filter on the shingle they share, and the suffix filter: a range whose size
   is odd in one set and even in the other holds a shingle that only one of the two has. Each distinct pair that is
   left is verified once per round, by the exact intersection.
4. Of shingles with few nodes all pairs are listed. For the others pairs inside one component need no test. Each
   of two rounds tests nodes against pivots, which is linear: all nodes against one, then those outside a shingle's largest
   component against a few of it. Then blocks of the nodes that are still outside meet blocks of a shingle's nodes. The three filters are applied to a block at once, and only what passes all becomes a row, in the least
   shingle that the pair shares.

Nulls: a row with a null id takes the component of rows with an equal set, else null. Rows that share an id are one document
with the links of all its texts. An empty table gives an empty result; columns other than the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import LOWER_VALUES, STEP_BYTES, Ids, SpanHash, bucketed, materialise, mix, only, passed, scratch, signed, small_batches, steps, utf8, word_spans

SHINGLE_WORDS = 5
THRESHOLD = 75  # percent
STEP = STEP_BYTES // 2  # bytes of text that one numpy step handles: the tasks of the join run beside large shuffles
SKETCH_BITS = 19
SKETCH_CHUNK = 1 << 14
RANGES = 1024
FEW = 8  # nodes of a shingle whose pairs are all listed
PIVOTS = (1, 8)  # nodes of a shingle that the others are tested against, in each round
BLOCK = 2048  # nodes of a shingle that meet as many others in one task


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Each text's set as sorted distinct 64-bit hashes."""
    data, offsets = utf8(column)
    starts, ends, first = word_spans(data, offsets)
    words = SpanHash(data, LOWER_VALUES)(starts, ends)
    factors = mix(np.arange(11, 11 + SHINGLE_WORDS, dtype=np.uint64)) | np.uint64(1)
    runs = np.zeros(max(0, len(words) - SHINGLE_WORDS + 1), np.uint64)
    for k in range(SHINGLE_WORDS):
        runs += words[k : k + len(runs)] * factors[k]
    runs = mix(runs)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= SHINGLE_WORDS:
            yield np.unique(runs[a : b - SHINGLE_WORDS + 1])
        elif b > a:
            yield mix(np.array([(words[a:b] * factors[: b - a]).sum() + np.uint64(b - a)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def measured(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """doc_id, n (set size), h1, h2 (hash of the set), odd (a bit for each range) of every row; and the sketch.

    The sketch says how many rows hold a shingle of each of 2^SKETCH_BITS classes. One pass makes both: the last row of a task
    holds its counts.
    """
    mask = np.uint64((1 << SKETCH_BITS) - 1)
    names = ["doc_id", "n", "h1", "h2", "odd", "counts"]
    shift = np.uint64(64 - RANGES.bit_length() + 1)

    def build(batches):
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in steps(batches, limit=STEP):
            size, one, two, ranges, sets = [], [], [], [], list(shingle_sets(batch.column("text")))
            for s in sets:
                size.append(len(s))
                one.append(int(s.sum(dtype=np.uint64)))
                two.append(int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)))
                ranges.append(np.packbits(np.bincount((s >> shift).astype(np.int64), minlength=RANGES) & 1).tobytes())
            total += np.bincount((np.concatenate(sets) & mask).astype(np.int64), minlength=len(total))
            hashes = [pa.array(signed(np.array(x, np.uint64))) for x in (one, two)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(size, pa.int32()), *hashes, pa.array(ranges, pa.binary()), pa.nulls(len(size), pa.binary())], names)
        yield pa.RecordBatch.from_arrays([pa.nulls(1, t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())] + [pa.array([total.astype(np.uint32).tobytes()], pa.binary())], names)

    def cut(batches):
        for batch in batches:
            for blob in batch.column("counts"):
                parts = np.frombuffer(blob.as_buffer(), np.uint32).reshape(-1, SKETCH_CHUNK)
                yield chunks(dict(enumerate(parts.astype(np.int64))))

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, blob in zip(batch.column("chunk").to_pylist(), batch.column("counts"), strict=True):
                sums[i] = sums.get(i, 0) + np.frombuffer(blob.as_buffer(), np.int64)
        yield chunks(sums)

    def chunks(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array([x.tobytes() for x in parts.values()], pa.binary())], ["chunk", "counts"])

    both = materialise(docs.mapInArrow(build, "doc_id long, n int, h1 long, h2 long, odd binary, counts binary"), keep=True)
    schema = "chunk int, counts binary"
    rows = both.filter("counts is not null").select("counts").mapInArrow(cut, schema).repartition("chunk").mapInArrow(add, schema).collect()
    out = np.zeros(1 << SKETCH_BITS, np.int32)
    for row in rows:
        out[row.chunk * SKETCH_CHUNK : (row.chunk + 1) * SKETCH_CHUNK] = np.minimum(np.frombuffer(row.counts, np.int64), 2**31 - 1)
    return both.filter("counts is null").drop("counts"), out


def postings(docs: DataFrame, nodes: DataFrame, sketch: np.ndarray) -> DataFrame:
    """token, doc, n, pos, c: the prefix shingles that several nodes hold, with their nodes and places, and how many nodes hold them.

    One scan counts them; the next lists those that a filter of bounded size lets through, and a join with the counts leaves the right
    ones. A copy that the filter of nodes lets through is one more node.
    """
    counts = docs.sparkSession.sparkContext.broadcast(sketch)
    mask = np.uint64((1 << SKETCH_BITS) - 1)
    rows, own = only(docs, nodes)

    def heads(batch):
        for s in shingle_sets(batch.column("text")):
            n = len(s)
            order = np.argsort(counts.value[(s & mask).astype(np.int64)], kind="stable")
            yield n, s[order[: n - -(-THRESHOLD * n // 100) + 1 if n else 0]]

    def count(batches):
        for batch in passed(batches, own, STEP):
            sizes, found = zip(*heads(batch))
            # 2 t / (1 + t) of its shingles are common to the smaller of two sets that link.
            early = np.concatenate([np.arange(len(x)) <= n - -(-2 * THRESHOLD * n // (100 + THRESHOLD)) for n, x in zip(sizes, found)])
            token, first, c = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
            yield pa.RecordBatch.from_pydict({"token": signed(token), "c": c.astype(np.int32), "early": np.bincount(first, early, len(token)) > 0})

    counted = rows.mapInArrow(count, "token long, c int, early boolean").groupBy("token").agg(F.sum("c").alias("c"), F.max("early").alias("early"))
    several = materialise(counted.filter("c > 1 and early").select("token", "c"))
    held = docs.sparkSession.sparkContext.broadcast(Ids(several, several.count(), F.col("token")))

    def build(batches):
        for batch in passed(batches, own, STEP):
            sizes, found = zip(*heads(batch))
            lengths = np.array([len(x) for x in found])
            token, text = np.concatenate(found), np.repeat(np.arange(len(found)), lengths)
            pos = np.arange(len(token)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            kept = np.flatnonzero(held.value.holds(token))
            columns = {"token": signed(token[kept]), "doc": batch.column("doc_id").take(pa.array(text[kept])), "n": np.array(sizes, np.int32)[text[kept]], "pos": pos[kept].astype(np.int32)}
            yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(build, "token long, doc long, n int, pos int").join(several, "token")


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id and text of the rows with these ids, and of a few others that the filter lets through."""
    rows, own = only(docs, ids)

    def build(batches):
        for batch in passed(batches, own, STEP):
            yield batch.select(["doc_id", "text"])

    return rows.mapInArrow(build, "doc_id long, text string")


def may_link(n: str, at: str, other_n: str, other_at: str) -> Column:
    """Length filter and positional filter for two nodes that share a shingle at these places of their prefixes."""
    a, b, i, j = F.col(n), F.col(other_n), F.col(at), F.col(other_at)
    return (100 * F.least(a, b) >= THRESHOLD * F.greatest(a, b)) & ((100 + THRESHOLD) * (F.least(a - i, b - j)) >= THRESHOLD * (a + b))


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    """The exact test of two sorted sets."""
    both = np.concatenate((x, y))
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= THRESHOLD * (len(x) + len(y) - common)


def few_apart(differing: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Suffix filter: whether two sets of together ``n`` shingles may link if that many ranges differ. Each holds a shingle of one side only."""
    return (100 + THRESHOLD) * differing.astype(np.int64) <= (100 - THRESHOLD) * n.astype(np.int64)


def bit_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, RANGES // 64)


def suffix_filtered(pairs: DataFrame, odd: DataFrame) -> DataFrame:
    """The pairs (a, b) that may link by their ranges. ``odd``: doc_id, n, odd."""

    def test(batches):
        for batch in batches:
            differing = np.bitwise_count(bit_rows(batch.column("x")) ^ bit_rows(batch.column("y"))).sum(1)
            n = sum(batch.column(c).to_numpy().astype(np.int64) for c in ("n", "m"))
            yield batch.select(["a", "b"]).filter(pa.array(few_apart(differing, n)))

    left = odd.select(F.col("doc_id").alias("a"), F.col("odd").alias("x"), "n")
    right = odd.select(F.col("doc_id").alias("b"), F.col("odd").alias("y"), F.col("n").alias("m"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y", "n", "m").mapInArrow(test, "a long, b long").distinct()


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that link. Texts travel, since they compress and hashes of shingles don't; the sets are made where they meet."""

    def test(batches):
        for batch in steps(batches, "x", STEP // 2):
            kept = [linked(x, y) for x, y in zip(shingle_sets(batch.column("x")), shingle_sets(batch.column("y")), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("x"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(test, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node reachable over ``edges`` (a, b). Rounds of taking the neighbours' least label and its label."""
    both = materialise(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")))
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        moved = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        of = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = materialise(moved.join(of, "label", "left").select("node", "old", F.least("label", F.coalesce("next", "label")).alias("label")))
        labels = jumped.select("node", "label")
        if jumped.filter("old <> label").isEmpty():
            return labels


def candidate(other: str = "p_") -> Column:
    """Two nodes of a shingle, in one row, that pass the length and the positional filter."""
    return may_link("n", "pos", f"{other}n", f"{other}pos")


def all_pairs(shared: DataFrame) -> DataFrame:
    other = shared.select("token", *(F.col(c).alias(f"p_{c}") for c in shared.columns if c not in ("token", "c")))
    both = shared.join(other, "token").filter(F.col("doc") < F.col("p_doc")).filter(candidate())
    return both.select(F.col("doc").alias("a"), F.col("p_doc").alias("b")).distinct()


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) after joining the components that ``links`` (a, b) connect."""
    ends = links.join(labels.select(F.col("node").alias("a"), F.col("label").alias("x")), "a").join(labels.select(F.col("node").alias("b"), F.col("label").alias("y")), "b")
    edges = materialise(ends.filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    if edges.isEmpty():
        return labels
    new = components(edges).select(F.col("node").alias("label"), F.col("label").alias("new"))
    return materialise(labels.join(new, "label", "left").select("node", F.coalesce("new", "label").alias("label")))


def largest(live: DataFrame) -> DataFrame:
    """token, c (its nodes), top: the label of most of its nodes."""
    groups = live.groupBy("token", "label").agg(F.count("*").alias("size"))
    found = groups.groupBy("token").agg(F.sum("size").alias("c"), F.max(F.struct("size", (-F.col("label")).alias("label"))).alias("most"))
    return found.select("token", "c", (-F.col("most.label")).alias("top"))


def pivot_pairs(live: DataFrame, turn: int) -> DataFrame:
    """Pairs of nodes of each shingle with a few of them: with one, later of nodes outside its largest component with nodes of it."""
    inside = rest = live
    if turn:
        marked = live.join(largest(live).drop("c"), "token")
        inside, rest = marked.filter("label = top"), marked.filter("label <> top")
    # The nodes with the least hashes; each seed gives one.
    least = [F.min(F.struct(F.xxhash64("doc", F.lit(turn), F.lit(i)).alias("h"), "doc", "n", "pos", "label")) for i in range(PIVOTS[turn])]
    pivots = inside.groupBy("token").agg(F.array_distinct(F.transform(F.array(*least), lambda x: x.dropFields("h"))).alias("p"))
    pivots = pivots.select("token", F.explode("p").alias("p")).select("token", *(F.col(f"p.{c}").alias(f"p_{c}") for c in ("doc", "n", "pos", "label")))
    pairs = rest.join(pivots, "token").filter(F.col("label") != F.col("p_label")).filter(candidate())
    return pairs.select(F.least("doc", "p_doc").alias("a"), F.greatest("doc", "p_doc").alias("b")).distinct()


def block_pairs(live: DataFrame, odd: DataFrame) -> DataFrame:
    """All pairs of nodes of different components that share a shingle of ``live`` and pass the filters, each once.

    A shingle's nodes are dealt to blocks of about ``BLOCK``. Each block's nodes outside the largest component meet the nodes of
    each block. A pair counts in the first shingle that it shares, where the positional filter holds; if that one is not in ``live``, the
    pair has been tested or is in one component. An id with several texts counts in all its shingles.
    """
    sets = odd.select(F.col("doc_id").alias("doc"), "n", "odd").distinct()
    several = sets.groupBy("doc").agg((F.count("*") > 1).alias("several"))
    shingles = live.groupBy("doc").agg(F.transform(F.sort_array(F.collect_set(F.struct("pos", "token"))), lambda x: x["token"]).alias("tokens"))
    rows = live.join(largest(live), "token").join(shingles.join(several, "doc"), "doc").join(sets, ["doc", "n"])
    rows = rows.withColumn("blocks", F.ceil(F.col("c") / BLOCK).cast("int"))
    # What the pair may share before this shingle.
    earlier = F.when(F.col("several"), F.array().cast("array<long>")).otherwise(F.slice("tokens", F.lit(1), F.array_position("tokens", F.col("token")).cast("int") - 1))
    own, other = F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    keep = ["doc", "n", "pos", "label", "odd", earlier.alias("earlier"), (F.col("label") != F.col("top")).alias("out")]
    outside = rows.filter("label <> top").select("token", own.alias("i"), other.alias("j"), F.lit(True).alias("probe"), *keep)
    every = rows.select("token", other.alias("i"), own.alias("j"), F.lit(False).alias("probe"), *keep)

    def test(key, rows):
        probe = rows.column("probe").to_numpy(zero_copy_only=False)
        x, y = (rows.filter(pa.array(p)) for p in (probe, ~probe))
        a, b = [], []
        if x.num_rows:
            doc, n, pos, label, out = (y.column(c).to_numpy() for c in ("doc", "n", "pos", "label", "out"))
            bits, n, shared = bit_rows(y.column("odd")), n.astype(np.int64), None
            for k, mine in enumerate(bit_rows(x.column("odd"))):
                me = {c: x.column(c)[k].as_py() for c in ("doc", "n", "pos", "label", "earlier")}
                ok = (label != me["label"]) & ~(out & (doc <= me["doc"])) & (100 * np.minimum(n, me["n"]) >= THRESHOLD * np.maximum(n, me["n"]))
                ok &= (100 + THRESHOLD) * np.minimum(n - pos, me["n"] - me["pos"]) >= THRESHOLD * (n + me["n"])
                at = np.flatnonzero(ok)
                at = at[few_apart(np.bitwise_count(bits[at] ^ mine).sum(1), n[at] + me["n"])]
                if len(at):
                    shared, held = shared or [set(t) for t in y.column("earlier").to_pylist()], set(me["earlier"])
                    first = [i for i in at if held.isdisjoint(shared[i])]
                    a += [me["doc"]] * len(first)
                    b += doc[first].tolist()
        both = np.array([a, b], np.int64).reshape(2, -1)
        return pa.table({"a": both.min(0), "b": both.max(0)})

    return outside.union(every).groupBy("token", "i", "j").applyInArrow(test, "a long, b long")


def node_links(shared: DataFrame, docs: DataFrame, odd: DataFrame) -> DataFrame | None:
    """node, label for the nodes that may link with another. ``shared``: token, doc, n, pos, c (nodes of the shingle)."""
    listed = materialise(suffix_filtered(all_pairs(shared.filter(F.col("c") <= FEW)), odd))
    hot = materialise(shared.filter(F.col("c") > FEW).drop("c"))
    ids = materialise(listed.select(F.col("a").alias("doc_id")).union(listed.select("b")).union(hot.select("doc")).distinct())
    if ids.isEmpty():
        return None
    odd = materialise(odd.join(ids, "doc_id", "left_semi"))
    with bucketed(texts_of(docs, ids), "doc_id") as texts:
        return settled(listed, hot, ids, texts, odd)


def settled(listed: DataFrame, hot: DataFrame, ids: DataFrame, texts: DataFrame, odd: DataFrame) -> DataFrame:
    """The labels after the listed pairs, the rounds over the shingles of many nodes and the blocks of what these leave."""
    labels = merged(ids.select(F.col("doc_id").alias("node"), F.col("doc_id").alias("label")), materialise(verified(listed, texts)))
    for turn in range(len(PIVOTS) + 1):
        live = hot.join(labels.withColumnRenamed("node", "doc"), "doc")
        # Shingles whose nodes are all in one component are done.
        open_ = live.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("token")
        live = materialise(live.join(open_, "token", "left_semi"))
        if live.isEmpty():
            break
        pairs = suffix_filtered(pivot_pairs(live, turn), odd) if turn < len(PIVOTS) else block_pairs(live, odd)
        labels = merged(labels, materialise(verified(materialise(pairs), texts)))
    return labels


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id: one row for each row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with small_batches(docs.sparkSession, "6m"), scratch(docs.sparkSession):
        sets, sketch = measured(docs)
        named = sets.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("node"))
        nodes = materialise(named.filter("node is not null and n > 0").select(F.col("node").alias("doc_id")).distinct())
        shared = materialise(postings(docs.filter("doc_id is not null"), nodes, sketch))
        labels = node_links(shared, docs, sets.select("doc_id", "n", "odd"))
        labels = labels if labels is None else materialise(labels.filter("node <> label"), keep=True)
    rows = sets.select("doc_id", "h1", "h2", "n").join(named, ["h1", "h2", "n"], "left")
    # A set without shingles links with nothing: its document is its own component.
    node = F.when(F.col("n") > 0, F.col("node")).otherwise(F.col("doc_id"))
    rows = rows.select("doc_id", F.col("n").cast("long").alias("n_shingles"), node.alias("node"))
    if labels is None:
        return rows.select("doc_id", "n_shingles", F.col("node").alias("component_id"))
    return rows.join(labels, "node", "left").select("doc_id", "n_shingles", F.coalesce("label", "node").alias("component_id"))
