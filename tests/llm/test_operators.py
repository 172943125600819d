"""Each operator against a plain version on small tables, and on tables with nulls, empty and long texts, ties and repeated rows."""

import collections
import hashlib
import random
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from waymark.llm import decontaminate, html, language, mixing, ngram_join, quality, sharding, suffix, templates, urls
from waymark.llm.common import LOWER_VALUES, SpanHash, utf8, word_spans

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
random.seed(5)
VOCABULARY = ["".join(random.choice("abcdefghij") for _ in range(random.randint(2, 7))) for _ in range(400)]


def prose(n, seed):
    own = random.Random(seed)
    return " ".join(own.choice(VOCABULARY) for _ in range(n))


EDGES = [
    (None, prose(80, 1), "s", 1), (1, None, "s", 2), (2, "", None, 3), (3, "   \n\t ", "s", 4), (4, "one", "s", 5), (5, prose(30_000, 2), "big", 6),
    (6, prose(80, 1), None, 7), (7, prose(80, 3), "s", 8), (7, prose(80, 3), "s", 8), (8, "Ä ö\nÄ ö\n# é", "s", 9), (9, "x" * 400, "s", 10), (10, prose(80, 1), "s", 11),
]


@pytest.fixture(scope="module")
def edges(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, and columns named like results."""
    return spark.createDataFrame(EDGES, "doc_id long, text string, source string, score int").withColumns({"lang_pred": F.lit(1), "shard": F.lit("a"), "tokens": F.lit("b"), "n_lines": F.lit(0)})


@pytest.fixture(scope="module")
def empty(edges):
    return edges.filter("false")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").cache()


# 1: quality


def base_figures(text):
    words = WORD.findall(text or "")
    windows = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    marked = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(marked))


def test_quality_figures(edges, documents, empty):
    for df in (edges, documents):
        texts = collections.Counter(base_figures(r.text) for r in df.select("text").collect())
        rows = quality.judged(df, None).collect()
        assert texts == collections.Counter((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
        assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and r.kept == (not r.base_failed) for r in rows)
    assert quality.judged(empty, None).count() == 0
    assert quality.fit(empty, empty.select("doc_id", F.lit(1).alias("quality"))) is None


def test_quality_holds_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit(docs, labels.filter("doc_id % 3 <> 0"), sample_rows=200)
    rows = quality.judged(docs, model).join(labels.filter("doc_id % 3 = 0"), "doc_id").collect()
    right = [(r.p_good >= quality.THRESHOLD) == (r.quality == 1) for r in rows if not r.base_failed]
    assert len(right) > 80 and sum(right) >= 0.95 * len(right)
    assert all(0 <= r.p_good <= 1 for r in rows)


# 2: language


def test_language_of_few_rows_is_learned(spark):
    """The sample is bounded for each language, and takes the least hashes of each."""
    rows = [(i, prose(30, 40_000 + i), "en") for i in range(1500)] + [(5000 + i, "zuvo krawt plumq zyx wovv " * 4, "rare") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df, sample_rows=20)
    assert model.langs == ["en", "rare"] and model.predict(pa.array(["krawt zyx plumq", rows[0][1]]))[0] == ["rare", "en"]
    hashes = sorted((r.h, r.doc_id) for r in df.filter("lang = 'en'").select(F.xxhash64("doc_id").alias("h"), "doc_id").collect())
    chosen = language.sampled(df.union(df.filter("lang = 'rare'")), 20).collect()
    assert {r.doc_id for r in chosen if r.lang == "en"} == {i for _, i in hashes[:20]} and len(chosen) == 30


def test_language_holds_out(documents, edges, empty):
    model = language.fit(language.training_rows(documents))
    rows = language.identify(documents.withColumn("held", language.held_out()), model).filter("held and lang is not null").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all((zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    judged = {r.text: r for r in language.identify(edges, model).collect()}
    assert all(judged[t].lang_pred == "und" and judged[t].score == 0 for t in (None, "", "   \n\t "))
    assert judged["one"].lang_pred in model.langs and 0 <= judged["one"].score <= 1
    assert language.identify(empty, model).count() == 0
    assert {r.lang_pred for r in language.identify(edges, language.fit(empty.withColumn("lang", F.lit("en")))).collect()} == {"und"}


def test_backoff_by_hand(spark):
    """Known words by log frequency, others by the mean over places of the longest known n-gram."""
    rows = [(1, "aaa bbb " * 5, "x"), (2, "abab aaa " * 5, "y")]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    counts = {"x": collections.Counter(), "y": collections.Counter()}
    for _, text, lang in rows:
        for w in text.split():
            counts[lang][0, w] += 1
            padded = f" {w} "
            for n in (4, 3, 2):
                for i in range(len(padded) - n + 1):
                    counts[lang][n, padded[i : i + n]] += 1
            for c in w:
                counts[lang][1, c] += 1
    known = {k for c in counts.values() for k, v in c.items() if v >= 3}
    import math

    def log(key, lang):
        own = [k for k in known if k[0] == key[0]]
        total = sum(counts[lang][k] for k in own if counts[lang][k] >= 3)
        c = counts[lang][key]
        return math.log(((c if c >= 3 else 0) + 0.5) / (total + 0.5 * len(own)))

    def score(word, lang):
        if (0, word) in known:
            return log((0, word), lang)
        padded, out = f" {word} ", []
        for i in range(len(padded) - 1):
            for n in (4, 3, 2, 1):
                g = padded[i : i + n]
                if len(g) == n and (n > 1 or g != " ") and (n, g) in known:
                    out.append(log((n, g), lang))
                    break
        return sum(out) / max(1, len(out))

    for text in ("aaa", "abb", "aaa qqq abab", "bbbb a"):
        totals = {lang: sum(score(w, lang) for w in text.split()) for lang in ("x", "y")}
        got = language.identify(spark.createDataFrame([(9, text)], "doc_id long, text string"), model).first()
        best = max(sorted(totals), key=totals.get)
        assert got.lang_pred == best
        assert got.score == pytest.approx(1 / sum(math.exp(v - totals[best]) for v in totals.values()))


# 3: n-gram Jaccard join


def shingle_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_components(rows):
    rows = [(i, shingle_set(t)) for i, t in rows]
    least = {i: i for i, _ in rows}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for k, (i, a) in enumerate(rows):
        for j, b in rows[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((root(i), root(j)))
                least[y] = x
    return {(i, len(s), root(i)) for i, s in rows}


def near_copies(n):
    """A large group of near copies, a chain, a passage that many share, and short texts."""
    own, base, out = random.Random(11), prose(60, 21).split(), []
    for i in range(n):
        words = list(base)
        for _ in range(own.randint(0, 2)):
            words[own.randrange(len(words))] = own.choice(VOCABULARY)
        out.append((i, " ".join(words)))
    chain = prose(100, 22).split()
    for i in range(12):
        out.append((n + i, " ".join(chain[3 * i : 3 * i + 60])))
    shared = prose(25, 23)
    out += [(n + 20 + i, f"{shared} {prose(15, 100 + i)}") for i in range(40)]
    out += [(n + 70, "a b"), (n + 71, "A b"), (n + 72, "b a"), (n + 73, ""), (n + 74, ""), (n + 75, None)]
    return out


@pytest.mark.parametrize("few, pivots, block", [(8, (1, 8), 2048), (1, (1, 1), 7), (1, (), 1)])
def test_jaccard_components(spark, monkeypatch, few, pivots, block):
    """Also with next to nothing listed or found by pivots, so that blocks of few nodes do the work."""
    for name, value in (("FEW", few), ("PIVOTS", pivots), ("BLOCK", block)):
        monkeypatch.setattr(ngram_join, name, value)
    rows = near_copies(90)
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {tuple(r) for r in got.collect()} == brute_components(rows)


def test_jaccard_ids_with_several_texts(spark, monkeypatch):
    """An id that stands for several texts has the links of all of them, also where blocks meet."""
    for name, value in (("FEW", 1), ("PIVOTS", (1, 1)), ("BLOCK", 5)):
        monkeypatch.setattr(ngram_join, name, value)
    texts = near_copies(60)
    rows = [(i % 41, t) for i, t in texts]
    links = {i: {j for j, _, c in brute_components(texts) if c == own} for i, _, own in brute_components(texts)}
    least = {i: i for i in range(41)}
    while True:
        new = {i: min(least[j % 41] for k in links if k % 41 == i for j in links[k]) for i in least if any(k % 41 == i for k in links)}
        if new == {i: least[i] for i in new}:
            break
        least.update(new)
    got = collections.Counter(tuple(r) for r in ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == collections.Counter((i % 41, n, least[i % 41]) for i, n, _ in brute_components(texts))


def test_blocks_find_what_pairs_find(spark):
    """Every pair that links is found once by the blocks alone, when each node is a component."""
    rows = near_copies(50)
    docs = spark.createDataFrame(rows, "doc_id long, text string").filter("length(text) > 30")
    sets, sketch = ngram_join.measured(docs)
    named = sets.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("doc_id"))
    shared = ngram_join.postings(docs, named.select("doc_id"), sketch)
    live = shared.drop("c").withColumn("label", F.col("doc")).join(named.withColumnRenamed("doc_id", "doc").select("doc"), "doc")
    found = collections.Counter(tuple(r) for r in ngram_join.block_pairs(live, sets.select("doc_id", "n", "odd")).collect())
    items = {r.doc_id: set(next(ngram_join.shingle_sets(pa.array([t]))).tolist()) for r in named.collect() for i, t in rows if i == r.doc_id}
    want = {(a, b) for a in items for b in items if a < b and 100 * len(items[a] & items[b]) >= 75 * len(items[a] | items[b])}
    assert want <= set(found) and max(found.values()) == 1 and len(want) > 100


def test_jaccard_edges(edges, empty):
    rows = collections.Counter(tuple(r) for r in ngram_join.jaccard_components(edges).collect())
    named = brute_components({i: t for i, t, *_ in EDGES if i is not None}.items())
    assert {r for r in rows if r[0] is not None} == named
    assert rows[7, 76, 7] == 2 and rows[None, 76, 6] == 1  # a repeated row; a row without an id
    assert ngram_join.jaccard_components(empty).count() == 0


# 4: line templates


def brute_templates(rows):
    """Counter of (doc_id, n_lines, n_dropped, clean_text)."""
    rows, lines = [(i, text) for i, text, *_ in rows], {}
    for i, text in rows:
        for no, line in enumerate(text.split("\n") if text is not None else []):
            tokens = ["<*>" if re.search("[0-9]", t) else t for t in WORD.findall(line)]
            if tokens:
                lines[i, text, no] = (len(tokens), tuple(tokens[: templates.LEADS]), tokens)
    held = collections.defaultdict(set)
    for (i, _, _), (n, lead, tokens) in lines.items():
        for place, token in enumerate(tokens):
            held[n, lead, place, token].add(i)
    made, by = {}, collections.defaultdict(set)
    for at, (n, lead, tokens) in lines.items():
        stay = [len(held[n, lead, p, t]) >= templates.MIN_DOCS for p, t in enumerate(tokens)]
        general = tuple(t if s else "<*>" for t, s in zip(tokens, stay, strict=True))
        enough = sum(stay) >= (n if n < templates.SHORT else n * templates.SIMILAR)
        made[at] = (n, lead, general) if enough else ("own", n, lead, tuple(tokens))
        by[made[at]].add(at[0])
    out = []
    for i, text in rows:
        own = text.split("\n") if text is not None else []
        left = [x for no, x in enumerate(own) if (i, text, no) not in made or len(by[made[i, text, no]]) < templates.MIN_DOCS]
        out.append((i, len(own), len(own) - len(left), None if text is None else "\n".join(left)))
    return collections.Counter(out)


def lines_left(df):
    return collections.Counter((r.doc_id, r.n_lines, r.n_dropped, r.clean_text) for r in templates.deduplicated(df).collect())


def test_line_templates(spark, empty):
    rows = [(i, f"{prose(12, i)}\nUser {i} logged in from host{i} today\n{prose(9, i + 50)}\nshort one\n\nAll rights are reserved by {VOCABULARY[i]}") for i in range(8)]
    rows += [(20, None), (21, ""), (22, "one line of its own only"), (23, "All rights are reserved by nobody at all"), (24, prose(5000, 9))]
    rows[3] = (3, rows[3][1].replace("\nshort one\n", "\n short\tone \r\n"))
    got = lines_left(spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_dropped", F.lit("x")))
    assert got == brute_templates(rows)
    by_id = {i: x for i, *x in got}
    assert by_id[0][1] == 3 and "short one" not in by_id[0][2] and by_id[0][2].endswith("\n")
    assert templates.deduplicated(empty).count() == 0


def test_lines_of_two_documents(spark):
    """A line, a template and a passage of exactly two documents are dropped in both, plain copies too; what one document repeats stays."""
    rows = [(None, f"the same line in two documents\n{prose(12, 61)}"), (1, f"{prose(11, 62)}\nthe same line in two documents"), (2, f"Host a17 answered after 20 ms\n{prose(60, 63)}")]
    rows += [(3, f"{prose(60, 63)}\nHost a18 answered after 31 ms"), (4, "said twice by one only\nsaid twice by one only"), (5, prose(30, 64)), (6, prose(30, 64))]
    got = lines_left(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute_templates(rows)
    assert {i: n for i, _, n, _ in got} == {None: 1, 1: 1, 2: 2, 3: 2, 4: 0, 5: 1, 6: 1}


def test_short_lines(spark):
    """Lines of one to three tokens go if two documents hold the whole line, numbers apart; lines that share a part stay."""
    rows = [(1, "Top\nAll rights reserved.\nPage 1\n7\nof the king\na b\n"), (2, " Top\r\nAll rights reserved.\nPage 22\n8\nof the sea\na c\n\n"), (3, "top\nAll rights\nPage one\nsea the of\nb a")]
    got = lines_left(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute_templates(rows)
    assert {i: (n, text) for i, _, n, text in got} == {1: (4, "of the king\na b\n"), 2: (4, "of the sea\na c\n\n"), 3: (0, rows[2][1])}


def test_repeated_rows_change_nothing(spark):
    """Rows that repeat, and ids with several texts: what goes is what would go without the repeats."""
    rows = [(1, "aa bb cc dd\nx 1"), (2, "aa bb ee ff\nx 2"), (3, f"{prose(9, 70)}\ngg hh ii jj"), (3, "gg hh ii jj\nx 3"), (None, "gg hh kk ll"), (None, f"gg hh kk ll\n{prose(9, 71)}")]
    once = lines_left(spark.createDataFrame(rows, "doc_id long, text string"))
    assert once == brute_templates(rows)
    assert {(i, n) for i, _, n, _ in once} == {(1, 1), (2, 1), (3, 0), (3, 1), (None, 0)}
    twice = lines_left(spark.createDataFrame(rows + rows + rows[:3], "doc_id long, text string"))
    assert set(twice) == set(once) and twice == brute_templates(rows + rows + rows[:3])


def test_line_templates_edges(edges, documents):
    out = templates.deduplicated(edges)
    assert lines_left(edges) == brute_templates(EDGES)
    assert sorted(map(str, out.columns)) == sorted({*edges.columns, "n_lines", "n_dropped", "clean_text"})
    assert lines_left(documents) == brute_templates([(r.doc_id, r.text) for r in documents.collect()])


# 5: URLs


def test_url_filter(spark):
    rules = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/")]
    cases = [
        (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("no scheme", "", "", None, "allow"), ("http://", "", "", None, "allow"),
        ("http://WWW.Example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"), ("http://m.example.com/en/?q", "m.example.com", "/en/", "example.com/en/", "block"),
        ("https://example.com/EN/", "example.com", "/EN/", "com/", "allow"), ("https://example.com", "example.com", "", None, "allow"), ("x://notcom/", "notcom", "/", None, "allow"),
        ("x://a.net/es/#f", "a.net", "/es/", "net/es/", "block"), ("x://a.net/fr/?utm_source=1&b=2&a=1#x", "a.net", "/fr/", None, "block"), ("x://www.a.net/fr?a=1&b=2", "www.a.net", "/fr", None, "block"),
        ("x://a.net/fr?a=1", "a.net", "/fr", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)] + [(9, cases[9][0])], "page_id long, url string").withColumn("host", F.lit(1))
    listed = spark.createDataFrame([("a.net/fr?a=1&b=2",), ("a.net/fr?a=1&b=2",), (None,), ("else.org",)], "canonical string")
    rows = urls.judged(pages, rules, listed).collect()
    assert len(rows) == len(cases) + 1
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == cases[r.page_id][1:]
    assert urls.judged(pages.filter("false"), rules, listed).count() == 0
    assert urls.judged(pages, [], listed.filter("false")).filter("verdict = 'block'").count() == 0


def test_bloom_never_misses(spark):
    listed = spark.range(3000).select(F.concat(F.lit("h/"), "id").alias("canonical"))
    bloom = urls.BlockedBloom(listed)
    import numpy as np

    def hold(df):
        h = df.select(F.xxhash64("canonical").alias("a"), F.xxhash64("canonical", F.lit(1)).alias("b")).toPandas()
        return bloom.may_hold(*(h[c].to_numpy().view(np.uint64) for c in "ab"))

    assert hold(listed).all()
    assert hold(spark.range(20_000).select(F.concat(F.lit("g/"), "id").alias("canonical"))).mean() < 0.02


# 6: decontamination


def test_contamination(spark, edges, empty):
    items = [(i, prose(n, 500 + i)) for i, n in enumerate([12, 15, 20, 33, 47, 60, 3, 1])] + [(20, None), (21, ""), (22, prose(150, 600)), (22, prose(40, 601))]
    own, docs, want = random.Random(3), [], {}
    for k in range(60):
        host = prose(own.randint(0, 300), 1000 + k).split()
        i, text = items[k % 6]
        words = text.translate(LOWER).upper().split() if k % 2 else text.split()
        if k % 3 == 2 and len(words) > 30:
            words[own.randrange(len(words))] = "zzz"
        at = own.randint(0, len(host))
        docs.append((k, " ".join(host[:at] + words + host[at:]).replace(" ", "\n" if k % 5 == 0 else " ")))
        want[k] = i
    docs += [(100 + k, prose(400, 5000 + k)) for k in range(20)] + [(130, items[6][1]), (131, prose(160, 600)), (132, prose(40, 601))]
    hits = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    long_hits = {(d, i) for d, i in hits if i < 6 or i > 7}
    assert long_hits == {*want.items(), (131, 22), (132, 22)}
    assert (130, 6) in hits and all(0.75 <= s <= 1 for s in hits.values())
    assert {(d, i) for d, i in hits if i == 7} == {(d, 7) for d, t in docs if items[7][1] in t.lower().split()}
    bench = spark.createDataFrame([(1, prose(80, 1)), (2, "one")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.contamination(edges, bench).collect()} == {(None, 1), (6, 1), (10, 1), (4, 2)}
    assert decontaminate.contamination(empty, bench).count() == 0 and decontaminate.contamination(edges, bench.filter("false")).count() == 0


def best_run(items, i, text):
    """Similarity, first word and words of the best run of any length, by comparing all of them."""
    weight, size = dict(zip(text, items.weight(text), strict=True)), items.sizes[i]
    weigh = lambda s: 1 + sum(int(weight[w]) if w in weight else int(items.weight(items.words[i][items.words[i] == w])[0]) for w in s)
    cut = lambda w: [tuple(w[k : k + size].tolist()) for k in range(len(w) - size + 1)]
    item, runs = collections.Counter(cut(items.words[i])), cut(text)
    total, best = sum(weigh(s) * n for s, n in item.items()), (0.0, 0, 0)
    weights = [weigh(s) for s in runs]
    for a in range(len(runs)):
        common, own, seen = 0, 0, collections.Counter()
        for b in range(a, len(runs)):
            seen[runs[b]] += 1
            own += weights[b]
            common += weights[b] if seen[runs[b]] <= item[runs[b]] else 0
            best = max(best, (common / (total + own - common), -a, a - b - size))
    return best[0], -best[1], -best[2]


def edited(words, kind, edits, own):
    """``words`` with some deleted, inserted or exchanged."""
    words = list(words)
    for _ in range(edits):
        k = own.randrange(len(words))
        words[k : k + 1] = {"delete": [], "insert": [words[k], own.choice(VOCABULARY)], "exchange": [own.choice(VOCABULARY)]}[kind]
    return words


def leaks(own, count):
    """Items as rows of the group, and texts that hold edited ones: (text, item)."""
    rows = [Row(item_id=i, text=prose(n, 700 + i)) for i, n in enumerate([9, 14, 22, 31, 40, 48, 57, 59, 75, 90])]
    rows.append(Row(item_id=10, text=" ".join([prose(12, 730)] * 3)))  # repeated shingles
    texts = []
    for k in range(count):
        i = own.randrange(len(rows))
        words = rows[i].text.split()
        words = edited(words, ["delete", "insert", "exchange"][k % 3], own.randint(0, len(words) // 14), own)
        host = prose(own.randint(0, 60), 9000 + k).split()
        at = own.randint(0, len(host))
        texts.append((" ".join(host[:at] + words + host[at:]), i))
    return rows, texts


def compared(rows, texts):
    """What the group finds, and what comparing each text with its item finds at 0.75 or more: {(text, item): (similarity, first word, words)}."""
    items = decontaminate.Items(rows)
    got = {(d, i): rest for d, i, *rest in items.search(pa.array([t for t, _ in texts]))}
    want = {}
    for d, (text, i) in enumerate(texts):
        data, offsets = utf8(pa.array([text]))
        starts, ends, _ = word_spans(data, offsets)
        run = best_run(items, i, SpanHash(data, LOWER_VALUES)(starts, ends))
        if run[0] >= 0.75:
            want[d, i] = list(run)
    return got, want


def test_runs_of_every_length():
    """Passages with words deleted, inserted or exchanged, those just over the threshold too, have the similarity of their best run."""
    rows, texts = leaks(random.Random(21), 240)
    got, want = compared(rows, texts)
    assert sum(s < 0.8 for s, *_ in want.values()) > 10
    assert {k: v for k, v in got.items() if k in want} == {k: v for k, v in want.items() if k in got}
    assert len(want.keys() & got.keys()) > 0.9 * len(want) and not {k for k in got if texts[k[0]][1] == k[1]} - want.keys()


def test_no_passage_is_missed():
    """Exact and edited passages at every phase of the windows, those without a window within the radius too."""
    rows, texts = leaks(random.Random(22), 300)
    rows.append(Row(item_id=11, text=prose(3, 740)))
    for i, row in enumerate(rows):
        texts += [(f"{prose(k, 9500 + k)} {row.text} {prose(40 - k, 9600 + k)}", i) for k in range(12)]
    got, want = compared(rows, texts)
    assert got == want | {k: v for k, v in got.items() if texts[k[0]][1] != k[1]} and len(want) > 300
    radius, decontaminate.RADIUS = decontaminate.RADIUS, -1  # no window is within it
    try:
        assert compared(rows, texts)[0] == got
    finally:
        decontaminate.RADIUS = radius


def test_groups_of_items_change_nothing(spark, monkeypatch):
    """Weights of words are those over all items, however many groups these are dealt into."""
    own = random.Random(31)
    items = [(i, f"which of the following {VOCABULARY[i % 7]} {VOCABULARY[i % 3]} {prose(12, 800 + i)}") for i in range(60)] + [(60, ""), (61, None)]
    docs = [(k, " ".join([prose(20, 9700 + k), *edited(items[k % 60][1].split(), "exchange", 1, own), prose(20, 9800 + k)])) for k in range(120)]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one = sorted(decontaminate.contamination(*frames).collect())
    monkeypatch.setattr(decontaminate, "GROUP_BYTES", 1500)
    assert sorted(decontaminate.contamination(*frames).collect()) == one and len(one) > 20


def test_multi_index_is_complete():
    """Every fingerprint within the radius shares a listed key with the item."""
    import numpy as np

    own = np.random.default_rng(1)
    prints = own.integers(0, 2**63, 50, dtype=np.uint64)
    _, _, blocks = decontaminate.Items.indexed(np.arange(50), prints)
    for _ in range(3000):
        i = own.integers(50)
        near = int(prints[i])
        for bit in own.choice(64, own.integers(0, decontaminate.RADIUS + 1), replace=False):
            near ^= 1 << int(bit)
        assert any(i in listed[where[near >> s & 0xFFFF] : where[(near >> s & 0xFFFF) + 1]] for s, where, listed in blocks)


# 7: suffix arrays


def brute_repeats(rows):
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (text or "").encode()
        cover = bytearray(len(b))
        for p in range(len(b) - 99):
            if b[p : p + 100] in seen:
                cover[p : p + 100] = b"\x01" * 100
            seen.add(b[p : p + 100])
        kept = bytes(x for x, c in zip(b, cover, strict=True) if not c)
        out[i] = (len(b), sum(cover), len(re.findall(b"\x01+", bytes(cover))), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("shard_runs", [20_000, 3])
def test_suffix_dedup(spark, documents, shard_runs):
    rows = [(r.doc_id, r.text) for r in documents.filter("doc_id < 80").select("doc_id", "text").collect()]
    rows += [(1000, "ab" * 300), (1001, "x" * 99), (1002, None), (1003, ""), (1004, "x" * 350), (1005, "é" * 120), (1006, "ab" * 200 + "end"), (None, rows[3][1])]
    got = suffix.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), shard_runs)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()} == brute_repeats(rows)


def test_suffix_edges(edges, empty):
    got = collections.Counter((r.doc_id, r.n_removed) for r in suffix.without_repeats(edges).collect())
    want = brute_repeats({i: t for i, t, *_ in EDGES}.items())
    assert got[7, want[7][1]] == 2 and set(got) == {(i, v[1]) for i, v in want.items()}
    assert suffix.without_repeats(empty).count() == 0


def test_suffix_array_and_prefixes():
    import numpy as np

    for text in (b"banana", b"aaaaaaaaaaaaaaaaaaaaaaaaaaa", b"mississippi" * 9, random.Random(2).randbytes(300)):
        data = np.frombuffer(text, np.uint8)
        order, place = suffix.suffix_array(data)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        got = suffix.common_prefixes(data, order, place, np.array([0, len(text) // 2]), cap=50)
        for k in range(1, len(text)):
            a, b = text[order[k] :], text[order[k - 1] :]
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert got[order[k]] == min(same, 50)


# 8: ring


def test_ring(spark, edges, empty):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    one = {r.doc_id: r for r in sharding.assign(docs, 16).collect()}
    by = collections.defaultdict(list)
    for r in one.values():
        by[r.shard].append(r.slot)
    assert len(by) == 16 and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    two = {r.doc_id: r.shard for r in sharding.assign(docs, 17).collect()}
    assert sum(one[i].shard != two[i] for i in two) < 0.4 * len(two)  # hashing modulo 17 would move 94 %
    rows = sharding.assign(edges).collect()
    counts = collections.Counter(r.shard for r in rows)
    assert len(rows) == len(EDGES) and max(counts.values()) == 1 and all(r.slot == 0 for r in rows)
    assert sharding.assign(empty).count() == 0


def test_ring_document_by_document(spark):
    """Shards and slots as a walk over single documents gives them."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    own = sharding.owners(spark, 5)
    rows = docs.select("doc_id", sharding.ring_hash().alias("h"), F.pmod(sharding.ring_hash(), F.lit(sharding.PLACES)).alias("place")).collect()
    at = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: r.h):
        at[r.place].append(r.doc_id)
    room, shards, over = sharding.quotas(len(rows), 5), [[] for _ in range(5)], collections.defaultdict(list)
    for place, shard in enumerate(own):
        for i in at[place]:
            (shards[shard] if len(shards[shard]) < room[shard] else over[place]).append(i)
    waiting = collections.deque()
    for turn in range(2):
        for place, shard in enumerate(own):
            waiting.extend(over[place] if turn == 0 else [])
            while waiting and len(shards[shard]) < room[shard]:
                shards[shard].append(waiting.popleft())
    assert over and not waiting
    want = {i: (s, slot) for s, ids in enumerate(shards) for slot, i in enumerate(ids)}
    assert {r.doc_id: (r.shard, r.slot) for r in sharding.assign(docs, 5).collect()} == want


def test_dealing_by_hand():
    owner, counts = [0, 1, 0, 2], {0: 5, 1: 1, 2: 3, 3: 0}
    pieces = sharding.dealt(counts, owner, 3)
    assert sorted(pieces) == [(0, 0, 3, 0, 0), (0, 3, 5, 1, 1), (1, 0, 1, 1, 0), (2, 0, 3, 2, 0)]


# 9: HTML


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("<p>", ""), ("<!-- <p>no</p> -->", ""),
        ("<html><body><nav><a href=x>Home</a></nav><article><h1>Title &amp; more</h1><p>One  two\n three<p>Four &lt;b&gt;</article><footer>&copy; me</footer>", "Title & more\nOne two three\nFour <b>"),
        ("<article><header><h1>T</h1></header><p>a<b>b</b>c<br>d<script>x('</p>')</script>e</p><div class='comments'><p>I like it</p></div><form><p>f</p></form></article>", "T\nabc\nd\ne"),
        ("<div class=sidebar><p>This is the part of the page that has all of the links to the rest of it, as it was.</p></div><div><p>This is the part of the page that has all of the text for us and for you, as it was.</p><p>Short.</p></div>", "This is the part of the page that has all of the text for us and for you, as it was.\nShort."),
        ("<main><p>a</p><div hidden>b</div><p><a href=x>only a link</a></p><p>c &#233;&eacute;</p></main>", "a\nc éé"),
    ],
)
def test_html(page, text):
    assert html.main_text(page) == text


def test_html_table(spark):
    pages = spark.createDataFrame([(1, None, None), (None, "u", "<article><p>x"), (2, "u", "<article>" + "<p>ab cd " * 50_000)], "page_id long, url string, html string").withColumn("text", F.lit(0))
    got = {r.page_id: (r.text, r.n_chars) for r in html.extracted(pages).collect()}
    assert got[1] == ("", 0) and got[None] == ("x", 1) and got[2][1] == 50_000 * 6 - 1
    assert html.extracted(pages.filter("false")).count() == 0


# 10: mixing


def test_mixing(spark):
    sizes = {"a": 400, "b": 60, "c": 25, None: 10}
    docs = spark.createDataFrame([(f"{s}{i}", s, prose(9 + i % 5, i)) for s, n in sizes.items() for i in range(n)], "doc_id string, source string, text string")
    rows = mixing.mix(docs, max_repeats=3.0).collect()
    tokens = collections.Counter()
    for r in docs.collect():
        tokens[r.source] += len(r.text.split()) + 1
    drawn, seen = collections.Counter(), collections.Counter(r.doc_id for r in rows)
    for r in rows:
        drawn[r.source] += r.tokens
        assert r.tokens == len(r.text.split()) + 1
    assert set(seen) == {r.doc_id for r in docs.collect()} and max(seen.values()) == 3
    # weights: shares to the power alpha, where the smallest source is repeated three times and the largest once
    import math

    alpha = 1 - math.log(3) / math.log(tokens["a"] / tokens[None])
    for s in sizes:
        assert drawn[s] / tokens["a"] == pytest.approx((tokens[s] / tokens["a"]) ** alpha, rel=0.15)
    places = collections.defaultdict(list)
    for r in rows:
        places[r.block].append(r.place)
    assert all(sorted(v) == list(range(len(v))) for v in places.values())


def test_mixing_entropy_and_budget(spark, edges, empty):
    import math

    docs = spark.createDataFrame([(f"{s}{i}", s, prose(10, i)) for s, n in (("a", 300), ("b", 30), ("c", 3)) for i in range(n)], "doc_id string, source string, text string")
    totals = spark.createDataFrame([("a", 3300), ("b", 330), ("c", 33)], "_key string, n long")
    alpha = mixing.exponent(totals, target_entropy=1.0)
    w = [n**alpha for n in (3300, 330, 33)]
    assert -sum(x / sum(w) * math.log(x / sum(w)) for x in w) == pytest.approx(1.0, abs=1e-4)
    assert mixing.exponent(totals, target_entropy=0.0) == 1 and mixing.exponent(totals, target_entropy=5.0) == 0 and mixing.exponent(totals, max_repeats=1e9) == 0
    drawn = mixing.mix(docs, max_repeats=None, budget=1000).groupBy().agg(F.sum("tokens")).first()[0]
    assert 1000 <= drawn < 1000 + 3 * 11  # a document that begins within its source's budget is whole
    rows = mixing.mix(edges)
    assert {r.doc_id for r in rows.collect()} == {e[0] for e in EDGES} and mixing.mix(empty).count() == 0
