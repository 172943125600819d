"""Collocations against plain counting with Python integers."""

import collections
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymark.llm import collocations

DATA = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, longest=3, least=10, top=2000):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for n in range(1, longest + 1):
                counts[lang or "und"].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        found = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            holds = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            if any(len(q) > len(p) and b >= least and 100 * b >= 50 * a and holds(q) for q, b in f.items()):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def held(df):
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


@pytest.fixture(scope="module")
def edges(spark):
    rows = [
        (1, None, "en"), (2, "", "en"), (3, " \n\t. ", None), (None, "New York city New\tYork  City, new york. " * 6, "en"), (4, "new york city " * 5 + "\x0b york", "en"), (4, "new york city " * 5 + "\x0b york", "en"),
        (5, "a b! a b? a b; a b: a b\na b\ra b\x0ca b " * 3, None), (6, "a b " * 12, "und"), (7, "é ü x é ü x " * 9, "fr"), (8, ("x y z. " * 9 + "p q. ") * 3000, "big"),
        (-9, "y z w. " * 15, "big"), (10, "one", "en"), (11, "tie tie " * 11 + "| top top " * 11, "fr"),
    ]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"phrase": F.lit(1), "n": F.lit("n"), "words": F.lit("w")})


@pytest.mark.parametrize("how", [{}, {"limit": 64}, {"bits": 2}])
def test_collocations_edges(edges, how):
    """Also in slices of few bytes, which end where a piece ends, and with fingerprints that nearly all collide."""
    rows, df = edges
    assert held(collocations.collocations(df, **how)) == brute(rows)


def test_collocations_other_lengths(edges):
    rows, df = edges
    assert held(collocations.collocations(df, longest=4, least=6, top=3)) == brute(rows, 4, 6, 3)


def test_collocations_given(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    assert held(collocations.collocations(docs)) == brute(rows)
    assert collocations.collocations(docs.filter("false")).count() == 0


def test_first_occurrence(edges):
    rows, df = edges
    found = {(r.lang, r.phrase): (r.first_doc_id, r.first_byte) for r in collocations.collocations(df).collect()}
    assert found["en", "new york city"] == (4, 0) and found["big", "y z w"] == (-9, 0) and found["big", "p q"] == (8, 7 * 9)
    for (lang, phrase), (doc, byte) in found.items():
        if doc is None:  # in the row without an id only
            continue
        text = next(t for i, t, x in rows if i == doc and (x or "und") == lang).encode()
        assert " ".join(text[byte:].decode().translate(LOWER).split()).startswith(phrase.replace(" ", " "))


def test_equal_word_hashes_fall_apart():
    data = np.frombuffer(b"ab cd ab ee", np.uint8)
    starts, lengths = np.array([0, 3, 6, 9]), np.array([2, 2, 2, 2])
    for hashes in (np.array([5, 6, 5, 7], np.uint64), np.zeros(4, np.uint64)):
        number, first = collocations.numbered(hashes, data, starts, lengths)
        assert number[0] == number[2] and len(set(number.tolist())) == 3
        assert [number[i] for i in first] == list(range(3))


def test_exact_beyond_64_bits(spark, monkeypatch):
    rows = [("en", 2, "a b", 3_000_000_000_019, None), ("en", 1, "a", 3_000_000_000_023, None), ("en", 1, "b", 3_000_000_000_020, None), ("en", 0, "", 10**13, None)]
    known = spark.createDataFrame(rows, "lang string, words int, phrase string, n long, pointer decimal(38,0)")
    monkeypatch.setattr(collocations, "phrases", lambda *_, **__: known)
    (row,) = collocations.collocations(known).collect()
    assert row.score == 1_000_000 * 3_000_000_000_019**2 // (3_000_000_000_023 * 3_000_000_000_020) and row.first_doc_id is None
