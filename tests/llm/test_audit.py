"""The filter audit against a walk through every order, row by row."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from waymark.llm import audit

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fails(rows):
    """The letters that each row (doc_id, text, ...) fails by."""
    out = []
    for doc_id, text, *_ in rows:
        t = text or ""
        words = WORD.findall(t)
        letters = "A" if len(words) < 50 else ""
        letters += "B" if 100 * len(set(words)) < 65 * len(words) else ""
        letters += "C" if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t) else ""
        letters += "D" if re.search("[#$%&*|]", t) else ""
        letters += "E" if any(i is not None and doc_id is not None and i < doc_id and (x or "") == t for i, x, *_ in rows) else ""
        out.append(letters)
    return out


def brute(rows, marks):
    """Rows (part, letters, doc_id): one walk for each order and row."""
    found = {}
    for part, letters, doc_id in rows:
        good, toxic = marks.get(doc_id, (False, False))
        for order in itertools.permutations("ABCDE"):
            gone = False
            for step, x in enumerate(order, 1):
                cell = found.setdefault((part, "".join(order), step), dict.fromkeys(("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"), 0))
                hit = x in letters
                removed = hit and not gone
                gone = gone or hit
                cell["kept"] += not gone
                cell["removed"] += removed
                cell["redundant"] += hit and not removed
                cell["unique_fails"] += letters == x
                cell["good_lost"] += removed and good
                cell["toxic_lost"] += removed and toxic
    for (part, order, step), cell in found.items():
        cell["shapley"] = sum(c["removed"] for (p, o, s), c in found.items() if p == part and o[s - 1] == order[step - 1])
    return found


def held(df):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): {n: r[n] for n in names} for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.fixture(scope="module")
def edges(spark):
    """Nulls in every column, empty, blank and long texts, copies, repeated rows, and columns named like results."""
    own = random.Random(3)
    prose = " ".join("".join(own.choice("abcdef") for _ in range(own.randint(2, 6))) for _ in range(70))
    rows = [
        (None, prose, "s"), (1, None, "s"), (2, "", None), (3, "  \n\t ", ""), (4, prose, "s"), (4, prose, "s"), (5, prose, "t"), (5, "other", "t"), (6, "other", "t"), (7, "AB # é", "t"),
        (8, "x y " * 60, "s"), (9, "Y" + prose * 40_000, "big"), (10, prose.upper(), None), (None, "other", "t"), (11, "é" * 80, "s"), (-3, "other", "neg"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return rows, df.withColumns({"part": F.lit(1), "A": F.lit("b"), "mask": F.lit(0), "good": F.lit("g")})


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (4, 0, 1), (5, 1, 1), (6, None, 1), (None, 1, 1), (99, 1, 1), (7, 0, 0)], "doc_id long, quality int, toxic int")


MARKS = {4: (True, True), 5: (True, True), 6: (False, True)}


def test_audit_edges(edges, labels):
    rows, df = edges
    want = brute([(s or "", f, i) for (i, _, s), f in zip(rows, fails(rows))], MARKS)
    assert held(audit.audited(df, labels)) == want
    assert len(want) == 600 * len({s or "" for _, _, s in rows})


def test_audit_given(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    marks = {r.doc_id: (r.quality == 1, r.toxic == 1) for r in labels.collect()}
    assert held(audit.audited(docs, labels)) == brute([(s or "", f, i) for (i, _, s), f in zip(rows, fails(rows))], marks)


def test_audit_empty(edges, labels):
    _, df = edges
    assert audit.audited(df.filter("false"), labels).count() == 0
    assert held(audit.audited(df, labels.filter("false"))) == held(audit.audited(df, labels.filter("doc_id = 99")))


def test_long_texts_count_like_short_ones(monkeypatch):
    text = "aa  b\tb aa   c\n".encode()
    whole = audit.word_counts(text)
    monkeypatch.setattr(audit, "LONG", 3)
    assert audit.word_counts(text) == whole == (6, 4)


def test_other_filters_and_many_parts(spark, monkeypatch):
    """Any filters and marks; more parts than a task holds at once; fields far from overflow stay apart."""
    monkeypatch.setattr(audit, "HELD", 5)
    df = spark.range(3000).selectExpr("id % 40 as p", "id % 2 = 0 as x", "id % 3 = 0 as yy", "if(id % 5 = 0, null, id % 7 = 0) as z", "id % 11 = 0 as odd")
    got = {(r.part, r.filter_order, r.step): r for r in audit.interactions(df, ["x", "yy", "z"], ["odd"], part="p").collect()}
    assert len(got) == 40 * 6 * 3
    rows = [(str(r.p), r.x, r.yy, bool(r.z), r.odd) for r in df.collect()]
    for (part, order, step), r in got.items():
        names = {"xyyz": (1, 2, 3), "xzyy": (1, 3, 2), "yyxz": (2, 1, 3), "yyzx": (2, 3, 1), "zxyy": (3, 1, 2), "zyyx": (3, 2, 1)}[order]
        own = [x for x in rows if x[0] == part]
        before = [x for x in own if not any(x[i] for i in names[: step - 1])]
        gone = [x for x in before if x[names[step - 1]]]
        assert (r.kept, r.removed, r.odd_lost) == (len(before) - len(gone), len(gone), sum(x[4] for x in gone))
        assert r.redundant == sum(x[names[step - 1]] for x in own) - len(gone)
    with pytest.raises(ValueError):
        audit.Outcomes(list("abcdefg"))


def test_fields_hold_large_counts():
    made = audit.Outcomes(["a", "b"], ["m"])
    total = (1 << 62) * made.words[5] + 3 * made.words[0]
    rows = {(r["filter_order"], r["step"]): r for r in made.table("p", total).to_pylist()}
    assert rows["ab", 1]["removed"] == rows["ab", 1]["m_lost"] == rows["ab", 1]["unique_fails"] == 1 << 62
    assert rows["ab", 1]["kept"] == rows["ba", 2]["kept"] == 3 and rows["ba", 1]["kept"] == (1 << 62) + 3
