"""The stages of the corpus pipeline against plain versions, the registered queries and their check SQL."""

import pytest
from check import compare, connect

import corpus_pipeline
from test_operators import brute_components
from waymark.llm.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_check_sql(spark, name):
    message, _ = compare(QUERIES[name](spark, DATA), connect(DATA), ORACLES[name])
    assert message == ""


def test_registry():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    extra = spark.createDataFrame([(9001, "12 34", "en", "s", 5), (9002, None, "en", "s", 0), (None, "the house of the king and the sea", "en", None, 33)], docs.schema)
    first = stages["language"](spark, docs.union(extra), DATA)
    ids = {r.doc_id for r in first.collect()}
    assert {r.doc_id for r in docs.collect()} - ids == set() and not ids & {9001, 9002}
    again = docs.union(docs.limit(5))
    second = stages["ngram_join"](spark, again, DATA).collect()
    want = {c for _, _, c in brute_components([(r.doc_id, r.text) for r in docs.collect()])}
    assert sorted(r.doc_id for r in second) == sorted(want)
    third = stages["decontaminate"](spark, docs, DATA)
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    whole = {r.doc_id for r in docs.collect() if any(f" {i} " in f" {' '.join(r.text.lower().split())} " for i in items)}
    left = {r.doc_id for r in third.collect()}
    assert whole and not whole & left and len(left) >= docs.count() - 2 * len(whole)
    fourth = stages["mixing"](spark, docs, DATA)
    assert fourth.columns == docs.columns and {r.doc_id for r in fourth.collect()} == {r.doc_id for r in docs.collect()}
    last = stages["sharding"](spark, docs, DATA)
    assert last.columns == [*docs.columns, "shard", "slot"] and last.count() == docs.count()


def test_rows_that_share_an_id(spark):
    """Of different texts under one id the same one stays, however the table is dealt out."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    more = docs.filter("doc_id < 40").withColumn("text", docs.text.substr(1, 900))
    both = docs.union(more).union(more)
    stage = dict(corpus_pipeline.STAGES)["ngram_join"]
    one, other = ({(r.doc_id, r.text) for r in stage(spark, df, DATA).collect()} for df in (both, both.repartition(9, "text")))
    assert one == other and len({i for i, _ in one}) == len(one)


def test_empty_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
    assert docs.count() == 0


def test_run(spark):
    rows = corpus_pipeline.run(spark, DATA)
    assert rows.columns[-2:] == ["shard", "slot"] and rows.count() > 100
