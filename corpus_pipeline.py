"""The documents table through five stages: language, near copies, leaks, mixture, shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm import decontaminate, language, mixing, ngram_join, sharding
from waymark.llm.common import materialise, table

# A language with less than half of the probability is no decision.
LEAST_SCORE = 0.5


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: not ``und``, and a score of ``LEAST_SCORE`` at least."""
    judged = language.identify(docs, language.fit(language.training_rows(docs)))
    return judged.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(docs.columns)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id, once. Rows without an id can't be named and stay.

    Of rows that share an id, which are one document, the one with the least hash stays: a repeated run keeps the same one.
    """
    groups = ngram_join.jaccard_components(docs)
    first = groups.filter("doc_id = component_id").select("doc_id").distinct()
    marked = docs.withColumn("_row", F.xxhash64(*docs.columns))
    least = marked.groupBy("doc_id").agg(F.min("_row").alias("_row")).join(first, "doc_id", "left_semi")
    named = marked.filter("doc_id is not null").join(least, ["doc_id", "_row"], "left_semi").dropDuplicates(["doc_id", "_row"])
    return named.select(docs.columns).union(docs.filter("doc_id is null"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Rows without an id can't be named and stay."""
    hits = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return docs.join(hits.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of small sources up to ``mixing.MAX_REPEATS`` times."""
    return mixing.drawn(docs).select(docs.columns)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With shard and slot."""
    return sharding.assign(docs)


STAGES = [("language", identified), ("ngram_join", distinct_texts), ("decontaminate", decontaminated), ("mixing", mixed), ("sharding", sharded)]

# The first stage is a fitted model, which SQL can't express: the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage is written and read again by the next; the last one's rows are the result."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
