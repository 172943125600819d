"""Registered queries: each runs a library operator over whole tables and names its check SQL, if any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from waymark.fixtures import load, oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
MODULES: dict[str, str] = {}


class Tables:
    """Tables of one scale-factor folder by name: ``t.fx_routes``, ``t.lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return load(self.spark, self.sf_dir, name)


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with its check SQL."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        MODULES[name] = fn.__module__
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn

    return register


def load_all() -> None:
    from waymark.queries import geometry, inspection, mapfeatures, relational, sinks  # noqa: F401
