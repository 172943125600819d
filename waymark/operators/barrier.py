"""Compute costly columns once when a filter or an explode follows.

Catalyst pushes a filter below the projection that makes its column, which copies the expression: a
Python kernel or a parsed line would then be computed twice. A projection that holds a
non-deterministic column is not crossed, and an outer explode gets no inferred filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def keep_where(df: DataFrame, condition: Column, columns: dict[str, Column] | None = None) -> DataFrame:
    """Add the columns, then filter; neither the new columns nor those below are computed twice."""
    marked = df.withColumns({**(columns or {}), "_barrier": F.monotonically_increasing_id()})
    return marked.filter(condition & (F.col("_barrier") >= 0)).drop("_barrier")


def explode_once(df: DataFrame, array: Column | str, out: str) -> DataFrame:
    """Inner explode of non-null elements without a filter on the array being pushed down."""
    return df.withColumn(out, F.explode_outer(array)).filter(F.col(out).isNotNull())
