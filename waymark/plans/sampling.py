"""Sampling of routes and evaluation sets, region tiles, deletion of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from waymark.functions import tiles
from waymark.operators.order import exact_sample, hash_chunk, hash_key, hash_unit, running_totals, split_by_weights


def tile_sample(
    candidates: DataFrame, targets: dict[str, int], id_cols: list[str], tile: str = "tile_id", quality: str = "quality",
    banned_classes: list[str] | None = None, seed: int = 0,
) -> DataFrame:
    """Up to the target number of routes per tile and quality, in hash order.

    Candidates are 100 to 2000 m long, take over 30 s, have over 10 points and no banned road class.
    The hash order is cut into chunks, so a tile with very many candidates is ranked by several tasks.
    """
    ok = (F.col("length").between(100, 2000)) & (F.col("seconds") > 30) & (F.col("points") > 10)
    if banned_classes:
        ok = ok & ~F.coalesce(F.col("road_class").isin(*banned_classes), F.lit(False))
    want = F.create_map(*[F.lit(x) for pair in targets.items() for x in pair])
    rows = candidates.filter(ok).withColumn("_h", hash_key(*id_cols, seed=seed))
    ranked = running_totals(
        rows, ["_h", *id_cols], {"_rank": F.lit(1).cast("bigint")}, hash_chunk(F.col("_h")), [tile, quality]
    )
    return ranked.filter(F.col("_rank") <= F.try_element_at(want, F.col(quality))).drop("_h", "_rank")


def weighted_sample(df: DataFrame, weight: str, n: int, id_cols: list[str], seed: int = 0) -> DataFrame:
    """``n`` rows without replacement with probability by weight: the n smallest -ln(u) / weight."""
    key = -F.ln(F.greatest(hash_unit(*id_cols, seed=seed), F.lit(1e-18))) / F.col(weight)
    return df.filter(F.col(weight) > 0).withColumn("_k", key).orderBy("_k", *id_cols).limit(n).drop("_k")


def driven_roads_sample(
    df: DataFrame, driven_km: str, total_km: str, min_share: float, weight: str, n: int, id_cols: list[str], seed: int = 0
) -> DataFrame:
    """Routes with enough kilometres on the most driven roads, drawn by use."""
    share = F.try_divide(F.col(driven_km), F.col(total_km))
    return weighted_sample(df.filter(share >= min_share), weight, n, id_cols, seed)


def point_in_ring(x: Column, y: Column, ring: list[tuple[float, float]]) -> Column:
    """Ray casting against one closed ring, given as literals."""
    edges = F.array(
        *[
            F.struct(F.lit(float(a[0])).alias("ax"), F.lit(float(a[1])).alias("ay"), F.lit(float(b[0])).alias("bx"), F.lit(float(b[1])).alias("by"))
            for a, b in zip(ring, ring[1:] + ring[:1]) if a != b
        ]
    )
    crossing = F.filter(
        edges,
        lambda e: ((e["ay"] > y) != (e["by"] > y))
        & (x < (e["bx"] - e["ax"]) * (y - e["ay"]) / F.nullif(e["by"] - e["ay"], F.lit(0.0)) + e["ax"]),
    )
    return F.size(crossing) % 2 == 1


def tiles_of_region(spark, ring: list[tuple[float, float]], level: int) -> DataFrame:
    """Tiles whose centre lies in the region: new region rows."""
    xs, ys = [p[0] for p in ring], [p[1] for p in ring]
    box = spark.range(1).select(
        tiles.tile_of_point(F.lit(min(xs)), F.lit(min(ys)), level).alias("lo"), tiles.tile_of_point(F.lit(max(xs)), F.lit(max(ys)), level).alias("hi")
    )
    # Columns first, then rows in parallel: the covering is never one array.
    cells = (
        box.select(F.explode(F.sequence("lo.x", "hi.x")).alias("x"), F.col("lo.y").alias("y0"), F.col("hi.y").alias("y1"))
        .repartition("x").select("x", F.explode(F.sequence("y0", "y1")).alias("y"))
    )
    cells = cells.select(tiles.tile(level, F.col("x"), F.col("y")).alias("t")).select("t", tiles.tile_bounds(F.col("t"), level).alias("b"))
    cx, cy = (F.col("b.min_x") + F.col("b.max_x")) / 2, (F.col("b.min_y") + F.col("b.max_y")) / 2
    return cells.filter(point_in_ring(cx, cy, ring)).select("t.level", "t.code", "t.x", "t.y", cx.alias("lon"), cy.alias("lat"))


def rows_in_region(df: DataFrame, x: str, y: str, ring: list[tuple[float, float]]) -> DataFrame:
    return df.filter(point_in_ring(F.col(x), F.col(y), ring))


def delete_run(tables: dict[str, DataFrame], run_id: str) -> dict[str, DataFrame]:
    """Every table without the rows of a run; written back, this rewrites (or drops) one partition."""
    return {name: df.filter(~F.col("run_id").eqNullSafe(F.lit(run_id))) if "run_id" in df.columns else df for name, df in tables.items()}


def km_cap(df: DataFrame, km: str, limit: float, id_cols: list[str], seed: int = 0) -> DataFrame:
    """Rows in random order while the running kilometres stay below the limit: two-level running sum."""
    rows = df.withColumn("_h", hash_key(*id_cols, seed=seed))
    summed = running_totals(rows, ["_h", *id_cols], {"_km": F.col(km)}, hash_chunk(F.col("_h")))
    return summed.filter(F.col("_km") < limit).drop("_h", "_km")


def time_split(df: DataFrame, date_col: str, id_cols: list[str], months: int = 3, test_rows: int = 5000, seed: int = 0):
    """(train, test): test is drawn from the last months; train is everything else, each row once."""
    newest = df.agg(F.max(date_col).alias("_max"))
    dated = df.crossJoin(F.broadcast(newest))  # one row
    recent = dated.filter(F.col(date_col) >= F.add_months("_max", -months)).drop("_max")
    test = exact_sample(recent, test_rows, id_cols, seed)
    return df.subtract(test), test


def random_split(df: DataFrame, id_cols: list[str], weights=(0.7, 0.2, 0.1), subsample: float | None = None, seed: int = 0) -> DataFrame:
    """Label rows train / validation / test by hash; optionally keep a share of the training rows."""
    labelled = split_by_weights(df, dict(zip(("train", "validation", "test"), weights)), id_cols, seed)
    if subsample is not None:
        labelled = labelled.filter((F.col("split") != "train") | (hash_unit(*id_cols, seed=seed + 1) < subsample))
    return labelled


def balanced_set(discards: DataFrame, errors: DataFrame, discard_rate: float, errors_n: int, id_cols: list[str], seed: int = 0) -> DataFrame:
    """Errors and discards in the share seen in production, on the columns both tables have."""
    from waymark.schemas import common_union

    total = round(errors_n / (1 - discard_rate))
    return common_union(exact_sample(discards, total - errors_n, id_cols, seed), exact_sample(errors, errors_n, id_cols, seed))
