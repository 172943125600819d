"""Pairs of lines that are close: spatial joins, near duplicates, contained lines, clusters.

Candidates come from an equi-join on grid cells. A cell that holds many rows is split by AQE's skew join,
or salted on request: one side is spread over several tasks and the other side is repeated there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from waymark.functions import geo, kernels as k, tiles
from waymark.operators import grid
from waymark.operators.barrier import explode_once, keep_where
from waymark.session import cut_lineage


def line_cells(points: Column | str, size: float, pad: float = 0.0) -> Column:
    """Cells met by the boxes of the line's segments: a long line takes cells along it, not its whole box."""
    boxes = F.transform(
        geo.segments(points),
        lambda s: tiles.grid_cells(
            F.struct(
                (F.least(s["a"]["x"], s["b"]["x"]) - pad).alias("min_x"), (F.least(s["a"]["y"], s["b"]["y"]) - pad).alias("min_y"),
                (F.greatest(s["a"]["x"], s["b"]["x"]) + pad).alias("max_x"), (F.greatest(s["a"]["y"], s["b"]["y"]) + pad).alias("max_y"),
            ),
            size,
        ),
    )
    return F.array_distinct(F.flatten(boxes))


def cell_join(
    left: DataFrame, right: DataFrame, left_id: str, left_line: str, right_line: str, size: float, pad: float,
    on: list[str] | None = None, salt_above: int | None = None, extra: Column | None = None,
) -> DataFrame:
    """Candidate pairs of lines that share a cell (right side padded), each pair once.

    A pair that shares several cells is kept in the smallest of them: no distinct, no second shuffle.
    A hot cell is left to AQE, which splits the skewed side of the join; ``salt_above`` cuts cells with
    more left rows than that beforehand, at the price of counting the cells first.
    """
    on = on or []
    a_long = explode_once(left.withColumn("_cells_a", line_cells(left_line, size)), "_cells_a", "_cell")
    b_long = explode_once(right.withColumn("_cells_b", line_cells(right_line, size, pad)), "_cells_b", "_cell")
    keys = [*on, "_cell"]
    if salt_above:
        # Only cells above the limit, so at most cell rows / limit of them.
        hot = (
            a_long.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > salt_above)
            .select(*keys, F.ceil(F.col("_n") / salt_above).cast("int").alias("_salts"))
        )
        salts = F.coalesce(F.col("_salts"), F.lit(1))
        a_long = a_long.join(hot, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(left_id), salts.cast("bigint")).cast("int"))
        b_long = b_long.join(hot, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        a_long, b_long, keys = a_long.drop("_salts"), b_long.drop("_salts"), [*keys, "_salt"]
    pairs = a_long.join(b_long, keys)
    if extra is not None:
        pairs = pairs.filter(extra)
    smaller_shared = F.exists("_cells_a", lambda c: (c < F.col("_cell")) & F.array_contains("_cells_b", c))
    return pairs.filter(~smaller_shared).drop("_cell", "_salt", "_cells_a", "_cells_b")


def _boxes_meet(a: str, b: str, pad: float) -> Column:
    p, q = geo.bbox(a, pad), geo.bbox(b)
    return (
        (p["min_x"] <= q["max_x"]) & (q["min_x"] <= p["max_x"]) & (p["min_y"] <= q["max_y"]) & (q["min_y"] <= p["max_y"])
    )


def intersecting_lines(
    left: DataFrame, right: DataFrame, left_id: str, right_id: str, left_line: str, right_line: str, radius: float,
    on: list[str] | None = None, limit: int = grid.LIMIT,
) -> DataFrame:
    """Left lines that meet the flat-ended buffer of right lines, with the spans of the left line inside it."""
    on = on or []
    near = grid.near_pairs(
        grid.line_segments(left, left_id, left_line, on, "_a", 0.0), grid.line_segments(right, right_id, right_line, on, "_b", radius), radius, on, limit
    )
    pairs = left.join(near.withColumnRenamed("_a", left_id), [*on, left_id]).withColumnRenamed("_b", right_id).join(right, [*on, right_id])
    pairs = pairs.filter(_boxes_meet(left_line, right_line, radius))
    return keep_where(pairs, F.size("spans") > 0, {"spans": k.spans_near_flat(left_line, right_line, F.lit(radius))})


def _box_inside(inner: str, outer: str, radius: float) -> Column:
    p, q = geo.bbox(inner), geo.bbox(outer, radius)
    return (
        (p["min_x"] >= q["min_x"]) & (p["max_x"] <= q["max_x"]) & (p["min_y"] >= q["min_y"]) & (p["max_y"] <= q["max_y"])
    )


def contained_lines(
    lines: DataFrame, id_col: str, line: str, radius: float, on: list[str] | None = None, limit: int = grid.LIMIT
) -> DataFrame:
    """Unordered pairs (a < b) of rows where one lies in the buffer of the other: flags ``a_in_b``, ``b_in_a``.

    A line can only lie in the buffer of one that its first point is near to, so first points meet segments.
    """
    on = on or []
    near = grid.near_pairs(
        grid.first_points(lines, id_col, line, on, "_a"), grid.line_segments(lines, id_col, line, on, "_b", radius), radius, on, limit
    ).filter("_a <> _b")
    inner = lines.select(*on, F.col(id_col).alias("_a"), F.col(line).alias("_p"))
    outer = lines.select(*on, F.col(id_col).alias("_b"), F.col(line).alias("_q"))
    pairs = near.join(inner, [*on, "_a"]).join(outer, [*on, "_b"]).filter(_box_inside("_p", "_q", radius))
    inside = keep_where(pairs, F.col("_in"), {"_in": k.inside_buffer("_p", "_q", F.lit(radius))})
    ordered = inside.select(*on, F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"), (F.col("_a") < F.col("_b")).alias("_up"))
    return ordered.groupBy(*on, "a", "b").agg(F.bool_or("_up").alias("a_in_b"), F.bool_or(~F.col("_up")).alias("b_in_a"))


def remove_contained(
    lines: DataFrame, id_col: str, line: str, radius: float = 0.00001, on: list[str] | None = None, literal: bool = False,
    limit: int = grid.LIMIT,
) -> DataFrame:
    """Drop lines that lie in the buffer of another line.

    Two lines inside each other's buffers are equal up to the buffer: the smaller id stays. ``literal``
    drops both, which is what a plain "contained in at least two buffers" rule does.

    One line that contains it is enough for a line to go, so pairs aren't listed: each line is first held against the
    largest line whose box holds its own. Only what that leaves is held against all such lines.
    """
    on = on or []
    lines = cut_lineage(lines)
    extent = [f"_{c}" for c in ("min_x", "min_y", "max_x", "max_y")]
    boxed = lines.withColumn("_q", geo.bbox(line)).withColumns({c: F.col(f"_q.{c[1:]}") for c in extent}).drop("_q")
    leaves = grid.near_leaves(
        grid.first_points(boxed, id_col, line, on, "_a", extent), grid.line_segments(boxed, id_col, line, on, "_b", radius, extent), radius, on, limit, extent
    )
    held = F.col("_a") != F.col("_b")
    for low, high in (("_min_x", "_max_x"), ("_min_y", "_max_y")):
        held &= (F.col(low) >= F.col(f"_r{low}") - radius) & (F.col(high) <= F.col(f"_r{high}") + radius)
    size = F.col("_r_max_x") - F.col("_r_min_x") + F.col("_r_max_y") - F.col("_r_min_y")
    inner = lines.select(*on, F.col(id_col).alias("_a"), F.col(line).alias("_p"))
    outer = lines.select(*on, F.col(id_col).alias("_b"), F.col(line).alias("_q"))

    def go(pairs):
        both = pairs.join(inner, [*on, "_a"]).join(outer, [*on, "_b"])
        inside = {"_in": k.inside_buffer("_p", "_q", F.lit(radius)), "_back": k.inside_buffer("_q", "_p", F.lit(radius))}
        flags = both.withColumns(inside).groupBy(*on, "_a", "_b").agg(F.bool_or("_in").alias("_in"), F.bool_or("_back").alias("_back"))
        goes = F.col("_in") & (F.lit(literal) | (F.col("_b") < F.col("_a")) | ~F.col("_back"))
        return cut_lineage(flags.filter(goes).select(*on, "_a").distinct())

    largest = leaves.pairs(where=held).groupBy(*on, "_a").agg(F.min_by("_b", F.struct(-size, F.col("_b"))).alias("_b"))
    gone = go(largest)
    gone = gone.unionByName(go(leaves.pairs(gone, held).select(*on, "_a", "_b").distinct()))
    return lines.join(gone.withColumnRenamed("_a", id_col), [*on, id_col], "left_anti")


# ---- near duplicates ------------------------------------------------------------------------


def _extent_cell(box: Column, size: float) -> Column:
    return F.struct(*[F.floor(box[c] / F.lit(size)).alias(c) for c in ("min_x", "min_y", "max_x", "max_y")])


def _extent_reach(box: Column, size: float, d: float) -> Column:
    """Cells in which the extents of a line at Hausdorff distance <= d can fall: one or two per side."""
    d = d + 1e-9

    def options(side):
        return F.sequence(F.floor((box[side] - d) / F.lit(size)), F.floor((box[side] + d) / F.lit(size)))

    def expand(sides, made):
        side, rest = sides[0], sides[1:]
        if not rest:
            return F.transform(options(side), lambda v: F.struct(*[c.alias(n) for n, c in [*made, (side, v)]]))
        return F.flatten(F.transform(options(side), lambda v: expand(rest, [*made, (side, v)])))

    return expand(["min_x", "min_y", "max_x", "max_y"], [])


def near_duplicates(
    lines: DataFrame, ordinal: str, line: str, max_distance: float, max_point_diff: int, pair_limit: int = 128
) -> DataFrame:
    """(ordinal, seed) of the rows that an earlier row takes: greedy in order of ``ordinal``.

    Row by row, each row that is still free takes every later free row whose vertex count differs by at
    most ``max_point_diff`` and whose Hausdorff distance is at most ``max_distance``. Only rows whose box
    extents differ by at most the distance can qualify, so the extents give the join key.

    Rounds with the same outcome as the row-by-row pass:
    1. While some key holds more than ``pair_limit`` rows: a row that is the first free row of every key
       it can reach is a seed for certain; all such seeds take their rows at once. This is linear per
       round, whatever the size of a key.
    2. Then all close pairs are listed (at most ``pair_limit`` x 16 candidates per row), and seeds are
       the rows without an earlier free partner, round after round.
    """
    size = 4 * max_distance
    base = keep_where(lines.select(F.col(ordinal).alias("o"), F.col(line).alias("p")), F.size("p") >= 2)
    base = base.withColumn("_box", geo.bbox("p")).select(
        "o", "p", F.size("p").alias("n"), _extent_cell(F.col("_box"), size).alias("cell"),
        _extent_reach(F.col("_box"), size, max_distance).alias("reach"),
    )
    free = cut_lineage(base)
    taken = None

    def close(pairs):
        ok = F.abs(F.col("n") - F.col("seed_n")) <= max_point_diff
        return pairs.filter(ok).filter(k.hausdorff("p", "seed_p") <= F.lit(float(max_distance)))

    def reached(rows):
        return rows.select(
            F.col("o").alias("seed"), F.col("n").alias("seed_n"), F.col("p").alias("seed_p"), F.explode("reach").alias("cell")
        )

    while True:
        blocks = free.groupBy("cell").agg(F.count("*").alias("c"), F.min("o").alias("first"))
        largest = blocks.agg(F.max("c")).first()[0]
        if largest is None or largest <= pair_limit:
            break
        heads = free.join(blocks.select("cell", F.col("first").alias("o")), ["cell", "o"], "left_semi")
        checks = heads.select("o", F.explode("reach").alias("cell")).join(blocks.select("cell", "first"), "cell")
        sure = checks.groupBy("o").agg(F.min("first").alias("first")).filter(F.col("o") == F.col("first")).select("o")
        seeds = cut_lineage(heads.join(sure, "o", "left_semi"))
        pairs = free.join(reached(seeds), "cell").filter(F.col("o") > F.col("seed"))
        caught = cut_lineage(close(pairs).groupBy("o").agg(F.min("seed").alias("seed")))
        taken = caught if taken is None else taken.unionByName(caught)
        gone = caught.select("o").unionByName(seeds.select("o"))
        free = cut_lineage(free.join(gone, "o", "left_anti"))

    edges = close(free.join(reached(free), "cell").filter(F.col("o") > F.col("seed"))).select("o", "seed")
    # Decided rows leave the edge list; a row whose earlier partners are all taken becomes a seed.
    edges = cut_lineage(edges)
    while not edges.isEmpty():
        later = edges.select(F.col("o").alias("x")).distinct()
        seeds = edges.select(F.col("seed").alias("x")).distinct().join(later, "x", "left_anti")
        by_seed = edges.join(seeds.withColumnRenamed("x", "seed"), "seed", "left_semi")
        caught = cut_lineage(by_seed.groupBy("o").agg(F.min("seed").alias("seed")))
        taken = caught if taken is None else taken.unionByName(caught)
        rows = caught.select("o")
        edges = edges.join(rows, "o", "left_anti").join(rows.withColumnRenamed("o", "seed"), "seed", "left_anti")
        edges = cut_lineage(edges.select("o", "seed"))
    if taken is None:
        taken = edges.groupBy("o").agg(F.min("seed").alias("seed"))  # no edges: no rows
    return taken.withColumnRenamed("o", ordinal)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every id that has an edge; the component is its smallest id.

    Alternating large-star / small-star rounds: edges are rewired to the smallest neighbour until every
    component is a star. Each round is a group-by and a join on ids, written to the checkpoint folder.
    """
    spark_edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    current = cut_lineage(spark_edges)
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u")
        small = small.select("v", "m").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low2.select("u", F.col("m").alias("v"))
        ).distinct()
        new = cut_lineage(small)
        # Unchanged edge set: compare sizes and the sum of hashes, two numbers each.
        def digest(df):
            return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

        if digest(new) == digest(current):
            break
        current = new
    members = current.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return members.unionByName(members.select(F.col("component").alias("id"), "component").distinct())


def trace_clusters(lines: DataFrame, id_col: str, line: str, eps: float, pair_limit: int = 128) -> DataFrame:
    """Clusters of lines linked by Hausdorff distance <= eps (at least two members): (id, cluster).

    A near-duplicate pass at eps gives every taken row an edge to its seed. Rows of one seed are linked
    already, so only pairs of rows with different seeds are tried: a dense group costs no pairs.
    """
    rows = lines.select(F.col(id_col).alias("id"), F.col(line).alias("p")).filter(F.size("p") >= 2)
    taken = near_duplicates(rows, "id", "p", eps, 1 << 30, pair_limit)
    edges = taken.select(F.col("id").alias("a"), F.col("seed").alias("b"))
    size = 4 * eps
    keyed = rows.join(taken, "id", "left").withColumn("seed", F.coalesce("seed", "id")).withColumn("_box", geo.bbox("p"))
    keyed = cut_lineage(
        keyed.select(
            "id", "p", "seed", _extent_cell(F.col("_box"), size).alias("cell"),
            _extent_reach(F.col("_box"), size, eps).alias("reach"),
        )
    )
    other = keyed.select(
        F.col("id").alias("b"), F.col("p").alias("q"), F.col("seed").alias("seed_b"), F.explode("reach").alias("cell")
    )
    pairs = keyed.select(F.col("id").alias("a"), "p", "seed", "cell").join(other, "cell")
    pairs = pairs.filter((F.col("a") < F.col("b")) & (F.col("seed") != F.col("seed_b")))
    edges = edges.unionByName(pairs.filter(k.hausdorff("p", "q") <= F.lit(float(eps))).select("a", "b"))
    return components(edges).select(F.col("id").alias(id_col), F.col("component").alias("cluster"))


def cluster_mean_lines(lines: DataFrame, clusters: DataFrame, id_col: str, line: str) -> DataFrame:
    """Mean point per cluster and vertex index, in long form."""
    points = lines.join(clusters, id_col).select("cluster", F.posexplode(line).alias("seq", "pt"))
    return points.groupBy("cluster", "seq").agg(F.avg("pt.x").alias("x"), F.avg("pt.y").alias("y"), F.count("*").alias("lines"))
