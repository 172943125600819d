"""Pairs of lines that may touch, from a grid that is fine where lines are dense.

Each segment is keyed by the squares that it really crosses, found by descent: a square is split into ``FAN`` x ``FAN`` smaller ones, and
the segment goes on to those that it meets (separating axes). Squares are counted level by level. One that holds rows of one side
only is dropped, one of at most ``limit`` rows is a leaf, and the segments of the others descend. Squares of the last level that are still
fuller hold lines that lie on each other; their left rows are dealt to as many tasks as the limit asks for. Only ids and segments are
shuffled; the lines themselves are joined to the pairs that are left, once.

All steps are column expressions. A level that has rows is written to the checkpoint folder, since it is read for the counts, the leaves
and the descent. There are at most ``LEVELS`` of them, and those at which even evenly spread rows would overfill every square
are passed without a count.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from waymark.functions import geo
from waymark.session import cut_lineage

ROOT = 8.0  # degrees
FAN = 8
LEVELS = 6  # the last level has squares of 8 / 8^5 degrees, about 27 m
LIMIT = 512

SEGMENT = ["_x1", "_y1", "_x2", "_y2"]


def _range(low: Column, high: Column, size: float) -> Column:
    return F.sequence(F.floor(low / F.lit(size)), F.floor(high / F.lit(size)))


def _crosses(size: float) -> Column:
    """Whether the padded segment meets the square (_cx, _cy): its box does, and the square isn't all on one side of its line."""
    half = F.lit(size / 2) + F.col("_pad")
    mx, my = (F.col("_x1") + F.col("_x2")) / 2 - (F.col("_cx") + 0.5) * size, (F.col("_y1") + F.col("_y2")) / 2 - (F.col("_cy") + 0.5) * size
    dx, dy = (F.col("_x2") - F.col("_x1")) / 2, (F.col("_y2") - F.col("_y1")) / 2
    tiny = 1e-12  # the square's border belongs to both sides
    return (
        (F.abs(mx) <= half + F.abs(dx) + tiny) & (F.abs(my) <= half + F.abs(dy) + tiny)
        & (F.abs(mx * dy - my * dx) <= half * (F.abs(dx) + F.abs(dy)) + tiny)
    )


def _descend(parts: DataFrame, size: float, inside: bool = True) -> DataFrame:
    """The squares of ``size`` that each segment meets; inside the square it is at, if it is at one."""
    out = parts
    for axis, (a, b) in (("_cx", ("_x1", "_x2")), ("_cy", ("_y1", "_y2"))):
        low, high = F.least(a, b) - F.col("_pad"), F.greatest(a, b) + F.col("_pad")
        if inside:
            first = F.col(axis) * FAN
            cells = F.sequence(F.greatest(F.floor(low / F.lit(size)), first), F.least(F.floor(high / F.lit(size)), first + FAN - 1))
            # A border case of rounding may leave nothing between the two.
            cells = F.when(F.floor(low / F.lit(size)) <= first + FAN - 1, F.when(F.floor(high / F.lit(size)) >= first, cells))
        else:
            cells = _range(low, high, size)
        out = out.withColumn("_cells", cells).drop(axis).withColumn(axis, F.explode("_cells")).drop("_cells")
    return out.filter(_crosses(size))


def line_segments(
    lines: DataFrame, id_col: str, line: str, on: list[str], name: str, pad: float, carry: list[str] | None = None
) -> DataFrame:
    carry = carry or []
    rows = lines.select(*on, *carry, F.col(id_col).alias(name), F.explode(geo.segments(line)).alias("_s"))
    return rows.select(*on, *carry, name, F.lit(float(pad)).alias("_pad"), *(F.col(f"_s.{p}.{c}").alias(n) for n, (p, c) in zip(SEGMENT, (("a", "x"), ("a", "y"), ("b", "x"), ("b", "y")))))


def first_points(lines: DataFrame, id_col: str, line: str, on: list[str], name: str, carry: list[str] | None = None) -> DataFrame:
    """Segments without length where the lines begin."""
    p = geo.first(line)
    rows = lines.filter(F.size(line) > 0).select(*on, *(carry or []), F.col(id_col).alias(name), F.lit(0.0).alias("_pad"), p["x"].alias("_x1"), p["y"].alias("_y1"))
    return rows.withColumns({"_x2": F.col("_x1"), "_y2": F.col("_y1")})


def _even_level(parts: DataFrame, limit: int) -> int:
    """The first level at which evenly spread rows could be leaves, with squares of a few segments' size at least."""
    extent = F.avg(F.greatest(F.abs(F.col("_x1") - F.col("_x2")), F.abs(F.col("_y1") - F.col("_y2")))).alias("extent")
    box = parts.agg(extent, F.count("*").alias("n"), *(f(c).alias(n) for c, f, n in (("_x1", F.min, "a"), ("_x1", F.max, "b"), ("_y1", F.min, "c"), ("_y1", F.max, "d")))).first()
    if not box.n:
        return 0
    area = max(box.b - box.a, 1e-6) * max(box.d - box.c, 1e-6)
    size = max(math.sqrt(area * limit / box.n), 4 * box.extent)
    return min(LEVELS - 1, max(0, math.ceil(math.log(ROOT / size, FAN) - 1)))


def near_pairs(left: DataFrame, right: DataFrame, pad: float, on: list[str] | None = None, limit: int = LIMIT) -> DataFrame:
    """Distinct (``on``, _a, _b) of segments whose boxes come as near as ``pad``: no pair that is nearer than that is missing.

    ``left`` has ``on``, _a and ``right`` has ``on``, _b, each with _pad (``pad`` on the right) and the columns of ``SEGMENT``.
    """
    return near_leaves(left, right, pad, on, limit).pairs().distinct()


class Leaves:
    """Both sides' segments in the squares where they meet. ``pairs`` can be taken several times, of some left ids only too."""

    def __init__(self, on: list[str], sides: list[tuple[DataFrame, DataFrame]], carry: list[str]):
        self.on, self.sides, self.carry = on, sides, carry

    def pairs(self, without: DataFrame | None = None, where: Column | None = None) -> DataFrame:
        """(``on``, _a, _b, carried columns: ``_x`` of the left, ``_r_x`` of the right) of each meeting, so pairs may repeat.

        ``without`` has ``on``, _a of left ids that are left out; ``where`` is a condition on the carried columns.
        """
        met, found = F.lit(True), None
        for p, q in (("_x1", "_x2"), ("_y1", "_y2")):
            met &= F.least(p, q) <= F.greatest(f"_r{p}", f"_r{q}") + F.col("_r_pad")
            met &= F.least(f"_r{p}", f"_r{q}") - F.col("_r_pad") <= F.greatest(p, q)
        for a, b in self.sides:
            a = a if without is None else a.join(without, [*self.on, "_a"], "left_anti")
            met_here = a.join(b, [*self.on, "_cx", "_cy", "_salt"]).filter(met if where is None else met & where)
            part = met_here.select(*self.on, "_a", "_b", *self.carry, *(f"_r{c}" for c in self.carry))
            found = part if found is None else found.unionByName(part)
        return found


def near_leaves(left: DataFrame, right: DataFrame, pad: float, on: list[str] | None = None, limit: int = LIMIT, carry: list[str] | None = None) -> Leaves:
    """The same before pairs are made; ``carry`` names columns of both sides that a pair keeps."""
    on, carry = on or [], carry or []
    # Squares smaller than the padding would only be copies of each other.
    levels = max(1, min(LEVELS, 1 + int(math.log(ROOT / (2 * pad), FAN)) if pad > 0 else LEVELS))
    one = left.filter(" and ".join(f"{c} is not null" for c in SEGMENT)).withColumn("_b", F.lit(None).cast(right.schema["_b"].dataType))
    two = right.filter(" and ".join(f"{c} is not null" for c in SEGMENT)).withColumn("_a", F.lit(None).cast(left.schema["_a"].dataType))
    names = [*on, "_a", "_b", "_pad", *SEGMENT, *carry]
    start = cut_lineage(one.select(names).unionByName(two.select(names)).withColumn("_left", F.col("_b").isNull()))
    keys, sides = [*on, "_cx", "_cy"], []
    even, size = min(_even_level(start, limit), levels - 1), ROOT
    parts = _descend(start, size, inside=False)
    for level in range(levels):
        if level:
            size /= FAN
            parts = _descend(parts, size)
        if level < even:
            continue
        parts = cut_lineage(parts)
        counts = parts.groupBy(*keys).agg(F.count_if("_left").alias("_n"), F.count("*").alias("_c")).filter("_n > 0 and _n < _c")
        counts = cut_lineage(counts.withColumn("_full", (F.col("_c") > limit) & F.lit(level < levels - 1)))
        leaves = counts.filter("not _full").select(*keys, F.ceil(F.col("_n") / limit).cast("int").alias("_salts"))
        a = parts.filter("_left").join(leaves, keys).withColumn("_salt", F.pmod(F.xxhash64("_a"), F.col("_salts").cast("long")).cast("int"))
        b = parts.filter("not _left").join(leaves, keys).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
        a, b = (rows.select(*keys, "_salt", name, "_pad", *SEGMENT, *carry) for rows, name in ((a, "_a"), (b, "_b")))
        sides.append((a, b.select(*keys, "_salt", "_b", *(F.col(c).alias(f"_r{c}") for c in ("_pad", *SEGMENT, *carry)))))
        full = counts.filter("_full").select(*keys)
        if full.isEmpty():
            break
        parts = parts.join(full, keys, "left_semi")
    return Leaves(on, sides, carry)
