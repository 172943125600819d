"""Quad tiles (bit-interleaved column/row codes) as column expressions; levels 0 to 29."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Masks that spread the low 32 bits of a number over the even bits of 64.
_SPREAD = [(16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)]
_SCALE = 1e7


def _mask(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _fold(v: Column, steps, shift_fn) -> Column:
    """Apply the shift-or-mask steps in order; the steps are literals, so the column is named only once."""
    plan = F.array(*[F.struct(F.lit(s).alias("shift"), _mask(m).alias("mask")) for s, m in steps])
    return F.aggregate(plan, v, lambda acc, p: acc.bitwiseOR(shift_fn(acc, p["shift"])).bitwiseAND(p["mask"]))


def _spread(v: Column) -> Column:
    return _fold(v, _SPREAD, lambda acc, n: F.call_function("shiftleft", acc, n))


def _squeeze(v: Column) -> Column:
    masks = [m for _, m in reversed(_SPREAD[:-1])] + [0x00000000FFFFFFFF]
    steps = [(shift, mask) for (shift, _), mask in zip(reversed(_SPREAD), masks)]
    return _fold(v.bitwiseAND(_mask(_SPREAD[-1][1])), steps, lambda acc, n: F.call_function("shiftright", acc, n))


def interleave(x: Column, y: Column) -> Column:
    return _spread(x.cast("bigint")).bitwiseOR(F.shiftleft(_spread(y.cast("bigint")), 1))


def _normal(value: Column, bound: float) -> Column:
    inside = (value >= -bound) & (value < bound)
    return F.when(inside, value + bound).when(value == bound, value - 1 + bound).otherwise(
        F.raise_error(F.lit("coordinate out of range")).cast("double")
    )


def tile(level: int, x: Column, y: Column) -> Column:
    return F.struct(
        F.lit(level).alias("level"), interleave(x, y).alias("code"), x.cast("bigint").alias("x"), y.cast("bigint").alias("y")
    )


def tile_of_point(lon: Column, lat: Column, level: int) -> Column:
    if not 0 <= level <= 29:
        raise ValueError("level must be between 0 and 29")
    x = F.floor(_normal(lon, 180.0) / F.lit(360.0 / (1 << level)))
    y = F.floor(_normal(lat, 90.0) / F.lit(360.0 / (1 << (level + 1))))
    return tile(level, x, y)


def tile_of_code(code: Column, level: int) -> Column:
    x, y = _squeeze(code), _squeeze(F.shiftrightunsigned(code, 1))
    return F.struct(F.lit(level).alias("level"), code.alias("code"), x.alias("x"), y.alias("y"))


def parent_code(code: Column, steps: int = 1) -> Column:
    if steps < 1:
        raise ValueError("the parent level must be lower")
    return F.shiftright(code, 2 * steps)


def child_codes(code: Column, steps: int = 1) -> Column:
    if steps < 1:
        raise ValueError("the child level must be higher")
    return F.sequence(F.shiftleft(code, 2 * steps), F.shiftleft(code + 1, 2 * steps) - 1)


def neighbour(t: Column, level: int, dx: int, dy: int) -> Column:
    return tile(level, t["x"] + dx, t["y"] + dy)


def ring(t: Column, level: int, k: int = 1) -> Column:
    """All tiles at most k columns and rows away."""
    offsets = [(dx, dy) for dx in range(-k, k + 1) for dy in range(-k, k + 1)]
    return F.array(*[neighbour(t, level, dx, dy) for dx, dy in offsets])


def tile_bounds(t: Column, level: int, inclusive: bool = False) -> Column:
    top = (1 << level) - 1
    less = 1 if inclusive else 0

    def edge(index: Column, step: float, half: float, minus: int = 0) -> Column:
        return F.ceil(index * F.lit(step * _SCALE) - F.lit(half * _SCALE) - minus) / F.lit(_SCALE)

    sx, sy = 360.0 / (1 << level), 360.0 / (1 << (level + 1))
    return F.struct(
        edge(t["x"], sx, 180.0).alias("min_x"),
        edge(t["y"], sy, 90.0).alias("min_y"),
        F.when(t["x"] == top, F.lit(180.0)).otherwise(edge(t["x"] + 1, sx, 180.0, less)).alias("max_x"),
        F.when(t["y"] == top, F.lit(90.0)).otherwise(edge(t["y"] + 1, sy, 90.0, less)).alias("max_y"),
    )


def code_hex(code: Column) -> Column:
    return F.lower(F.hex(code))


def code_base4(code: Column, level: int) -> Column:
    digits = F.when(code == 0, F.lit("")).otherwise(F.conv(code, 10, 4))
    return F.lpad(digits, max(level, 1), "0") if level else digits


def covering(min_x: Column, max_x: Column, min_y: Column, max_y: Column, level: int) -> Column:
    """Array of all tiles between two corners."""
    low, high = tile_of_point(min_x, min_y, level), tile_of_point(max_x, max_y, level)
    return F.flatten(
        F.transform(
            F.sequence(low["x"], high["x"]),
            lambda x: F.transform(F.sequence(low["y"], high["y"]), lambda y: tile(level, x, y)),
        )
    )


def grid_cells(box: Column, size: float) -> Column:
    """Square cells of ``size`` degrees that a bounding box meets, each one BIGINT (column, row): cheap join keys."""
    def span(low, high):
        return F.sequence(F.floor(box[low] / F.lit(size)), F.floor(box[high] / F.lit(size)))

    return F.flatten(
        F.transform(
            span("min_x", "max_x"),
            lambda cx: F.transform(span("min_y", "max_y"), lambda cy: cx * F.lit(1 << 32) + cy),
        )
    )
