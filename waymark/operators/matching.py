"""Pieces of lines that run along partner lines, without those that lie in another piece's buffer, decided square by square.

A piece lies in the buffer of another only if its first point does. So lines go to every square that they come near to, whole, and the
square with a piece's first point has all lines that could make a piece which contains it. Nothing but the lines is shuffled, once:
pairs, spans and pieces are made and told apart in the task, in numpy over many squares at a time, in slices of bounded size.

Squares have four mean line lengths at least. One with more than ``PAIRS`` possible pairs or ``ROWS`` lines is split into ``FAN`` x ``FAN``, as in
``operators/grid.py``. A square of the last level is one task's work, however full.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from waymark.functions import geo, kernels as k
from waymark.operators.grid import FAN, LEVELS, ROOT
from waymark.session import cut_lineage

PAIRS = 1 << 25  # of a square, before it is split
ROWS = 1 << 17
GROUP = 30_000  # lines that a task has in Python at a time, unless one square has more
SLICE = 1 << 19  # pairs of lines that are looked at together
SLACK = 1e-9

SQUARE = ["_level", "_cx", "_cy"]


# ---- lines in squares ------------------------------------------------------------------------


def _extent(line: str) -> list[Column]:
    x, y = F.col(line)["x"], F.col(line)["y"]
    return [F.array_min(x), F.array_min(y), F.array_max(x), F.array_max(y)]


def _cells(extent: list[Column], size: float) -> Column:
    """All squares of a box."""
    xs, ys = (F.sequence(F.floor(a / F.lit(size)), F.floor(b / F.lit(size))) for a, b in ((extent[0], extent[2]), (extent[1], extent[3])))
    return F.flatten(F.transform(xs, lambda x: F.transform(ys, lambda y: F.struct(x.alias("x"), y.alias("y")))))


def _squares(line: str, size: float, pad: float) -> Column:
    """The squares of the line's box if they are four at most, else those of the boxes of its segments; NULL where there are fewer."""
    x0, y0, x1, y1 = (F.floor((F.col(f"_e{i}") + (-pad if i < 2 else pad)) / F.lit(size)) for i in range(4))

    def square(x, y):
        return F.struct(x.alias("x"), y.alias("y"))

    def box(s):
        return [f(s["a"][x], s["b"][x]) + p for f, p in ((F.least, -pad), (F.greatest, pad)) for x in ("x", "y")]

    right, up = x1 > x0, y1 > y0
    few = F.array(square(x0, y0), F.when(right, square(x1, y0)), F.when(up, square(x0, y1)), F.when(right & up, square(x1, y1)))
    along = F.flatten(F.transform(geo.segments(line), lambda s: _cells(box(s), size)))
    return F.when((x1 - x0 <= 1) & (y1 - y0 <= 1), few).otherwise(F.array_distinct(along))


def _twice(lines: DataFrame, key: list[str]) -> DataFrame | None:
    """Hashes of keys that several rows share, if any."""
    found = lines.groupBy(F.xxhash64(*key).alias("_h")).agg(F.count("*").alias("_n")).filter("_n > 1").select("_h")
    found = cut_lineage(found)
    return None if found.isEmpty() else found


def _dealt(lines: DataFrame, line: str, key: list[str], pad: float, level: int, full: list[DataFrame]) -> DataFrame:
    """A row for each square of a line: first those of ``level``, then the parts of those that are full."""
    def at(rows, deep, squares):
        rows = rows.withColumns({"_level": F.lit(deep), "_c": F.explode(squares)}).filter("_c is not null")
        return rows.withColumns({"_cx": F.col("_c.x"), "_cy": F.col("_c.y")}).drop("_c")

    found, out = at(lines, level, _squares(line, ROOT / FAN**level, pad)), None
    for deeper, squares in enumerate(full, level + 1):
        marked = found.join(F.broadcast(squares.withColumn("_full", F.lit(True))), [*key[:-1], *SQUARE], "left")
        kept = marked.filter("_full is null").drop("_full")
        out = kept if out is None else out.unionByName(kept)
        inside = F.filter(_squares(line, ROOT / FAN**deeper, pad), lambda c: (F.floor(c["x"] / FAN) == F.col("_cx")) & (F.floor(c["y"] / FAN) == F.col("_cy")))
        found = at(marked.filter("_full").drop("_full"), deeper, inside)
    return found if out is None else out.unionByName(found)


def matched_pieces(
    left: DataFrame, right: DataFrame, left_id: str, right_id: str, left_line: str, right_line: str, radius: float, min_metres: float,
    inside: float | None, on: list[str] | None = None, start: int | None = None, pairs: int = PAIRS,
) -> DataFrame:
    """The longest piece of each left line in the flat-ended buffer of each right line that runs the same way: both rows, ``piece``, ``piece_metres``.

    Pieces of ``min_metres`` at most don't count. With ``inside`` a piece goes if it lies within that distance of another one;
    of two that lie in each other's buffers the one with the smaller "left_id|right_id" stays. Rows that share an id are one line with several
    courses. ``start`` is the level of the first squares.
    """
    on = on or []
    reach = (inside or 0.0) + SLACK
    sides = []
    for lines, name, line, pad in ((left, left_id, left_line, reach), (right, right_id, right_line, radius + reach)):
        named = lines.filter(" and ".join(f"`{c}` is not null" for c in [*on, name])).filter(F.size(line) > 1)
        named = named.withColumns({f"_e{i}": e.cast("double") for i, e in enumerate(_extent(line))})
        bounds = " and ".join(f"abs(_e{i}) < 1e5" for i in range(4))
        sides.append((named.filter(bounds), [*on, name], line, pad))
    size = F.greatest(F.col("_e2") - F.col("_e0"), F.col("_e3") - F.col("_e1"))
    shape = [rows.agg(F.count("*").alias("n"), F.sum(size).alias("s")).first() for rows, *_ in sides]
    n = sum(s.n for s in shape)
    wide = max(4 * sum(s.s or 0.0 for s in shape) / max(n, 1), 2 * (radius + reach))
    last = min(LEVELS - 1, max(0, math.floor(math.log(ROOT / (2 * (radius + reach)), FAN))))
    level = min(last, max(0, math.floor(math.log(ROOT / wide, FAN)))) if start is None else start

    # Rows with the same id go to the squares of all of them together.
    held = []
    for rows, key, line, pad in sides:
        many = _twice(rows, key)
        if many is None:
            held.append([(rows, line, key, pad)])
            continue
        marked = rows.withColumn("_h", F.xxhash64(*key))
        common = marked.join(many, "_h", "left_semi").drop("_h")
        held.append([(marked.join(many, "_h", "left_anti").drop("_h"), line, key, pad), (common, line, key, pad)])

    def dealt(full):
        for parts in held:
            out = _dealt(*(parts[0][i] for i in (0, 1, 2, 3)), level, full)
            if len(parts) > 1:
                rows, line, key, pad = parts[1]
                squares = _dealt(rows.select(*key, line, *(f"_e{i}" for i in range(4))), line, key, pad, level, full).select(*key, *SQUARE).distinct()
                out = out.unionByName(rows.join(squares, key))
            yield out

    full: list[DataFrame] = []
    for deeper in range(level, last):
        counts = None
        for rows, mark in zip(dealt(full), (1, 0), strict=True):
            part = rows.select(*on, *SQUARE, F.lit(mark).alias("_l"))
            counts = part if counts is None else counts.unionByName(part)
        found = counts.filter(F.col("_level") == deeper).groupBy(*on, *SQUARE).agg(F.sum("_l").alias("_n"), F.count("*").alias("_c"))
        found = cut_lineage(found.filter((F.col("_n") > 0) & (F.col("_n") < F.col("_c")) & ((F.col("_n") * (F.col("_c") - F.col("_n")) > pairs) | (F.col("_c") > ROWS))).select(*on, *SQUARE))
        if found.isEmpty():
            break
        full.append(found)
    groups = F.pmod(F.xxhash64(*on, *SQUARE), F.lit(max(1, -(-n // GROUP))))

    packed = []
    for rows, (_, key, line, _) in zip(dealt(full), sides, strict=True):
        place = F.shiftleft("_cx", 32).bitwiseOR(F.col("_cy").bitwiseAND(F.lit(0xFFFFFFFF)))
        packed.append(rows.drop(*(f"_e{i}" for i in range(4))).withColumns({
            "_x": F.col(line)["x"].cast("array<double>"), "_y": F.col(line)["y"].cast("array<double>"), "_square": place, "_group": groups,
        }).drop(line, "_cx", "_cy"))
    rest = [[f for f in lines.schema.fields if f.name not in {*on, left_id, right_id}] for lines in (left, right)]
    ids = [lines.schema[name] for lines, name in ((left, left_id), (right, right_id))]
    lines_ = {left_line, right_line}
    schema = T.StructType([
        *(left.schema[c] for c in on), *ids, *(T.StructField(f.name, k.POINTS if f.name in lines_ else f.dataType) for side in rest for f in side),
        T.StructField("piece", k.POINTS), T.StructField("piece_metres", k.DOUBLE),
    ])
    names, ids_ = [f.name for f in schema.fields], [left_id, right_id]
    own = [{*on, left_id, *(f.name for f in rest[0])}, {right_id, *(f.name for f in rest[1])}]
    lines_of = [left_line, right_line]

    def decide(one: pa.Table, two: pa.Table) -> pa.Table:
        a, b, xy, at, metres = _decided(one, two, ids_, on, radius, min_metres, inside)
        columns = []
        for name in names[:-2]:
            side, rows, table = (0, a, one) if name in own[0] else (1, b, two)
            if name == lines_of[side]:
                columns.append(k._points_column(*_taken(*_course(table), rows)))
            else:
                columns.append(table.column(name).take(pa.array(rows)))
        return pa.table([*columns, k._points_column(xy, at), pa.array(metres, pa.float64())], names=names)

    return packed[0].groupBy("_group").cogroup(packed[1].groupBy("_group")).applyInArrow(decide, schema)


# ---- in a task -------------------------------------------------------------------------------


def _course(table: pa.Table):
    """All vertices of the lines, and their offsets."""
    columns = [c if isinstance(c := table.column(n).combine_chunks(), pa.ListArray) else pa.array([], pa.list_(pa.float64())) for n in ("_x", "_y")]
    lengths = np.asarray(columns[0].value_lengths()).astype(np.int64)
    return np.column_stack([np.asarray(c.flatten().to_numpy(zero_copy_only=False), dtype=float) for c in columns]), np.concatenate([[0], lengths.cumsum()])


def _taken(xy, at, rows):
    """The lines ``rows``, one behind the other."""
    n = np.diff(at)[rows]
    off = np.concatenate([[0], n.cumsum()])
    return xy[np.repeat(at[rows] - off[:-1], n) + np.arange(off[-1])], off


def _boxes(xy, at):
    """Least and largest known coordinates (row, axis) of lines with vertices."""
    if len(at) < 2:
        return np.empty((0, 2)), np.empty((0, 2))
    return np.fmin.reduceat(xy, at[:-1]), np.fmax.reduceat(xy, at[:-1])


def _within(inner, outer, pad):
    return (inner[0] >= outer[0] - pad).all(1) & (inner[1] <= outer[1] + pad).all(1)


def _inside(a, a_at, b, b_at, radius):
    """As ``kernels.inside_buffer`` for lines of two vertices at least."""
    spans = k.batch_near_spans(a, a_at, b, b_at, np.full(len(a_at) - 1, radius))
    ok = np.ones(len(a_at) - 1, dtype=bool)
    ok[k._gaps(len(ok), *spans, k.batch_stations(a, a_at)[1])[0]] = False
    return ok


def _same_direction(a, a_at, b, b_at):
    """As ``geo.same_direction`` for lines of two vertices at least."""
    rows = np.arange(len(a_at) - 1)
    start, end = (k.batch_locate(b, b_at, a[i], rows)[0] if len(rows) else np.empty(0) for i in (a_at[:-1], a_at[1:] - 1))
    ok = start < end
    for i in np.flatnonzero(start == end):
        p, q = a[a_at[i] : a_at[i + 1]], b[b_at[i] : b_at[i + 1]]
        ok[i] = _continuous(p, q) or _continuous(q, p)
    return ok


def _continuous(before, after, limit=5.0):
    out, into = (np.mod(np.degrees(np.arctan2(*(d[1], d[0]))) - 90, 360.0) for d in (before[-1] - before[-2], after[1] - after[0]))
    return abs(np.mod(out - into + 180, 360.0) - 180) < limit


def _codes(table: pa.Table, names: list[str]) -> np.ndarray:
    """A number for each distinct row of the columns, the same in two tables that are asked together."""
    code = np.zeros(table.num_rows, dtype=np.int64)
    for name in names:
        one = pc.dictionary_encode(table.column(name).combine_chunks())
        one = np.asarray(one.indices) if isinstance(one, pa.DictionaryArray) else np.empty(0, np.int64)
        code = np.unique(code * (int(one.max(initial=0)) + 1) + one, return_inverse=True)[1]
    return code


def _ranks(ids: pa.ChunkedArray, end: str) -> tuple[np.ndarray, pa.Array]:
    """Order of the ids as texts that go on with ``end``."""
    texts = pc.binary_join_element_wise(ids.combine_chunks().cast(pa.string()), "", end)
    return np.asarray(pc.rank(texts, tiebreaker="dense")).astype(np.int64) - 1, texts


class _Grid:
    """Cells of each square, to find what is near in one that holds many lines: ``m`` x ``m``, of two mean extents of lines at least."""

    def __init__(self, corner: np.ndarray, size: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.m = int(np.clip(size.min() / max(2 * (high - low).max(1).mean(), 1e-9), 1, 64))
        self.corner, self.step = corner * size[:, None], size / self.m

    def place(self, square, points):
        """Column and row (n, 2) of the cells of points, those at the border for what lies beyond."""
        return np.clip(np.floor((points - self.corner[square]) / self.step[square][:, None]), 0, self.m - 1).astype(np.int64)

    def code(self, square, cell):
        return (square * self.m + cell[:, 0]) * self.m + cell[:, 1]

    def spread(self, square, low, high):
        """(item, cell) of all cells that boxes meet."""
        first, last = self.place(square, low), self.place(square, high)
        n = last - first + 1
        count = n[:, 0] * n[:, 1]
        item = np.repeat(np.arange(len(square)), count)
        at = np.arange(len(item)) - np.repeat(count.cumsum() - count, count)
        return item, first[item] + np.column_stack([at // n[item, 1], at % n[item, 1]])


def _meetings(code_a, code_b, budget=SLICE):
    """Slices (item of a, item of b) of the same code."""
    known, place = np.unique(np.concatenate([code_a, code_b]), return_inverse=True)
    a, b = place[: len(code_a)], place[len(code_a) :]
    order = np.argsort(b, kind="stable")
    off = np.concatenate([[0], np.bincount(b, minlength=len(known)).cumsum()])
    for item, partner in k._row_pairs(a, off, budget):
        yield item, order[partner]


def _decided(one: pa.Table, two: pa.Table, ids: list[str], on: list[str], radius: float, min_metres: float, inside: float | None):
    """(left row, right row, vertices and offsets of the piece, metres) of the pieces that begin in their square and stay."""
    none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, 2)), np.zeros(1, np.int64), np.empty(0)
    if not one.num_rows or not two.num_rows:
        return none
    names = [*on, "_level", "_square"]
    square = _codes(pa.concat_tables([one.select(names), two.select(names)]), names)
    sq_a, sq_b = square[: one.num_rows], square[one.num_rows :]
    a, a_at = _course(one)
    b, b_at = _course(two)
    (rank_a, text_a), (rank_b, text_b) = (_ranks(t.column(c), end) for t, c, end in zip((one, two), ids, ("|", ""), strict=True))
    n = int(square.max()) + 1
    corner, size = np.zeros((n, 2)), np.ones(n)
    place = np.asarray(one.column("_square"))
    corner[sq_a] = np.column_stack([place >> 32, (place & 0xFFFFFFFF).astype(np.uint32).view(np.int32)])
    size[sq_a] = ROOT / np.power(float(FAN), np.asarray(one.column("_level")))
    box_a, box_b = _boxes(a, a_at), _boxes(b, b_at)
    # A vertex without a place has no station; a line with one matches nothing, and would spoil the stations of others.
    whole_a, whole_b = (np.flatnonzero(np.logical_and.reduceat(np.isfinite(xy).all(1), at[:-1])) for xy, at in ((a, a_at), (b, b_at)))
    if not len(whole_a) or not len(whole_b):
        return none
    grid = _Grid(corner, size, *(v[whole_a] for v in box_a))
    barred = bool(pc.any(pc.greater(pc.count_substring(text_a, "|"), 1)).as_py())
    by_a, by_b = (w[np.argsort(s[w], kind="stable")] for w, s in ((whole_a, sq_a), (whole_b, sq_b)))
    off_a, off_b = (np.concatenate([[0], np.bincount(s[w], minlength=n).cumsum()]) for w, s in ((whole_a, sq_a), (whole_b, sq_b)))
    load = (np.diff(off_a) * np.diff(off_b)).cumsum()
    out, begin = [], 0
    while begin < n:
        stop = max(begin + 1, int(np.searchsorted(load, (load[begin - 1] if begin else 0) + 8 * SLICE, side="right")))
        some = by_a[off_a[begin] : off_a[stop]], by_b[off_b[begin] : off_b[stop]]
        begin = stop
        if not all(map(len, some)):
            continue
        ia, ib, s, e = _pieces(*some, sq_a, sq_b, grid, a, a_at, b, b_at, box_a, box_b, rank_a, rank_b, radius, min_metres)
        if not len(ia):
            continue
        if barred:
            rank = np.asarray(pc.rank(pc.binary_join_element_wise(text_a.take(pa.array(ia)), text_b.take(pa.array(ib)), ""), tiebreaker="dense")).astype(np.int64)
        else:
            rank = rank_a[ia] * (int(rank_b.max()) + 1) + rank_b[ib]
        if inside is not None:
            keep = _without_nested(ia, s, e, rank, a, a_at, inside)
            ia, ib, s, e, rank = (v[keep] for v in (ia, ib, s, e, rank))
        xy, at = k.batch_cut(*_taken(a, a_at, ia), s, e)
        stays = (np.floor(xy[at[:-1]] / size[sq_a[ia]][:, None]) == corner[sq_a[ia]]).all(1)
        if inside is not None:
            stays = _not_contained(sq_a[ia], grid, xy, at, rank, stays, inside)
        rows = np.flatnonzero(stays)
        xy, at = _taken(xy, at, rows)
        out.append((ia[rows], ib[rows], xy, at, k.batch_metres(xy, at)))
    if not out:
        return none
    ia, ib, xy, at, metres = zip(*out, strict=True)
    return *(np.concatenate(v) for v in (ia, ib, xy)), np.concatenate([[0], np.concatenate([np.diff(v) for v in at]).cumsum()]), np.concatenate(metres)


def _pieces(some_a, some_b, sq_a, sq_b, grid, a, a_at, b, b_at, box_a, box_b, rank_a, rank_b, radius, min_metres):
    """(left row, right row, start, end) of the longest piece of each pair of ids, of some rows."""
    parts = []
    item_a, cell_a = grid.spread(sq_a[some_a], box_a[0][some_a], box_a[1][some_a])
    item_b, cell_b = grid.spread(sq_b[some_b], box_b[0][some_b] - radius, box_b[1][some_b] + radius)
    item_a, item_b = some_a[item_a], some_b[item_b]
    first_a = grid.place(sq_a, box_a[0])
    first_b = grid.place(sq_b, box_b[0] - radius)
    a4, b4 = ([np.ascontiguousarray(box[i][:, x]) for i in (0, 1) for x in (0, 1)] for box in (box_a, box_b))
    for i, j in _meetings(grid.code(sq_a[item_a], cell_a), grid.code(sq_b[item_b], cell_b)):
        ia, ib = item_a[i], item_b[j]
        # Once: in the cell with the lower corner of what their boxes share.
        near = (cell_a[i] == np.maximum(first_a[ia], first_b[ib])).all(1)
        ia, ib = ia[near], ib[near]
        near = np.ones(len(ia), dtype=bool)
        for low, high in ((0, 2), (1, 3)):
            near &= (a4[low][ia] - radius <= b4[high][ib]) & (b4[low][ib] <= a4[high][ia] + radius)
        ia, ib = ia[near], ib[near]
        if not len(ia):
            continue
        p, p_at = _taken(a, a_at, ia)
        q, q_at = _taken(b, b_at, ib)
        row, s, e = k.batch_near_spans(p, p_at, q, q_at, np.full(len(ia), radius), True)
        if not len(row):
            continue
        met = np.unique(row)
        way = np.zeros(len(ia), dtype=bool)
        way[met] = _same_direction(*_taken(p, p_at, met), *_taken(q, q_at, met))
        ok = way[row]
        parts.append((ia[row[ok]], ib[row[ok]], s[ok], e[ok]))
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0)
    ia, ib, s, e = (np.concatenate(v) for v in zip(*parts, strict=True))
    # A degree is never shorter than this; only what may be too short, and pairs with several pieces, are measured.
    shortest = (e - s) * 110_000 * np.cos(np.radians(np.minimum(np.maximum(np.abs(box_a[0][ia, 1]), np.abs(box_a[1][ia, 1])), 90.0)))
    pair = np.stack([sq_a[ia], rank_a[ia], rank_b[ib]])
    order = np.lexsort(pair[::-1])
    new = np.concatenate([[True], (pair[:, order[1:]] != pair[:, order[:-1]]).any(0)])
    group = np.empty(len(ia), np.int64)
    group[order] = new.cumsum() - 1
    several = np.bincount(group)[group] > 1
    doubt = several | (e - s >= 1) | (shortest <= min_metres)
    keep, at_ = ~doubt, np.flatnonzero(doubt)
    if len(at_):
        xy, at = k.batch_cut(*_taken(a, a_at, ia[at_]), s[at_], e[at_])
        metres, first, last = k.batch_metres(xy, at), xy[at[:-1]], xy[at[1:] - 1]
        order = np.lexsort((last[:, 1], last[:, 0], first[:, 1], first[:, 0], metres, group[at_]))
        order = order[metres[order] > min_metres]
        top = np.concatenate([group[at_[order[1:]]] != group[at_[order[:-1]]], [True]]) if len(order) else np.empty(0, bool)
        keep[at_[order[top]]] = True
    return ia[keep], ib[keep], s[keep], e[keep]


def _without_nested(ia, s, e, rank, a, a_at, inside):
    """Pieces without those that are a part of the widest piece of their line, where that one does all they do.

    It contains them, and whatever lies in their buffer. It has to win against what they win against as well: by the smaller id,
    or as it reaches beyond what lies within twice the distance of them.
    """
    order = np.lexsort((rank, s - e, ia))
    new = np.concatenate([[True], ia[order[1:]] != ia[order[:-1]]])
    widest = np.empty(len(ia), np.int64)
    widest[order] = order[np.flatnonzero(new)][new.cumsum() - 1]
    part = (widest != np.arange(len(ia))) & (s[widest] <= s) & (e <= e[widest])
    keep = ~part | (rank[widest] >= rank)
    ask = np.flatnonzero(part & keep)
    if len(ask):
        one, two = (_boxes(*k.batch_cut(*_taken(a, a_at, ia[i]), s[i], e[i])) for i in (ask, widest[ask]))
        keep[ask[~_within(two, one, 2 * inside + SLACK)]] = False
    return keep


def _not_contained(square, grid, xy, at, rank, stays, inside):
    """Which of ``stays`` lie in no other piece's buffer; of two in each other's buffers the smaller rank stays."""
    stays = stays.copy()
    low, high = _boxes(xy, at)
    x0, y0, x1, y1 = (np.ascontiguousarray(v[:, x]) for v in (low, high) for x in (0, 1))
    wide = x1 - x0 + y1 - y0
    # A piece is looked for in the cell where it begins, others are known in all that their boxes meet.
    home = grid.code(square, grid.place(square, xy[at[:-1]]))
    other, cell = grid.spread(square, low - inside - SLACK, high + inside + SLACK)
    known, place = np.unique(np.concatenate([home, grid.code(square[other], cell)]), return_inverse=True)
    home, cell = place[: len(home)], place[len(home) :]
    order = np.lexsort((rank[other], -wide[other], cell))
    other = other[order]
    off = np.concatenate([[0], np.bincount(cell, minlength=len(known)).cumsum()])
    n = np.diff(off)

    def drop(p, q):
        ok = (x0[p] >= x0[q] - inside) & (x1[p] <= x1[q] + inside) & (y0[p] >= y0[q] - inside) & (y1[p] <= y1[q] + inside) & (p != q)
        p, q = p[ok], q[ok]
        ok = _inside(*_taken(xy, at, p), *_taken(xy, at, q), inside)
        p, q = p[ok], q[ok]
        wins = rank[q] < rank[p]
        ask = np.flatnonzero(~wins)
        wins[ask] = ~_inside(*_taken(xy, at, q[ask]), *_taken(xy, at, p[ask]), inside)
        stays[p[wins]] = False

    # The widest pieces of each cell first, while that saves more than it costs.
    for turn in range(64):
        left = np.flatnonzero(stays)
        if n[home[left]].sum() <= SLICE:
            break
        left = left[n[home[left]] > turn]
        drop(left, other[off[home[left]] + turn])
    left = np.flatnonzero(stays)
    for item, partner in k._row_pairs(home[left], off, SLICE):
        drop(left[item], other[partner])
    return stays
