"""Critical sections of two lines: the spans of one where the other leaves it, found by splitting intervals.

The open intervals of all routes of an Arrow batch are a stack of rows (route, start, end); each step looks at all of them at once with
the batch kernels, closes some and puts halves of the places where the lines part on the stack for the next. Nothing leaves the task
between the steps, so a route costs one pass and no intermediate table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from waymark import values as v
from waymark.functions import kernels as k


class Lines:
    """Lines of a batch: vertices one after another, and where each line begins."""

    def __init__(self, xy: np.ndarray, at: np.ndarray):
        self.xy, self.at = xy, at

    def __len__(self) -> int:
        return len(self.at) - 1

    def take(self, rows: np.ndarray) -> Lines:
        count = np.diff(self.at)[rows]
        at = np.concatenate([[0], np.cumsum(count)])
        return Lines(self.xy[np.arange(at[-1]) - np.repeat(at[:-1], count) + np.repeat(self.at[rows], count)], at)

    def cut(self, start: np.ndarray, end: np.ndarray) -> Lines:
        return Lines(*k.batch_cut(self.xy, self.at, start, end))

    def simplified(self, tolerance: float) -> Lines:
        keep = k.batch_simplify(self.xy, self.at, np.full(len(self), tolerance))
        return Lines(self.xy[keep], np.concatenate([[0], np.cumsum(keep)])[self.at])

    def long(self) -> np.ndarray:
        """Which have two vertices or more."""
        return np.diff(self.at) >= 2

    def length(self) -> np.ndarray:
        return k.batch_stations(self.xy, self.at)[1]

    def metres(self) -> np.ndarray:
        first, row, _ = k._segments(self.xy, self.at)
        (x0, y0), (x1, y1) = np.radians(self.xy[first]).T.reshape(2, -1), np.radians(self.xy[first + 1]).T.reshape(2, -1)
        h = np.sin((y1 - y0) / 2) ** 2 + np.cos(y0) * np.cos(y1) * np.sin((x1 - x0) / 2) ** 2
        return np.bincount(row, 2 * v.EARTH_RADIUS_M * np.arctan2(np.sqrt(h), np.sqrt(1 - h)), len(self))

    def end(self, last: bool) -> np.ndarray:
        """The first or last vertex; NaN for an empty line."""
        out = np.full((len(self), 2), np.nan)
        some = np.diff(self.at) > 0
        out[some] = self.xy[self.at[1:][some] - 1 if last else self.at[:-1][some]]
        return out

    def away(self, other: Lines, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, start, end) of the parts farther than ``radius`` from the other line; all of a line whose other one is empty."""
        near = k.batch_near_spans(self.xy, self.at, other.xy, other.at, np.full(len(self), radius))
        return k._gaps(len(self), *near, self.length())

    def inside(self, other: Lines, radius: float) -> np.ndarray:
        """Which lie within ``radius`` of the other line; none that is empty or has an empty one."""
        ok = self.long() & other.long()
        ok[self.away(other, radius)[0]] = False
        return ok

    def projected(self, other: Lines, row: np.ndarray, start: np.ndarray, end: np.ndarray):
        """Spans of the other lines as spans of these, in increasing order."""
        use = (self.long() & other.long())[row]
        row, ends = row[use], np.column_stack([start, end])[use]
        rows = np.repeat(row, 2)
        if not len(rows):
            return row, np.empty(0), np.empty(0)
        places, _ = k.batch_locate(self.xy, self.at, k.batch_at(other.xy, other.at, ends.ravel(), rows), rows)
        places = np.sort(places.reshape(-1, 2), axis=1)
        return row, places[:, 0], places[:, 1]


def union(row: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Spans of each row without overlaps; those that touch join. Works through the spans of all rows at the same place at once."""
    order = np.lexsort((end, start, row))
    row, start, end = row[order], start[order], end[order].copy()
    if not len(row):
        return row, start, end
    new = np.concatenate([[True], row[1:] != row[:-1]])
    place = np.arange(len(row)) - np.maximum.accumulate(np.where(new, np.arange(len(row)), 0))
    for n in range(1, int(place.max()) + 1):
        i = np.flatnonzero(place == n)
        reach = end[i - 1]
        joins = start[i] <= reach
        new[i] = ~joins
        end[i] = np.where(joins, np.maximum(end[i], reach), end[i])
    first = np.flatnonzero(new)
    return row[first], start[first], end[np.concatenate([first[1:], [len(row)]]) - 1]


def step(a: Lines, other: Lines, start: np.ndarray, end: np.ndarray, first: bool, literal: bool):
    """One step for open intervals of ``a``: (interval, closed, start, end) of what becomes of them."""
    r = v.ROUTE_BUFFER
    whole = a.cut(start, end)
    metres = whole.metres()
    section, other = whole.simplified(v.SIMPLIFY_TOLERANCE), other.simplified(v.SIMPLIFY_TOLERANCE)
    equal = section.inside(other, r) & other.inside(section, r)
    short = (metres < v.SECTION_MIN_METRES) | (section.length() < v.SECTION_MIN_DEGREES)
    with np.errstate(invalid="ignore"):
        off = np.logical_or.reduce([np.hypot(*(section.end(last) - other.end(last)).T) > r for last in (False, True)])
    misaligned = (not first) & (other.length() > 0) & (metres < 10 * v.SECTION_MIN_METRES) & off
    stop = short | misaligned
    closed = np.flatnonzero(stop & ~equal)
    # Parts of each line away from the other, as spans of the whole line.
    own, foreign = section.away(other, r), other.away(section, r)
    row, s, e = (np.concatenate(x) for x in zip(a.projected(section, *own), a.projected(other, *foreign), strict=True))
    lo, hi = start[row], end[row]
    s, e = np.minimum(np.maximum(s - v.SECTION_PAD, lo), hi), np.maximum(np.minimum(e + v.SECTION_PAD, hi), lo)
    use = (s < e) & ~(stop | equal)[row]
    row, s, e = union(row[use], s[use], e[use])
    lo, hi, mid = start[row], end[row], (s + e) / 2
    edge = (s + e if literal else mid) - r
    out = [(closed, np.ones(len(closed), bool), start[closed], end[closed])]
    for grows, x, y in (((s <= lo) & (mid + r >= hi), s, mid + r), ((edge <= lo) & (e >= hi), mid - r, e)):
        out.append((row, grows, np.where(grows, lo, x), np.where(grows, hi, y)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def batch_sections(a: Lines, b: Lines, rows: np.ndarray, given: dict | None = None, literal: bool = False):
    """(row, start, end) of the critical sections of the lines ``a`` of these rows, each against its partner ``b``.

    ``given`` maps (row, start, end), rounded to nine places, to the other side's line between the interval's ends.
    """
    row, start, end = rows, np.zeros(len(rows)), a.length()[rows]
    other, done = b.take(rows), []
    for depth in range(v.MAX_SPLIT_DEPTH + 1):
        interval, closed, s, e = step(a.take(row), other, start, end, depth == 0, literal)
        at = row[interval]
        done.append((at[closed], s[closed], e[closed]))
        row, start, end = at[~closed], s[~closed], e[~closed]
        if not len(row):
            break
        other = between(a.take(row), b.take(row), start, end)
        if given:
            other = replaced(other, [given.get((i, round(x, 9), round(y, 9))) for i, x, y in zip(row.tolist(), start.tolist(), end.tolist())])
    else:
        done.append((row, start, end))
    return union(*(np.concatenate(x) for x in zip(*done, strict=True)))


def between(a: Lines, b: Lines, start: np.ndarray, end: np.ndarray) -> Lines:
    """The other lines between the projections of the intervals' ends; empty if there is none."""
    ok = np.flatnonzero(a.long() & b.long())
    places = [np.zeros(len(a)), np.zeros(len(a))]
    for place, position in zip(places, (start, end)):
        if len(ok):
            place[ok], _ = k.batch_locate(b.xy, b.at, k.batch_at(a.xy, a.at, position[ok], ok), ok)
    return b.cut(*places)


def replaced(lines: Lines, new: list) -> Lines:
    parts = [np.asarray(n, float).reshape(-1, 2) if n is not None else lines.xy[lines.at[i] : lines.at[i + 1]] for i, n in enumerate(new)]
    return Lines(np.concatenate(parts) if parts else lines.xy, np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64))


# Rows of a batch that go through a step together: bounds the memory of long routes.
ROWS = 256


def _critical(a: pa.Array, b: pa.Array, given: pa.Array | None, literal: bool) -> pa.Array:
    n, out = len(a), []
    for begin in range(0, n, ROWS):
        one, two = (Lines(*k._coords(x.slice(begin, ROWS))) for x in (a, b))
        known = {}
        if given is not None:
            for i, spans in enumerate(given.slice(begin, ROWS).to_pylist()):
                known |= {(i, round(g["s"], 9), round(g["e"], 9)): [(p["x"], p["y"]) for p in g["line"]] for g in spans or []}
        row, s, e = batch_sections(one, two, np.flatnonzero(a.slice(begin, ROWS).is_valid().to_numpy(zero_copy_only=False)), known, literal)
        out.append((row + begin, s, e))
    row, s, e = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.empty(0, np.int64), np.empty(0), np.empty(0))
    return k._spans_column(n, row, s, e)


@F.arrow_udf(k.SPANS)
def critical_spans(a: pa.Array, b: pa.Array) -> pa.Array:
    """Spans of ``a`` where ``b`` leaves it; none where ``a`` is null."""
    return _critical(a, b, None, False)


@F.arrow_udf(k.SPANS)
def critical_spans_given(a: pa.Array, b: pa.Array, given: pa.Array, literal: pa.Array) -> pa.Array:
    """The same with the other side's lines ``array<struct<s, e, line>>`` for some intervals, and the literal second test."""
    return _critical(a, b, given, bool(len(literal)) and bool(literal[0].as_py()))
