"""Section splitting of whole batches against a plain recursion over one interval at a time."""

import numpy as np
import pytest

from waymark import values as v
from waymark.functions import kernels as k, sections as sec
from waymark.plans import inspection as ins


def pairs(n, seed):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        m = int(rng.integers(2, 30))
        a = np.cumsum(rng.normal(0.001, 0.001, (m, 2)), axis=0)
        b = a + np.where(rng.random((m, 1)) < 0.3, rng.normal(0, 0.0015, (m, 2)), rng.normal(0, 0.00005, (m, 2)))
        if i % 25 == 3:  # a detour beside a long straight road
            a = np.column_stack([np.linspace(0, 0.05, 40), np.zeros(40)])
            b = a + np.column_stack([np.zeros(40), np.where((a[:, 0] > 0.02) & (a[:, 0] < 0.03), 0.004, 0)])
        out.append((i, a, b[:1] if i % 50 == 0 else b[:0] if i % 60 == 1 else b))
    return out


def lines(*rows):
    return sec.Lines(np.concatenate([np.reshape(r, (-1, 2)) for r in rows]), np.concatenate([[0], np.cumsum([len(r) for r in rows])]))


def recursed(a, b, other, start, end, depth, literal):
    """Closed intervals below [start, end]."""
    if depth > v.MAX_SPLIT_DEPTH:
        return [(start, end)]
    _, closed, s, e = sec.step(lines(a), lines(other), np.array([start]), np.array([end]), depth == 0, literal)
    out = []
    for done, x, y in zip(closed, s, e):
        if done:
            out.append((x, y))
            continue
        cut = sec.between(lines(a), lines(b), np.array([x]), np.array([y]))
        out += recursed(a, b, cut.xy, x, y, depth + 1, literal)
    return out


def merged(spans):
    out = []
    for s, e in sorted(spans):
        if out and out[-1][1] >= s:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


@pytest.mark.parametrize("literal", [False, True])
def test_batches_equal_plain_recursion(spark, literal):
    data = pairs(120, 5)
    rows = [(i, [tuple(p) for p in a.tolist()], [tuple(p) for p in b.tolist()]) for i, a, b in data]
    df = spark.createDataFrame(rows, "i long, a array<struct<x: double, y: double>>, b array<struct<x: double, y: double>>").repartition(3)
    got = {}
    for r in ins.split_sections(df, "i", literal_second_test=literal).collect():
        got.setdefault(r.i, []).append((r.s, r.e))
    want = {i: merged(recursed(a, b, b, 0.0, float(lines(a).length()[0]), 0, literal)) for i, a, b in data}
    assert {i for i, s in want.items() if s} == set(got) and len(got) > 80
    for i, spans in got.items():
        assert np.allclose(sorted(spans), want[i], rtol=0, atol=1e-9)


def test_given_lines_replace_the_cut(spark):
    """A line that the other side gives for an open interval is compared instead of the cut, and the plan has no shuffle."""
    a = [(x, 0.0) for x in np.linspace(0, 0.06, 60).tolist()]
    b = [(x, 0.004 if 0.02 < x < 0.04 else 0.0) for x, _ in a]
    df = spark.createDataFrame([(1, a, b), (2, a, b)], "i long, a array<struct<x: double, y: double>>, b array<struct<x: double, y: double>>")
    plain = {r.i: (r.s, r.e) for r in ins.split_sections(df, "i").collect()}
    assert plain[1] == plain[2] and 0.018 < plain[1][0] < 0.021 and 0.039 < plain[1][1] < 0.042
    # What the first step leaves open: for route 2 the other side drives those parts like the own line.
    one, two = lines(np.array(a)), lines(np.array(b))
    _, closed, s, e = sec.step(one, two, np.zeros(1), one.length(), True, False)
    assert not closed.any()
    given = [(2, float(x), float(y), [tuple(p) for p in sec.Lines(*k.batch_cut(one.xy, one.at, np.array([x]), np.array([y]))).xy.tolist()]) for x, y in zip(s, e)]
    sub = spark.createDataFrame(given, "id long, s double, e double, line array<struct<x: double, y: double>>")
    found = ins.split_sections(df, "i", subroutes=sub)
    assert [r.i for r in found.collect()] == [1]
    assert "Exchange" not in ins.split_sections(df, "i")._jdf.queryExecution().executedPlan().toString()


def test_union_of_spans():
    rng = np.random.default_rng(1)
    row = rng.integers(0, 9, 200)
    s = rng.integers(0, 60, 200).astype(float)
    e = s + rng.integers(0, 4, 200)
    got = {}
    for r, x, y in zip(*sec.union(row, s, e)):
        got.setdefault(int(r), []).append((x, y))
    assert got == {r: merged([(x, y) for q, x, y in zip(row, s, e) if q == r]) for r in set(row.tolist())}


def test_known_sections_leave_the_competitor_lines_behind(spark):
    from waymark.plans.inspection import reuse_static_routes

    lines = ["LINESTRING (0 0, 1 1)", "LINESTRING (5 5, 6 6)"]
    routes = spark.createDataFrame(
        [("s", "r1", "c", "x", lines[0], 1.0, "p"), ("s", "r2", "c", "x", lines[0], 1.0, "p"), ("s2", "r1", "c", "x", lines[0], 1.0, "p")],
        "sample_id string, route_id string, competitor string, country string, provider_route string, provider_route_length double, provider string",
    )
    history = spark.createDataFrame(
        [
            ("s", "r1", "c", "x", "h1", lines[0], "cr1", "optimal", 1.0, 2.0), ("s", "r1", "c", "x", "h2", lines[0], "cr2", "optimal", 3.0, 4.0),
            ("s", "r2", "c", "x", "h2", lines[1], "cr3", "optimal", 5.0, 6.0), (None, "r1", "c", "x", "h2", lines[0], "cr4", "optimal", 7.0, 8.0),
        ],
        "sample_id string, route_id string, competitor string, country string, run_id string, provider_route string, competitor_route string, "
        "rac_state string, competitor_route_length double, competitor_route_time double",
    )
    sections = spark.createDataFrame(
        [("h1", "r1", "a", None, 9.0), ("h1", "r1", "b", "q", 9.0), ("h2", "r1", "a", None, 9.0)],
        "run_id string, route_id string, case_id string, reference_case_id string, stretch_length double",
    )
    feedback = spark.createDataFrame(
        [("h1", "r1", "a", "WGEO", "TEMP", "z"), ("h1", "r1", "a", "MMAN", None, "y"), (None, "r1", "a", "A", None, None), ("h2", "r1", None, None, None, None)],
        "run_id string, route_id string, case_id string, mcp_state string, error_subtype string, reference_case_id string",
    )
    meta = spark.sql("select * from values ('h1', date'2024-01-01'), ('h2', date'2024-02-01') as m(run_id, inspection_date)")
    unknown, known, found = reuse_static_routes(routes, history, sections, feedback, meta, "new")
    # The reviewed run wins over the later one; a history row without a sample meets nothing.
    assert [(r["sample_id"], r["route_id"], r["run_id"], r["competitor_route"], r["competitor_route_time"]) for r in known.collect()] == [("s", "r1", "h1", "cr1", 2.0)]
    assert sorted((r["sample_id"], r["route_id"]) for r in unknown.collect()) == [("s", "r2"), ("s2", "r1")]
    assert sorted((r["reference_case_id"], r["mcp_state"], r["error_subtype"]) for r in found.collect()) == [("a", "MMAN", None), ("q", None, None)]
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not [line for line in plan if "competitor_route#" in line and "LogicalRDD" not in line]
