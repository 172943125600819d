import numpy as np
import pytest
from pyspark.sql import functions as F

from waymark.functions import geo, kernels as k, text as tx, tiles
from waymark.plans import inspection as ins, mapdata as md


def wkt(spark, **cols):
    df = spark.range(1)
    for name, text in cols.items():
        df = df.withColumn(name, geo.points_of_wkt(F.lit(text)))
    return df


def one(df, col):
    return df.select(col.alias("x")).first()["x"]


def test_parse(spark):
    hexa = "0102000000020000000000000000000000000000000000F03F00000000000000400000000000000840"
    df = spark.createDataFrame([("POINT(1 2)",), ("LINESTRING EMPTY",), (hexa,), (None,)], "g string")
    got = [r["p"] for r in df.select(geo.parse_geometry("g").alias("p")).collect()]
    assert [None if g is None else [tuple(p) for p in g] for g in got] == [[(1.0, 2.0)], [], [(0.0, 1.0), (2.0, 3.0)], None]


def test_angles(spark):
    df = spark.range(1)
    for a, b, want in [(5, 355, 10), (5, 12, -7), (5, -5, 10)]:
        assert one(df, geo.angle_difference(F.lit(float(a)), F.lit(float(b)))) == pytest.approx(want)


def test_geodesic_lengths():
    d, az = k.geodesic_inverse([0.0, 0.0, 5.0], [0.0, 0.0, 50.0], [1.0, 0.0, 5.0], [0.0, 1.0, 50.0])
    # One degree of longitude at the equator and of latitude on WGS84.
    assert d[:2] == pytest.approx([111319.4908, 110574.3886], abs=1e-3)
    assert d[2] == 0.0 and az[0] == pytest.approx(90)


def test_near_spans_against_dense_points():
    rng = np.random.default_rng(3)
    for _ in range(20):
        a, b = np.cumsum(rng.normal(0, 1, (6, 2)), axis=0), np.cumsum(rng.normal(0, 1, (5, 2)), axis=0)
        ends = np.array([0, len(a)]), np.array([0, len(b)])
        row, s, e = k.batch_near_spans(a, ends[0], b, ends[1], np.array([0.7]))
        _, total = k.batch_stations(a, ends[0])
        pos = np.linspace(0, total[0], 2000)
        pts = k.batch_at(a, ends[0], pos, np.zeros(len(pos), dtype=int))
        near = k.point_to_segments(pts, b)[0].min(axis=1)
        inside = ((pos[:, None] >= s) & (pos[:, None] <= e)).any(axis=1)
        clear = np.abs(near - 0.7) > 1e-9
        assert (inside[clear] == (near < 0.7)[clear]).all()
        assert (s[1:] > e[:-1]).all()


def test_linear_referencing(spark):
    df = wkt(spark, a="LINESTRING (0 0, 1 0, 1 1)")
    assert one(df, k.project("a", F.lit(1.2), F.lit(0.5))) == pytest.approx(1.5)
    part = one(df, k.substring("a", F.lit(0.25), F.lit(1.75)))
    assert [tuple(p) for p in part] == [(0.25, 0.0), (1.0, 0.0), (1.0, 0.75)]
    assert tuple(one(df, k.interpolate("a", F.lit(9.0)))) == (1.0, 1.0)


def test_containment_and_direction(spark):
    df = wkt(spark, a="LINESTRING (0 0, 1 0)", b="LINESTRING (0 0.0001, 0.5 0.0001, 1 0.0001)", c="LINESTRING (0 0, 2 0)", e="LINESTRING EMPTY")
    assert one(df, geo.equal_within("a", "b", 0.0002)) is True
    assert one(df, geo.equal_within("a", "c", 0.0002)) is False
    assert one(df, geo.equal_within("e", "e", 0.0002)) is False
    assert one(df, geo.same_direction("a", "c")) is True
    assert one(df, geo.same_direction(F.reverse("a"), "c")) is False


def test_polygon_clip(spark):
    df = wkt(spark, a="LINESTRING (-1 0.5, 3 0.5)", r="LINESTRING (0 0, 1 0, 1 1, 0 1)", far="LINESTRING (5 5, 6 6)")
    parts = geo.lines_in_polygon(df, "a", "r").collect()
    assert [[tuple(p) for p in r["part"]] for r in parts] == [[(0.0, 0.5), (1.0, 0.5)]]
    assert geo.lines_in_polygon(df, "far", "r").first()["part"] == []


def test_polyline(spark):
    df = spark.createDataFrame([("_p~iF~ps|U_ulLnnqC",)], "t string")
    got = one(df, k.decode_polyline("t"))
    assert [tuple(p) for p in got] == [(-12.02, 3.85), (-12.095, 4.07)]


def test_tiles(spark):
    df = spark.range(1)
    t = one(df, tiles.tile_of_point(F.lit(-180.0), F.lit(-90.0), 5))
    assert (t["code"], t["x"], t["y"]) == (0, 0, 0)
    t = one(df, tiles.tile_of_code(F.lit(0b1101).cast("bigint"), 4))
    assert (t["x"], t["y"]) == (0b11, 0b10)
    assert one(df, tiles.code_base4(F.lit(13).cast("bigint"), 4)) == "0031"
    with pytest.raises(ValueError):
        tiles.tile_of_point(F.lit(0.0), F.lit(0.0), 30)


def test_lane_strings(spark):
    rows = [("designated|yes", "designated|yes", 0), ("designated|designated||", None, 2), ("designated|yes|designated", "yes|yes|designated", 1), (None, "designated", 0)]
    df = spark.createDataFrame(rows, "b string, h string, want int")
    assert all(r["got"] == r["want"] for r in df.select("want", tx.bus_only_lanes("b", "h").alias("got")).collect())
    tags = spark.createDataFrame([(["lanes", "2", "name", "x", "odd"],)], "t array<string>")
    assert one(tags, tx.tag_map("t", "^lanes")) == {"lanes": "2"}


def test_json_update(spark):
    df = spark.createDataFrame([('{"a":1,"b":"x"}', '{"b":2}'), ('{"a":1}', "not json"), ('{"a":1}', None)], "o string, n string")
    got = [r["j"] for r in df.select(tx.update_tags("o", "n").alias("j")).collect()]
    assert got == ['{"a":1,"b":2}', '{"a":1}', '{"a":1}']


def test_point_text(spark):
    df = spark.createDataFrame([("POINT(9.5 45.25)",), ("POINT (9 45)",), ("x",), (None,)], "p string")
    assert [r["q"] for r in df.select(tx.point_as_lat_lon("p").alias("q")).collect()] == ["45.25, 9.5", "POINT (9 45)", "x", None]


def test_match_pieces(spark):
    a = spark.createDataFrame([("a1", "LINESTRING (0 0, 0 2)"), ("a2", "LINESTRING (0 2, 0 3)")], "feature_a string, w string")
    b = spark.createDataFrame([("b1", "LINESTRING (0 1, 0 2)"), ("b2", "LINESTRING (0 2, 0 3)")], "feature_b string, w string")
    a = a.select("feature_a", geo.points_of_wkt("w").alias("line_a"))
    b = b.select("feature_b", geo.points_of_wkt("w").alias("line_b"))
    got = {(r["feature_a"], r["feature_b"]): [tuple(round(c, 6) for c in p) for p in r["piece"]] for r in md.match_features(a, b).collect()}
    assert got == {("a1", "b1"): [(0.0, 1.0), (0.0, 2.0)], ("a2", "b2"): [(0.0, 2.0), (0.0, 3.0)]}


@pytest.mark.parametrize("radius", [1.0, 2.0])
def test_match_pieces_of_a_wide_buffer(spark, radius):
    """Flat ends: the buffer does not reach beyond the partner's ends, however wide it is."""
    a = spark.createDataFrame([("p1", "LINESTRING (0 0, 0 1, 0 2)"), ("p2", "LINESTRING (0 2, 0 4, 0 5)")], "feature_a string, w string").select("feature_a", geo.points_of_wkt("w").alias("line_a"))
    b = spark.createDataFrame([("c1", "LINESTRING (0 1, 0 2, 0 3)"), ("c2", "LINESTRING (5 2, 5 3, 5 4)")], "feature_b string, w string").select("feature_b", geo.points_of_wkt("w").alias("line_b"))
    got = {(r["feature_a"], r["feature_b"]): [tuple(round(c, 2) for c in p) for p in r["piece"]] for r in md.match_features(a, b, radius=radius).collect()}
    assert got == {("p1", "c1"): [(0.0, 1.0), (0.0, 2.0)], ("p2", "c1"): [(0.0, 2.0), (0.0, 3.0)]}


def test_comparison_states(spark):
    base = "LINESTRING (0 0, 0.01 0, 0.02 0)"
    rows = [
        ("same", base, "LINESTRING (0 0.00005, 0.02 0.00005)"),
        ("detour", base, "LINESTRING (0 0, 0.008 0, 0.008 0.002, 0.012 0.002, 0.012 0, 0.02 0)"),
        ("empty", base, "LINESTRING EMPTY"),
    ]
    df = spark.createDataFrame(rows, "route_id string, provider_route string, competitor_route string")
    df = df.withColumns({"country": F.lit("X"), "provider": F.lit("P")})
    got = ins.compare_routes(df, run_id="r").collect()
    states = {}
    for r in got:
        states.setdefault(r["route_id"], []).append((r["rac_state"], r["stretch"]))
    assert states["same"] == [("optimal", "LINESTRING EMPTY")]
    assert {s for s, _ in states["detour"]} == {"potential_error"}
    xs = [float(p.split()[0]) for _, w in states["detour"] for p in w[12:-1].split(", ")]
    assert min(xs) > 0.005 and max(xs) < 0.015
    assert {s for s, _ in states["empty"]} == {"potential_error"}
    assert len({r["case_id"] for r in got}) == len(got)


def test_polygon_spans_of_a_whole_batch_at_once():
    """The rows of a batch share the kernels' fixed costs; spans hold against the middle points of fine steps."""
    import time

    rng = np.random.default_rng(5)
    sizes = rng.integers(0, 6, 4000)
    at_ = np.concatenate([[0], np.cumsum(sizes)])
    xy, ring = rng.uniform(-2, 2, (at_[-1], 2)), rng.uniform(-2, 2, (5, 2))
    began = time.process_time()
    row, start, end = k.batch_spans_in_polygon(xy, at_, np.tile(ring, (4000, 1)), 5 * np.arange(4001))
    assert time.process_time() - began < 1.0
    e, f = ring, np.roll(ring, -1, axis=0)
    for r in range(0, 4000, 100):
        p = xy[at_[r] : at_[r + 1]]
        if len(p) < 2:
            assert r not in row
            continue
        steps = (np.arange(500) + 0.5) / 500 * np.hypot(*np.diff(p, axis=0).T).sum()
        x, y = k.batch_at(p, np.array([0, len(p)]), steps, np.zeros(500, dtype=np.int64)).T[:, :, None]
        above = (e[:, 1] > y) != (f[:, 1] > y)
        inside = (above & (x < e[:, 0] + (y - e[:, 1]) * (f[:, 0] - e[:, 0]) / (f[:, 1] - e[:, 1]))).sum(axis=1) % 2 == 1
        mine = np.zeros(500, dtype=bool)
        for s, t in zip(start[row == r], end[row == r]):
            mine |= (steps > s) & (steps < t)
        assert (mine != inside).sum() == 0


def test_tiles_of_a_line_need_no_shuffle_of_their_own(spark):
    from types import SimpleNamespace

    from waymark.queries.geometry import cells_along_lines

    rows = [(1, "LINESTRING (10 50, 10.001 50, 10.5 50)"), (1, "LINESTRING (10 50, 10.0001 50)"), (2, "LINESTRING EMPTY"), (None, "LINESTRING (1 1, 1 1)"), (3, None)]
    df = spark.createDataFrame([(i, "DE", w, w) for i, w in rows], "route_id long, country string, provider_route string, competitor_route string")
    out = cells_along_lines(SimpleNamespace(fx_route_lines=df))
    assert out._jdf.queryExecution().sparkPlan().toString().count("HashAggregate") <= 4
    assert {r.route_id: r.cells for r in out.collect()} == {1: 18, None: 9}
