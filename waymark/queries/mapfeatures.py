"""Section features, traces, signs, map attributes, ingest parsers and views."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from waymark.functions import geo
from waymark.operators import order as od
from waymark.plans import features as ft, mapdata as md, reporting as rp, training as tr
from waymark.queries import query
from waymark.queries.geometry import TILE, VERTICES, _near_sql
from waymark.session import cut_lineage
from waymark.sources import datasets as ds, ingest as ig


def _round(df, digits, *cols):
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---- geometric features ----------------------------------------------------------------------

TURN_COLS = ["total_right_angle", "max_right_angle", "total_left_angle", "max_left_angle", "absolute_angle", "heading_stretch", "tortuosity"]
TURNS = f"""with {VERTICES},
    u as (select route_id, seq, (bx - ax) / sqrt(power(bx - ax, 2) + power(by_ - ay, 2)) as ux, (by_ - ay) / sqrt(power(bx - ax, 2) + power(by_ - ay, 2)) as uy from cs),
    w as (select route_id, seq, ux, uy, lead(ux) over (partition by route_id order by seq) as wx, lead(uy) over (partition by route_id order by seq) as wy from u),
    a as (select route_id, sign(uy * wx + ux * wy) * degrees(acos(least(1, greatest(-1, ux * wx + uy * wy)))) as ang from w where wx is not null),
    h as (select f.route_id, sign(f.uy * l.ux + f.ux * l.uy) * degrees(acos(least(1, greatest(-1, f.ux * l.ux + f.uy * l.uy)))) as heading
          from u f join u l on f.route_id = l.route_id and f.seq = 0 and l.seq = 6),
    g as (select route_id, seq, case when seq = 0 then lead(x) over o - x when seq = 7 then x - lag(x) over o else (lead(x) over o - lag(x) over o) / 2 end as gx,
                 case when seq = 0 then lead(y) over o - y when seq = 7 then y - lag(y) over o else (lead(y) over o - lag(y) over o) / 2 end as gy
          from cv window o as (partition by route_id order by seq)),
    gg as (select route_id, seq, gx, gy, case when seq = 0 then lead(gx) over o - gx when seq = 7 then gx - lag(gx) over o else (lead(gx) over o - lag(gx) over o) / 2 end as hx,
                 case when seq = 0 then lead(gy) over o - gy when seq = 7 then gy - lag(gy) over o else (lead(gy) over o - lag(gy) over o) / 2 end as hy
          from g window o as (partition by route_id order by seq)),
    c as (select route_id, min(k) as kmin, max(k) as kmax, avg(k) as kavg from (select route_id, abs(hx * gy - gx * hy) / power(gx * gx + gy * gy, 1.5) as k from gg) group by route_id),
    t as (select route_id, count(*) filter (where ang > 45) as rt, count(*) filter (where ang < -45) as lt, count(*) filter (where abs(ang) <= 45) as st,
          coalesce(sum(ang) filter (where ang > 45), 0) as tr, coalesce(max(ang) filter (where ang > 45), 0) as mr,
          coalesce(sum(-ang) filter (where ang < -45), 0) as tl, coalesce(max(-ang) filter (where ang < -45), 0) as ml, sum(ang) as ab, sum(abs(ang)) / (7 * 180) as tort from a group by route_id)
"""


@query(
    "stretch_turn_features",
    TURNS + """select route_id, cast(rt as integer) as right_turns, cast(lt as integer) as left_turns, cast(st as integer) as straight_turns, round(tr, 5) as total_right_angle, round(mr, 5) as max_right_angle,
      round(tl, 5) as total_left_angle, round(ml, 5) as max_left_angle, round(ab, 5) as absolute_angle, cast(rt > 0 as double) as has_right_turns, cast(lt > 0 as double) as has_left_turns,
      round(heading, 5) as heading_stretch, round(tort, 5) as tortuosity, round(kmin, 4) as min_curvature, round(kmax, 4) as max_curvature, round(kavg, 4) as mean_curvature
    from t join h using (route_id) join c using (route_id)""",
)
def stretch_turn_features(t):
    df = ft.turn_features(t.fx_route_lines.select("route_id", geo.points_of_wkt("competitor_route").alias("stretch")), "stretch").drop("stretch")
    return _round(_round(df, 5, *TURN_COLS), 4, "min_curvature", "max_curvature", "mean_curvature")


@query("stretch_geometric_features")
def stretch_geometric_features(t):
    df = t.fx_route_lines.select("route_id", geo.points_of_wkt("provider_route").alias("route"), geo.points_of_wkt("competitor_route").alias("stretch"))
    return ft.geometric_features(df).select("route_id", *ft.GEOMETRIC)


# ---- traces ----------------------------------------------------------------------------------

TRACE_SQL = f"""with raw as (select c.case_id || '|' || tr.trace_id as route_id, c.stretch as competitor_route, tr.trace as provider_route, c.case_id, tr.trace_id
        from fx_corridors c join fx_traces tr on tr.org = c.case_id where tr.trace_date between c.date_end - 14 and c.date_end),
    {VERTICES.replace('fx_route_lines', 'raw')},
    {_near_sql('ps', 'cs', 0.0001)},
    pos as (select route_id, seq + lo as b, seq + hi as e from cl_ps),
    isl as (select *, max(e) over (partition by route_id order by b, e rows between unbounded preceding and 1 preceding) as reach from pos),
    grp as (select *, sum(case when reach >= b - 1e-9 then 0 else 1 end) over (partition by route_id order by b, e) as g from isl),
    near as (select route_id, count(distinct g) as pieces, min(b) as s, max(e) as e from grp group by route_id),
    ends as (select route_id, arg_min(x, seq) as x0, arg_min(y, seq) as y0, arg_max(x, seq) as x1, arg_max(y, seq) as y1 from cv group by route_id),
    cir as (select p.route_id, p.seq, k.which, k.r, (p.bx - p.ax) as dx, (p.by_ - p.ay) as dy, p.ax - (case k.which when 'a' then x0 else x1 end) as fx,
                   p.ay - (case k.which when 'a' then y0 else y1 end) as fy
            from ps p join ends using (route_id) cross join (values ('a', 0.0001), ('b', 0.0001), ('a', 0.00011), ('b', 0.00011)) k(which, r)),
    q as (select *, dx * dx + dy * dy as qa, fx * dx + fy * dy as qb, fx * fx + fy * fy - r * r as qc from cir),
    hit as (select route_id, which, r, seq + greatest(0, (-qb - sqrt(qb * qb - qa * qc)) / qa) as b, seq + least(1, (-qb + sqrt(qb * qb - qa * qc)) / qa) as e
            from q where qb * qb - qa * qc >= 0 and (-qb + sqrt(qb * qb - qa * qc)) / qa >= 0 and (-qb - sqrt(qb * qb - qa * qc)) / qa <= 1),
    sp as (select route_id, min(b) filter (where which = 'a' and r < 0.000105) as a0, max(e) filter (where which = 'a' and r < 0.000105) as a1,
                  min(b) filter (where which = 'b' and r < 0.000105) as b0, max(e) filter (where which = 'b' and r < 0.000105) as b1,
                  min(b) filter (where which = 'a' and r > 0.000105) as wa0, max(e) filter (where which = 'a' and r > 0.000105) as wa1,
                  min(b) filter (where which = 'b' and r > 0.000105) as wb0, max(e) filter (where which = 'b' and r > 0.000105) as wb1 from hit group by route_id),
    fl as (select raw.case_id, n.route_id, a0 is not null as in_a, b0 is not null as in_b, coalesce(a0 < b0 and b1 > a1, false) as ab, coalesce(b0 < a0 and a1 > b1, false) as ba,
                  n.pieces = 1 and coalesce(wa0 <= n.e and wa1 >= n.s, false) and coalesce(wb0 <= n.e and wb1 >= n.s, false) as cont,
                  coalesce(n.s >= wa0 - 1e-9 and n.s <= wa1 + 1e-9, false) as s_in_a, coalesce(n.e >= wb0 - 1e-9 and n.e <= wb1 + 1e-9, false) as e_in_b,
                  coalesce(n.s >= wb0 - 1e-9 and n.s <= wb1 + 1e-9, false) as s_in_b, coalesce(n.e >= wa0 - 1e-9 and n.e <= wa1 + 1e-9, false) as e_in_a
           from near n join raw using (route_id) left join sp using (route_id)),
    ag as (select case_id, count(*) as tot, count(*) filter (where in_a) as a, count(*) filter (where in_b) as b, count(*) filter (where in_a and not in_b) as ao,
           count(*) filter (where in_b and not in_a) as bo, count(*) filter (where in_a and in_b) as both_, count(*) filter (where ab) as fw, count(*) filter (where ba) as bk,
           count(*) filter (where cont) as c, count(*) filter (where cont and s_in_a and e_in_b) as fwc, count(*) filter (where cont and s_in_b and e_in_a) as bkc from fl group by case_id),
    f as (select s.case_id, coalesce(tot, 0) as tot, coalesce(a, 0) as a, coalesce(b, 0) as b, coalesce(ao, 0) as ao, coalesce(bo, 0) as bo, coalesce(both_, 0) as both_, coalesce(fw, 0) as fw,
           coalesce(bk, 0) as bk, coalesce(c, 0) as c, coalesce(fwc, 0) as fwc, coalesce(bkc, 0) as bkc from fx_corridors s left join ag using (case_id))
    select case_id, tot as tot_new, """ + ", ".join(
    f"round(case when {ok} then cast({top} as double) / {base} else -2 end, 6) as {name}"
    for name, top, base, ok in [
        ("pra_new", "a", "tot", "tot >= 6"), ("prb_new", "b", "tot", "tot >= 6"), ("pra_not_b", "ao", "tot", "tot >= 6"),
        ("prb_not_a", "bo", "tot", "tot >= 6"), ("pra_and_b", "both_", "tot", "tot >= 6"), ("pra_to_b", "fw", "tot", "tot >= 6"),
        ("prb_to_a", "bk", "tot", "tot >= 6"), ("pra_to_b_contained", "fwc", "c", "tot >= 6 and c >= 6"),
        ("prb_to_a_contained", "bkc", "c", "tot >= 6 and c >= 6"), ("pra_to_b_not_contained", "(fw - fwc)", "(tot - c)", "tot >= 6 and c >= 6 and tot > c"),
        ("prb_to_a_not_contained", "(bk - bkc)", "(tot - c)", "tot >= 6 and c >= 6 and tot > c"),
        ("traffic_direction", "(fw - bk)", "tot", "tot >= 6"), ("traffic_direction_contained", "(fwc - bkc)", "c", "tot >= 6 and c >= 6"),
    ]
) + ", case when tot >= 6 then c else 0 end as tot_contained, cast(0 as integer) as ab_intersect from f"


def _sections(t):
    return t.fx_corridors.select("case_id", geo.points_of_wkt("stretch").alias("stretch"), "date_end")


def _traces(t):
    return t.fx_traces.select("trace_id", "trace_date", geo.points_of_wkt("trace").alias("line"))


@query("trace_features", TRACE_SQL)
def trace_features(t):
    df = ft.trace_features(_sections(t), _traces(t))
    return _round(df, 6, *[c for c in ft.TRACE_FEATURES if c not in ("tot_new", "tot_contained", "ab_intersect")])


@query("trace_pairs_per_section", TRACE_SQL.split("ag as (")[0].rstrip().rstrip(",") + " select case_id, count(*) as traces from fl group by case_id")
def trace_pairs_per_section(t):
    return ft.trace_pairs(_sections(t), _traces(t)).groupBy("case_id").agg(F.count("*").alias("traces"))


@query(
    "trace_feature_cleanup",
    """select case_id, case when n = 0 then -2 else p end as pra_new, case when c < 6 then -2 else p end as pra_to_b_contained from
    (select case_id, cast(stretch_length as bigint) % 30 // 10 as n, cast(stretch_length as bigint) % 70 // 10 as c, probability as p from fx_sections)""",
)
def trace_feature_cleanup(t):
    n = F.col("stretch_length").cast("bigint")
    df = t.fx_sections.select(
        "case_id", F.floor(n % 30 / 10).alias("tot_new"), F.floor(n % 70 / 10).alias("tot_contained"),
        F.col("probability").alias("pra_new"), F.col("probability").alias("pra_to_b_contained"),
    )
    return tr.clean_trace_features(df, ["pra_new"], ["pra_to_b_contained"]).drop("tot_new", "tot_contained")


_SIGN_ROW = """'{"features": [{"properties": {"sign": "NO_ENTRY", "CLUSTER_SIZE": ' || cast(event_id % 5 as varchar(20)) || '}}, {"properties": {"sign": "NO_U_TURN"}}, {"properties": {"sign": "' ||
   case event_type when 'click' then 'NO_VEHICLE' when 'view' then 'NO_LEFT_TURN' else 'OTHER' end || '", "CLUSTER_SIZE": ' || cast(user_id % 4 as varchar(20)) || '}}]}'"""


@query(
    "sign_features",
    """select event_id, cast(event_type <> 'error' and event_id % 5 > 2 as integer) as "NO_ENTRY", cast(0 as integer) as "NO_U_TURN",
      cast(event_type = 'click' and user_id % 4 > 2 as integer) as "NO_VEHICLE", cast(event_type = 'view' and user_id % 4 > 2 as integer) as "NO_LEFT_TURN" from events""",
)
def sign_features(t):
    df = t.events.select("event_id", F.expr(f"case when event_type = 'error' then 'not json' else {_SIGN_ROW} end").alias("response"))
    out = ft.sign_features(df, "response")
    return out.select("event_id", "NO_ENTRY", "NO_U_TURN", "NO_VEHICLE", "NO_LEFT_TURN")


# ---- classifier ------------------------------------------------------------------------------

FEATURES = ["stretch_length", "probability", "probability_new"]


def _labelled(t):
    return t.fx_sections.filter("mcp_state is not null").select(
        "case_id", *FEATURES, (F.col("mcp_state") != "discard").cast("double").alias("label"),
        F.when(F.col("run_id") < "1997", "HDR").when(F.col("run_id") < "2000", "TbT").alias("metric"),
    )


@query(
    "standardised_features",
    """select case_id, round((stretch_length - avg(stretch_length) over ()) / stddev_samp(stretch_length) over (), 6) as stretch_length,
    round((coalesce(p, avg(p) over ()) - avg(p) over ()) / sd, 6) as probability from
    (select *, stddev_samp(coalesce(p, m)) over () as sd from (select *, avg(p) over () as m from
       (select case_id, stretch_length, case when fcd_state = 'no error' then null else probability end as p from fx_sections)))""",
)
def standardised_features(t):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    df = t.fx_sections.select("case_id", "stretch_length", F.when(F.col("fcd_state") != "no error", F.col("probability")).alias("probability"))
    model = Pipeline(stages=tr.standardise(["stretch_length", "probability"])).fit(df)
    x = vector_to_array("features")
    out = model.transform(df).select("case_id", x[0].alias("stretch_length"), x[1].alias("probability"))
    return _round(out, 6, "stretch_length", "probability")


@query("classifier_scores")
def classifier_scores(t):
    df = cut_lineage(_labelled(t).drop("case_id"))
    models = {m: (tr.train_classifier(df.filter(F.col("metric") == m), FEATURES), 0.9) for m in ("TbT", "HDR")}
    models["combined"] = (tr.train_classifier(df, FEATURES), 0.9)
    return tr.classify(models, df).groupBy("metric", "error_label").agg(F.count("*").alias("n"), F.avg("probability_error").alias("mean_probability"))


@query("classifier_calibrated")
def classifier_calibrated(t):
    df = _labelled(t)
    out = tr.calibrated_scores(tr.cross_calibrated(df, FEATURES), df)
    return out.agg(F.avg("calibrated").alias("mean_calibrated"), F.avg("label").alias("mean_label"), F.count("*").alias("n"))


@query("stored_scores", "select case_id, cast(probability >= 0.5 as integer) as prediction from fx_sections")
def stored_scores(t):
    return tr.score_at_least(t.fx_sections, "probability", 0.5).select("case_id", "prediction")


@query(
    "feature_assembly",
    """select s.case_id, s.stretch_length, p.probability as trace_share, n.probability_new as sign_share from fx_sections s
    join (select case_id, min(probability) as probability from fx_sections where fcd_state = 'no error' group by case_id) p using (case_id)
    left join (select case_id, min(probability_new) as probability_new from fx_sections where mcp_state is null group by case_id) n using (case_id)""",
)
def feature_assembly(t):
    s = t.fx_sections
    trace = s.filter("fcd_state = 'no error'").select("case_id", F.col("probability").alias("trace_share"))
    sign = s.filter("mcp_state is null").select("case_id", F.col("probability_new").alias("sign_share"))
    return tr.feature_table(s.select("case_id", "stretch_length"), trace, sign, ["trace_share"])


@query(
    "filled_missing",
    "select case_id, coalesce(case when mcp_state is null then null else probability end, -1) as probability from fx_sections",
)
def filled_missing(t):
    df = t.fx_sections.select("case_id", F.when(F.col("mcp_state").isNotNull(), F.col("probability")).alias("probability"))
    return tr.fill_missing(df, ["probability"])


@query(
    "filled_routes",
    """select s.case_id, case when s.fcd_state = 'no error' then l.provider_route else 'own' end as route from fx_sections s left join fx_route_lines l using (route_id)""",
)
def filled_routes(t):
    cases = t.fx_sections.select("case_id", "route_id", F.when(F.col("fcd_state") != "no error", F.lit("own")).alias("route"))
    return tr.fill_routes(cases, t.fx_route_lines.select("route_id", "provider_route"), ["route_id"]).select("case_id", "route")


# ---- lanes, relations, matches ---------------------------------------------------------------


@query(
    "lane_enrichment",
    """with tg as (select way_id, cast(case when bus_lanes = hov_lanes then 0 when b = 0 then 0 when h = 0 then b
         when len(bl) = len(hl) then list_count(list_filter(range(1, len(bl) + 1), lambda i: bl[i] = 'designated' and hl[i] <> 'designated')) else 0 end as integer) as bus_only,
       cast(h as integer) as hov, cast(a as integer) as psv, coalesce(oneway in ('reversible', 'alternating', 'conditional'), false) as bidirectional,
       coalesce(try_cast(lanes_both_ways as integer), 0) as suicide_lane, lanes is null and lanes_forward is null and lanes_backward is null as untagged
      from (select *, coalesce(len(regexp_extract_all(bus_lanes, 'designated')), 0) as b, coalesce(len(regexp_extract_all(hov_lanes, 'designated')), 0) as h,
          coalesce(len(regexp_extract_all(access_lanes, 'no|psv|bus|taxi')), 0) as a, string_split(bus_lanes, '|') as bl, string_split(hov_lanes, '|') as hl from fx_tags))
    select l_orderkey, l_linenumber, l_partkey as way_id, cast(case when l_linenumber % 4 <= 1 and coalesce(untagged, true) then 0 else l_linenumber % 4 end + coalesce(suicide_lane, 0) as integer) as lanes,
      bus_only, hov, case when bus_only = 0 then psv else 0 end as psv_only, coalesce(bidirectional, false) as bidirectional, coalesce(suicide_lane, 0) as suicide_lane
    from lineitem left join tg on l_partkey = way_id""",
)
def lane_enrichment(t):
    matched = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("way_id"), (F.col("l_linenumber") % 4).alias("lanes"))
    tags = t.fx_tags
    return md.add_lane_info(matched, tags, "way_id", "lanes")


@query(
    "tag_coverage",
    """select count(*) as requested, count(p) as found, round((count(*) - count(p)) / cast(count(*) as double), 6) as loss, (count(*) - count(p)) / cast(count(*) as double) > 0.1 as warn
    from (select distinct l_partkey as k from lineitem) left join (select p_partkey as p from part where p_size > 10) on k = p""",
)
def tag_coverage(t):
    want, have = t.lineitem.select(F.col("l_partkey").alias("k")), t.part.filter("p_size > 10").select(F.col("p_partkey").alias("k"))
    return _round(md.coverage_loss(want, have, "k"), 6, "loss")


@query(
    "directed_lanes",
    """select p_partkey, cast(case when ph = 0 or ph = f + tt then case when p_partkey % 2 = 1 then f else tt end
      when codes is null then -1 when len(codes) > 1 then list_count(list_filter(codes, lambda c: c = case when p_partkey % 2 = 1 then 'F' else 'T' end or c = 'B')) else case when p_partkey % 2 = 1 then f else tt end end as integer) as lanes
    from (select p_partkey, p_size % 3 as f, p_size % 2 as tt, p_size % 6 as ph, case when p_size % 5 = 0 then null when p_size % 5 = 1 then ['F'] else ['F', 'B', 'T', 'T'] end as codes from part)""",
)
def directed_lanes(t):
    size = F.col("p_size")
    codes = F.when(size % 5 == 0, F.lit(None)).when(size % 5 == 1, F.array(F.lit("F"))).otherwise(F.array(*[F.lit(c) for c in "FBTT"]))
    link = F.when(F.col("p_partkey") % 2 == 1, F.lit("7")).otherwise(F.lit("-7"))
    return t.part.select(
        "p_partkey",
        md.directed_lanes(md.drive_direction(link), codes, (size % 3).cast("string"), (size % 2).cast("string"), (size % 6).cast("string")).alias("lanes"),
    )


@query(
    "lane_details",
    """select p_partkey as link_id, l_orderkey, s_suppkey as lane_info_id, length(v) - length(replace(v, '1', '')) as open_lanes, length(v) - length(replace(v, '0', '')) as closed_lanes
    from part left join (select l_partkey, l_orderkey, l_suppkey, l_linenumber % 3 as ty from lineitem) on l_partkey = p_partkey
    left join (select s_suppkey, case when s_suppkey % 2 = 0 then '0101' else '1110' end as v from supplier) on s_suppkey = l_suppkey
    where p_size <> 7 and (ty is null or ty = 1)""",
)
def lane_details(t):
    links = t.part.select(F.col("p_partkey").alias("link_id"), F.when(F.col("p_size") != 7, F.col("p_size")).alias("num_lanes"))
    n2l = t.lineitem.select(F.col("l_partkey").alias("link_id"), "l_orderkey", F.col("l_suppkey").alias("lane_info_id"), (F.col("l_linenumber") % 3).alias("lane_info_type"))
    lanes = t.supplier.select(F.col("s_suppkey").alias("lane_info_id"), F.when(F.col("s_suppkey") % 2 == 0, "0101").otherwise("1110").alias("lane_validity"))
    out = md.lane_details(links, n2l, lanes)
    return out.select("link_id", "l_orderkey", F.when(F.col("lane_validity").isNotNull(), F.col("lane_info_id")).alias("lane_info_id"),
                      F.col("open_lanes").cast("bigint").alias("open_lanes"), F.col("closed_lanes").cast("bigint").alias("closed_lanes"))


@query(
    "lane_connections",
    "select l_orderkey as maneuver_id, l_linenumber, o_custkey as junction_id from lineitem join orders on l_orderkey = o_orderkey where o_custkey in (select c_custkey from customer where c_nationkey = 3)",
)
def lane_connections(t):
    conn = t.lineitem.select(F.col("l_orderkey").alias("maneuver_id"), "l_linenumber")
    man = t.orders.select(F.col("o_orderkey").alias("maneuver_id"), F.col("o_custkey").alias("junction_id"))
    return md.lane_connections(conn, man, t.customer.filter("c_nationkey = 3").select(F.col("c_custkey").alias("junction_id")))


def _members():
    w = lambda c: F.concat(F.lit("w"), F.col(c).cast("string"))
    return F.array(w("o_custkey"), F.lit("from"), F.concat(F.lit("n"), F.col("o_orderkey").cast("string")), F.lit("via"), w("o_orderkey"), F.lit("via"),
                   F.concat(F.lit("w"), (F.col("o_custkey") + 1).cast("string")), F.lit("to"), w("o_orderkey"), F.lit("to"), F.lit("odd"))


@query(
    "relation_ends",
    "select o_orderkey as id, o_custkey as from_way_id, o_custkey as last_from_way_id, o_custkey + 1 as to_way_id, o_orderkey as via_node_id, cast(1 as integer) as vias from orders",
)
def relation_ends(t):
    df = t.orders.select(F.col("o_orderkey").alias("id"), _members().alias("members"))
    return md.relation_ends(df).select("id", "from_way_id", "last_from_way_id", "to_way_id", "via_node_id", F.size("via_way_ids").alias("vias"))


def _ways(t):
    # One straight line per customer, next to each other.
    x, y = (F.col("c_custkey") % 100) * 0.002, F.floor(F.col("c_custkey") / 100) * 0.01
    return t.customer.select(F.col("c_custkey").alias("way_id"), F.array(geo.point(x, y), geo.point(x + 0.001, y), geo.point(x + 0.002, y)).alias("line"))


@query(
    "relations_by_way",
    """with m as (select max(c_custkey) as mx from customer)
    select o_orderkey as relation_id, o_custkey as from_way_id, o_custkey + 1 as to_way_id, cast(6 as integer) as points from orders, m
    -- the next way after the end of a row starts the next row, so it lies against the driving direction
    where o_orderkey % 3 <> 0 and o_custkey + 1 <= mx and o_custkey % 100 <> 99""",
)
def relations_by_way(t):
    rel = t.orders.select(
        F.col("o_orderkey").alias("id"), _members().alias("members"),
        F.when(F.col("o_orderkey") % 3 == 0, F.array(F.lit("restriction"))).otherwise(F.array(F.lit("type"), F.lit("destination_sign"))).alias("tags"),
    )
    ways = _ways(t)
    features = ways.select(F.col("way_id").alias("feature_id"), "line")
    nodes = ways.select(F.col("way_id").alias("id"), geo.first("line").alias("point"))
    p = "destination_sign_"
    out = md.relations_by_way(rel, features, ways, nodes)
    return out.select(
        F.col(p + "relation_id").alias("relation_id"), F.col(p + "from_way_id").alias("from_way_id"), F.col(p + "to_way_id").alias("to_way_id"),
        F.size(p + "combined_line").alias("points"),
    )


EDGES = """e as (select cast(l_orderkey as varchar) as trace_id, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) - 1 as seq,
   l_returnflag as road_class, case when l_linestatus = 'O' and l_returnflag = 'A' then 'ferry' else 'road' end as use, l_quantity as length, l_partkey as edge_id from lineitem)"""


def _edges(t):
    # By the trace id, as all that follows: its rows are shuffled once.
    w = W.partitionBy("trace_id").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    df = t.lineitem.withColumn("trace_id", F.col("l_orderkey").cast("string")).select(
        "trace_id", (F.row_number().over(w) - 1).alias("seq"), F.col("l_returnflag").alias("road_class"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "A"), "ferry").otherwise("road").alias("use"),
        F.col("l_quantity").alias("length"), F.col("l_partkey").alias("edge_id"),
    )
    return df.withColumn("begin_shape_index", F.col("seq")).withColumn("end_shape_index", F.col("seq") + 1)


def _shapes(t):
    """A line of each trace with one vertex more than it has edges."""
    sizes = t.lineitem.groupBy(F.col("l_orderkey").cast("string").alias("trace_id")).agg(F.count("*").alias("n"))
    text = F.array_join(F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("n")), lambda i: F.concat_ws(" ", (10 + i / 1000).cast("string"), (50 + i / 500).cast("string"))), ", ")
    return sizes.select("trace_id", geo.points_of_wkt(F.concat(F.lit("LINESTRING ("), text, F.lit(")"))).alias("line"))


@query(
    "edge_runs",
    f"""with {EDGES}, f as (select *, case when lag(road_class) over w = road_class and lag(use) over w = use then 0 else 1 end as nw from e window w as (partition by trace_id order by seq)),
    g as (select *, sum(nw) over (partition by trace_id order by seq) as run_no from f)
    select trace_id, cast(run_no as bigint) as run_no, round(sum(length), 4) as length, cast(count(*) as integer) as edges, min(road_class) as road_class, min(use) as use, cast(count(*) + 1 as integer) as points
    from g where use <> 'ferry' group by trace_id, run_no""",
)
def edge_runs(t):
    out = md.edge_runs(_edges(t), _shapes(t), ["road_class", "use"])
    return _round(out.select("trace_id", "run_no", "length", F.size("edge_ids").alias("edges"), "road_class", "use", F.size("line").alias("points")), 4, "length")


@query(
    "overlong_matches_dropped",
    f"with {EDGES} select trace_id, count(*) as pieces from e group by trace_id having count(*) <= 3",
)
def overlong_matches_dropped(t):
    edges = t.lineitem.select(F.col("l_orderkey").cast("string").alias("trace_id"))
    shapes = _shapes(t)
    # Every piece is as long as the trace; a hair less, so that three pieces stay.
    matched = edges.join(shapes, "trace_id")
    return md.drop_overlong_matches(matched, shapes, factor=3.0000001).groupBy("trace_id").agg(F.count("*").alias("pieces"))


@query(
    "trace_columns_joined",
    """select cast(l_orderkey as varchar) as trace_id, l_linenumber as quality, r.quality as original_quality, r.country from lineitem left join fx_routes r on r.route_id = cast(l_orderkey as varchar)""",
)
def trace_columns_joined(t):
    matched = t.lineitem.select(F.col("l_orderkey").cast("string").alias("trace_id"), F.col("l_linenumber").alias("quality"))
    traces = t.fx_routes.select(F.col("route_id").alias("trace_id"), "quality", "country", F.col("origin").alias("line"))
    return md.join_trace_columns(matched, traces)


@query("traces_split")
def traces_split(t):
    return md.split_traces(_shapes(t), metres=400.0).select("trace_id", "piece", F.size("line").alias("points"))


VISITS = """v as (select o_custkey as feature_id, o_orderkey as original_trace_id, o_orderkey % 3 <> 0 as fwd from orders),
    r as (select feature_id, bool_or(fwd) as ref from v group by feature_id),
    d as (select v.*, fwd = ref as weight_direction from v join r using (feature_id))"""


def _visits(t):
    ways = _ways(t).withColumnRenamed("way_id", "feature_id")
    v_ = t.orders.select(F.col("o_custkey").alias("feature_id"), F.col("o_orderkey").alias("original_trace_id"), (F.col("o_orderkey") % 3 != 0).alias("fwd"))
    joined = v_.join(ways, "feature_id").withColumn("line", F.when(F.col("fwd"), F.col("line")).otherwise(F.reverse("line"))).drop("fwd")
    return md.weight_directions(joined)


@query(
    "feature_weights",
    f"""with {VISITS}, w as (select feature_id, weight_direction, count(*) as weight, min(original_trace_id) as original_trace_id from d group by feature_id, weight_direction),
    h as (select *, sha256('OV' || cast(feature_id as varchar) || case when weight_direction then 'True' else 'False' end) as h from w)
    select feature_id, weight_direction, weight, original_trace_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) as feature_id_uuid from h""",
)
def feature_weights(t):
    return md.weight_features(_visits(t), "OV").drop("line")


@query("feature_visits", f"with {VISITS} select feature_id, weight_direction, cast(original_trace_id as varchar) as original_trace_id from d")
def feature_visits(t):
    return md.visiting_traces(_visits(t))


# Features along the equator, in slots of a hundredth of a degree; every length is a multiple of a ten-thousandth. Provider features
# belong to lines of orders, competitor features to parts; some parts run against them or lie too far off.
MATCHED = """a as (select l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey as feature_a, l_partkey % 36000 as slot, l_suppkey % 3 as y,
      (l_partkey % 36000) * 100 + l_linenumber as x0, (l_partkey % 36000) * 100 + l_linenumber + 21 + cast(l_quantity as integer) as x1 from lineitem),
    b as (select cast(p_partkey as varchar) as feature_b, p_partkey % 36000 as slot, p_partkey % 4 as y, (p_partkey % 36000) * 100 + 10 as x0, (p_partkey % 36000) * 100 + 50 + p_size % 10 as x1
      from part where p_partkey % 5 <> 0),
    p as (select feature_a, feature_b, a.slot, a.y, greatest(a.x0, b.x0) as s, least(a.x1, b.x1) as e, feature_a || '|' || feature_b as id
      from a join b on a.slot = b.slot and abs(a.y - b.y) <= 2 and greatest(a.x0, b.x0) < least(a.x1, b.x1)),
    gone as (select i.id from p i join p j on i.slot = j.slot and i.y = j.y and i.id <> j.id and j.s <= i.s and i.e <= j.e and (j.s < i.s or i.e < j.e or j.id < i.id)),
    m as (select *, cast(e - s as double) * 0.0001 * 111319.49079327358 as metres from p where id not in (select id from gone))"""


def _features(t):
    """The two tables of ``MATCHED`` as lines; the slot stands for the trace of a provider feature."""

    def line(x0, x1, y, *between):
        return F.array(*(geo.point(x * 0.0001 - 180, y * 0.000011) for x in (x0, *between, x1)))

    base = (F.col("l_partkey") % 36000) * 100 + F.col("l_linenumber")
    size = 21 + F.col("l_quantity").cast("int")
    a = t.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("feature_a"), (F.col("l_partkey") % 36000).alias("trace_id"),
        line(base, base + size, F.col("l_suppkey") % 3, base + size * 0.45).alias("line_a"),
    )
    base = (F.col("p_partkey") % 36000) * 100
    there = line(base + 10, base + 50 + F.col("p_size") % 10, F.col("p_partkey") % 4)
    b = t.part.select(F.col("p_partkey").cast("string").alias("feature_b"), F.when(F.col("p_partkey") % 5 == 0, F.reverse(there)).otherwise(there).alias("line_b"))
    return a, b


@query("matched_features", f"with {MATCHED} select feature_a, feature_b, round(metres, 2) as piece_metres, round(cast(s as double) * 0.0001 - 180, 4) as start_x, round(cast(e as double) * 0.0001 - 180, 4) as end_x from m")
def matched_features(t):
    out = md.match_features(*_features(t))
    ends = [F.round(p["x"], 4).alias(n) for p, n in ((geo.first("piece"), "start_x"), (geo.last("piece"), "end_x"))]
    return out.select("feature_a", "feature_b", F.round("piece_metres", 2).alias("piece_metres"), *ends)


@query(
    "matching_balance",
    f"""with {MATCHED}, own as (select slot as trace_id, sum(cast(x1 - x0 as double) * 0.0001 * 111319.49079327358) as own from a group by slot),
    got as (select slot as trace_id, sum(metres) as got from m group by slot)
    select trace_id, round(own, 1) as own_metres, round(coalesce(got, 0), 1) as matched_metres, abs(own - coalesce(got, 0)) > own * 0.2 as lost, coalesce(got, 0) > own * 1.005 as gained
    from own left join got using (trace_id)""",
)
def matching_balance(t):
    a, b = _features(t)
    return _round(md.matching_balance(a, md.match_features(a, b)), 1, "own_metres", "matched_metres")


@query(
    "match_store_info",
    "select trace_id, cast(null as varchar) as unpaved, count(*) as n from (select cast(l_orderkey as varchar) as trace_id from lineitem) group by trace_id",
)
def match_store_info(t):
    w = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    feats = t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("trace_id"), F.row_number().over(w).alias("seq"), F.col("l_partkey").alias("edge_id"),
        F.array(geo.point(F.lit(0.0), F.lit(0.0)), geo.point(F.lit(0.0), F.lit(0.001))).alias("line"), F.col("l_returnflag").alias("road_class"),
    )
    stored = t.spark.createDataFrame([], "sample_id string, product string, map_version string")
    tables = md.match_store(feats, stored, "s", "p", "v1", ["road_class", "unpaved"])
    joined = tables["map_matched"].join(tables["map_info"].select("match_info_id", "unpaved"), "match_info_id")
    return joined.groupBy("trace_id", "unpaved").agg(F.count("*").alias("n"))


@query("trace_cluster_sizes")
def trace_cluster_sizes(t):
    from waymark.operators.pairs import trace_clusters

    ways = _ways(t)
    return trace_clusters(ways, "way_id", "line", 0.0021).groupBy("cluster").agg(F.count("*").alias("lines"))


# ---- ingest ----------------------------------------------------------------------------------


@query(
    "samples_from_documents",
    """select 'wanted' as sample_id, route_id, quality, country, round(cast(split_part(substr(origin, 7, length(origin) - 7), ' ', 1) as double), 6) as lon, cast(41.5 as double) as to_lat from fx_routes""",
)
def samples_from_documents(t):
    docs = t.fx_routes.select(F.to_json(F.struct("sample_id", "route_id", "quality", "country", "origin", F.lit("41.5, 2.25").alias("to_coord"))).alias("route_data"))
    out = ig.samples_from_documents(docs, "route_data", "wanted")
    o, d = geo.first(geo.points_of_wkt("origin")), geo.first(geo.points_of_wkt("destination"))
    return out.select("sample_id", "route_id", "quality", "country", F.round(o["x"], 6).alias("lon"), d["y"].alias("to_lat"))


@query(
    "sample_metadata_rows",
    "select distinct sample_id, country, 'TbT' as metric, cast(0 as integer) as final_routes from fx_routes",
)
def sample_metadata_rows(t):
    samples = t.fx_routes.select("sample_id", "country", F.lit(None).cast("date").alias("date_generated"))
    return ig.metadata_from_samples(samples).select("sample_id", "country", "metric", "final_routes")


@query(
    "table_to_lines",
    """select json_extract_string(j, '$.route_id') as route_id, cast(2 as integer) as points from (select to_json({'route_id': route_id}) as j from fx_routes where quality <> 'Q3')""",
)
def table_to_lines(t):
    rows = t.fx_routes.select(F.when(F.col("quality") == "Q3", "POINT(bad)").otherwise(F.col("origin")).alias("origin"), "destination", "route_id", "country")
    return ig.lines_from_table(rows).select(F.get_json_object("properties", "$.route_id").alias("route_id"), F.size("line").alias("points"))


_POINT_JSON = "struct<longitude: double, latitude: double>"


@query(
    "answers_with_legs",
    """select route_id, cast(0 as integer) as route_no, cast(16 as integer) as points, 2 * provider_route_length as metres, 2 * provider_route_time as seconds,
      cast(4 as integer) as sections, cast(route_id as bigint) % 2 = 0 as violation, case when cast(route_id as bigint) % 2 = 0 then 'TRUCK' else 'OTHER' end as last_kind from fx_routes""",
)
def answers_with_legs(t):
    base = t.fx_routes.join(t.fx_route_lines.drop("country"), "route_id")
    pts = F.transform(geo.points_of_wkt("provider_route"), lambda p: F.struct(p["y"].alias("latitude"), p["x"].alias("longitude")))
    leg = F.struct(pts.alias("points"), F.struct(F.col("provider_route_length").alias("lengthInMeters"), F.col("provider_route_time").alias("travelTimeInSeconds")).alias("summary"))

    def sec(kind, mode):
        return F.struct(F.lit(0).alias("startPointIndex"), F.lit(3).alias("endPointIndex"), F.lit(kind).alias("sectionType"), mode.alias("travelMode"))

    last = F.when(F.col("route_id").cast("bigint") % 2 == 0, "truck").otherwise("ferry")
    secs = F.array(sec("TRAVEL_MODE", F.lit("truck")), sec("TOLL_ROAD", F.lit(None).cast("string")), sec("TRAVEL_MODE", F.lit("ferry")), sec("TRAVEL_MODE", last))
    body = F.to_json(F.struct(F.array(F.struct(F.array(leg, leg).alias("legs"), secs.alias("sections"))).alias("routes")))
    out = ig.answers_with_legs(base.select("route_id", body.alias("body")), "body", ["route_id"])
    return out.select(
        "route_id", "route_no", F.size("line").alias("points"), "metres", "seconds", F.size("sections").alias("sections"), "violation",
        F.element_at("sections", -1)["kind"].alias("last_kind"),
    )


@query(
    "answers_with_flat_vertices",
    "select route_id, cast(16 as integer) as points, provider_route_length as metres, provider_route_time as seconds from fx_routes",
)
def answers_with_flat_vertices(t):
    base = t.fx_routes.join(t.fx_route_lines.drop("country"), "route_id")
    flat = F.flatten(F.transform(geo.points_of_wkt("provider_route"), lambda p: F.array(p["x"], p["y"])))
    road = F.struct(flat.alias("vertexes"))
    route = F.struct(F.array(F.struct(F.array(road, road).alias("roads"))).alias("sections"), F.struct(F.col("provider_route_length").alias("distance"), F.col("provider_route_time").alias("duration")).alias("summary"))
    df = base.select("route_id", F.to_json(F.struct(F.array(route).alias("routes"))).alias("body"))
    return ig.answers_with_flat_vertices(df, "body", ["route_id"]).select("route_id", F.size("line").alias("points"), "metres", "seconds")


@query(
    "answers_with_polylines",
    """select route_id, cast(n as integer) as route_no, cast(2 as integer) as points, round(provider_route_length, 6) as metres, cast(-12.02 as double) as x from fx_routes cross join (values (0), (1)) k(n)""",
)
def answers_with_polylines(t):
    trip = F.struct(F.array(F.struct(F.lit("_p~iF~ps|U_ulLnnqC").alias("shape"))).alias("legs"), F.struct((F.col("provider_route_length") / 1000).alias("length"), F.lit(9.0).alias("time")).alias("summary"))
    df = t.fx_routes.select("route_id", F.to_json(F.struct(trip.alias("trip"), F.array(F.struct(trip.alias("trip"))).alias("alternates"))).alias("body"))
    out = ig.answers_with_polylines(df, "body", ["route_id"]).select("route_id", "route_no", F.size("line").alias("points"), "metres", geo.first("line")["x"].alias("x"))
    return _round(out, 6, "metres")


@query(
    "traces_from_reports",
    "select event_id, cast(user_id as varchar) as organisation, cast(2 as integer) as points from events where event_id % 4 <> 0",
)
def traces_from_reports(t):
    rep = lambda x: F.struct(F.lit(float(x)).alias("lon"), F.col("value").alias("lat"))
    df = t.events.select("event_id", F.col("user_id").cast("string").alias("organisation"), F.when(F.col("event_id") % 4 == 0, F.array(rep(0))).otherwise(F.array(rep(0), rep(1))).alias("reports"))
    return ig.traces_from_reports(df).select("event_id", "organisation", F.size("line").alias("points"))


@query("calls_per_service", "select event_type as service, count(*) as calls from events group by event_type")
def calls_per_service(t):
    return ig.calls_per_service(t.events.withColumnRenamed("event_type", "service"))


@query(
    "enrichment_batches",
    "select cast(batch as bigint) as batch, cast(case when batch = (select (count(*) - 1) // 500 from orders) then (select (count(*) - 1) % 500 + 1 from orders) else 500 end as bigint) as n from range(0, (select (count(*) - 1) // 500 + 1 from orders)) r(batch)",
)
def enrichment_batches(t):
    return ds.batch_numbers(t.orders.select("o_orderkey"), ["o_orderkey"]).groupBy("batch").agg(F.count("*").alias("n"))


@query(
    "error_log_layout",
    """select case_id, route_id, 'tbt' as source_type, 'pl-1' as pipeline_id, 'proj' as project, 'label' as location_label, round(cast(split_part(substr(r.origin, 7), ' ', 1) as double), 6) as lon
    from fx_sections s join fx_routes r using (route_id) where s.mcp_state is null""",
)
def error_log_layout(t):
    logs = t.fx_sections.filter("mcp_state is null").select("case_id", "route_id", "run_id").join(t.fx_routes.select("route_id", "origin", "destination", "country", "provider"), "route_id")
    pipelines = t.spark.createDataFrame([("pl-1", "proj", "label"), ("pl-2", "x", "y")], "id string, project string, label string")
    out = ds.error_log_export(logs, pipelines, "pl-1")
    return out.select("case_id", "route_id", "source_type", "pipeline_id", "project", "location_label", F.round(F.element_at(F.split("origin", ", "), 2).cast("double"), 6).alias("lon"))


# ---- views -----------------------------------------------------------------------------------


@query(
    "route_summary_view",
    """select run_id, count(*) as total_routes, count(*) filter (where rac_state = 'optimal') as optimal, count(*) filter (where rac_state = 'potential_error') as potential_error,
    count(*) filter (where rac_state = 'routing_issue') as routing_issue, round(avg(provider_route_length), 4) as avg_provider_length, round(avg(competitor_route_length), 4) as avg_competitor_length from fx_routes group by run_id""",
)
def route_summary_view(t):
    return _round(rp.route_summary(t.fx_routes), 4, "avg_provider_length", "avg_competitor_length")


@query(
    "section_summary_view",
    """select run_id, count(*) as total_critical_sections, count(*) filter (where fcd_state = 'potential_error') as potential_error, count(*) filter (where fcd_state = 'no error') as no_error,
    round(avg(probability), 6) as avg_probability, round(avg(probability_new), 6) as avg_probability_new from fx_sections group by run_id""",
)
def section_summary_view(t):
    return _round(rp.section_summary(t.fx_sections, "probability", "probability_new"), 6, "avg_probability", "avg_probability_new")


FINISHED = """todo as (select distinct run_id from fx_metadata where run_id <> '1993'),
    j as (select r.run_id, r.route_id, r.provider_route_time as s, r.provider_route_length as m, x.mcp_state as e from fx_routes r left join fx_sections x on x.run_id = r.run_id and x.route_id = r.route_id and x.mcp_state is not null
          where r.run_id in (select run_id from todo)),
    p as (select run_id, route_id, min(s) as s, min(m) as m, count(*) filter (where e is not null and e <> 'discard') as n, count(*) filter (where e = 'WDTRF') as ow,
          count(*) filter (where e in ('MMAN', 'MGSC', 'MBP')) as tu, count(*) filter (where e in ('WRC', 'SGEO', 'WGEO')) as nn from j group by run_id, route_id),
    q as (select run_id, count(*) as routes, sum(n) as errors, sum(m) / 1000 as km, sum(s) / 3600 as hours, count(*) filter (where n > 0) / cast(count(*) as double) as failed, sum(ow) as ow, sum(tu) as tu, sum(nn) as nn from p group by run_id)"""


def _runs(t):
    meta = t.fx_metadata.withColumn("completed", F.lit(True))
    scored = t.fx_metadata.filter("run_id = '1993'").select("run_id")
    reviewed = t.fx_sections.filter("mcp_state is not null").select("run_id", "route_id", F.col("mcp_state").alias("error_type"))
    return t.fx_routes, reviewed, meta, scored


def _finished(t):
    return rp.score_finished_runs(*_runs(t))


@query("finished_run_intervals")
def finished_run_intervals(t):
    df = rp.finished_run_intervals(*_runs(t))
    return _round(df, 6, *(c for c in df.columns if c != "run_id"))


@query(
    "finished_run_metrics",
    f"""with {FINISHED} select run_id, cast(routes as integer) as routes, cast(errors as integer) as errors, round(km, 4) as provider_km, round(hours, 4) as provider_hours, round(failed, 6) as failed_routes,
      round(errors / hours, 6) as eph, cast(tu as bigint) as turnrest_errors, round(ow / hours, 3) as oneway_eph from q""",
)
def finished_run_metrics(t):
    df = _finished(t)
    j = "metrics_per_error_type"
    out = df.select("run_id", "routes", "errors", "provider_km", "provider_hours", "failed_routes", "eph",
                    rp.json_metric(j, "turnrest", "errors", "bigint").alias("turnrest_errors"), rp.json_metric(j, "oneway", "eph", "double", 3).alias("oneway_eph"))
    return _round(_round(out, 4, "provider_km", "provider_hours"), 6, "failed_routes", "eph")


@query(
    "published_metrics_view",
    f"""with {FINISHED}, m as (select run_id, min(country) as country, min(product) as product, max(inspection_date) as d from fx_metadata group by run_id)
    select q.run_id, m.country, w.ranking, m.product, cast(date_trunc('month', m.d) as date) as mapdate, cast(routes as integer) as routes, round(hours, 2) as hours, round(km, 2) as km, round(errors / hours, 3) as eph,
      cast(errors as integer) as errors, round(tu / hours, 3) as turnrest_eph, cast(tu as integer) as turnrest_errors, round(ow / hours, 3) as oneway_eph, cast(ow as integer) as oneway_errors,
      round(nn / hours, 3) as nonnav_eph, cast(nn as integer) as nonnav_errors from q join m using (run_id) left join fx_weights w on w.country = m.country""",
)
def published_metrics_view(t):
    meta = t.fx_metadata.groupBy("run_id").agg(F.min("country").alias("country"), F.min("product").alias("product"), F.max("inspection_date").alias("mapdate"))
    meta = meta.withColumn("sample_id", F.lit("1"))
    samples = t.spark.createDataFrame([("1", "TbT 3.0")], "sample_id string, metric string")
    metrics = _finished(t).withColumn("publish_value_stream", F.lit(True))
    return rp.published_view(metrics, meta, samples, t.fx_weights)


@query(
    "inspection_results_view",
    f"""with {FINISHED} select m.run_id, m.sample_id, m.product, case when m.sample_id = '3' then 'HDR' else 'TbT 3 (legacy)' end as sample_metric, cast(q.errors as integer) as errors, cast(4 as integer) as alpha_api_calls
    from fx_metadata m left join q using (run_id)""",
)
def inspection_results_view(t):
    samples = t.spark.createDataFrame([("3", "HDR")], "sample_id string, metric string")
    meta = t.fx_metadata.withColumn("api_calls", F.lit('{"Alpha": 4}'))
    out = rp.inspection_results(meta, samples, _finished(t).select("run_id", "errors"), ["Alpha"])
    return out.select("run_id", "sample_id", "product", "sample_metric", "errors", "alpha_api_calls")


@query(
    "json_record_filter",
    "select cast(event_id as varchar) as id, event_type from events where event_type = 'click' and cast(json_extract(props, '$.k') as bigint) = 69",
)
def json_record_filter(t):
    docs = t.events.select(F.col("event_id").cast("string").alias("id"), "event_type", F.to_json(F.struct("event_type", F.get_json_object("props", "$.k").alias("k"))).alias("data"))
    return rp.json_records(docs, "data", {"event_type": "click", "k": "69"}).select("id", "event_type")


@query("json_records_per_source", "select cast(user_id as varchar) as source, count(*) as n from events group by user_id")
def json_records_per_source(t):
    return rp.records_per(t.events.select(F.col("user_id").cast("string").alias("source")), "source")


@query(
    "morton_sorted_chunks",
    TILE + """, r as (select code, row_number() over (order by code) - 1 as rank from c)
    select cast(rank // 1000 as bigint) as chunk, count(*) as n, cast(min(code) as bigint) as first_code, cast(max(code) as bigint) as last_code from r group by 1""",
)
def morton_sorted_chunks(t):
    from waymark.functions import tiles

    p = geo.first(geo.points_of_wkt("provider_route"))
    df = t.fx_route_lines.select("route_id", p.alias("p")).select("route_id", tiles.tile_of_point(F.col("p.x"), F.col("p.y"), 14)["code"].alias("code"))
    ranked = od.numbered_by_value(df, "code", ["route_id"], "rank")
    return ranked.withColumn("chunk", F.floor(F.col("rank") / 1000)).groupBy("chunk").agg(F.count("*").alias("n"), F.min("code").alias("first_code"), F.max("code").alias("last_code"))

