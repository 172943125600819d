"""Geometry column expressions, tiles and helpers over whole tables of lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark.functions import geo, kernels as k, text as tx, tiles
from waymark.operators.barrier import explode_once
from waymark.queries import query

# Vertices of the provider and competitor lines, parsed from the same WKT text.
VERTICES = """
pv as (select route_id, i as seq,
              cast(split_part(trim(p), ' ', 1) as double) as x, cast(split_part(trim(p), ' ', 2) as double) as y
       from (select route_id, unnest(string_split(substr(provider_route, 13, length(provider_route) - 13), ',')) as p,
                    unnest(range(0, len(string_split(provider_route, ',')))) as i from fx_route_lines)),
cv as (select route_id, i as seq,
              cast(split_part(trim(p), ' ', 1) as double) as x, cast(split_part(trim(p), ' ', 2) as double) as y
       from (select route_id, unnest(string_split(substr(competitor_route, 13, length(competitor_route) - 13), ',')) as p,
                    unnest(range(0, len(string_split(competitor_route, ',')))) as i from fx_route_lines)),
ps as (select route_id, seq, x as ax, y as ay, lead(x) over w as bx, lead(y) over w as by_ from pv
       window w as (partition by route_id order by seq) qualify lead(x) over w is not null),
cs as (select route_id, seq, x as ax, y as ay, lead(x) over w as bx, lead(y) over w as by_ from cv
       window w as (partition by route_id order by seq) qualify lead(x) over w is not null)
"""


def lines(t):
    return t.fx_route_lines.select(
        "route_id", "country", geo.points_of_wkt("provider_route").alias("a"), geo.points_of_wkt("competitor_route").alias("b")
    )


def _round(df, digits, *cols):
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


@query(
    "route_haversine_length",
    f"""with {VERTICES} select route_id, round(sum(2 * 6371000.0 * atan2(sqrt(h), sqrt(1 - h))), 4) as metres
    from (select route_id, power(sin(radians(by_ - ay) / 2), 2) + cos(radians(ay)) * cos(radians(by_)) *
                 power(sin(radians(bx - ax) / 2), 2) as h from ps) group by route_id""",
)
def route_haversine_length(t):
    return _round(lines(t).select("route_id", geo.haversine_length("a").alias("metres")), 4, "metres")


@query("route_geodesic_length")
def route_geodesic_length(t):
    df = lines(t).select("route_id", k.geodesic_length("a").alias("metres"), geo.bearing("a").alias("bearing"))
    return _round(df, 4, "metres", "bearing")


@query(
    "route_headings",
    f"""with {VERTICES}, e as (select route_id, arg_min(x, seq) as x0, arg_min(y, seq) as y0, arg_max(x, seq) as x1,
        arg_max(y, seq) as y1 from pv group by route_id),
    h as (select route_id, degrees(atan2(cos(radians(y1)) * sin(radians(x1 - x0)), cos(radians(y0)) * sin(radians(y1))
          - sin(radians(y0)) * cos(radians(y1)) * cos(radians(x1 - x0)))) as heading,
          degrees(atan2(y1 - y0, x1 - x0)) - 90 as raw from e)
    select route_id, round(heading, 6) as heading, round(raw - 360 * floor(raw / 360), 6) as angle,
           round((heading - 350 + 180) - 360 * floor((heading - 350 + 180) / 360) - 180, 6) as difference from h""",
)
def route_headings(t):
    df = lines(t).select(
        "route_id", geo.line_heading("a").alias("heading"),
        geo.planar_angle(geo.first("a"), geo.last("a")).alias("angle"),
        geo.angle_difference(geo.line_heading("a"), F.lit(350.0)).alias("difference"),
    )
    return _round(df, 6, "heading", "angle", "difference")


@query(
    "route_bounding_boxes",
    f"""with {VERTICES} select route_id, round(min(x) - 0.0001, 6) as min_x, round(min(y) - 0.0001, 6) as min_y,
    round(max(x) + 0.0001, 6) as max_x, round(max(y) + 0.0001, 6) as max_y from pv group by route_id""",
)
def route_bounding_boxes(t):
    df = lines(t).select("route_id", geo.bbox("a", 0.0001).alias("q")).select("route_id", "q.*")
    return _round(df, 6, "min_x", "min_y", "max_x", "max_y")


@query(
    "route_hausdorff",
    f"""with {VERTICES},
    d as (select p.route_id, p.seq, 0 as side, min(sqrt(power(p.x - ax - u * (bx - ax), 2) + power(p.y - ay - u * (by_ - ay), 2))) as d
          from (select pv.route_id, pv.seq, pv.x, pv.y, ax, ay, bx, by_, least(1, greatest(0, ((pv.x - ax) * (bx - ax) + (pv.y - ay) * (by_ - ay))
                / (power(bx - ax, 2) + power(by_ - ay, 2)))) as u from pv join cs using (route_id)) p group by 1, 2
          union all
          select p.route_id, p.seq, 1, min(sqrt(power(p.x - ax - u * (bx - ax), 2) + power(p.y - ay - u * (by_ - ay), 2)))
          from (select cv.route_id, cv.seq, cv.x, cv.y, ax, ay, bx, by_, least(1, greatest(0, ((cv.x - ax) * (bx - ax) + (cv.y - ay) * (by_ - ay))
                / (power(bx - ax, 2) + power(by_ - ay, 2)))) as u from cv join ps using (route_id)) p group by 1, 2)
    select route_id, round(max(d), 8) as distance from d group by route_id""",
)
def route_hausdorff(t):
    return _round(lines(t).select("route_id", k.hausdorff("a", "b").alias("distance")), 8, "distance")


# Span of positions on each segment of one line near each segment of the other: two discs and a slab.
def _near_sql(one, other, r):
    return f"""
    pr_{one} as (select p.route_id, p.seq, p.ax, p.ay, p.bx - p.ax as dx, p.by_ - p.ay as dy, q.seq as qseq,
               q.ax as qx, q.ay as qy, q.bx as rx, q.by_ as ry, sqrt(power(q.bx - q.ax, 2) + power(q.by_ - q.ay, 2)) as ql
        from {one} p join {other} q using (route_id)),
    pd_{one} as (select *, dx * dx + dy * dy as a,
               (ax - qx) * dx + (ay - qy) * dy as b1, power(ax - qx, 2) + power(ay - qy, 2) - {r} * {r} as c1,
               (ax - rx) * dx + (ay - ry) * dy as b2, power(ax - rx, 2) + power(ay - ry, 2) - {r} * {r} as c2,
               ((ax - qx) * (rx - qx) + (ay - qy) * (ry - qy)) / ql as u0, (dx * (rx - qx) + dy * (ry - qy)) / ql as du,
               (-(ax - qx) * (ry - qy) + (ay - qy) * (rx - qx)) / ql as v0, (-dx * (ry - qy) + dy * (rx - qx)) / ql as dv
        from pr_{one}),
    sp_{one} as (
        select route_id, seq, (-b1 - sqrt(b1 * b1 - a * c1)) / a as lo, (-b1 + sqrt(b1 * b1 - a * c1)) / a as hi
        from pd_{one} where b1 * b1 - a * c1 >= 0
        union all
        select route_id, seq, (-b2 - sqrt(b2 * b2 - a * c2)) / a, (-b2 + sqrt(b2 * b2 - a * c2)) / a
        from pd_{one} where b2 * b2 - a * c2 >= 0
        union all
        select route_id, seq,
            greatest(case when du = 0 then -1e9 else least((0 - u0) / du, (ql - u0) / du) end,
                     case when dv = 0 then -1e9 else least((-{r} - v0) / dv, ({r} - v0) / dv) end),
            least(case when du = 0 then 1e9 else greatest((0 - u0) / du, (ql - u0) / du) end,
                  case when dv = 0 then 1e9 else greatest((-{r} - v0) / dv, ({r} - v0) / dv) end)
        from pd_{one} where (du <> 0 or (u0 >= 0 and u0 <= ql)) and (dv <> 0 or abs(v0) <= {r})),
    cl_{one} as (select route_id, seq, greatest(lo, 0) as lo, least(hi, 1) as hi from sp_{one} where lo <= hi and hi >= 0 and lo <= 1),
    rn_{one} as (select *, max(hi) over (partition by route_id, seq order by lo, hi rows between unbounded preceding and 1 preceding) as reach
        from cl_{one}),
    gp_{one} as (select route_id, seq, sum(greatest(0, lo - coalesce(reach, 0))) + (1 - max(greatest(hi, coalesce(reach, 0)))) as gap
        from rn_{one} group by route_id, seq),
    aw_{one} as (select s.route_id, sum(coalesce(g.gap, 1) * sqrt(power(s.bx - s.ax, 2) + power(s.by_ - s.ay, 2))) as away,
                        max(coalesce(g.gap, 1)) as worst
        from {one} s left join gp_{one} g using (route_id, seq) group by s.route_id)
    """


@query(
    "route_mutual_containment",
    f"""with {VERTICES}, {_near_sql('ps', 'cs', 0.0002)}, {_near_sql('cs', 'ps', 0.0002)}
    select p.route_id, p.worst < 1e-6 and c.worst < 1e-6 as same_route, round(p.away, 6) as provider_away, round(c.away, 6) as competitor_away
    from aw_ps p join aw_cs c using (route_id)""",
)
def route_mutual_containment(t):
    def away(a, b):
        return F.aggregate(k.spans_away(a, b, F.lit(0.0002)), F.lit(0.0), lambda acc, s: acc + s["e"] - s["s"])

    df = lines(t).select(
        "route_id", geo.equal_within("a", "b", 0.0002).alias("same_route"),
        away("a", "b").alias("provider_away"), away("b", "a").alias("competitor_away"),
    )
    return _round(df, 6, "provider_away", "competitor_away")


@query(
    "route_touches",
    f"""with {VERTICES}, {_near_sql('ps', 'cs', 0.0002)}
    select route_id, count(cl.seq) > 0 as touches from fx_route_lines left join cl_ps cl using (route_id) group by route_id""",
)
def route_touches(t):
    return lines(t).select("route_id", geo.touches_within("a", "b", 0.0002).alias("touches"))


@query(
    "route_rounded_wkt_parse",
    f"""with {VERTICES} select route_id, seq, round(x, 2) as x, round(y, 2) as y from pv""",
)
def route_rounded_wkt_parse(t):
    df = lines(t).select("route_id", F.posexplode(geo.round_points("a", 2)).alias("seq", "p"))
    return df.select("route_id", F.col("seq").cast("bigint").alias("seq"), "p.x", "p.y")


@query(
    "route_combined",
    f"""with {VERTICES}, n as (select route_id, count(*) as np from pv group by route_id), m as (select route_id, count(*) as nc from cv group by route_id)
    select route_id, np, nc, np + nc as joined, round(p1.x, 6) as first_x, round(c1.y, 6) as last_y, cast(3 as integer) as sub_points
    from n join m using (route_id) join pv p1 using (route_id) join cv c1 using (route_id) where p1.seq = 0 and c1.seq = nc - 1""",
)
def route_combined(t):
    df = lines(t).select(
        "route_id", F.size("a").cast("bigint").alias("np"), F.size("b").cast("bigint").alias("nc"),
        geo.combine_lines("a", "b").alias("c"), geo.subroute("a", F.lit(2), F.lit(4)).alias("s"),
    )
    df = df.select(
        "route_id", "np", "nc", F.size("c").cast("bigint").alias("joined"), geo.first("c")["x"].alias("first_x"),
        geo.last("c")["y"].alias("last_y"), F.size("s").alias("sub_points"),
    )
    return _round(df, 6, "first_x", "last_y")


@query(
    "route_nearest_end_join",
    f"""with {VERTICES}, e as (select p.route_id, p.fx, p.fy, p.lx, p.ly, c.fx as cfx, c.fy as cfy, c.lx as clx, c.ly as cly from
      (select route_id, arg_min(x, seq) as fx, arg_min(y, seq) as fy, arg_max(x, seq) as lx, arg_max(y, seq) as ly from pv group by route_id) p join
      (select route_id, arg_min(x, seq) as fx, arg_min(y, seq) as fy, arg_max(x, seq) as lx, arg_max(y, seq) as ly from cv group by route_id) c using (route_id)),
    d as (select *, sqrt(power(fx - cfx, 2) + power(fy - cfy, 2)) as d0, sqrt(power(fx - clx, 2) + power(fy - cly, 2)) as d1,
          sqrt(power(lx - cfx, 2) + power(ly - cfy, 2)) as d2, sqrt(power(lx - clx, 2) + power(ly - cly, 2)) as d3 from e),
    k as (select *, least(d0, d1, d2, d3) as dm from d)
    select route_id, round(case when d0 = dm or d1 = dm then lx else fx end, 6) as first_x,
      round(case when d0 = dm then clx when d1 = dm then cfx when d2 = dm then clx else cfx end, 6) as last_x from k""",
)
def route_nearest_end_join(t):
    df = lines(t).select("route_id", geo.join_nearest_ends("a", "b").alias("j"))
    df = df.select("route_id", geo.first("j")["x"].alias("first_x"), geo.last("j")["x"].alias("last_x"))
    return _round(df, 6, "first_x", "last_x")


@query(
    "route_continuity",
    f"""with {VERTICES}, l as (select route_id, degrees(atan2(by_ - ay, bx - ax)) - 90 as a from ps where seq = 6),
    f as (select route_id, degrees(atan2(by_ - ay, bx - ax)) - 90 as b from cs where seq = 0),
    d as (select route_id, a - b + 180 as r from l join f using (route_id))
    select route_id, abs(r - 360 * floor(r / 360) - 180) < 5 as continuous from d""",
)
def route_continuity(t):
    return lines(t).select("route_id", geo.is_continuous("a", "b").alias("continuous"))


@query(
    "route_same_direction",
    f"""with {VERTICES}, st as (select *, sqrt(power(bx - ax, 2) + power(by_ - ay, 2)) as len from cs),
    cu as (select *, sum(len) over (partition by route_id order by seq) - len as before from st),
    ends as (select route_id, seq, x as px, y as py from pv where seq in (0, 7)),
    u as (select c.*, e.seq as e, px, py, least(1, greatest(0, ((px - ax) * (bx - ax) + (py - ay) * (by_ - ay)) / (len * len))) as u from cu c join ends e using (route_id)),
    best as (select route_id, e, arg_min(before + u * len, power(px - ax - u * (bx - ax), 2) + power(py - ay - u * (by_ - ay), 2)) as pos from u group by route_id, e)
    select a.route_id, a.pos < b.pos as forward, b.pos < a.pos as backward from best a join best b on a.route_id = b.route_id and a.e = 0 and b.e = 7""",
)
def route_same_direction(t):
    return lines(t).select(
        "route_id", geo.same_direction("a", "b").alias("forward"), geo.same_direction(F.reverse("a"), F.col("b")).alias("backward")
    )


LOCATE = f"""with {VERTICES}, mid as (select route_id, x as px, y as py from cv where seq = 3),
    st as (select *, sqrt(power(bx - ax, 2) + power(by_ - ay, 2)) as len from ps),
    cu as (select *, sum(len) over (partition by route_id order by seq) - len as before from st),
    u as (select c.*, px, py, least(1, greatest(0, ((px - ax) * (bx - ax) + (py - ay) * (by_ - ay)) / (len * len))) as u from cu c join mid using (route_id)),
    best as (select route_id, arg_min(before + u * len, power(px - ax - u * (bx - ax), 2) + power(py - ay - u * (by_ - ay), 2)) as pos,
                    sum(len) as total from u group by route_id),
    goal as (select route_id, pos, total, least(pos + 0.1 * total, total) as nxt from best)
    select g.route_id, round(any_value(g.pos), 7) as position,
      round(arg_max(c.ax + (c.bx - c.ax) * (g.nxt - c.before) / c.len, c.before) filter (where c.before <= g.nxt), 7) as next_x
    from goal g join cu c on g.route_id = c.route_id group by g.route_id"""


@query("route_following_point", LOCATE)
def route_following_point(t):
    df = lines(t).withColumn("p", F.element_at("b", 4)).select(
        "route_id", k.project("a", F.col("p.x"), F.col("p.y")).alias("position"),
        geo.following_point("a", F.col("p"))["x"].alias("next_x"),
    )
    return _round(df, 7, "position", "next_x")


@query("route_point_bearing")
def route_point_bearing(t):
    df = lines(t).withColumn("p", F.element_at("b", 4)).select(
        "route_id", geo.point_bearing(F.col("p"), "a", F.lit(12.0)).alias("bearing"),
        geo.planar_length(geo.direction_segment(F.col("p"), "a")).alias("segment_length"),
    )
    return _round(df, 6, "bearing", "segment_length")


@query("route_simplified")
def route_simplified(t):
    return lines(t).select(
        "route_id", F.size(k.simplify("b", F.lit(0.0001))).alias("points"),
        F.size(k.simplify_to("b", F.lit(4.0))).alias("at_most_four"),
    )


@query(
    "route_curvature_radius",
    f"""with {VERTICES}, v as (select route_id, {", ".join(f"max({c}) filter (where seq = {i}) as {c}{i}" for i in (0, 3, 4, 7) for c in "xy")} from pv group by route_id),
    m as (select route_id, true as east, x0 as fx, y0 as fy, x7 as lx, y7 as ly, x4 as mx, y4 as my from v
      union all select route_id, false, x7, y7, x0, y0, x3, y3 from v),
    s as (select route_id, east, sqrt(power(lx - fx, 2) + power(fy - ly, 2)) as chord,
      (lx - fx) / sqrt(power(lx - fx, 2) + power(fy - ly, 2)) * (case when mx > lx then ly when mx < fx then fy else my end - my) as h from m)
    select route_id, east, case when h = 0 then -1 else round(abs(chord * chord / 8 / h + h / 2) * 1000000, 2) end as radius from s""",
)
def route_curvature_radius(t):
    """Lines as they are and turned round; -1 stands for no curvature."""
    one = lines(t).select("route_id", F.explode(F.array(F.struct(F.lit(True).alias("east"), F.col("a").alias("p")), F.struct(F.lit(False).alias("east"), F.reverse("a").alias("p")))).alias("d"))
    r = geo.curvature_radius_m("d.p")
    return one.select("route_id", "d.east", F.when(F.isnan(r) | (r == float("inf")), -1.0).otherwise(F.round(r, 2)).alias("radius"))


@query(
    "trace_time_and_speed",
    """with e as (select user_id, min(epoch_us(ts)) / 1000000.0 as t0, max(epoch_us(ts)) / 1000000.0 as t1 from events group by user_id)
    select cast(user_id as varchar) as org, round(t1 - t0, 3) as seconds,
           round(case when abs(t1 - t0) <= 0.001 then 0 else 1000.0 / (t1 - t0) end, 8) as speed from e""",
)
def trace_time_and_speed(t):
    # First and last report only: the trace itself is never collected.
    ends = t.events.groupBy(F.col("user_id").cast("string").alias("org")).agg(
        F.array(*[F.struct((F.unix_micros(f("ts").cast("timestamp")) / 1e6).alias("t")) for f in (F.min, F.max)]).alias("trace")
    )
    df = ends.select("org", geo.trace_seconds("trace").alias("seconds"), geo.trace_speed("trace", F.lit(1000.0)).alias("speed"))
    return _round(_round(df, 3, "seconds"), 8, "speed")


def _interleave_sql(x, y):
    return " + ".join(f"(((({x}) >> {b}) & 1) << {2 * b}) + (((({y}) >> {b}) & 1) << {2 * b + 1})" for b in range(14))


TILE = f"""with {VERTICES}, o as (select route_id, x, y from pv where seq = 0),
    g as (select route_id, cast(floor((x + 180) / (360.0 / 16384)) as bigint) as tx, cast(floor((y + 90) / (360.0 / 32768)) as bigint) as ty from o),
    c as (select *, {_interleave_sql('tx', 'ty')} as code from g)"""


@query(
    "tile_codes",
    TILE + """ select route_id, cast(code as bigint) as code, tx as x, ty as y, cast(code >> 4 as bigint) as grandparent, lower(to_hex(code)) as hex,
      cast((code + 1) << 2 as bigint) - 1 as last_child, ceil(tx * (360.0 / 16384 * 1e7) - 180 * 1e7) / 1e7 as min_x,
      ceil((ty + 1) * (360.0 / 32768 * 1e7) - 90 * 1e7) / 1e7 as max_y from c""",
)
def tile_codes(t):
    p = geo.first("a")
    df = lines(t).select("route_id", tiles.tile_of_point(p["x"], p["y"], 14).alias("t"))
    b = tiles.tile_bounds(F.col("t"), 14)
    return df.select(
        "route_id", "t.code", "t.x", "t.y", tiles.parent_code(F.col("t.code"), 2).alias("grandparent"),
        tiles.code_hex(F.col("t.code")).alias("hex"), F.element_at(tiles.child_codes(F.col("t.code")), -1).alias("last_child"),
        b["min_x"].alias("min_x"), b["max_y"].alias("max_y"),
    )


@query(
    "tile_round_trip",
    TILE + " select count(*) as routes, count(*) as same, cast(sum(tx) as bigint) as sum_x, cast(sum(ty) as bigint) as sum_y from c",
)
def tile_round_trip(t):
    p = geo.first("a")
    df = lines(t).select(tiles.tile_of_point(p["x"], p["y"], 14).alias("t"))
    df = df.withColumn("u", tiles.tile_of_code(F.col("t.code"), 14))
    return df.agg(
        F.count("*").alias("routes"), F.count_if(F.col("t") == F.col("u")).alias("same"),
        F.sum("u.x").alias("sum_x"), F.sum("u.y").alias("sum_y"),
    )


@query(
    "tile_covering",
    f"""with {VERTICES}, b as (select route_id, min(x) as x0, max(x) as x1, min(y) as y0, max(y) as y1 from pv group by route_id)
    select route_id, cast((floor((x1 + 180) / (360.0 / 16384)) - floor((x0 + 180) / (360.0 / 16384)) + 1) *
      (floor((y1 + 90) / (360.0 / 32768)) - floor((y0 + 90) / (360.0 / 32768)) + 1) as bigint) as tiles from b""",
)
def tile_covering(t):
    df = lines(t).select("route_id", geo.bbox("a").alias("q"))
    return df.select("route_id", F.explode(tiles.covering(F.col("q.min_x"), F.col("q.max_x"), F.col("q.min_y"), F.col("q.max_y"), 14))).groupBy("route_id").agg(
        F.count("*").alias("tiles")
    )


@query(
    "cells_along_lines",
    f"""with {VERTICES}, c as (select distinct route_id, cast(floor((x + 180) / (360.0 / 16384)) as bigint) as tx, cast(floor((y + 90) / (360.0 / 32768)) as bigint) as ty from pv),
    o as (select unnest([-1, 0, 1]) as d), r as (select distinct route_id, tx + a.d as tx, ty + b.d as ty from c, o a, o b)
    select route_id, count(*) as cells from r group by route_id""",
)
def cells_along_lines(t):
    # A line's vertices share most of their tiles, so they are told apart inside its row before any shuffle.
    met = F.array_distinct(F.transform("a", lambda p: tiles.tile_of_point(p["x"], p["y"], 14)))
    df = lines(t).select("route_id", met.alias("t"))
    df = explode_once(df, "t", "t")
    rings = df.select("route_id", F.explode(tiles.ring(F.col("t"), 14, 1)).alias("n"))
    return rings.select("route_id", "n.code").distinct().groupBy("route_id").agg(F.count("*").alias("cells"))


@query(
    "span_union",
    """with s as (select l_orderkey as k, l_partkey % 100 as b, l_partkey % 100 + l_quantity as e from lineitem),
    m as (select *, max(e) over (partition by k order by b, e rows between unbounded preceding and 1 preceding) as reach from s),
    g as (select *, sum(case when reach >= b then 0 else 1 end) over (partition by k order by b, e) as grp from m),
    u as (select k, grp, min(b) as b, max(e) as e from g group by k, grp)
    select k, count(*) as spans, round(sum(e - b), 4) as covered from u group by k""",
)
def span_union(t):
    # Spans of one route are a bounded list in its row.
    spans = F.struct((F.col("l_partkey") % 100).cast("double").alias("s"), (F.col("l_partkey") % 100 + F.col("l_quantity")).cast("double").alias("e"))
    df = t.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_list(spans).alias("sp"))
    df = df.withColumn("u", geo.merge_spans("sp"))
    return _round(
        df.select("k", F.size("u").cast("bigint").alias("spans"), F.aggregate("u", F.lit(0.0), lambda acc, s: acc + s["e"] - s["s"]).alias("covered")),
        4, "covered",
    )


# ---- text and tags --------------------------------------------------------------------------


@query(
    "lane_derivations",
    """select way_id, cast(case when bus_lanes = hov_lanes then 0 when b = 0 then 0 when h = 0 then b
         when len(bl) = len(hl) then list_count(list_filter(range(1, len(bl) + 1), lambda i: bl[i] = 'designated' and hl[i] <> 'designated')) else 0 end as integer) as bus_only,
       cast(h as integer) as hov, cast(a as integer) as psv_only, coalesce(oneway in ('reversible', 'alternating', 'conditional'), false) as bidirectional
    from (select *, coalesce(len(regexp_extract_all(bus_lanes, 'designated')), 0) as b, coalesce(len(regexp_extract_all(hov_lanes, 'designated')), 0) as h,
          coalesce(len(regexp_extract_all(access_lanes, 'no|psv|bus|taxi')), 0) as a, string_split(bus_lanes, '|') as bl, string_split(hov_lanes, '|') as hl from fx_tags)""",
)
def lane_derivations(t):
    return t.fx_tags.select(
        "way_id", tx.bus_only_lanes("bus_lanes", "hov_lanes").alias("bus_only"), tx.designated_lanes("hov_lanes").alias("hov"),
        tx.restricted_lanes("access_lanes").alias("psv_only"), tx.is_reversible("oneway").alias("bidirectional"),
    )


@query(
    "tag_map_filtered",
    """select p_partkey as way_id, p_brand as brand, cast(null as varchar) as size, 2 as n from part""",
)
def tag_map_filtered(t):
    flat = F.array(F.lit("brand"), F.col("p_brand"), F.lit("size"), F.col("p_size").cast("string"), F.lit("brand:old"), F.lit("x"), F.lit("dangling"))
    df = t.part.select(F.col("p_partkey").alias("way_id"), tx.tag_map(flat, "^brand").alias("m"))
    return df.select("way_id", F.col("m")["brand"].alias("brand"), F.col("m")["size"].alias("size"), F.size("m").alias("n"))


@query(
    "json_pack",
    """select p_partkey, case when p_size % 2 = 1 then '{"p_brand":"' || p_brand || '","p_size":' || p_size || '}'
    else '{"p_size":' || p_size || '}' end as tags from part""",
)
def json_pack(t):
    df = t.part.select("p_partkey", F.when(F.col("p_size") % 2 == 1, F.col("p_brand")).alias("p_brand"), "p_size")
    return tx.pack_json(df, ["p_partkey"])


@query(
    "json_unpack",
    "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events",
)
def json_unpack(t):
    return tx.unpack_json(t.events.select("event_id", "props"), "props", "k bigint")


@query(
    "json_update",
    """select event_id, cast(json_extract(props, '$.k') as bigint) as k, cast(event_id % 7 as bigint) as seen from events where event_id % 3 <> 0
    union all select event_id, cast(event_id % 5 as bigint), cast(event_id % 7 as bigint) from events where event_id % 3 = 0""",
)
def json_update(t):
    new = F.when(F.col("event_id") % 3 == 0, F.to_json(F.struct((F.col("event_id") % 5).alias("k"), (F.col("event_id") % 7).alias("seen")))).otherwise(
        F.to_json(F.struct((F.col("event_id") % 7).alias("seen")))
    )
    df = t.events.select("event_id", tx.update_tags("props", new).alias("j"))
    return tx.unpack_json(df, "j", "k bigint, seen bigint")


@query(
    "json_path_values",
    "select event_type, cast(sum(cast(json_extract(props, '$.k') as bigint)) as bigint) as total from events group by event_type",
)
def json_path_values(t):
    return t.events.groupBy("event_type").agg(F.sum(F.get_json_object("props", "$.k").cast("bigint")).alias("total"))


@query(
    "joined_columns",
    "select case_id, case when mcp_state is not null and error_subtype is not null then mcp_state || '_' || error_subtype else 'none' end as code from fx_sections",
)
def joined_columns(t):
    return t.fx_sections.select("case_id", tx.join_columns(["mcp_state", "error_subtype"], "none").alias("code"))


@query(
    "point_text_export",
    "select route_id, cast(round(cast(split_part(substr(origin, 7), ' ', 1) as double), 6) as double) as lon, origin is not null as present from fx_routes",
)
def point_text_export(t):
    # "lat, lon" text back to a number, so that the number formats of two engines do not matter.
    df = t.fx_routes.withColumn("latlon", tx.point_as_lat_lon("origin"))
    return df.select(
        "route_id", F.round(F.element_at(F.split("latlon", ", "), 2).cast("double"), 6).alias("lon"), F.col("latlon").isNotNull().alias("present")
    )


@query(
    "date_rules",
    """select case_id, inspection_date - 14 as trace_start, cast(date_trunc('month', inspection_date) as date) as month_start,
    cast(case when isodow(inspection_date) = 1 then inspection_date else inspection_date + cast(8 - isodow(inspection_date) as integer) end as date) as monday
    from fx_sections""",
)
def date_rules(t):
    return t.fx_sections.select(
        "case_id", F.date_sub("inspection_date", 14).alias("trace_start"), F.trunc("inspection_date", "month").alias("month_start"),
        tx.next_monday("inspection_date").alias("monday"),
    )


@query(
    "reproducible_ids",
    """select p_partkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) as id
    from (select p_partkey, sha256(p_brand || cast(p_partkey as varchar) || 'True') as h from part)""",
)
def reproducible_ids(t):
    return t.part.select("p_partkey", tx.reproducible_uuid(F.col("p_brand"), F.col("p_partkey"), F.lit("True")).alias("id"))


# ---- polygons and groups --------------------------------------------------------------------

@query(
    "lines_in_region",
    f"""with {VERTICES}, s as (select *, bx - ax as dx, by_ - ay as dy from ps),
    c as (select route_id, seq, ax, ay, dx, dy, greatest(0, case when dx = 0 then 0 else (0.004 - ax) / dx end, case when dy = 0 then 0 when dy > 0 then (40.0 - ay) / dy else (46.55 - ay) / dy end) as t0,
            least(1, case when dx = 0 then 1 else (12.005 - ax) / dx end, case when dy = 0 then 1 when dy > 0 then (46.55 - ay) / dy else (40.0 - ay) / dy end) as t1 from s
          where not (dy = 0 and (ay > 46.55 or ay < 40.0))),
    r as (select route_id, sum(sqrt(dx * dx + dy * dy) * (t1 - t0)) as inside from c where t1 > t0 group by route_id)
    select route_id, round(coalesce(inside, 0), 6) as inside from fx_route_lines left join r using (route_id)""",
)
def lines_in_region(t):
    ring = F.array(*[geo.point(F.lit(x), F.lit(y)) for x, y in [(0.004, 40.0 - 1e-7), (12.005, 40.0 - 1e-7), (12.005, 46.55), (0.004, 46.55)]])
    parts = geo.lines_in_polygon(lines(t).select("route_id", "a").withColumn("ring", ring), "a", "ring")
    out = parts.groupBy("route_id").agg(F.sum(geo.planar_length("part")).alias("inside"))
    return _round(out, 6, "inside")


@query(
    "merged_group_lines",
    f"""with {VERTICES} select route_id, cast(count(*) as integer) as points from pv group by route_id""",
)
def merged_group_lines(t):
    # Segments of each route as separate lines, chained again in order.
    parts = lines(t).select("route_id", F.posexplode(geo.segments("a")).alias("seq", "s")).select("route_id", "seq", F.array("s.a", "s.b").alias("line"))
    merged = geo.merge_group_lines(parts, ["route_id"], "seq", "line")
    return merged.select("route_id", F.size("line").alias("points"))
