"""Inspection jobs, joins, dedup, sampling and views."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark import schemas, values as v
from waymark.functions import geo, text as tx
from waymark.operators import order as od, quality as ql
from waymark.plans import inspection as ins, sampling as sp
from waymark.queries import query
from waymark.queries.geometry import VERTICES

_H = "cast('0x' || substr(md5('{seed}|' || {id}), 1, 15) as bigint)"
_U = "(" + _H + " / 1152921504606846976.0)"


def H(id_, seed=0):
    return _H.format(seed=seed, id=id_)


def U(id_, seed=0):
    return _U.format(seed=seed, id=id_)


def _round(df, digits, *cols):
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---- predicates and labels -------------------------------------------------------------------


@query(
    "sample_metric",
    "select sample_id, case when bool_or(product <> 'G1' or product is null) then 'HDR' else 'TbT' end as metric from fx_metadata group by sample_id",
)
def sample_metric(t):
    meta = t.fx_metadata.withColumn("metric", F.when(F.col("product") == "G1", "TbT 3.0").otherwise("HDR"))
    # The smallest metric text of a sample counts; 'HDR' sorts before 'TbT 3.0'.
    return ins.sample_metric(meta)


@query(
    "error_labels",
    """select case_id, case when mcp_state in ('discard') then 'no_error' else 'error' end as error_label,
    coalesce(mcp_state, 'discard') as error_type, case when run_id in ('1995', '1996') then 'HDR' else 'TbT' end as metric from fx_sections""",
)
def error_labels(t):
    from waymark.plans.training import error_label

    df = t.fx_sections.withColumn("m", F.when(F.col("run_id").isin("1995", "1996"), "HDR_v2").otherwise("TbT"))
    return df.select(
        "case_id", error_label("mcp_state").alias("error_label"), F.coalesce("mcp_state", F.lit(v.DISCARD)).alias("error_type"),
        ins.metric_family("m").alias("metric"),
    )


FEEDBACK = "((mcp_state is not null and mcp_state <> 'MBP') or (mcp_state = 'MBP' and error_subtype = 'NO-TEMP'))"


@query(
    "feedback_and_logs",
    f"""select fcd_state, mcp_state is null as open, count(*) filter (where {FEEDBACK}) as feedback,
    count(*) filter (where mcp_state is null and (not {FEEDBACK} or fcd_state = 'potential_error')) as logs
    from fx_sections group by fcd_state, mcp_state is null""",
)
def feedback_and_logs(t):
    return t.fx_sections.groupBy("fcd_state", F.col("mcp_state").isNull().alias("open")).agg(
        F.count_if(ins.is_feedback()).alias("feedback"), F.count_if(ins.is_error_log()).alias("logs")
    )


@query(
    "road_importance",
    """with m(code, level) as (values ('ECONOMY', 'High'), ('LARGE', 'Low'), ('MEDIUM', 'Medium'))
    select coalesce(level, 'none') as importance, count(*) as n from part left join m on p_type = code group by 1""",
)
def road_importance(t):
    # Road classes stand for part types here; the real table maps class names the same way.
    names = {"ECONOMY": "primary", "LARGE": "service", "MEDIUM": "track"}
    rows = [(cls, level) for level, classes in v.ROAD_IMPORTANCE.items() for cls in classes]
    classes = t.spark.createDataFrame(rows, "road_class string, importance string")
    df = t.part.replace(names, subset=["p_type"]).withColumnRenamed("p_type", "road_class")
    joined = df.join(F.broadcast(classes), "road_class", "left")
    return joined.groupBy(F.coalesce("importance", F.lit("none")).alias("importance")).agg(F.count("*").alias("n"))


@query(
    "driving_side",
    """select country, cast(case when country in ('NATION_3', 'NATION_7') then 1.0 else 0.0 end as double) as drive_left_side,
    cast(case when country in ('NATION_3', 'NATION_7') then 0.0 else 1.0 end as double) as drive_right_side from fx_weights""",
)
def driving_side(t):
    from waymark.plans.features import general_features

    codes = t.fx_weights.select("country", F.when(F.col("country") == "NATION_3", "GBR").when(F.col("country") == "NATION_7", "JPN").otherwise("DEU").alias("iso"))
    side = general_features(F.col("iso"), F.lit(v.METRIC_DEFAULT))
    return codes.select("country", side["drive_left_side"].alias("drive_left_side"), side["drive_right_side"].alias("drive_right_side"))


# ---- joins -----------------------------------------------------------------------------------


@query(
    "error_log_enriched",
    f"""select s.run_id, s.route_id, s.case_id, r.country, r.provider, r.competitor, r.origin, 'O1' as product
    from fx_sections s left join fx_routes r on s.run_id = r.run_id and s.route_id = r.route_id
    where s.mcp_state is null and (not {FEEDBACK.replace('mcp_state', 's.mcp_state').replace('error_subtype', 's.error_subtype')} or s.fcd_state = 'potential_error')""",
)
def error_log_enriched(t):
    logs = t.fx_sections.filter(ins.is_error_log()).select("run_id", "route_id", "case_id")
    routes = t.fx_routes.select("run_id", "route_id", "country", "provider", "competitor", "origin")
    return logs.join(routes, ["run_id", "route_id"], "left").withColumn("product", F.lit("O1"))


HISTORY = """
hist as (select r.sample_id, r.route_id, r.competitor, r.country, 'h1' as run_id, l.competitor_route as old_route, r.rac_state
         from fx_routes r join fx_route_lines l using (route_id)
         union all
         select r.sample_id, r.route_id, r.competitor, r.country, 'h2', l.provider_route, r.rac_state
         from fx_routes r join fx_route_lines l using (route_id) where r.country < 'NATION_3'),
fb as (select distinct 'h1' as run_id, route_id from fx_sections where mcp_state is not null),
m as (select h.*, fb.route_id is not null as reviewed, case h.run_id when 'h1' then date '2024-01-01' else date '2024-02-01' end as d
      from hist h join fx_route_lines l using (route_id) left join fb on fb.run_id = h.run_id and fb.route_id = h.route_id
      where l.provider_route = h.old_route),
best as (select * from m qualify row_number() over (partition by sample_id, route_id, competitor, country
                                                   order by reviewed desc, d desc, run_id) = 1)
"""


def _reuse(t, **kw):
    base = t.fx_routes.join(t.fx_route_lines.drop("country"), "route_id")
    routes = base.select(*ins.ROUTE_KEYS, "provider_route", "provider_route_length", "provider")
    cols = [*ins.ROUTE_KEYS, "rac_state", "competitor_route", "competitor_route_length", "competitor_route_time"]
    h1 = base.select(*cols, F.lit("h1").alias("run_id"), F.col("competitor_route").alias("provider_route"))
    h2 = base.filter("country < 'NATION_3'").select(*cols, F.lit("h2").alias("run_id"), "provider_route")
    sections = t.fx_sections.select(
        F.lit("h1").alias("run_id"), "route_id", "case_id", "fcd_state", "stretch_length", "reference_case_id", "mcp_state", "error_subtype"
    )
    feedback = sections.filter("mcp_state is not null").select("run_id", "route_id", "case_id", "mcp_state", "reference_case_id", "error_subtype")
    meta = t.spark.sql("select * from values ('h1', date'2024-01-01'), ('h2', date'2024-02-01') as m(run_id, inspection_date)")
    return ins.reuse_static_routes(routes, h1.unionByName(h2), sections.drop("mcp_state", "error_subtype"), feedback, meta, "new", **kw)


@query(
    "reuse_known_routes",
    f"with {HISTORY} select route_id, sample_id, competitor, country, run_id, rac_state from best where rac_state is not null",
)
def reuse_known_routes(t):
    return _reuse(t)[1].select("route_id", "sample_id", "competitor", "country", "run_id", "rac_state")


@query(
    "reuse_unknown_routes",
    f"with {HISTORY} select route_id, country from fx_routes where route_id not in (select route_id from best where rac_state is not null)",
)
def reuse_unknown_routes(t):
    return _reuse(t)[0].select("route_id", "country")


@query(
    "reuse_known_sections",
    f"""with {HISTORY}, k as (select route_id, run_id from best where rac_state is not null),
    s as (select 'h1' as run_id, route_id, case_id, mcp_state, coalesce(reference_case_id, case_id) as reference_case_id from fx_sections)
    select s.route_id, s.reference_case_id, s.mcp_state, count(*) as n from k join s using (run_id, route_id)
    group by s.route_id, s.reference_case_id, s.mcp_state""",
)
def reuse_known_sections(t):
    return _reuse(t)[2].groupBy("route_id", "reference_case_id", "mcp_state").agg(F.countDistinct("case_id").alias("n"))


@query(
    "competitor_assembly",
    """select route_id, case when rac_state = 'optimal' then 'history' else 'answer' end as source,
    case when rac_state = 'optimal' then competitor_route_time else provider_route_time end as competitor_route_time
    from fx_routes""",
)
def competitor_assembly(t):
    lines = t.fx_route_lines.drop("country")
    base = t.fx_routes.join(lines, "route_id")
    routes = base.select("sample_id", "route_id", "competitor", "country", "provider_route")
    history = base.filter("rac_state = 'optimal'").select(
        "sample_id", "route_id", "competitor", "competitor_route", "competitor_route_length", "competitor_route_time", "run_id"
    )
    answers = base.select("route_id", geo.points_of_wkt("provider_route").alias("line"), F.col("provider_route_time").alias("seconds"))
    df = ins.competitor_routes(routes, history, answers)
    old = history.select("route_id", F.lit("history").alias("source"))
    return df.join(old, "route_id", "left").select("route_id", F.coalesce("source", F.lit("answer")).alias("source"), "competitor_route_time")


@query(
    "provider_route_answers",
    f"""with {VERTICES}, m as (select route_id, round(sum(2 * 6371000.0 * atan2(sqrt(h), sqrt(1 - h))), 3) as metres
      from (select route_id, power(sin(radians(by_ - ay) / 2), 2) + cos(radians(ay)) * cos(radians(by_)) * power(sin(radians(bx - ax) / 2), 2) as h from ps) group by route_id)
    select route_id, sample_id, country, 'OV' as provider, provider_route_time, metres from fx_routes join m using (route_id) where sample_id = '7' and metres > 0""",
)
def provider_route_answers(t):
    base = t.fx_routes.join(t.fx_route_lines.drop("country"), "route_id")
    answers = base.select("route_id", geo.points_of_wkt("provider_route").alias("line"), F.col("provider_route_time").alias("seconds"))
    df = ins.provider_routes(t.fx_routes, answers, "7", "OV", "C1")
    return df.select("route_id", "sample_id", "country", "provider", "provider_route_time", F.round("provider_route_length", 3).alias("metres"))


@query(
    "training_join",
    """select h.case_id, h.mcp_state as error_type, m.product, m.sample_id, r.quality
    from fx_sections h left join fx_routes r on h.route_id = r.route_id left join fx_metadata m on m.run_id = h.run_id and m.sample_id = r.sample_id
    where h.mcp_state is not null and h.mcp_state <> 'no source'
    qualify row_number() over (partition by h.case_id order by h.route_id) = 1""",
)
def training_join(t):
    from waymark.plans.training import training_rows

    samples = t.fx_routes.select("route_id", "sample_id", "quality")
    history = t.fx_sections.select("case_id", "route_id", "run_id", F.col("mcp_state").alias("error_type")).join(samples, "route_id", "left")
    df = training_rows(history, t.fx_metadata.select("run_id", "sample_id", "product"), ["run_id", "sample_id"])
    return df.select("case_id", "error_type", "product", "sample_id", "quality")


@query(
    "append_only_new",
    "select case_id, fcd_state from fx_sections where case_id not in (select case_id from fx_sections where mcp_state is null)",
)
def append_only_new(t):
    from waymark.sources.datasets import only_new

    stored = t.fx_sections.filter("mcp_state is null")
    return only_new(t.fx_sections.select("case_id", "fcd_state"), stored, ["case_id"])


@query(
    "product_semi_join",
    "select case_id from fx_sections where run_id in (select run_id from fx_metadata where product like 'O%')",
)
def product_semi_join(t):
    runs = t.fx_metadata.filter(F.col("product").startswith("O")).select("run_id")
    return t.fx_sections.join(runs, "run_id", "left_semi").select("case_id")


@query(
    "reference_redirect",
    """with p as (select case_id, probability from fx_sections)
    select s.case_id, coalesce(s.reference_case_id, s.case_id) as joined_case_id, p.probability
    from fx_sections s left join p on p.case_id = coalesce(s.reference_case_id, s.case_id)""",
)
def reference_redirect(t):
    from waymark.plans.training import redirect_references

    predictions = t.fx_sections.select("case_id", "probability")
    cases = t.fx_sections.select("case_id", "reference_case_id")
    return redirect_references(cases, predictions)


@query(
    "route_union",
    """select route_id, country, 'known' as origin_table from fx_routes where rac_state = 'optimal'
    union all select route_id, country, 'new' from fx_routes where rac_state <> 'optimal'""",
)
def route_union(t):
    known = t.fx_routes.filter("rac_state = 'optimal'").select("route_id", "country", F.lit("known").alias("origin_table"), "quality")
    new = t.fx_routes.filter("rac_state <> 'optimal'").select("country", F.lit("new").alias("origin_table"), "route_id")
    return schemas.common_union(known, new)


@query(
    "distinct_union",
    "select route_id, stretch_length from fx_sections where fcd_state = 'no error' union select route_id, stretch_length from fx_sections where mcp_state is null",
)
def distinct_union(t):
    a = t.fx_sections.filter("fcd_state = 'no error'").select("route_id", "stretch_length")
    b = t.fx_sections.filter("mcp_state is null").select("route_id", "stretch_length")
    return a.unionByName(b).dropDuplicates()


@query(
    "anti_indicator",
    "select route_id, country from fx_routes r where not exists (select 1 from fx_sections s where s.route_id = r.route_id)",
)
def anti_indicator(t):
    return t.fx_routes.select("route_id", "country").join(t.fx_sections.select("route_id"), "route_id", "left_anti")


# ---- merge and sanity ------------------------------------------------------------------------


def _merge(t):
    base = t.fx_routes.join(t.fx_route_lines.drop("country"), "route_id")
    known = base.filter("rac_state = 'optimal'")
    new = base.filter("rac_state <> 'optimal'")
    sections = t.fx_sections.withColumn("stretch", F.lit("LINESTRING EMPTY")).withColumn("tot", F.lit(-1))
    for c in ("pra", "prb", "prab", "lift"):
        sections = sections.withColumn(c, F.lit(-1.0))
    fresh = sections.filter("mcp_state is null").drop("mcp_state", "error_subtype", "reference_case_id")
    return ins.merge_inspection(
        new, known, fresh, sections.filter("mcp_state is not null"), "run-9",
        {"sample_id": "1", "provider": "OV", "endpoint": "e", "mapdate": "2024-01-01", "product": "O1", "competitor": "C1"},
        {"provider": 1.5, "competitor": 2.0, "reuse": 0.5, "rac": 3.0, "fcd": 4.0}, {"B": 3, "A": 2}, "2024-05-06",
    )


@query(
    "merge_metadata",
    """with s as (select case when mcp_state is null then null else mcp_state end as mcp_state,
                   case when mcp_state is null then null else error_subtype end as error_subtype, fcd_state from fx_sections),
    l as (select count(*) as n from s where mcp_state is null and
          (not ((mcp_state is not null and mcp_state <> 'MBP') or (mcp_state = 'MBP' and error_subtype = 'NO-TEMP')) or fcd_state = 'potential_error'))
    select 'run-9' as run_id, '1' as sample_id, 'OV' as provider, 'e' as endpoint, '2024-01-01' as mapdate, 'O1' as product,
      (select min(country) from fx_routes) as country, 'all_fail' as mode, 'C1' as competitor, cast(n as integer) as mcp_tasks,
      n < 1 as completed, '2024-05-06' as inspection_date, case when n < 1 then 'Automatically closed' else '' end as comment,
      cast(3.0 as double) as rac_elapsed_time, cast(4.0 as double) as fcd_elapsed_time, cast(11.0 as double) as total_elapsed_time,
      '{"A":2,"B":3}' as api_calls from l""",
)
def merge_metadata(t):
    return _merge(t)["inspection_metadata"]


@query(
    "merge_error_logs",
    """select s.run_id2 as run_id, s.route_id, s.case_id, r.country, r.provider from
    (select *, 'run-9' as run_id2 from fx_sections where mcp_state is null and fcd_state = 'potential_error') s left join fx_routes r using (route_id)""",
)
def merge_error_logs(t):
    return _merge(t)["error_logs"].select("run_id", "route_id", "case_id", "country", "provider")


@query(
    "merge_feedback",
    f"""select 'run-9' as run_id, route_id, case_id, mcp_state, reference_case_id, error_subtype from fx_sections where mcp_state is not null and {FEEDBACK}""",
)
def merge_feedback(t):
    return _merge(t)["critical_sections_with_mcp_feedback"]


def _sanity_routes(t):
    base = t.fx_routes.join(t.fx_route_lines.drop("country"), "route_id")
    return base.select(
        "run_id", "sample_id", "provider_route_time", "competitor_route_time", "competitor_route",
        F.when(F.col("quality") == "Q1", F.lit("LINESTRING EMPTY")).otherwise(F.col("provider_route")).alias("provider_route"),
        F.when(F.col("quality") == "Q2", F.lit(0.0)).otherwise(F.col("provider_route_length")).alias("provider_route_length"),
        (F.col("competitor_route_length") * 3).alias("competitor_route_length"),
    )


SANITY = """
b as (select r.run_id, r.sample_id, case when quality = 'Q1' then 1 else 0 end as emp,
       case when quality = 'Q2' then 0.0 else provider_route_length end as pl, provider_route_time as pt,
       competitor_route_length * 3 as cl, competitor_route_time as ct, quality from fx_routes r),
c as (select run_id, sample_id, count(*) as n, count(*) filter (where emp = 0 and pl = 0) as nl, count(*) filter (where emp = 1) as ne,
      count(*) filter (where pl > 10000) as lo, count(*) filter (where cl > 10000) as clo, sum(pl) as pm, sum(cl) as cm, sum(pt) as ps, sum(ct) as cs
      from b group by run_id, sample_id),
s as (select sample_id, count(*) as sampled from fx_routes group by sample_id)
"""


@query(
    "sanity_checks",
    f"""with {SANITY} select run_id, sample_id, n, sampled,
      (nl > 0.1 * n or ne / cast(n as double) > 0.05 or lo / cast(n as double) > 0.2 or clo / cast(n as double) > 0.2
       or 1 - n / cast(sampled as double) > 0.05 or pm > 1.5 * cm or pm < 0.5 * cm or ps > 1.5 * cs or ps < 0.5 * cs) as sanity_fail,
      case when nl > 0.1 * n then 'WARNING: No route length saved in inspection_routes on ' || nl || ' routes. ' || printf('%.2f', nl / cast(n as double) * 100) || '% percent' end as length_text,
      case when pm < 0.5 * cm then 'WARNING: Less distance in provider than competitor: competitor-provider/competitor = ' || printf('%.2f', (1 - pm / cm) * 100) || '%' end as relative_text
    from c join s using (sample_id)""",
)
def sanity_checks(t):
    df = ql.sanity_check(_sanity_routes(t), t.fx_routes, ["run_id", "sample_id"], F.lit("TbT"))
    msg = F.col("sanity_msg")
    return df.select(
        "run_id", "sample_id", "n", "sampled", "sanity_fail",
        F.get_json_object(msg, "$.provider.warnings['Missing length']").alias("length_text"),
        F.get_json_object(msg, "$.provider_vs_competitor.warnings.route_length_vs_competitor").alias("relative_text"),
    )


@query(
    "outcome_share_check",
    """select case when c / cast(n as double) > 0.3 then 'WARNING' else 'OK' end as level, 'optimal_route_percentage' as key,
    case when c / cast(n as double) > 0.3 then 'WARNING: Too high percent of optimal routes in inspection_routes = ' || printf('%.2f', c / cast(n as double) * 100) || '%' else '' end as text
    from (select count(*) as n, count(*) filter (where rac_state = 'optimal') as c from fx_routes)""",
)
def outcome_share_check(t):
    return ql.outcome_share(t.fx_routes, "optimal", 0.3, "rac_state")


@query(
    "run_validation",
    """select run_id, cast(sum(n) as bigint) as mcp_tasks, cast(2 as bigint) as "calls_A", cast(0 as bigint) as "calls_Z", round(sum(s), 2) as route_seconds, cast(sum(n) as bigint) as routes
    from (select run_id, count(*) as n, sum(provider_route_time) as s from fx_routes group by run_id) group by run_id""",
)
def run_validation(t):
    meta = t.fx_routes.groupBy("run_id").agg(F.count("*").alias("mcp_tasks")).withColumn("api_calls", F.lit('{"A": 2, "B": 3}'))
    return _round(ql.validate_run(meta, t.fx_routes, ["A", "Z"]), 2, "route_seconds")


# ---- order, dedup, samples -------------------------------------------------------------------


@query(
    "latest_per_key",
    """select route_id, case_id, inspection_date from fx_sections
    qualify row_number() over (partition by route_id order by inspection_date desc, case_id) = 1""",
)
def latest_per_key(t):
    return od.first_per_key(t.fx_sections.select("route_id", "case_id", "inspection_date"), ["route_id"], [od.newest_first("inspection_date"), "case_id"])


@query(
    "latest_inspection_per_sample",
    """select sample_id, run_id, provider, competitor, country, inspection_date from fx_metadata
    qualify row_number() over (partition by sample_id order by inspection_date desc, run_id) = 1""",
)
def latest_inspection_per_sample(t):
    from waymark.plans.reporting import latest_inspections

    return latest_inspections(t.fx_metadata.select("sample_id", "run_id", "provider", "competitor", "country", "inspection_date"))


@query(
    "dedup_exact_stretch",
    "select stretch, min(ordinal) as ordinal from fx_stretches group by stretch",
)
def dedup_exact_stretch(t):
    return ins.dedup_exact(t.fx_stretches.select("stretch", "ordinal"), ["ordinal"])


STRETCH_POINTS = """
sv as (select ordinal, list_transform(string_split(substr(stretch, 13, length(stretch) - 13), ','),
        lambda p: [round(cast(split_part(trim(p), ' ', 1) as double), 2), round(cast(split_part(trim(p), ' ', 2) as double), 2)]) as pts
       from (select stretch, min(ordinal) as ordinal from fx_stretches group by stretch))
"""


@query("dedup_rounded_stretch", f"with {STRETCH_POINTS} select min(ordinal) as ordinal from sv group by pts")
def dedup_rounded_stretch(t):
    once = ins.dedup_exact(t.fx_stretches.select("stretch", "ordinal"), ["ordinal"])
    return ins.dedup_rounded(once, ["ordinal"]).select("ordinal")


@query("dedup_near_stretch")
def dedup_near_stretch(t):
    once = ins.dedup_exact(t.fx_stretches.select("stretch", "ordinal"), ["ordinal"])
    rounded = ins.cut_lineage(ins.dedup_rounded(once, ["ordinal"]))
    return ins.dedup_near(rounded, "ordinal", max_distance=0.012).select("ordinal")


@query("dedup_chain")
def dedup_chain(t):
    return ins.dedup_stretches(t.fx_stretches, "ordinal").select("ordinal", "case_id")


@query(
    "dedup_by_length_keys",
    """select country, provider_route_length, competitor_route_length, min(route_id) as route_id from fx_routes
    group by country, provider_route_length, competitor_route_length""",
)
def dedup_by_length_keys(t):
    df = t.fx_routes.select("country", "provider_route_length", "competitor_route_length", "route_id")
    return od.first_per_key(df, ["country", "provider_route_length", "competitor_route_length"], ["route_id"])


@query(
    "inspected_before",
    "select run_id, sample_id from fx_metadata where provider = 'OM' and sample_id = '3' and product = 'G1' and competitor = 'C1'",
)
def inspected_before(t):
    return ins.already_inspected(t.fx_metadata, "OM", "3", "G1", "C1").select("run_id", "sample_id")


@query(
    "km_cap",
    f"""with r as (select route_id, provider_route_length / 1000.0 as km, {H('route_id')} as h from fx_routes),
    s as (select route_id, km, sum(km) over (order by h, route_id) as c from r) select route_id, km from s where c < 20000.0""",
)
def km_cap(t):
    df = t.fx_routes.select("route_id", (F.col("provider_route_length") / 1000.0).alias("km"))
    return sp.km_cap(df, "km", 20000.0, ["route_id"])


@query("top_sections", "select case_id, stretch_length, probability from fx_sections order by probability desc, stretch_length desc, case_id limit 25")
def top_sections(t):
    return t.fx_sections.select("case_id", "stretch_length", "probability").orderBy(F.desc("probability"), F.desc("stretch_length"), "case_id").limit(25)


@query("fraction_sample", f"select case_id from fx_sections where {U('case_id', 3)} < 0.1")
def fraction_sample(t):
    return od.fraction_sample(t.fx_sections.select("case_id"), 0.1, ["case_id"], seed=3)


@query("exact_sample", f"select case_id from fx_sections order by {H('case_id', 4)}, case_id limit 400")
def exact_sample(t):
    return od.exact_sample(t.fx_sections.select("case_id"), 400, ["case_id"], seed=4)


TIME = f"""r as (select case_id, inspection_date from fx_sections where inspection_date >= (select max(inspection_date) from fx_sections) - interval 3 months),
    te as (select case_id, inspection_date from r order by {H('case_id')}, case_id limit 300)"""


@query("time_split_test", f"with {TIME} select * from te")
def time_split_test(t):
    return sp.time_split(t.fx_sections.select("case_id", "inspection_date"), "inspection_date", ["case_id"], test_rows=300)[1]


@query("time_split_train", f"with {TIME} select distinct case_id, inspection_date from fx_sections except select * from te")
def time_split_train(t):
    return sp.time_split(t.fx_sections.select("case_id", "inspection_date"), "inspection_date", ["case_id"], test_rows=300)[0]


@query(
    "random_split",
    f"""with u as (select case_id, {U('case_id')} as u, {U('case_id', 1)} as w from fx_sections),
    l as (select *, case when u < 0.7 then 'train' when u < 0.9 then 'validation' else 'test' end as split from u)
    select case_id, split from l where split <> 'train' or w < 0.1""",
)
def random_split(t):
    return sp.random_split(t.fx_sections.select("case_id"), ["case_id"], subsample=0.1)


@query(
    "balanced_set",
    f"""(select case_id, mcp_state from fx_sections where mcp_state = 'discard' order by {H('case_id')}, case_id limit 62)
    union all (select case_id, mcp_state from fx_sections where mcp_state <> 'discard' order by {H('case_id')}, case_id limit 400)""",
)
def balanced_set(t):
    df = t.fx_sections.select("case_id", "mcp_state")
    extra = df.withColumn("unused", F.lit(1))
    return sp.balanced_set(df.filter("mcp_state = 'discard'"), extra.filter("mcp_state <> 'discard'"), 0.1334, 400, ["case_id"])


@query(
    "tile_sample",
    f"""select route_id, sample_id, quality from (select *, row_number() over (partition by sample_id, quality order by {H('route_id')}, route_id) as rk from fx_routes
      where provider_route_length between 100 and 2000 and provider_route_time > 30 and rac_state <> 'routing_issue') where rk <= case quality when 'Q1' then 3 when 'Q2' then 5 end""",
)
def tile_sample(t):
    df = t.fx_routes.select(
        "route_id", F.col("sample_id").alias("tile_id"), "quality", F.col("provider_route_length").alias("length"),
        F.col("provider_route_time").alias("seconds"), F.lit(11).alias("points"), F.col("rac_state").alias("road_class"),
    )
    out = sp.tile_sample(df, {"Q1": 3, "Q2": 5}, ["route_id"], banned_classes=["routing_issue"])
    return out.select("route_id", F.col("tile_id").alias("sample_id"), "quality")


@query(
    "driven_roads_sample",
    f"""select route_id from fx_routes where provider_route_length > 0 and competitor_route_length / provider_route_length >= 0.95
    order by -ln(greatest({U('route_id')}, 1e-18)) / provider_route_time, route_id limit 200""",
)
def driven_roads_sample(t):
    return sp.driven_roads_sample(
        t.fx_routes, "competitor_route_length", "provider_route_length", 0.95, "provider_route_time", 200, ["route_id"]
    ).select("route_id")


RING = [(1.0, 41.0), (12.5, 40.5), (15.0, 46.0), (8.0, 44.0), (3.0, 49.0)]


def _ring_sql(x, y):
    parts = []
    for (ax, ay), (bx, by) in zip(RING, RING[1:] + RING[:1]):
        parts.append(
            f"(case when (({ay}) > {y}) <> (({by}) > {y}) and {x} < ({bx - ax}) * ({y} - ({ay})) / nullif({by - ay}, 0.0) + ({ax}) then 1 else 0 end)"
        )
    return "(" + " + ".join(parts) + ") % 2 = 1"


@query(
    "routes_in_region",
    f"""with p as (select route_id, cast(split_part(substr(origin, 7, length(origin) - 7), ' ', 1) as double) as x,
      cast(split_part(substr(origin, 7, length(origin) - 7), ' ', 2) as double) as y from fx_routes)
    select route_id from p where {_ring_sql('x', 'y')}""",
)
def routes_in_region(t):
    df = t.fx_routes.select("route_id", geo.first(geo.points_of_wkt("origin")).alias("p")).select("route_id", "p.x", "p.y")
    return sp.rows_in_region(df, "x", "y", RING).select("route_id")


@query("delete_run", "select run_id, count(*) as n from fx_sections where run_id <> '1995' group by run_id")
def delete_run(t):
    return sp.delete_run({"s": t.fx_sections}, "1995")["s"].groupBy("run_id").agg(F.count("*").alias("n"))


@query(
    "artificial_inspection",
    f"""with r as (select s.*, st.stretch from fx_sections s join fx_stretches st using (case_id) where s.fcd_state = 'no error'
        and run_id in (select run_id from fx_metadata where product in ('O1'))),
    l as (select * from r qualify row_number() over (partition by stretch order by inspection_date desc, case_id) = 1)
    select case_id, stretch from l order by {H('case_id')}, case_id limit 150""",
)
def artificial_inspection(t):
    log = t.fx_sections.drop("inspection_date").join(t.fx_stretches.select("case_id", "stretch"), "case_id").join(
        t.fx_sections.select("case_id", "inspection_date"), "case_id"
    )
    return ins.artificial_inspection(log, t.fx_metadata, ["O1"], 150).select("case_id", "stretch")


# ---- comparison ------------------------------------------------------------------------------


@query(
    "route_comparison_states",
    """with v as (select route_id, unnest(string_split(substr(provider_route, 13, length(provider_route) - 13), ', ')) as p,
      unnest(string_split(substr(competitor_route, 13, length(competitor_route) - 13), ', ')) as c from fx_route_lines),
    d as (select route_id, max(sqrt(power(cast(split_part(p, ' ', 1) as double) - cast(split_part(c, ' ', 1) as double), 2) + power(cast(split_part(p, ' ', 2) as double) - cast(split_part(c, ' ', 2) as double), 2))) as apart
      from v group by route_id)
    select route_id, case when apart <= 0.0002 then 'optimal' else 'potential_error' end as rac_state from d""",
)
def route_comparison_states(t):
    lines = t.fx_route_lines.withColumn("provider", F.lit("OV"))
    return ins.compare_routes(lines).select("route_id", "rac_state").distinct()


@query("route_critical_sections")
def route_critical_sections(t):
    lines = t.fx_route_lines.withColumn("provider", F.lit("OV"))
    return ins.compare_routes(lines).filter("rac_state = 'potential_error'").select("route_id", "case_id", "stretch")


@query(
    "default_states",
    """select case_id, 'potential_error' as fcd_state, cast(-1 as double) as pra, cast(-1 as double) as lift, cast(-1 as integer) as tot from fx_stretches""",
)
def default_states(t):
    return ins.default_states(t.fx_stretches).select("case_id", "fcd_state", "pra", "lift", "tot")
