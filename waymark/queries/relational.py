"""Metrics, profiles and evaluation over the route-like tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark import values
from waymark.operators import evaluate as ev, metrics as mt, profile as pf, resample as rs
from waymark.queries import query

# A section with its route: what the reference scores. Both engines read the same fixtures.
JOINED = """
joined as (select s.case_id, s.route_id, s.run_id, s.mcp_state, s.error_subtype, s.fcd_state, s.probability,
                  s.probability_new, s.stretch_length, r.country, r.quality, r.provider_route_time,
                  r.provider_route_length
           from fx_sections s join fx_routes r on s.route_id = r.route_id)
"""
ERR = "(mcp_state is not null and mcp_state <> 'discard')"


def scored(t):
    routes = t.fx_routes.select("route_id", "country", "quality", "provider_route_time", "provider_route_length")
    return t.fx_sections.join(routes, "route_id")


def _r(df, *cols, digits=4):
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


@query(
    "eph_by_country",
    f"""with {JOINED},
    per_route as (select country, route_id, min(provider_route_time) as s,
                         count(*) filter (where {ERR}) as e from joined group by country, route_id)
    select country, cast(sum(e) as bigint) as errors, round(sum(s) / 3600.0, 4) as hours,
           round(cast(sum(e) as double) / (sum(s) / 3600.0), 4) as eph
    from per_route group by country""",
)
def eph_by_country(t):
    return _r(mt.errors_per_hour(scored(t), "mcp_state", "provider_route_time", groups=["country"]), "hours", "eph")


@query(
    "eph_filtered_total",
    f"""with {JOINED},
    per_route as (select route_id, min(provider_route_time) as s,
                         count(*) filter (where {ERR} and quality = 'Q1') as e from joined group by route_id)
    select cast(sum(e) as bigint) as errors, round(sum(s) / 3600.0, 4) as hours,
           round(cast(sum(e) as double) / (sum(s) / 3600.0), 4) as eph from per_route""",
)
def eph_filtered_total(t):
    df = mt.errors_per_hour(scored(t), "mcp_state", "provider_route_time", filter_=F.col("quality") == "Q1")
    return _r(df, "hours", "eph")


@query(
    "epk_by_quality",
    f"""with {JOINED},
    per_route as (select quality, route_id, min(provider_route_length) as m,
                         count(*) filter (where {ERR}) as e from joined group by quality, route_id)
    select quality, cast(sum(e) as bigint) as errors, round(sum(m) / 1000.0, 4) as km,
           round(cast(sum(e) as double) / (sum(m) / 1000.0), 4) as epk from per_route group by quality""",
)
def epk_by_quality(t):
    return _r(mt.errors_per_km(scored(t), "mcp_state", "provider_route_length", groups=["quality"]), "km", "epk")


@query(
    "failed_routes_by_country",
    f"""with {JOINED},
    per_route as (select country, route_id, max(case when {ERR} then 1 else 0 end) as f
                  from joined group by country, route_id)
    select country, cast(sum(f) as bigint) as failed, count(*) as routes,
           round(cast(sum(f) as double) / count(*), 6) as failed_routes from per_route group by country""",
)
def failed_routes_by_country(t):
    return _r(mt.failed_routes(scored(t), "mcp_state", groups=["country"]), "failed_routes", digits=6)


@query(
    "failed_routes_weighted",
    f"""with {JOINED},
    per_route as (select country, route_id, max(case when {ERR} then 1 else 0 end) as f
                  from joined group by country, route_id),
    g as (select country, cast(sum(f) as double) / count(*) as v from per_route group by country)
    select round(sum(v * w.weight) / sum(w.weight), 6) as value from g join fx_weights w using (country)""",
)
def failed_routes_weighted(t):
    per_group = mt.failed_routes(scored(t), "mcp_state", groups=["country"])
    return _r(mt.weighted_average(per_group, "country", "failed_routes", t.fx_weights), "value", digits=6)


@query(
    "eph_weighted",
    f"""with {JOINED},
    per_route as (select country, route_id, min(provider_route_time) as s,
        count(*) filter (where {ERR} and quality = 'Q2') as e, count(*) filter (where quality = 'Q2') as k
        from joined group by country, route_id),
    g as (select country, case when sum(k) > 0 then cast(sum(e) as double) / (sum(s) / 3600.0) end as v
          from per_route group by country)
    select round(sum(v * w.weight) / sum(w.weight), 4) as eph from g left join fx_weights w using (country)""",
)
def eph_weighted(t):
    df = mt.weighted_errors_per_hour(
        scored(t), "mcp_state", "provider_route_time", "country", t.fx_weights, F.col("quality") == "Q2"
    )
    return _r(df, "eph")


@query(
    "deduplicated_sum",
    f"""with {JOINED}, f as (select route_id, min(provider_route_length) as v from joined where quality = 'Q3'
    group by route_id) select round(sum(v), 2) as total from f""",
)
def deduplicated_sum(t):
    df = mt.deduplicated_sum(scored(t), "provider_route_length", filter_=F.col("quality") == "Q3")
    return _r(df, "total", digits=2)


@query(
    "value_counts_state",
    "select mcp_state, count(*) as n from fx_sections where mcp_state is not null group by mcp_state",
)
def value_counts_state(t):
    return mt.value_counts(t.fx_sections, "mcp_state")


@query(
    "error_and_route_counts",
    f"""select count(*) filter (where {ERR}) as errors,
        count(*) filter (where {ERR} and fcd_state = 'potential_error') as potential_errors
        from fx_sections""",
)
def error_and_route_counts(t):
    return t.fx_sections.agg(
        mt.error_count("mcp_state").alias("errors"),
        mt.error_count("mcp_state", F.col("fcd_state") == "potential_error").alias("potential_errors"),
    )


@query(
    "route_count_distinct",
    "select count(*) as routes from (select distinct route_id from fx_sections where mcp_state = 'MBP')",
)
def route_count_distinct(t):
    return mt.route_count(t.fx_sections, filter_=F.col("mcp_state") == "MBP")


LEVELS = {
    "quality": ("quality", {"high": ["Q1", "Q2"], "low": ["Q4", "Q5"], "all": ["Q1", "Q2", "Q3", "Q4", "Q5"]}),
    "family": ("mcp_state", {**{k: v for k, v in values.ERROR_FAMILIES.items()}, "MBP": ["MBP"]}),
}


def _level_sql():
    cases = [("all", "all", "true")]
    for level, (col, lists) in LEVELS.items():
        for name, vals in lists.items():
            cases.append((level, name, f"coalesce({col} in ({', '.join(repr(v) for v in vals)}), false)"))
    parts = []
    for level, name, cond in cases:
        parts.append(f"""
        select '{level}' as level, '{name}' as level_value, m.metric,
               round(case m.metric when 'errors' then e when 'hours' then h when 'routes' then n
                     when 'eph' then case when n = 0 or th = 0 then 0 else e / th end
                     when 'epk' then case when n = 0 or tk = 0 then 0 else e / tk end
                     else case when n = 0 or tr = 0 then 0 else f / tr end end, 4) as value
        from (select cast(sum(e) as double) as e, coalesce(sum(s), 0) / 3600.0 as h,
                     cast(count(*) filter (where r) as double) as n, cast(count(*) filter (where e > 0) as double) as f,
                     sum(ts) / 3600.0 as th, sum(tm) / 1000.0 as tk, cast(count(*) as double) as tr
              from (select route_id, count(*) filter (where {ERR} and {cond}) as e,
                           min(case when {cond} then provider_route_time end) as s, bool_or({cond}) as r,
                           min(provider_route_time) as ts, min(provider_route_length) as tm
                    from joined group by route_id)) x
        cross join (values ('errors'), ('hours'), ('routes'), ('eph'), ('epk'), ('failed_routes')) m(metric)""")
    return f"with {JOINED} " + " union all ".join(parts)


@query("metric_levels", _level_sql())
def metric_levels(t):
    df = mt.metric_levels(scored(t), "mcp_state", "provider_route_time", "provider_route_length", LEVELS)
    return _r(df, "value")


@query("metric_levels_json")
def metric_levels_json(t):
    return mt.levels_as_json(metric_levels(t))


@query(
    "error_family_counts",
    """with f(code, family) as (values """
    + ", ".join(
        f"('{c}', '{f}')" for c, f in values.code_families(values.ERROR_TYPES[1:], values.ERROR_FAMILIES)
    )
    + """) select family, count(*) as errors from fx_sections join f on mcp_state = code group by family""",
)
def error_family_counts(t):
    families = mt.code_table(t.spark, values.ERROR_TYPES[1:], values.ERROR_FAMILIES)
    # Count per code first: the mapping then multiplies a few rows, not the table.
    per_code = t.fx_sections.groupBy(F.col("mcp_state").alias("code")).agg(F.count("*").alias("n"))
    return per_code.join(F.broadcast(families), "code").groupBy("family").agg(F.sum("n").alias("errors"))


def _boot_routes(t, *groups):
    routes = mt.per_route(scored(t), "mcp_state", groups=list(groups), measures={"seconds": "provider_route_time"})
    return routes.select(*groups, "route_id", (F.col("seconds") / 3600.0).alias("hours"), F.col("errors").cast("double").alias("errors"))


def _boot(routes, **how):
    metrics = {"draws": F.sum("draws"), "errors": F.sum("errors"), "hours": F.sum("hours"), "eph": F.sum("errors") / F.sum("hours")}
    return rs.bootstrap(routes, ["hours", "errors"], metrics, **how)


# Draws come from a generator of the tasks, which SQL does not have: the tests hold them against plain resampling, and
# bootstrap_moments holds all resamples against the moments that follow from the routes.
@query("bootstrap_resamples")
def bootstrap_resamples(t):
    return _r(_r(_boot(_boot_routes(t)), "hours"), "eph", digits=6)


@query("bootstrap_interval")
def bootstrap_interval(t):
    df = mt.bootstrap_interval(_boot(_boot_routes(t)), ["errors", "eph"])
    return df.select(*[F.round(c, 4 if c.startswith("errors") else 6).alias(c) for c in df.columns])


@query(
    "bootstrap_moments",
    f"""with {JOINED},
    per_route as (select route_id, min(provider_route_time) / 3600.0 as hours, cast(count(*) filter (where {ERR}) as double) as errors from joined group by route_id)
    select metric, cast(1000 as bigint) as resamples, n as least_draws, n as most_draws, true as mean_agrees, true as spread_agrees
    from (select count(*) as n from per_route), (values ('errors'), ('hours')) m(metric)""",
)
def bootstrap_moments(t):
    """The mean and the variance over the resamples against n times those of a route; 6 standard errors are allowed."""
    routes = _boot_routes(t)
    draws = _boot(routes)
    out = []
    for m in ("errors", "hours"):
        own = routes.agg(F.count("*").alias("n"), F.sum(m).alias("total"), F.var_pop(m).alias("var"))
        made = draws.agg(F.count("*").alias("resamples"), F.min("draws").alias("least_draws"), F.max("draws").alias("most_draws"), F.avg(m).alias("mean"), F.var_samp(m).alias("spread"))
        due = F.col("n") * F.col("var")
        mean = F.abs(F.col("mean") - F.col("total")) <= 6 * F.sqrt(due / F.col("resamples"))
        spread = F.abs(F.col("spread") / due - 1) <= 6 * F.sqrt(F.lit(2.0) / F.col("resamples"))
        out.append(made.crossJoin(F.broadcast(own)).select(F.lit(m).alias("metric"), "resamples", "least_draws", "most_draws", mean.alias("mean_agrees"), spread.alias("spread_agrees")))
    return out[0].unionByName(out[1])


@query("bootstrap_levels")
def bootstrap_levels(t):
    """Intervals of errors per hour for all routes, by country and by quality, from the same 1000 resamples."""
    drawn = _boot(_boot_routes(t, "country", "quality"), levels=["country", "quality"])
    return _r(mt.bootstrap_interval(drawn, ["eph"], by=["level", "level_value"]), "eph_lower", "eph_upper", digits=6)


@query("bootstrap_stratified")
def bootstrap_stratified(t):
    fraction = F.when(F.col("quality") == "Q1", 0.5).otherwise(1.5)
    return _r(_boot(_boot_routes(t, "quality"), keys=["quality"], fraction=fraction).drop("eph"), "hours")


def _observations(t):
    df = scored(t).select(
        "quality",
        F.when(F.col("mcp_state") != "discard", F.col("mcp_state")).alias("error_type"),
        (F.col("stretch_length") / 10.0).alias("seconds"),
        (F.col("stretch_length") / 1000.0).alias("km"),
        F.col("mcp_state").isNotNull().alias("reviewed"),
    )
    return df, df.filter("reviewed and quality <> 'Q5'")


EXTRA_SQL = f"""with {JOINED},
    obs as (select quality, case when mcp_state <> 'discard' then mcp_state end as error_type,
                   stretch_length / 10.0 as seconds, stretch_length / 1000.0 as km,
                   mcp_state is not null as reviewed from joined),
    gtd as (select * from obs where reviewed and quality <> 'Q5'),
    g as (select quality, sum(seconds) / 3600.0 as gtd_hours, sum(km) as gtd_km from gtd group by quality),
    a as (select quality, sum(seconds) / 3600.0 as all_hours, sum(km) as all_km from obs group by quality),
    tm as (select quality, coalesce(gtd_hours, 0) as gtd_hours, coalesce(all_hours, 0) as all_hours,
                  coalesce(gtd_km, 0) as gtd_km, coalesce(all_km, 0) as all_km from g full join a using (quality)),
    e as (select quality, error_type, sum(seconds) / 3600.0 as error_hours, sum(km) as error_km,
                 sum(0.9 / (1 + exp(-0.2 * (seconds - 20.0)))) as w from gtd where error_type is not null
          group by quality, error_type),
    rows_ as (select tm.quality, coalesce(e.error_type, 'no error') as error_type, gtd_hours, all_hours, gtd_km, all_km,
                     coalesce(error_hours, 0) as error_hours, coalesce(error_km, 0) as error_km, coalesce(w, 0) as w
              from e right join tm on e.quality = tm.quality),
    rates as (select quality, error_type, gtd_hours, all_hours, gtd_km, all_km, error_hours, error_km,
        case when gtd_hours = 0 then 0 else error_hours / gtd_hours * all_hours end as estimated_error_hours,
        case when gtd_km = 0 then 0 else error_km / gtd_km * all_km end as estimated_error_km,
        case when gtd_hours = 0 then 0 else w / gtd_hours * all_hours end as estimated_errors from rows_)
"""
RATE_COLS = ["gtd_hours", "all_hours", "gtd_km", "all_km", "error_hours", "error_km", "estimated_error_hours",
             "estimated_error_km", "estimated_errors"]


def _rates(t):
    everything, reviewed = _observations(t)
    return mt.extrapolated_rates(
        everything, reviewed, ["quality"], "error_type", "seconds", (0.9, 0.2, 20.0), "km"
    )


@query(
    "extrapolated_rates",
    EXTRA_SQL + "select quality, error_type, " + ", ".join(f"round({c}, 4) as {c}" for c in RATE_COLS) + " from rates",
)
def extrapolated_rates(t):
    return _r(_rates(t), *RATE_COLS)


@query(
    "extrapolated_totals",
    EXTRA_SQL + """, pg as (select quality, max(gtd_hours) as gh, max(all_hours) as ah, max(gtd_km) as gk, max(all_km) as ak,
        sum(error_hours) as eh, sum(error_km) as ek, sum(estimated_error_hours) as xh, sum(estimated_error_km) as xk,
        sum(estimated_errors) as xe from rates group by quality)
    select round(sum(gh), 4) as gtd_hours, round(sum(ah), 4) as all_hours, round(sum(gk), 4) as gtd_km,
        round(sum(ak), 4) as all_km, round(sum(eh), 4) as error_hours, round(sum(ek), 4) as error_km,
        round(sum(xh), 4) as estimated_error_hours, round(sum(xk), 4) as estimated_error_km,
        round(sum(xe), 4) as estimated_errors, (select count(*) from gtd where error_type is not null) as gtd_errors,
        round(sum(xh) / sum(ah), 4) as error_hours_share, round(sum(xe) / sum(ah), 4) as total_eph,
        round(sum(xk) / sum(ak), 4) as error_km_share, round(sum(xe) / sum(ak), 4) as total_epkm from pg""",
)
def extrapolated_totals(t):
    _, reviewed = _observations(t)
    df = mt.extrapolated_totals(_rates(t), ["quality"], reviewed.filter("error_type is not null"))
    return _r(df, *[c for c in df.columns if c != "gtd_errors"])


@query(
    "support_weights",
    """select mcp_state, round(sum(0.9 / (1 + exp(-0.2 * (stretch_length / 10.0 - 20.0)))), 4) as weighted_errors
    from fx_sections where mcp_state <> 'discard' group by mcp_state""",
)
def support_weights(t):
    df = t.fx_sections.filter("mcp_state <> 'discard'").groupBy("mcp_state").agg(
        F.sum(mt.support_weight(F.col("stretch_length") / 10.0, 0.9, 0.2, 20.0)).alias("weighted_errors")
    )
    return _r(df, "weighted_errors")


@query(
    "empirical_cdf",
    """select distinct provider_route_time, round(cume_dist() over (order by provider_route_time), 8) as share
    from fx_routes""",
)
def empirical_cdf(t):
    return _r(mt.empirical_cdf(t.fx_routes, "provider_route_time"), "share", digits=8)


@query(
    "run_totals",
    """select run_id, country, count(*) as routes, round(sum(provider_route_time) / 3600.0, 4) as provider_hours,
    round(sum(provider_route_length) / 1000.0, 4) as provider_km,
    round(sum(competitor_route_time) / 3600.0, 4) as competitor_hours,
    round(sum(competitor_route_length) / 1000.0, 4) as competitor_km from fx_routes group by run_id, country""",
)
def run_totals(t):
    df = mt.run_totals(t.fx_routes, ["run_id", "country"])
    return _r(df, "provider_hours", "provider_km", "competitor_hours", "competitor_km")


@query(
    "world_rate",
    f"""with {JOINED},
    pr as (select country, run_id, route_id, min(provider_route_time) as s, count(*) filter (where {ERR}) as e
           from joined group by country, run_id, route_id),
    cur as (select country, sum(e) / (sum(s) / 3600.0) as eph from pr where run_id = '1997' and country < 'NATION_2'
            group by country),
    old as (select country, sum(e) / (sum(s) / 3600.0) as eph from pr where run_id = '1996' and country < 'NATION_7'
            group by country)
    select count(coalesce(cur.eph, old.eph, 20.0)) as countries,
           round(sum(coalesce(cur.eph, old.eph, 20.0) * weight) / sum(weight), 4) as eph
    from fx_weights left join cur using (country) left join old using (country)""",
)
def world_rate(t):
    def rates(run, below):
        rows = scored(t).filter((F.col("run_id") == run) & (F.col("country") < below))
        return mt.errors_per_hour(rows, "mcp_state", "provider_route_time", groups=["country"])

    return _r(mt.world_rate(rates("1997", "NATION_2"), rates("1996", "NATION_7"), t.fx_weights, "WorldWide", 20.0), "eph")


# ---- profiles -------------------------------------------------------------------------------


@query(
    "null_profile",
    """select count(*) filter (where mcp_state is null) as mcp_state,
    count(*) filter (where error_subtype is null) as error_subtype,
    count(*) filter (where case_id is null) as case_id from fx_sections""",
)
def null_profile(t):
    return pf.null_counts(t.fx_sections, ["mcp_state", "error_subtype", "case_id"])


@query(
    "null_ratio_profile",
    """select round(count(*) filter (where mcp_state is null) / cast(count(*) as double), 6) as mcp_state,
    round(count(*) filter (where error_subtype is null) / cast(count(*) as double), 6) as error_subtype from fx_sections""",
)
def null_ratio_profile(t):
    return _r(pf.null_ratios(t.fx_sections, ["mcp_state", "error_subtype"]), "mcp_state", "error_subtype", digits=6)


@query(
    "category_rates",
    """select country, count(*) as n, round(count(*) / cast(sum(count(*)) over () as double), 6) as rate
    from fx_routes group by country""",
)
def category_rates(t):
    return _r(pf.category_rates(t.fx_routes, "country"), "rate", digits=6)


@query(
    "error_share_by_country",
    f"""with {JOINED} select country, count(*) filter (where {ERR}) as errors, count(*) as total,
    round(count(*) filter (where {ERR}) / cast(count(*) as double) * 100, 4) as error_percent
    from joined group by country""",
)
def error_share_by_country(t):
    return _r(pf.error_share(scored(t), "country", mt.is_error("mcp_state")), "error_percent")


@query(
    "date_span",
    """select min(inspection_date) as first_date, max(inspection_date) as last_date,
    count(*) filter (where inspection_date > date '1999-01-01') as future_rows from fx_sections""",
)
def date_span(t):
    return pf.date_span(t.fx_sections, "inspection_date", F.lit("1999-01-01").cast("date"))


DESCRIBE_COLS = ["provider_route_length", "provider_route_time", "competitor_route_length"]


def _describe_sql(where="true"):
    return " union all ".join(
        f"""select '{c}' as feature, cast(count({c}) as double) as n, avg({c}) as mean, stddev_samp({c}) as std,
        min({c}) as min, max({c}) as max, quantile_cont({c}, 0.25) as q25, quantile_cont({c}, 0.5) as median,
        quantile_cont({c}, 0.75) as q75 from fx_routes where {where}"""
        for c in DESCRIBE_COLS
    )


@query(
    "describe_features",
    "select feature, n, " + ", ".join(f"round({c}, 3) as {c}" for c in ["mean", "std", "min", "max", "q25", "median", "q75"])
    + f" from ({_describe_sql()})",
)
def describe_features(t):
    return _r(pf.describe(t.fx_routes, DESCRIBE_COLS), "mean", "std", "min", "max", "q25", "median", "q75", digits=3)


@query(
    "feature_drift",
    f"""with a as ({_describe_sql("quality = 'Q1'")}), b as ({_describe_sql("quality = 'Q5'")})
    select feature, round(a.mean, 3) as mean_left, round(a.median, 3) as median_left, round(b.mean, 3) as mean_right,
    round(b.median, 3) as median_right, round(b.mean - a.mean, 3) as mean_diff, round(b.median - a.median, 3) as median_diff,
    round((b.mean - a.mean) / a.mean, 5) as mean_change, round((b.median - a.median) / a.median, 5) as median_change
    from a join b using (feature)""",
)
def feature_drift(t):
    df = pf.drift(t.fx_routes.filter("quality = 'Q1'"), t.fx_routes.filter("quality = 'Q5'"), DESCRIBE_COLS)
    df = _r(df, "mean_left", "median_left", "mean_right", "median_right", "mean_diff", "median_diff", digits=3)
    return _r(df, "mean_change", "median_change", digits=5)


STAT_COLS = ["stretch_length", "probability", "probability_new", "constant"]


@query(
    "feature_statistics",
    " union all ".join(
        f"""select '{c}' as feature, round(var_samp({e}), 4) as variance,
        cast(count(*) filter (where {e} is null) as double) as nulls,
        round(count(*) filter (where {e} is null) / cast(count(*) as double), 6) as null_share,
        count(distinct {e}) as n_unique,
        coalesce(var_samp({e}), 0) = 0 or count(*) filter (where {e} is null) / cast(count(*) as double) > 0.9 as excluded
        from fx_sections"""
        for c, e in [("stretch_length", "stretch_length"), ("probability", "case when fcd_state = 'no error' then null else probability end"),
                     ("probability_new", "probability_new"), ("constant", "cast(1 as double)")]
    ),
)
def feature_statistics(t):
    df = t.fx_sections.select(
        "stretch_length", F.when(F.col("fcd_state") != "no error", F.col("probability")).alias("probability"),
        "probability_new", F.lit(1.0).alias("constant"),
    )
    return _r(_r(pf.feature_statistics(df, STAT_COLS), "variance"), "null_share", digits=6)


@query(
    "duplicate_census",
    """select country, cast(floor(provider_route_length / 1000) as bigint) as km, count(*) as n from fx_routes group by 1, 2 having count(*) > 1""",
)
def duplicate_census(t):
    routes = t.fx_routes.withColumn("km", F.floor(F.col("provider_route_length") / 1000).cast("bigint"))
    return pf.duplicate_census(routes, ["country", "km"])


@query(
    "duplicates_per_date",
    """select inspection_date, cast(count(*) as bigint) as duplicates from fx_sections
    where (stretch_length, route_id) in (select (stretch_length, route_id) from fx_sections
                                         group by stretch_length, route_id having count(*) > 1)
    group by inspection_date""",
)
def duplicates_per_date(t):
    return pf.duplicates_per_date(t.fx_sections, ["stretch_length", "route_id"], "inspection_date")


THRESHOLDS = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.98, 0.99]
_X = "case when probability_new = 0 then -2 when stretch_length < 50 then 0 else probability end"


@query(
    "threshold_shares",
    f"with x as (select {_X} as v, coalesce({ERR}, false) as e from fx_sections) "
    + " union all ".join(
        f"select '{n}' as \"case\", count(*) filter (where {c}) as n, round(count(*) filter (where {c} and e) / "
        f"nullif(cast(count(*) filter (where {c}) as double), 0), 6) as error_share from x"
        for n, c in [("total", "true"), ("= -2", "v = -2"), ("= 0", "v = 0")] + [(f"> {t:g}", f"v > {t}") for t in THRESHOLDS]
    ),
)
def threshold_shares(t):
    df = t.fx_sections.withColumn("v", F.expr(_X))
    return _r(pf.threshold_shares(df, "v", mt.is_error("mcp_state"), THRESHOLDS), "error_share", digits=6)


CORR = ["stretch_length", "probability", "probability_new"]


@query(
    "correlation_matrix",
    " union all ".join(
        f"select '{a}' as feature_a, '{b}' as feature_b, round(corr({a}, {b}), 8) as r from fx_sections"
        for i, a in enumerate(CORR) for b in CORR[i:]
    ),
)
def correlation_matrix(t):
    return _r(pf.correlation_matrix(t.fx_sections, CORR), "r", digits=8)


@query(
    "feature_run_difference",
    """select l.route_id, round(r.provider_route_length * 1.1 - l.provider_route_length, 4) as provider_route_length_diff
    from fx_routes l join fx_routes r on l.route_id = r.route_id""",
)
def feature_run_difference(t):
    left = t.fx_routes.select("route_id", "provider_route_length")
    right = left.withColumn("provider_route_length", F.col("provider_route_length") * 1.1)
    return _r(pf.run_difference(left, right, "route_id", ["provider_route_length"]), "provider_route_length_diff")


@query(
    "distinct_counts",
    """select 'case_id' as column_name, count(distinct case_id) as n_unique from fx_sections
    union all select 'route_id', count(distinct route_id) from fx_sections
    union all select 'mcp_state', count(distinct mcp_state) from fx_sections""",
)
def distinct_counts(t):
    return pf.distinct_counts(t.fx_sections, ["case_id", "route_id", "mcp_state"])


@query(
    "discard_rate_over_time",
    """select inspection_date, count(*) filter (where fcd_state = 'no error') as no_error,
    count(*) filter (where fcd_state = 'potential_error') as potential_error,
    round(count(*) filter (where fcd_state = 'no error') / cast(count(*) as double), 6) as discard_rate
    from fx_sections where probability_new > 0 group by inspection_date""",
)
def discard_rate_over_time(t):
    log = t.fx_sections.withColumn("prab", F.when(F.col("probability_new") > 0, -1.0).otherwise(0.5))
    return _r(pf.discard_rate_over_time(log, "inspection_date", "fcd_state", "prab"), "discard_rate", digits=6)


@query(
    "false_negative_rate",
    """select count(*) filter (where mcp_state <> 'discard') as errors, count(*) as reviewed,
    round(count(*) filter (where mcp_state <> 'discard') / cast(count(*) as double), 6) as false_negative_rate
    from fx_sections where mcp_state is not null and fcd_state = 'no error'""",
)
def false_negative_rate(t):
    rows = t.fx_sections.filter("fcd_state = 'no error'")
    return _r(pf.false_negative_rate(rows, "mcp_state"), "false_negative_rate", digits=6)


@query(
    "any_null_rows",
    "select case_id, mcp_state, error_subtype from fx_sections where mcp_state is null or error_subtype is null",
)
def any_null_rows(t):
    return pf.rows_with_any_null(t.fx_sections.select("case_id", "mcp_state", "error_subtype"))


# ---- classifier evaluation ------------------------------------------------------------------

EVAL = "ev as (select case_id, mcp_state <> 'discard' as truth, probability as p, probability_new as p2 from fx_sections where mcp_state is not null)"


def _eval(t):
    return t.fx_sections.filter("mcp_state is not null").select(
        "case_id", (F.col("mcp_state") != "discard").alias("truth"), F.col("probability").alias("p"),
        F.col("probability_new").alias("p2"),
    )


SWEEP = f"""with {EVAL}, th as (select i as step, case when i = 100 then 1.0 else 1.0 * i / 100 end::double as threshold
        from range(0, 101) r(i)),
    c as (select step, threshold,
        count(*) filter (where truth and (p > threshold or (p = threshold and p <> 0))) as tp,
        count(*) filter (where not truth and (p > threshold or (p = threshold and p <> 0))) as fp,
        count(*) filter (where not truth and not (p > threshold or (p = threshold and p <> 0))) as tn,
        count(*) filter (where truth and not (p > threshold or (p = threshold and p <> 0))) as fn
        from ev cross join th group by step, threshold),
    sw as (select cast(step as integer) as step, threshold, tp, fp, tn, fn,
        (tp + tn) / cast(tp + fp + tn + fn as double) as accuracy,
        2 * tp / nullif(cast(2 * tp + fp + fn as double), 0) as f1, tp / nullif(cast(tp + fp as double), 0) as precision,
        tp / nullif(cast(tp + fn as double), 0) as recall, tn / nullif(cast(tn + fn as double), 0) as negative_precision,
        tn / nullif(cast(tn + fp as double), 0) as negative_recall,
        (tp + fp) / cast(tp + fp + tn + fn as double) as kept_rate,
        (tn + fn) / cast(tp + fp + tn + fn as double) as discard_rate,
        cast((tn + fn) * 2.0 - fn * 10.0 as double) as saving from c)
"""
SWEEP_RATES = ["accuracy", "f1", "precision", "recall", "negative_precision", "negative_recall", "kept_rate", "discard_rate"]


def _sweep(t):
    return ev.threshold_sweep(_eval(t), "truth", "p", 101)


@query(
    "threshold_sweep",
    SWEEP + "select step, threshold, tp, fp, tn, fn, " + ", ".join(f"round({c}, 6) as {c}" for c in SWEEP_RATES) + ", saving from sw",
)
def threshold_sweep(t):
    return _r(_sweep(t), *SWEEP_RATES, digits=6)


@query(
    "nearest_target_threshold",
    SWEEP + """select cast(target as double) as target, arg_min(threshold, abs(recall - target) * 1000000000 + step) as threshold,
    round(arg_min(recall, abs(recall - target) * 1000000000 + step), 6) as reached
    from sw cross join (values (0.95), (0.98), (0.99)) t(target) group by target""",
)
def nearest_target_threshold(t):
    return _r(ev.nearest_target(_sweep(t), "recall", [0.95, 0.98, 0.99]), "reached", digits=6)


@query(
    "last_before_recall_drop",
    SWEEP + """select max(threshold) as threshold, round(arg_max(recall, step), 6) as recall from sw
    where step < (select min(step) from sw where recall < 0.98)""",
)
def last_before_recall_drop(t):
    return _r(ev.last_before_drop(_sweep(t)), "recall", digits=6)


MANY = """ev as (select case_id, mcp_state <> 'discard' as truth, probability * 0.07 + (stretch_length % 97) / 4000 as probability_a,
        probability_new * 0.06 + (stretch_length % 89) / 2500 as probability_b, case when stretch_length % 30 > 1 then (probability + probability_new) * 0.055 end as probability_c
        from fx_sections where mcp_state is not null),
    l as (select truth, unnest(['probability_a', 'probability_b', 'probability_c']) as "column", unnest([probability_a, probability_b, probability_c]) as p from ev),
    th as (select i as step, case when i = 1999 then 0.1::double else i * (0.1::double / 1999) end as threshold from range(0, 2000) r(i)),
    c as (select "column", p, truth, count(*) as n from l where p is not null group by all),
    sw as (select "column", step, threshold, sum(case when truth and p >= threshold then n else 0 end) / sum(case when truth then n else 0 end) as recall,
        sum(case when not truth and p < threshold then n else 0 end) / sum(case when truth then 0 else n end) as specificity from c, th group by all)"""


def _many(t):
    p, q, s = F.col("probability"), F.col("probability_new"), F.col("stretch_length")
    df = t.fx_sections.filter("mcp_state is not null").select(
        (F.col("mcp_state") != "discard").alias("truth"), (p * 0.07 + (s % 97) / 4000).alias("probability_a"), (q * 0.06 + (s % 89) / 2500).alias("probability_b"),
        F.when(s % 30 > 1, (p + q) * 0.055).alias("probability_c"),
    )
    return ev.sweep_columns(df, "truth", [c for c in df.columns if c.startswith("probability_")])


@query("column_sweep", f'with {MANY} select "column", cast(step as integer) as step, threshold, round(recall, 8) as recall, round(specificity, 8) as specificity from sw')
def column_sweep(t):
    return _r(_many(t), "recall", "specificity", digits=8)


@query(
    "column_thresholds",
    f"""with {MANY} select "column", max(threshold) as threshold, round(arg_max(recall, step), 8) as recall, round(arg_max(specificity, step), 8) as specificity
    from sw s where not exists (select 1 from sw o where o."column" = s."column" and o.step <= s.step and o.recall < 0.98) group by "column\"""",
)
def column_thresholds(t):
    return _r(ev.last_before_drop_by_column(_many(t)), "recall", "specificity", digits=8)


@query(
    "classifier_rates",
    f"""with {EVAL}, c as (select count(*) filter (where truth and p >= 0.5) as tp, count(*) filter (where not truth and p >= 0.5) as fp,
    count(*) filter (where not truth and p < 0.5) as tn, count(*) filter (where truth and p < 0.5) as fn, count(*) as n from ev)
    select tp, fp, tn, fn, round(tp / cast(tp + fn as double), 6) as recall,
    round(tn / cast(tn + fp as double), 6) as negative_recall, round((tn + fn) / cast(n as double), 6) as discard_rate,
    round((tp + fp) / cast(n as double), 6) as kept_rate from c""",
)
def classifier_rates(t):
    df = ev.classifier_rates(_eval(t), F.col("truth"), F.col("p") >= 0.5)
    return _r(df, "recall", "negative_recall", "discard_rate", "kept_rate", digits=6)


@query(
    "roc_curve",
    f"""with {EVAL}, g as (select p, count(*) filter (where truth) as a, count(*) filter (where not truth) as b from ev group by p)
    select p as score, round(sum(a) over (order by p desc) / cast(sum(a) over () as double), 6) as tpr,
    round(sum(b) over (order by p desc) / cast(sum(b) over () as double), 6) as fpr from g""",
)
def roc_curve(t):
    return _r(ev.roc_curve(_eval(t), "truth", "p"), "tpr", "fpr", digits=6)


@query(
    "auc",
    f"""with {EVAL}, r as (select truth, rank() over (order by p) + (count(*) over (partition by p) - 1) / 2.0 as rk from ev),
    s as (select sum(rk) filter (where truth) as sr, count(*) filter (where truth) as np, count(*) filter (where not truth) as nn from r)
    select round(cast((sr - np * (np + 1) / 2.0) / (np * nn) as double), 8) as auc from s""",
)
def auc(t):
    return _r(ev.auc(_eval(t), "truth", "p"), "auc", digits=8)


@query(
    "confusion_matrix",
    f"""with {EVAL} select truth, count(*) filter (where p < 0.5) as no_error, count(*) filter (where p >= 0.5) as potential_error
    from ev group by truth""",
)
def confusion_matrix(t):
    df = _eval(t).withColumn("pred", F.when(F.col("p") >= 0.5, "potential_error").otherwise("no_error"))
    return ev.cross_table(df, "truth", "pred", ["no_error", "potential_error"])


@query(
    "model_vs_model",
    f"""with {EVAL} select p >= 0.5 as first, count(*) filter (where p2 < 0.4) as n, count(*) filter (where p2 >= 0.4) as y
    from ev group by p >= 0.5""",
)
def model_vs_model(t):
    df = _eval(t).select((F.col("p") >= 0.5).alias("first"), F.when(F.col("p2") >= 0.4, "y").otherwise("n").alias("second"))
    return ev.cross_table(df, "first", "second", ["n", "y"])


def _cells_sql():
    cells = []
    for tn, tc in (("error", "truth"), ("clean", "not truth")):
        for an, ac in (("first_hit", "a = truth"), ("first_miss", "a <> truth")):
            for bn, bc in (("second_hit", "b = truth"), ("second_miss", "b <> truth")):
                cells.append(f"count(*) filter (where {tc} and {ac} and {bc}) as {tn}_{an}_{bn}")
    return ", ".join(cells)


@query(
    "two_model_comparison",
    f"""with {EVAL}, m as (select truth, p >= 0.5 as a, p2 >= 0.4 as b from ev)
    select {_cells_sql()},
    round(count(*) filter (where a = truth and b = truth) / cast(count(*) filter (where a = truth) as double), 6) as p_second_hit_given_first_hit,
    round(count(*) filter (where a <> truth and b = truth) / cast(count(*) filter (where a <> truth) as double), 6) as p_second_hit_given_first_miss,
    round(count(*) filter (where a and b) / cast(count(*) filter (where a) as double), 6) as p_second_positive_given_first_positive,
    round(count(*) filter (where not a and b) / cast(count(*) filter (where not a) as double), 6) as p_second_positive_given_first_negative
    from m""",
)
def two_model_comparison(t):
    df = ev.two_model_cells(_eval(t), F.col("truth"), F.col("p") >= 0.5, F.col("p2") >= 0.4)
    return _r(df, *[c for c in df.columns if c.startswith("p_")], digits=6)


_H = "cast('0x' || substr(md5('{seed}|' || case_id), 1, 15) as bigint)"


@query(
    "calibration_table",
    f"""with {EVAL}, r as (select truth, p, row_number() over (order by p, {_H.format(seed=0)}, case_id) - 1 as rk, count(*) over () as n
        from ev), b as (select cast(floor(rk * 20 / cast(n as double)) as integer) as bin, truth, p from r)
    select bin, count(*) as n, round(avg(p), 8) as mean_probability, round(avg(cast(truth as integer)), 8) as observed_rate
    from b group by bin""",
)
def calibration_table(t):
    df = ev.calibration_table(_eval(t), "truth", "p", ["case_id"])
    return _r(df, "mean_probability", "observed_rate", digits=8)


SPLIT_SQL = f"""with {EVAL}, s as (select truth, p, cast(least(floor({_H.format(seed=7)} / 1152921504606846976.0 * 20), 19) as integer) as split from ev),
    g as (select split, sum(p) as probability_sum, count(*) filter (where truth) as errors from s group by split)"""


@query("probability_sum_by_split", SPLIT_SQL + "select split, round(probability_sum, 6) as probability_sum, errors from g")
def probability_sum_by_split(t):
    return _r(ev.split_sums(_eval(t), "truth", "p", ["case_id"]), "probability_sum", digits=6)


@query(
    "probability_sum_fit",
    SPLIT_SQL + """select round(regr_slope(errors, probability_sum), 6) as slope,
    round(regr_intercept(errors, probability_sum), 6) as intercept, round(regr_r2(errors, probability_sum), 6) as r2 from g""",
)
def probability_sum_fit(t):
    df = ev.linear_fit(ev.split_sums(_eval(t), "truth", "p", ["case_id"]), "probability_sum", "errors")
    return _r(df, "slope", "intercept", "r2", digits=6)


@query(
    "error_ratio_resamples",
    f"""with {EVAL}, ids as (select truth, p, row_number() over (partition by truth order by {_H.format(seed=0)}, case_id) - 1 as pos,
        count(*) over (partition by truth) as n from ev),
    plan as (select i as seed, (i + 1) / 10.0 as ratio, true as truth, cast(round((i + 1) / 10.0 * 1000) as bigint) as draws from range(0, 10) r(i)
             union all select i, (i + 1) / 10.0, false, 1000 - cast(round((i + 1) / 10.0 * 1000) as bigint) from range(0, 10) r(i)),
    sz as (select truth, max(n) as n from ids group by truth),
    sl as (select seed, ratio, truth, n, unnest(range(0, draws)) as i from plan join sz using (truth)),
    d2 as (select ratio, truth, cast('0x' || substr(md5('0|' || seed || '|' || i), 1, 15) as bigint) % n as pick from sl)
    select cast(ratio as double) as ratio, count(*) as n, count(*) filter (where d2.truth) as errors, round(sum(p), 6) as probability_sum
    from d2 join ids on ids.truth = d2.truth and pos = pick group by ratio""",
)
def error_ratio_resamples(t):
    ratios = [(i + 1) / 10 for i in range(10)]
    return _r(ev.ratio_resamples(_eval(t), "truth", "p", ["case_id"], ratios, 1000), "probability_sum", digits=6)
