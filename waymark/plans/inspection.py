"""The inspection run: routes, reuse, comparison, states, merge, dedup. DataFrames in, DataFrames out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from waymark import values as v
from waymark.functions import geo, kernels as k, sections as sec, text as tx
from waymark.operators.barrier import explode_once, keep_where
from waymark.operators.order import exact_sample, first_per_key, hash_key, newest_first
from waymark.operators.pairs import near_duplicates
from waymark.session import cut_lineage

ROUTE_KEYS = ["sample_id", "route_id", "competitor", "country"]


# ---- provider and competitor routes ----------------------------------------------------------


def sample_metric(metadata: DataFrame) -> DataFrame:
    """(sample_id, metric): the long-distance metric is kept, everything else is the default metric."""
    first = metadata.groupBy("sample_id").agg(F.min("metric").alias("_m"))
    return first.select(
        "sample_id", F.when(F.col("_m") == v.METRIC_LONG, F.lit(v.METRIC_LONG)).otherwise(F.lit(v.METRIC_DEFAULT)).alias("metric")
    )


def metric_family(metric: Column | str) -> Column:
    """Both spellings of the long-distance metric fold into one."""
    metric = F.col(metric) if isinstance(metric, str) else metric
    return F.when(metric.isin(*v.METRIC_LONG_FAMILY), F.lit(v.METRIC_LONG)).otherwise(F.lit(v.METRIC_DEFAULT))


def answer_columns(prefix: str, line: str = "line", seconds: str = "seconds") -> list[Column]:
    """Route text, length and time; a route without an answer is an empty line of length 0.

    The length is always measured on the line, never taken from the answer.
    """
    points = F.col(line)
    usable = F.coalesce(F.size(points) > 1, F.lit(False))
    return [
        F.when(usable, geo.wkt_of_points(points)).otherwise(F.lit("LINESTRING EMPTY")).alias(f"{prefix}_route"),
        F.when(usable, geo.haversine_length(points)).otherwise(F.lit(0.0)).alias(f"{prefix}_route_length"),
        F.when(usable, F.col(seconds).cast("double")).otherwise(F.lit(0.0)).alias(f"{prefix}_route_time"),
    ]


def provider_routes(samples: DataFrame, answers: DataFrame, sample_id: str, provider: str, competitor: str) -> DataFrame:
    """One route per sampled pair from the stored answers (route_id, line, seconds); empty routes are dropped."""
    wanted = samples.filter(F.col("sample_id") == sample_id)
    joined = wanted.join(answers.select("route_id", "line", "seconds"), "route_id", "left")
    routes = joined.select(
        "route_id", "sample_id", "country", "origin", "destination", F.lit(provider).alias("provider"),
        F.lit(competitor).alias("competitor"), *answer_columns("provider"),
    )
    return keep_where(routes, F.col("provider_route_length") > 0)


def reuse_static_routes(
    routes: DataFrame, history: DataFrame, old_sections: DataFrame, feedback: DataFrame, metadata: DataFrame, run_id: str,
    ignore_previous: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(unknown routes, known routes, known sections).

    A route is known when an earlier run had the same sample, route, competitor and country and a
    geometry within the reuse buffer; of several, a reviewed one wins, then the latest.
    """
    if ignore_previous:
        history, old_sections, feedback = (df.filter(F.lit(False)) for df in (history, old_sections, feedback))
    # Of the feedback on a case the least state counts, then the least subtype.
    feedback = first_per_key(
        feedback.select("run_id", "route_id", "case_id", "mcp_state", "error_subtype"), ["run_id", "route_id", "case_id"], ["mcp_state", "error_subtype"]
    )
    # Rows without a run or route meet nothing below. The barrier keeps the two uses of the picked rows equal, so that Spark shuffles them once.
    feedback = keep_where(feedback, F.col("run_id").isNotNull() & F.col("route_id").isNotNull())
    old = history.select(
        *ROUTE_KEYS, "run_id", F.col("provider_route").alias("_old"), "competitor_route", "rac_state",
        "competitor_route_length", "competitor_route_time",
    )
    # Lines that lie by route already, as after a join on it, aren't shuffled again; the other keys only tell the pairs of a route apart.
    others = [c for c in ROUTE_KEYS if c != "route_id"]
    pairs = routes.select(*ROUTE_KEYS, "provider_route").join(old.withColumnsRenamed({c: f"_old_{c}" for c in others}), "route_id")
    pairs = keep_where(pairs, reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_old_{c}") for c in others])).drop(*[f"_old_{c}" for c in others])
    # Unchanged text needs no geometry; only differing text goes to the kernel.
    same_text = (F.col("provider_route") == F.col("_old")) & ~geo.is_empty("_old")
    pairs = pairs.select(
        "*", same_text.alias("_same"), F.when(~same_text, geo.points_of_wkt("provider_route")).alias("_a"),
        F.when(~same_text, geo.points_of_wkt("_old")).alias("_b"),
    )
    matched = keep_where(pairs, F.col("_same") | geo.equal_within("_a", "_b", v.REUSE_BUFFER)).drop("_old", "_same", "_a", "_b")
    # Whether a run reviewed a route: the only thing the pick needs from the feedback.
    reviewed = feedback.groupBy("run_id", "route_id").agg(F.max(F.col("mcp_state").isNotNull()).alias("_reviewed"))
    dates = metadata.select("run_id", "inspection_date").groupBy("run_id").agg(F.max("inspection_date").alias("inspection_date"))
    matched = matched.join(reviewed, ["run_id", "route_id"], "left").join(dates, "run_id", "left")
    order = F.struct(
        (~F.coalesce("_reviewed", F.lit(False))).alias("o0"), newest_first("inspection_date").alias("o1"), F.col("run_id").alias("o2"),
        F.col("rac_state").isNull().alias("o3"), F.col("rac_state").alias("o4"),
    )
    # Two picks of the same row: whoever asks for the run alone doesn't carry the competitor's line through the joins.
    run, answer = ["run_id", "rac_state", "inspection_date"], ["competitor_route", "competitor_route_length", "competitor_route_time"]
    best = matched.groupBy(*ROUTE_KEYS).agg(F.min_by(F.struct(*run), order).alias("_run"), F.min_by(F.struct(*answer), order).alias("_answer"))
    best = best.select(*ROUTE_KEYS, "_run.run_id", "_answer.competitor_route", "_run.rac_state", *[f"_answer.{c}" for c in answer[1:]], "_run.inspection_date")
    unique = first_per_key(routes, [*ROUTE_KEYS, "provider_route", "provider_route_length"], ["provider"])
    joined = unique.join(best, ROUTE_KEYS, "left")
    known = joined.filter(F.col("rac_state").isNotNull())
    unknown = joined.filter(F.col("rac_state").isNull()).drop(
        "run_id", "rac_state", "competitor_route", "competitor_route_length", "competitor_route_time", "inspection_date"
    )
    sections = (
        known.select("route_id", "run_id")
        .join(
            old_sections.drop("mcp_state", "error_subtype").withColumn("reference_case_id", F.coalesce("reference_case_id", "case_id")),
            ["run_id", "route_id"],
        )
        .join(feedback, ["run_id", "route_id", "case_id"], "left")
        .withColumn("case_id", tx.hashed_uuid(F.lit(run_id), "run_id", "case_id"))
    )
    return unknown, known, sections


def competitor_routes(routes: DataFrame, history: DataFrame, answers: DataFrame) -> DataFrame:
    """Competitor route of every route: from history when there is one, else from the stored answers."""
    keys = ["sample_id", "route_id", "competitor"]
    kept = history.filter(F.col("competitor_route").isNotNull()).select(
        *keys, "competitor_route", "competitor_route_length", "competitor_route_time", "run_id"
    )
    kept = first_per_key(kept, keys, [F.struct(F.col("run_id").isNull(), F.col("run_id")), "competitor_route"]).drop("run_id")
    joined = routes.join(kept, keys, "left")
    known = joined.filter(F.col("competitor_route").isNotNull())
    missing = joined.filter(F.col("competitor_route").isNull()).drop(
        "competitor_route", "competitor_route_length", "competitor_route_time"
    )
    asked = missing.join(answers.select("route_id", "line", "seconds"), "route_id", "left")
    computed = asked.select(*missing.columns, *answer_columns("competitor"))
    return known.select(*routes.columns, "competitor_route", "competitor_route_length", "competitor_route_time").unionByName(computed)


# ---- comparison ------------------------------------------------------------------------------


def with_sections(pairs: DataFrame, id_col: str, own: Column, subroutes: DataFrame | None = None, literal_second_test: bool = False) -> DataFrame:
    """``pairs`` (id, ``b`` other line, ...) with ``spans``: where ``b`` leaves the line ``own``.

    An interval is closed as an error, closed as equal, or replaced by halves of the places where the lines part, down to
    ``MAX_SPLIT_DEPTH``. All intervals of a route are split in the task that holds it.
    ``subroutes`` (id, s, e, line) gives the other side's route between interval ends; without it, or
    where it has no row, the other route is cut between the projections of the ends.
    """
    if subroutes is None and not literal_second_test:
        return pairs.withColumn("spans", sec.critical_spans(own, F.col("b")))
    given = F.lit(None).cast("array<struct<s: double, e: double, line: array<struct<x: double, y: double>>>>")
    if subroutes is not None:
        # A route has few intervals, so its lines fit a row.
        listed = subroutes.groupBy(F.col("id").alias(id_col)).agg(F.collect_list(F.struct("s", "e", "line")).alias("_given"))
        pairs, given = pairs.join(listed, id_col, "left"), F.col("_given")
    return pairs.withColumn("spans", sec.critical_spans_given(own, F.col("b"), given, F.lit(literal_second_test))).drop("_given")


def split_sections(pairs: DataFrame, id_col: str, subroutes: DataFrame | None = None, literal_second_test: bool = False) -> DataFrame:
    """Critical sections of route pairs (id, ``a`` own line, ``b`` other line): rows (id, s, e)."""
    rows = with_sections(pairs.select(id_col, "a", "b"), id_col, F.col("a"), subroutes, literal_second_test)
    return explode_once(rows.select(id_col, "spans"), "spans", "x").select(id_col, "x.s", "x.e")


def compare_routes(routes: DataFrame, subroutes: DataFrame | None = None, run_id: str = "", literal_second_test: bool = False) -> DataFrame:
    """One row per critical section, or one row for an equal route (`optimal`) or one without sections (`routing_issue`)."""
    lines = routes.select(
        "route_id", "country", "provider", F.col("provider_route").alias("route"), geo.points_of_wkt("provider_route").alias("a"),
        geo.points_of_wkt("competitor_route").alias("b"),
    ).withColumn("same", geo.equal_within("a", "b", v.ROUTE_BUFFER))
    rows = with_sections(lines, "route_id", F.when(~F.col("same"), F.col("a")), subroutes, literal_second_test)
    rows = rows.withColumn("x", F.explode_outer("spans"))
    found, start = F.col("x").isNotNull(), F.coalesce("x.s", F.lit(0.0))
    stretch = k.substring("a", start, F.coalesce("x.e", F.lit(0.0)))
    out = rows.select(
        "country", "provider", "route_id", "route", F.when(found, geo.wkt_of_points(stretch)).otherwise(F.lit("LINESTRING EMPTY")).alias("stretch"),
        F.when(F.col("same"), F.lit(v.OPTIMAL)).when(found, F.lit(v.POTENTIAL_ERROR)).otherwise(F.lit(v.ROUTING_ISSUE)).alias("rac_state"), start.alias("_s"),
    )
    return out.withColumn("case_id", tx.hashed_uuid(F.lit(run_id), "route_id", F.round("_s", 9))).drop("_s")


def attach_states(routes: DataFrame, compared: DataFrame) -> DataFrame:
    return routes.join(compared.select("route_id", "rac_state").distinct(), "route_id", "left")


def default_states(sections: DataFrame) -> DataFrame:
    """Without a classifier every section is a potential error with -1 for all trace figures."""
    return sections.filter(~geo.is_empty("stretch")).select(
        "route_id", "case_id", "stretch", k.geodesic_length(geo.points_of_wkt("stretch")).alias("stretch_length"),
        F.lit(v.POTENTIAL_ERROR).alias("fcd_state"),
        *[F.lit(-1.0).alias(c) for c in ("pra", "prb", "prab", "lift")], F.lit(-1).alias("tot"),
    )


# ---- merge -----------------------------------------------------------------------------------


def is_feedback() -> Column:
    """Reviewed, and not a temporary MBP case."""
    state, subtype = F.col("mcp_state"), F.col("error_subtype")
    return (state.isNotNull() & (state != "MBP")) | ((state == "MBP") & (subtype == "NO-TEMP"))


def is_error_log() -> Column:
    """Not reviewed, and either not feedback or a potential error; NULLs follow three-valued logic."""
    return F.col("mcp_state").isNull() & (~is_feedback() | (F.col("fcd_state") == v.POTENTIAL_ERROR))


ROUTE_COLUMNS = [
    "route_id", "country", "sample_id", "competitor", "provider_route", "provider_route_time", "provider_route_length", "origin",
    "destination", "provider", "competitor_route", "competitor_route_length", "competitor_route_time", "rac_state",
]
SECTION_COLUMNS = [
    "route_id", "case_id", "stretch", "stretch_length", "fcd_state", "pra", "prb", "prab", "lift", "tot", "reference_case_id",
    "mcp_state", "error_subtype",
]


def merge_inspection(
    new_routes: DataFrame, known_routes: DataFrame, new_sections: DataFrame, known_sections: DataFrame, run_id: str, options: dict,
    times: dict[str, float], api_calls: dict[str, int], inspection_date: str,
) -> dict[str, DataFrame]:
    """The five output tables of a run as lazy frames; nothing comes to the driver."""
    routes = new_routes.select(*ROUTE_COLUMNS).unionByName(known_routes.select(*ROUTE_COLUMNS)).withColumn("run_id", F.lit(run_id))
    fresh = new_sections.select(
        *[F.col(c) if c in new_sections.columns else F.lit(None).cast("string").alias(c) for c in SECTION_COLUMNS]
    )
    sections = fresh.unionByName(known_sections.select(*SECTION_COLUMNS)).withColumn("run_id", F.lit(run_id))
    feedback = sections.filter(is_feedback()).select("run_id", "route_id", "case_id", "mcp_state", "reference_case_id", "error_subtype")
    logs = sections.filter(is_error_log()).select("run_id", "case_id", "route_id", "stretch")
    details = routes.select(
        "run_id", "route_id", "provider_route", "competitor_route", "country", "provider", "competitor", "origin", "destination"
    )
    logs = logs.join(details, ["run_id", "route_id"], "left").withColumn("product", F.lit(options["product"]))
    country = routes.agg(F.min("country").alias("country"))
    tasks = sections.agg(F.count_if(is_error_log()).cast("int").alias("mcp_tasks"))
    metadata = country.crossJoin(tasks).select(  # one row each
        F.lit(run_id).alias("run_id"), *[F.lit(options.get(c)).alias(c) for c in ("sample_id", "provider", "endpoint", "mapdate", "product")],
        "country", F.lit("all_fail").alias("mode"), F.lit(options.get("competitor")).alias("competitor"), "mcp_tasks",
        (F.col("mcp_tasks") < 1).alias("completed"), F.lit(inspection_date).alias("inspection_date"),
        F.when(F.col("mcp_tasks") < 1, F.lit("Automatically closed")).otherwise(F.lit("")).alias("comment"),
        F.lit(times.get("rac", 0.0)).alias("rac_elapsed_time"), F.lit(times.get("fcd", 0.0)).alias("fcd_elapsed_time"),
        F.lit(float(sum(times.values()))).alias("total_elapsed_time"),
        F.to_json(F.create_map(*[F.lit(x) for pair in sorted(api_calls.items()) for x in pair])).alias("api_calls")
        if api_calls else F.lit("{}").alias("api_calls"),
    )
    return {
        "inspection_routes": routes,
        "inspection_critical_sections": sections.drop("mcp_state", "error_subtype"),
        "critical_sections_with_mcp_feedback": feedback,
        "error_logs": logs,
        "inspection_metadata": metadata,
    }


# ---- dedup -----------------------------------------------------------------------------------


def already_inspected(metadata: DataFrame, provider: str, sample_id: str, product: str, competitor: str) -> DataFrame:
    return metadata.filter(
        (F.col("provider") == provider) & (F.col("sample_id") == sample_id) & (F.col("product") == product)
        & (F.col("competitor") == competitor)
    )


def check_duplicates(metadata: DataFrame, provider: str, sample_id: str, product: str, competitor: str, avoid: bool = True) -> bool:
    """Error when the same inspection was run before; one row is looked at."""
    if avoid and not already_inspected(metadata, provider, sample_id, product, competitor).isEmpty():
        raise ValueError("this inspection has already been done")
    return True


def dedup_exact(df: DataFrame, order_by: list, column: str = "stretch") -> DataFrame:
    return first_per_key(df, [column], order_by)


def rounded_key(column: str = "stretch", digits: int = 2) -> Column:
    """Vertices rounded; text that is not a line with a space before the bracket stands for itself."""
    is_line = F.col(column).rlike(r"LINESTRING \(.*\)")
    return F.struct(
        F.when(is_line, geo.round_points(geo.points_of_wkt(column), digits)).alias("line"),
        F.when(~F.coalesce(is_line, F.lit(False)), F.col(column)).alias("other"),
    )


def dedup_rounded(df: DataFrame, order_by: list, column: str = "stretch", digits: int = 2) -> DataFrame:
    return first_per_key(df.withColumn("_key", rounded_key(column, digits)), ["_key"], order_by).drop("_key")


def dedup_near(
    df: DataFrame, ordinal: str, column: str = "stretch", max_distance: float = 0.005, max_point_diff: int = 1, digits: int = 2
) -> DataFrame:
    """One row per group of near duplicates, compared on rounded vertices: the first non-null value of each column in row order."""
    rounded = df.select(ordinal, geo.round_points(geo.points_of_wkt(column), digits).alias("_p"))
    taken = near_duplicates(rounded, ordinal, "_p", max_distance, max_point_diff)
    rows = df.join(taken.select(ordinal, F.col("seed").alias("_seed")), ordinal, "left").withColumn("_seed", F.coalesce("_seed", ordinal))
    # min_by skips rows whose order is null, and with them the null values.
    firsts = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(ordinal))).alias(c) for c in df.columns if c != ordinal]
    return rows.groupBy(F.col("_seed").alias(ordinal)).agg(*firsts).select(df.columns)


def dedup_stretches(df: DataFrame, ordinal: str, column: str = "stretch") -> DataFrame:
    """Exact, then rounded, then near duplicates; a table without the column passes through."""
    if column not in df.columns:
        return df
    once = dedup_exact(df, [ordinal], column)
    twice = cut_lineage(dedup_rounded(once, [ordinal], column))
    return dedup_near(twice, ordinal, column)


def dedup_tables(tables: dict[str, DataFrame], ordinal: str = "_ordinal") -> dict[str, DataFrame]:
    """The dedup chain on each table that has stretches; row order is the hash of the case id, then run and case id themselves."""
    out = {}
    for name, df in tables.items():
        if "stretch" in df.columns:
            ids = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("run_id", "case_id") if c in df.columns]
            df = dedup_stretches(df.withColumn(ordinal, F.struct(hash_key("case_id").alias("h"), *ids)), ordinal).drop(ordinal)
        out[name] = df
    return out


# ---- artificial inspection --------------------------------------------------------------------


def artificial_inspection(log: DataFrame, metadata: DataFrame, products: list[str], n: int, seed: int = 0) -> DataFrame:
    """``n`` discarded sections of the given products, the latest case per stretch, drawn repeatably."""
    runs = metadata.filter(F.col("product").isin(*products)).select("run_id").distinct()
    rows = log.filter(tx.normal_state("fcd_state") == v.NO_ERROR).join(runs, "run_id", "left_semi")
    latest = first_per_key(rows, ["stretch"], [newest_first("inspection_date"), "case_id"])
    return exact_sample(latest, n, ["case_id"], seed)
