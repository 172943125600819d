"""Stored datasets: written, written again, read back. Every query works in a new folder beside the checkpoints."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from waymark.plans import reporting as rp
from waymark.queries import query
from waymark.session import ensure_checkpoint_dir
from waymark.sources import datasets as ds


def _store(t) -> ds.Catalog:
    ensure_checkpoint_dir(t.spark)
    return ds.Catalog(t.spark, f"{t.spark.sparkContext.getCheckpointDir()}/store_{uuid.uuid4().hex}")


def _sections(t):
    return t.fx_sections.withColumn("stretch", F.lit("LINESTRING EMPTY")).withColumn("lift", F.col("probability"))


def _per_run(df):
    return df.groupBy("run_id").agg(F.count("*").alias("n"), F.round(F.sum("stretch_length"), 2).alias("metres"), F.round(F.sum("lift"), 4).alias("lift"))


@query("sections_appended", "select run_id, count(*) as n, round(sum(stretch_length), 2) as metres, round(sum(probability), 4) as lift from fx_sections group by run_id")
def sections_appended(t):
    """Empty typed tables, then appends by run, read back by name."""
    store = _store(t)
    store.initialise(["inspection_critical_sections", "inspection_routes"])
    even = F.col("run_id").cast("int") % 2 == 0
    for half in (even, ~even):
        store.write("inspection_critical_sections", _sections(t).filter(half))
    return _per_run(store.read("inspection_critical_sections"))


@query(
    "sections_replaced",
    """select run_id, count(*) as n, round(sum(stretch_length), 2) as metres, round(sum(case when run_id in ('1994', '1995') then probability + 1 else probability end), 4) as lift
    from fx_sections group by run_id""",
)
def sections_replaced(t):
    """The partitions of two runs are replaced, twice: the others stay, and nothing is there twice."""
    store, name = _store(t), "inspection_critical_sections"
    store.write(name, _sections(t))
    again = _sections(t).filter("run_id in ('1994', '1995')").withColumn("lift", F.col("lift") + 1)
    for _ in range(2):
        store.replace_partitions(name, again)
    return _per_run(store.read(name))


@query(
    "run_deleted_from_store",
    """select 'inspection_critical_sections' as dataset, run_id, count(*) as n from fx_sections where run_id <> '1995' group by run_id
    union all select 'inspection_routes', run_id, count(*) from fx_routes where run_id <> '1995' group by run_id
    union all select 'inspection_metadata', run_id, count(*) from fx_metadata where run_id <> '1995' group by run_id""",
)
def run_deleted_from_store(t):
    """A run leaves three datasets: two by their partitions, one that has none by a rewrite. Deleting it again changes nothing."""
    store = _store(t)
    tables = {"inspection_critical_sections": _sections(t), "inspection_routes": t.fx_routes, "inspection_metadata": t.fx_metadata}
    for name, df in tables.items():
        store.write(name, df)
    for _ in range(2):
        store.delete_run(list(tables), "1995")
    out = [store.read(name).groupBy(F.lit(name).alias("dataset"), "run_id").agg(F.count("*").alias("n")) for name in tables]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query(
    "cleaned_datasets",
    """select 'inspection_critical_sections' as dataset, count(*) as before, cast(0 as bigint) as after from fx_sections
    union all select 'inspection_metadata', count(*), 0 from fx_metadata""",
)
def cleaned_datasets(t):
    """What a former run left behind goes when the datasets are initialised."""
    store, out = _store(t), []
    for name, df in (("inspection_critical_sections", _sections(t)), ("inspection_metadata", t.fx_metadata)):
        store.write(name, df)
        before = store.read(name).count()
        store.initialise([name])
        out.append(store.read(name).agg(F.count("*").alias("after")).select(F.lit(name).alias("dataset"), F.lit(before).cast("bigint").alias("before"), "after"))
    return out[0].unionByName(out[1])


@query(
    "csv_read_back",
    """select 'routes' as dataset, count(*) as n, count(distinct route_id) as ids, round(sum(provider_route_length), 2) as total from fx_routes
    union all select 'sections', count(*), count(distinct case_id), round(sum(stretch_length), 2) from fx_sections""",
)
def csv_read_back(t):
    """Exported with a header, read back by its names."""
    store = _store(t)
    store.export_csv({"routes": t.fx_routes, "sections": t.fx_sections}, store.root)
    out = []
    for name, key, value in (("routes", "route_id", "provider_route_length"), ("sections", "case_id", "stretch_length")):
        df = t.spark.read.option("header", True).csv(f"{store.root}/{name}")
        out.append(df.agg(F.lit(name).alias("dataset"), F.count("*").alias("n"), F.countDistinct(key).alias("ids"), F.round(F.sum(F.col(value).cast("double")), 2).alias("total")))
    return out[0].unionByName(out[1])


@query("labels_by_columns", "select country, quality, count(*) as n, count(distinct route_id) as routes from fx_routes group by country, quality")
def labels_by_columns(t):
    """One group of files for each country and quality, overwritten once; the partition columns come back from the folders."""
    path = f"{_store(t).root}/labels"
    for share in (F.col("quality") == "Q1", F.lit(True)):
        ds.write_by_columns(t.fx_routes.filter(share), path, ["country", "quality"])
    return t.spark.read.parquet(path).groupBy("country", "quality").agg(F.count("*").alias("n"), F.countDistinct("route_id").alias("routes"))


@query(
    "finished_runs_once",
    """with r as (select distinct run_id from fx_metadata), f as (select distinct run_id from fx_routes)
    select run_id, cast(case when run_id < '1995' then 1 else 2 end as integer) as pass, count(*) over () as stored from r join f using (run_id)""",
)
def finished_runs_once(t):
    """Runs are scored as they finish and written; a run that is stored is not scored again, and a third pass finds none."""
    store, name = _store(t), "scheduled_metrics"
    store.initialise([name])
    reviewed = t.fx_sections.filter("mcp_state is not null").select("run_id", "route_id", F.col("mcp_state").alias("error_type"))
    seen = None
    for number, finished in enumerate((F.col("run_id") < "1995", F.lit(True), F.lit(True)), 1):
        meta = t.fx_metadata.withColumn("completed", finished)
        new = rp.score_finished_runs(t.fx_routes, reviewed, meta, store.read(name).select("run_id"))
        ids = new.select("run_id", F.lit(number).alias("pass"))
        ids = t.spark.createDataFrame(ids.collect(), "run_id string, pass int")  # a few runs
        store.write(name, new)
        seen = ids if seen is None else seen.unionByName(ids)
    total = store.read(name).agg(F.count("*").alias("stored"))
    return seen.crossJoin(F.broadcast(total))
