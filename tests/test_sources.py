import json

import pytest
from pyspark.sql import functions as F

from waymark import schemas
from waymark.functions import text as tx
from waymark.plans import inspection as ins, mapdata as md
from waymark.sources import ingest as ig
from waymark.sources.datasets import Catalog, write_by_columns


def logs(spark, ids, pipeline="p1"):
    return spark.createDataFrame([(i, pipeline, "tbt") for i in ids], "case_id string, pipeline_id string, source_type string")


def test_catalog_round_trips(spark, tmp_path):
    cat = Catalog(spark, str(tmp_path))
    assert cat.read_or_empty("errorlogs").count() == 0
    cat.initialise(["error_logs"])
    assert cat.read("error_logs").schema.fieldNames() == schemas.schema_of("error_logs").fieldNames()
    cat.replace_partitions("errorlogs", logs(spark, ["a", "b"]))
    cat.replace_partitions("errorlogs", logs(spark, ["x"], "p2"))
    cat.replace_partitions("errorlogs", logs(spark, ["c"]))
    assert sorted((r["pipeline_id"], r["case_id"]) for r in cat.read("errorlogs").collect()) == [("p1", "c"), ("p2", "x")]
    cat.append_new("errorlogs", logs(spark, ["c", "d"]), ["case_id"])
    assert cat.read("errorlogs").filter("pipeline_id = 'p1'").count() == 2
    cat.export_csv({"logs": cat.read("errorlogs")}, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv" / "logs")).count() == 3
    write_by_columns(logs(spark, ["a", "b"]), str(tmp_path / "by"), ["pipeline_id"])
    assert spark.read.parquet(str(tmp_path / "by")).count() == 2


def test_schema_helpers(spark):
    df = schemas.conform(spark.createDataFrame([("1", "2.5")], "run_id string, total_elapsed_time string"), "inspection_metadata")
    row = df.first()
    assert row["total_elapsed_time"] == 2.5 and row["sample_id"] is None
    with pytest.raises(ValueError):
        schemas.require_same_frame(df, df.drop("run_id"))


def test_geojson_and_csv(spark, tmp_path):
    feature = {"geometry": {"coordinates": [[1.5, 2.0], [3, 4], [5.25, 6.5]]}, "properties": {"sample_id": "s", "route_id": "r", "country": "X"}}
    (tmp_path / "f.geojson").write_text(json.dumps({"features": [feature, feature]}))
    samples = ig.samples_from_features(ig.feature_rows(spark, str(tmp_path / "f.geojson")))
    assert {(r["origin"], r["destination"]) for r in samples.collect()} == {("POINT(1.5 2.0)", "POINT(5.25 6.5)")}
    assert ig.metadata_from_samples(samples).count() == 1
    (tmp_path / "r.csv").write_text("origin,destination,id\nPOINT(1 2),POINT(3 4),a\nbad,POINT(3 4),b\n")
    lines = ig.lines_from_csv(spark, str(tmp_path / "r.csv"))
    assert [json.loads(r["properties"]) for r in lines.collect()] == [{"id": "a"}]
    assert ig.bad_rows(spark.read.option("header", True).csv(str(tmp_path / "r.csv"))).first()["dropped"] == 1
    with pytest.raises(ValueError):
        ig.require_rows(samples.filter("false"), "samples")


def test_documents(spark):
    df = spark.createDataFrame([('{"origin":"nowhere","to_coord":"52.5, 22.25","route_id":"r"}',)], "d string")
    row = ig.samples_from_documents(df, "d", "wanted").first()
    assert (row["origin"], row["destination"], row["sample_id"]) == ("POINT(0.0 0.0)", "POINT(22.25 52.5)", "wanted")


def test_duplicate_gate(spark):
    meta = spark.createDataFrame([("P", "s", "x", "C")], "provider string, sample_id string, product string, competitor string")
    assert ins.check_duplicates(meta, "P", "s", "y", "C") is True
    assert ins.check_duplicates(meta, "P", "s", "x", "C", avoid=False) is True
    with pytest.raises(ValueError):
        ins.check_duplicates(meta, "P", "s", "x", "C")


def test_weights_and_store(spark):
    a, b = [(0.0, 0.0), (0.0, 1.0)], [(0.0, 1.0), (0.0, 0.0)]
    df = spark.createDataFrame([("t1", 1, a), ("t2", 1, b), ("t3", 1, a), ("t4", 2, b)], "original_trace_id string, feature_id int, line array<struct<x: double, y: double>>")
    got = {(r["feature_id"], r["weight_direction"]): (r["weight"], r["original_trace_id"]) for r in md.weight_features(md.weight_directions(df), "P").collect()}
    assert got == {(1, True): (2, "t1"), (1, False): (1, "t2"), (2, True): (1, "t4")}
    stored = spark.createDataFrame([("s", "p", "v")] * 2, "sample_id string, product string, map_version string")
    with pytest.raises(ValueError):
        md.match_store(df, stored, "s", "p", "v", [])


def test_uuid_shape(spark):
    got = spark.range(1).select(tx.hashed_uuid(F.lit("a"), F.lit(1)).alias("u")).first()["u"]
    assert [len(p) for p in got.split("-")] == [8, 4, 4, 4, 12]


def test_large_files_are_dealt_to_more_tasks_than_cores(spark, tmp_path):
    from waymark.fixtures import spread

    spark.range(20000).selectExpr("id", "md5(string(id)) as text").coalesce(1).write.parquet(f"{tmp_path}/t a")
    df = spark.read.parquet(f"{tmp_path}/t a")
    cores = spark.sparkContext.defaultParallelism
    assert spread(df).rdd.getNumPartitions() == cores
    more = spread(df, most=20000)
    assert more.rdd.getNumPartitions() > 2 * cores
    assert more.count() == 20000


def test_folders_get_one_file_though_partitions_are_cut(spark, tmp_path):
    import glob

    from waymark.sources import datasets as ds

    df = spark.range(0, 40000, 1, 8).selectExpr("id % 30 as a", "id % 7 as b", "md5(string(id)) as text")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        ds.write_by_columns(df, f"{tmp_path}/out", ["a", "b"])
    finally:
        spark.conf.set(key, before)
    files = glob.glob(f"{tmp_path}/out/a=*/b=*/*.parquet")
    assert len(files) == 210
    assert spark.read.parquet(f"{tmp_path}/out").count() == 40000
