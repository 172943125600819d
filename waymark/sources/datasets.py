"""Named datasets: typed reads, partitioned writes, idempotent exports."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import PurePosixPath

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from waymark import schemas
from waymark.functions import text as tx
from waymark.values import ERROR_LOG_SOURCE


# Shuffle partitions by two and more columns, which can have thousands of combinations.
FOLDER_PARTITIONS = 2048


def by_folder(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of one combination of the columns in one task per AQE-sized slice: few files, also for a hot combination.

    AQE cuts a large partition by its map tasks, so every slice holds rows of all folders of that partition, and each of them gets
    a file a slice. With many partitions a folder has its own, or shares it with few; small neighbours are read by one task.
    """
    if len(columns) < 2:
        return df.hint("rebalance", *columns)
    shuffles = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.hint("rebalance", max(FOLDER_PARTITIONS, shuffles), *columns)


@dataclass
class Catalog:
    """Datasets below one root folder, by name: path, schema and partition columns."""

    spark: SparkSession
    root: str
    paths: dict[str, str] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return self.paths.get(name, str(PurePosixPath(self.root) / name))

    def read(self, name: str) -> DataFrame:
        """Scan with the fixed schema; partition folders prune, columns prune."""
        return self.spark.read.schema(schemas.schema_of(name)).parquet(self.path(name))

    def read_or_empty(self, name: str) -> DataFrame:
        try:
            return self.read(name)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return schemas.empty(self.spark, name)

    def write(self, name: str, df: DataFrame, mode: str = "append") -> None:
        """Few files: see ``by_folder``."""
        parts = schemas.PARTITIONS.get(name, [])
        out = schemas.conform(df, name)
        if parts:
            by_folder(out, parts).write.mode(mode).partitionBy(*parts).parquet(self.path(name))
        else:
            out.write.mode(mode).parquet(self.path(name))

    def initialise(self, names: list[str]) -> None:
        """Zero-row tables with the right schema; replaces what a run left behind."""
        for name in names:
            schemas.empty(self.spark, name).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(self.path(name))

    def append_new(self, name: str, df: DataFrame, keys: list[str]) -> None:
        self.write(name, only_new(df, self.read_or_empty(name), keys))

    def replace_partitions(self, name: str, df: DataFrame) -> None:
        """Overwrite only the partitions that occur in ``df``: running an export twice leaves one copy."""
        parts = schemas.PARTITIONS[name]
        by_folder(schemas.conform(df, name), parts).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(*parts).parquet(self.path(name))

    def delete_run(self, names: list[str], run_id: str) -> None:
        """Take a run out of datasets: its partition folders where run_id is a partition column, else the dataset is rewritten.

        A rewrite goes through a second folder, since a dataset can't be overwritten while it is read.
        """
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            parts, path = schemas.PARTITIONS.get(name, []), self.path(name)
            if "run_id" not in parts:
                kept = self.read(name).filter(~F.col("run_id").eqNullSafe(F.lit(run_id)))
                kept.write.mode("overwrite").parquet(f"{path}.kept")
                self.spark.read.schema(schemas.schema_of(name)).parquet(f"{path}.kept").write.mode("overwrite").parquet(path)
                continue
            escaped = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(run_id)
            folders = jvm.org.apache.hadoop.fs.Path("/".join([path, *(f"{p}={escaped}" if p == "run_id" else "*" for p in parts)]))
            files = folders.getFileSystem(conf)
            for found in files.globStatus(folders) or []:
                files.delete(found.getPath(), True)

    def export_csv(self, tables: dict[str, DataFrame], folder: str) -> None:
        for name, df in tables.items():
            df.write.mode("overwrite").option("header", True).csv(str(PurePosixPath(folder) / name))


def only_new(df: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not stored yet."""
    return df.join(stored.select(*keys), keys, "left_anti")


def write_by_columns(df: DataFrame, path: str, columns: list[str], mode: str = "overwrite") -> None:
    """One file group per combination of the columns: see ``by_folder``."""
    by_folder(df, columns).write.mode(mode).partitionBy(*columns).parquet(path)


def batch_numbers(df: DataFrame, id_cols: list[str], size: int = 500) -> DataFrame:
    """Batches of at most ``size`` ids for paced enrichment."""
    from waymark.operators.order import numbered

    return numbered(df, id_cols, "_n").withColumn("batch", F.floor(F.col("_n") / size)).drop("_n")


def error_log_export(logs: DataFrame, pipelines: DataFrame, pipeline_id: str) -> DataFrame:
    """Error logs in the export layout: source, project and label by pipeline id, points as "lat, lon"."""
    info = pipelines.select(F.col("id").alias("pipeline_id"), "project", F.col("label").alias("location_label"))
    out = logs.withColumn("pipeline_id", F.lit(pipeline_id)).withColumn("source_type", F.lit(ERROR_LOG_SOURCE))
    out = out.join(info, "pipeline_id", "left")
    out = out.withColumn("origin", tx.point_as_lat_lon("origin")).withColumn("destination", tx.point_as_lat_lon("destination"))
    return schemas.conform(out, "errorlogs")
