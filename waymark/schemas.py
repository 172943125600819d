"""One schema per dataset, and conforming a frame to it in a single projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Column names and types of the stored datasets, as DDL. Numbers are double everywhere.
SCHEMAS: dict[str, str] = {
    "sampling_samples": """
        sample_id STRING, tile_id STRING, origin STRING, destination STRING, route_id STRING, quality STRING,
        country STRING, date_generated DATE, org STRING
    """,
    "sampling_metadata": """
        sample_id STRING, country STRING, fcd_extraction_time DOUBLE, fcd_extracted_routes DOUBLE,
        processed_routes DOUBLE, processing_time DOUBLE, date_generated DATE, osm_map_version STRING, parameters STRING,
        api_calls STRING, sample_q STRING, final_routes INT, elapsed_time INT, metric STRING
    """,
    "inspection_routes": """
        route_id STRING, country STRING, sample_id STRING, competitor STRING, provider_route STRING,
        provider_route_time DOUBLE, provider_route_length DOUBLE, origin STRING, destination STRING, provider STRING,
        competitor_route STRING, competitor_route_length DOUBLE, competitor_route_time DOUBLE, rac_state STRING,
        run_id STRING
    """,
    "inspection_critical_sections": """
        route_id STRING, case_id STRING, stretch STRING, stretch_length DOUBLE, fcd_state STRING, pra DOUBLE,
        prb DOUBLE, prab DOUBLE, lift DOUBLE, tot INT, reference_case_id STRING, run_id STRING
    """,
    "critical_sections_with_mcp_feedback": """
        run_id STRING, route_id STRING, case_id STRING, mcp_state STRING, reference_case_id STRING, error_subtype STRING
    """,
    "error_logs": """
        run_id STRING, route_id STRING, case_id STRING, stretch STRING, provider_route STRING, competitor_route STRING,
        country STRING, provider STRING, competitor STRING, product STRING
    """,
    "inspection_metadata": """
        run_id STRING, sample_id STRING, provider STRING, endpoint STRING, mapdate DATE, product STRING, country STRING,
        mode STRING, competitor STRING, mcp_tasks INT, completed BOOLEAN, inspection_date DATE, comment STRING,
        rac_elapsed_time DOUBLE, fcd_elapsed_time DOUBLE, total_elapsed_time DOUBLE, api_calls STRING,
        sanity_fail BOOLEAN, sanity_msg STRING
    """,
    "scheduled_error_logs_history": """
        run_id STRING, case_id STRING, stretch STRING, provider_route STRING, competitor_route STRING,
        error_type STRING, evaluated_by STRING, review_date TIMESTAMP, comment STRING, country STRING, provider STRING,
        product STRING, competitor STRING, route_id STRING
    """,
    "scheduled_metrics": """
        run_id STRING, routes INT, errors INT, provider_km DOUBLE, provider_hours DOUBLE, eph DOUBLE,
        metrics_per_error_type STRING, metrics_per_mqs STRING, publish_value_stream BOOLEAN, publish_harold BOOLEAN,
        failed_routes DOUBLE, competitor_hours DOUBLE, competitor_km DOUBLE, eph_lower DOUBLE, eph_upper DOUBLE,
        rac_state STRING, failed_routes_lower DOUBLE, failed_routes_upper DOUBLE
    """,
    "aggregation_weights": """
        country_name STRING, country STRING, top STRING, weight DOUBLE, ranking BIGINT
    """,
    "errorlogs": """
        case_id STRING, route_id STRING, country STRING, provider STRING, product STRING, source_type STRING,
        origin STRING, destination STRING, stretch STRING, run_id STRING, pipeline_id STRING, project STRING,
        location_label STRING
    """,
}


def schema_of(name: str) -> T.StructType:
    """The schema of a dataset; needs a session, which reads the DDL."""
    return T.StructType.fromDDL(SCHEMAS[name])


PARTITIONS: dict[str, list[str]] = {
    "inspection_routes": ["provider", "country", "sample_id", "run_id"],
    "inspection_critical_sections": ["run_id"],
    "critical_sections_with_mcp_feedback": ["run_id"],
    "scheduled_error_logs_history": ["run_id"],
    "errorlogs": ["pipeline_id", "source_type"],
}


def conform(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Select and cast every field; a missing column becomes NULL."""
    schema = schema_of(schema) if isinstance(schema, str) else schema
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
        ]
    )


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], schema_of(name))


def require_same_frame(a: DataFrame, b: DataFrame) -> None:
    """Error unless both frames have the same column names and types."""
    one, two = dict(a.dtypes), dict(b.dtypes)
    if one != two:
        raise ValueError(f"schemas differ: {sorted(set(one.items()) ^ set(two.items()))}")


def common_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union on the columns both frames have."""
    shared = [c for c in a.columns if c in b.columns]
    return a.select(*shared).unionByName(b.select(*shared))
