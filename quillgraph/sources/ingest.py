"""Batch ingest of delimited files into Parquet, with a row count and a null profile per table."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.profile import null_profile
from .files import path_exists, read_delimited, write_bucketed, write_table

REPORT_SCHEMA = "table_name string, row_count bigint, elapsed_s double, high_null_columns string"


def ingest_table(
    spark: SparkSession,
    source: str,
    target: str,
    schema: str | None = None,
    partition_key: str | None = None,
    buckets: int = 4,
    files_per_bucket: int | None = None,
    **options,
) -> DataFrame:
    """Load one file into a Parquet table and return its null profile, taken from the written table."""
    df = read_delimited(spark, source, schema, **options)
    if partition_key and partition_key.lower() in df.columns:
        write_bucketed(df, target, partition_key.lower(), buckets, files_per_bucket)
        written = spark.read.parquet(target).drop("bucket")
    else:
        write_table(df, target)
        written = spark.read.schema(df.schema).parquet(target)
    return null_profile(written)


def ingest_all(
    spark: SparkSession,
    source_dir: str,
    target_dir: str,
    schemas: dict[str, str],
    partition_keys: dict[str, str | None],
    buckets: int = 4,
    null_share: float = 0.1,
    files_per_bucket: int | None = None,
) -> DataFrame:
    """Ingest every table whose file exists, skipping the others; one report row per table."""
    report = []
    for table, schema in schemas.items():
        source = f"{source_dir}/{table.upper()}.csv"
        if not path_exists(spark, source):
            continue
        started = time.perf_counter()
        profile = ingest_table(
            spark, source, f"{target_dir}/{table}", schema, partition_keys.get(table), buckets, files_per_bucket
        ).collect()  # one row per column
        elapsed = time.perf_counter() - started
        flagged = ",".join(row["column_name"] for row in profile if row["null_share"] > null_share)
        report.append((table, profile[0]["row_count"], round(elapsed, 2), flagged))
    return spark.createDataFrame(report, REPORT_SCHEMA).orderBy(F.col("table_name"))
