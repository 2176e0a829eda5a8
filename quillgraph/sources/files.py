"""Delimited and Parquet files, bucketed tables and small metric reports."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.hashing import hash_bucket
from . import csv_split


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if a path exists in whatever file system it names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case all column names."""
    return df.toDF(*[name.lower() for name in df.columns])


def read_delimited(spark: SparkSession, path: str, schema: str | StructType | None = None, **options) -> DataFrame:
    """Read CSV files with a header; quoted fields may hold line breaks, and an empty cell is null.

    Columns are matched to ``schema`` by name whatever their case and order, for every file by its own header, which is read
    from the head of the file with the options given; a column the schema does not list is read as a string, and one a file lacks
    is null. Without a schema the types are inferred.

    A file of one split is read by one task. A larger one is read by as many as it has splits, also if its fields
    hold line breaks (:func:`quillgraph.sources.csv_split.read_split`), unless it is compressed or not in UTF-8. ``multiLine=False`` says that no
    field holds any.
    """
    settings = {"header": True, "multiLine": True, "escape": '"', "nullValue": "", **options}
    if schema is None:
        return lower_columns(spark.read.options(inferSchema=True, **settings).csv(path))
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    types = {field.name.lower(): field.dataType for field in wanted}
    encoding = str({k.lower(): v for k, v in options.items()}.get("encoding", "UTF-8"))
    dialect, most = csv_split.Dialect.of(settings), spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    files = sorted(spark.read.text(path).inputFiles())
    groups: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for file, (head, size, plain) in zip(files, csv_split.file_heads(spark, files, encoding), strict=True):
        large = size > most and plain and bool(settings["multiLine"]) and encoding.upper() in ("UTF-8", "UTF8")
        if size:
            groups.setdefault((tuple(dialect.names(head)), large), []).append(file)
    parts = []
    for (header, large), some in groups.items():
        present = [name.lower() for name in header]
        layout = StructType([StructField(name, types.get(name, StringType())) for name in present])
        df = csv_split.read_split(spark, some, layout, settings) if large else spark.read.schema(layout).options(**settings).csv(some)
        parts.append(
            df.select(
                *[(F.col(f"`{f.name.lower()}`") if f.name.lower() in present else F.lit(None).cast(f.dataType)).alias(f.name) for f in wanted],
                *[F.col(f"`{name}`") for name in present if name not in types],
            )
        )
    if not parts:
        return spark.createDataFrame([], wanted)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Read the named Parquet table of a folder, optionally only some columns."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None if there is none."""
    return spark.read.parquet(path) if path_exists(spark, path) else None


def present_inputs(spark: SparkSession, paths: Iterable[str]) -> tuple[list[str], list[str]]:
    """Split paths into those that exist and those to skip."""
    found = {path: path_exists(spark, path) for path in paths}
    return [p for p, ok in found.items() if ok], [p for p, ok in found.items() if not ok]


def write_table(df: DataFrame, path: str, max_records_per_file: int = 0) -> None:
    """Overwrite a flat Parquet table; ``max_records_per_file`` bounds the size of each file."""
    df.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file).parquet(path)


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, files_per_bucket: int | None = None) -> None:
    """Overwrite a Parquet table with one directory per hash bucket of ``key``.

    A directory per key would mean millions of them. The rows of a bucket are spread over ``files_per_bucket`` tasks and files
    by a hash of the whole row, so that neither a bucket nor a key with very many rows fills one task. By default there
    are twice as many files as cores; a large table should name a number that gives files of some hundred MB. Slots are
    dealt out by range, since a hash would put several of them into one task and leave others empty.
    """
    if files_per_bucket is None:
        files_per_bucket = max(1, -(-2 * df.sparkSession.sparkContext.defaultParallelism // buckets))
    part = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_bucket))
    bucketed = df.withColumn("bucket", hash_bucket(key, buckets))
    slots = bucketed.withColumn("_slot", F.col("bucket") * files_per_bucket + part)
    laid_out = slots.repartitionByRange(buckets * files_per_bucket, "_slot").drop("_slot")
    laid_out.write.mode("overwrite").partitionBy("bucket").parquet(path)


def read_bucket_of(spark: SparkSession, path: str, key: str, value, buckets: int, key_type: str) -> DataFrame:
    """The rows of one key of a bucketed table; only the directory of its bucket is read."""
    literal = F.lit(value).cast(key_type)
    df = spark.read.parquet(path)
    return df.filter((F.col("bucket") == hash_bucket(literal, buckets)) & (F.col(key) == literal)).drop("bucket")


def write_report(df: DataFrame, path: str) -> None:
    """Write a small table of metrics as a single CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read back a table of metrics."""
    return spark.read.schema(schema).option("header", True).csv(path)

