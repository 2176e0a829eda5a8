"""Row counts, null profiles and frequency tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, row_count, null_count, null_share) per column, from one pass over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns]
    )
    long = F.explode(
        F.array(*[F.struct(F.lit(name).alias("column_name"), F.col(name).alias("null_count")) for name in df.columns])
    )
    return (
        counts.select("_rows", long.alias("c"))
        .select("c.column_name", F.col("_rows").alias("row_count"), "c.null_count")
        .withColumn("null_share", F.col("null_count") / F.greatest("row_count", F.lit(1)))
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) over several tables."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def key_frequency(df: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Rows per key, most frequent first: the view that shows skew."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("frequency")).orderBy(F.desc("frequency"), key)
    return counts.limit(limit) if limit else counts


def frequent_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """The keys that hold at least ``share`` of all rows: never more than 1 / share of them."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("frequency"))
    total = df.count()
    return counts.filter(F.col("frequency") >= F.lit(max(1.0, share * total))).select(key)


def mean_and_deviation(df: DataFrame, key: str, value: Column) -> DataFrame:
    """Mean and sample standard deviation per key."""
    return df.groupBy(key).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean_value"), F.stddev_samp(value).alias("sd_value")
    )
