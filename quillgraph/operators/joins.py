"""Joins with a chosen layout or strategy. Every variant returns what the plain join returns."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .profile import frequent_keys

BROADCAST_ROW_LIMIT = 2_000_000
BROADCAST_BYTE_LIMIT = 256 << 20


def fits_broadcast(df: DataFrame, row_limit: int = BROADCAST_ROW_LIMIT, byte_limit: int = BROADCAST_BYTE_LIMIT) -> bool:
    """True if a count of its rows and bytes, made where they lie, shows that a table is within both limits."""
    fixed = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz")
    widths = [
        F.lit(16) if kind in fixed else F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
        for name, kind in df.dtypes
    ]
    width = sum(widths[1:], widths[0])
    seen = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(width).alias("bytes")).first()
    return seen["rows"] <= row_limit and (seen["bytes"] or 0) <= byte_limit


def broadcast_join(small: DataFrame, big: DataFrame, key: str, row_limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Inner join that broadcasts ``small`` if it was measured to be small. If not, it says so and lets Spark choose."""
    if fits_broadcast(small, row_limit):
        return big.join(F.broadcast(small), key)
    warnings.warn(f"a side of over {row_limit} rows is joined by a shuffle instead of a broadcast", stacklevel=2)
    return big.join(small, key)


def repartitioned_join(left: DataFrame, right: DataFrame, key: str, partitions: int) -> DataFrame:
    """Inner join after hashing both sides by the join key, so that the join needs no further shuffle."""
    return left.repartition(partitions, key).join(right.repartition(partitions, key), key)


def range_join_layout(left: DataFrame, right: DataFrame, key: str, partitions: int) -> DataFrame:
    """Inner join after range-partitioning both sides by the join key."""
    return left.repartitionByRange(partitions, key).join(right.repartitionByRange(partitions, key), key)


def coalesced_join(left: DataFrame, right: DataFrame, key: str, partitions: int) -> DataFrame:
    """Inner join after merging the input partitions of both sides without a shuffle."""
    return left.coalesce(partitions).join(right.coalesce(partitions), key)


def salted_join(
    small: DataFrame,
    big: DataFrame,
    key: str,
    row_key: list[str],
    salts: int = 10,
    hot_share: float = 0.01,
) -> DataFrame:
    """Inner join that spreads the hot keys of ``big`` over ``salts`` tasks each.

    A key is hot if it holds at least ``hot_share`` of the rows of ``big``; there are at most 1 / hot_share such
    keys, so the list is broadcast. Only the rows of ``small`` with a hot key are repeated, once per salt. A row's salt
    is a hash of ``row_key``, so a task that runs again gives the same rows.
    """
    hot = F.broadcast(frequent_keys(big, key, hot_share).withColumn("_hot", F.lit(True)))
    salt = F.pmod(F.xxhash64(*row_key), F.lit(salts)).cast("int")
    big_salted = big.join(hot, key, "left").withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(0)).drop("_hot")
    every_salt = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    small_salted = small.join(hot, key, "left").withColumn("_salt", F.explode(every_salt)).drop("_hot")
    return big_salted.join(small_salted, [key, "_salt"]).drop("_salt")
