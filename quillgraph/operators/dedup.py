"""Deduplication and top rows per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of every key in an order, with their rank.

    Spark prunes each task to ``k`` rows per key before the shuffle, so a key with very many rows stays cheap.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first one in an order."""
    return top_per_key(df, keys, order, 1, "_rank").drop("_rank")
