"""Repeatable samples."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.hashing import md5_number


def hash_sample(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """The rows whose key hashes below ``fraction``: the same rows on every run and at every layout."""
    return df.filter(md5_number(key, digits=7) % 1000 < int(1000 * fraction))


def first_rows(df: DataFrame, order: str, n: int) -> DataFrame:
    """The first ``n`` rows by a key."""
    return df.orderBy(order).limit(n)
