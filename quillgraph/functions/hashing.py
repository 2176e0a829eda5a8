"""Hashes that other SQL engines can repeat: the leading hex digits of md5, as a number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX_DIGITS = 15  # 60 bits, always positive in a bigint


def md5_number(*parts: Column | str, digits: int = _HEX_DIGITS) -> Column:
    """The first ``digits`` hex digits of md5 over the parts joined by '|', as a bigint."""
    text = F.concat_ws("|", *[(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def hash_bucket(column: Column | str, buckets: int) -> Column:
    """The bucket of a key in a bucketed table."""
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")
