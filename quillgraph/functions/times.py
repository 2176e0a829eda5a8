"""Event times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_time(charttime: Column, chartdate: Column) -> Column:
    """The event time of a note: its chart time, else its chart date; null where neither parses."""
    raw = F.coalesce(F.nullif(charttime, F.lit("")), chartdate)
    return F.coalesce(
        F.try_to_timestamp(F.substring(raw, 1, 19), F.lit("yyyy-MM-dd HH:mm:ss")),
        F.try_to_timestamp(F.substring(raw, 1, 10), F.lit("yyyy-MM-dd")),
    )
