"""Exact order statistics per group, without bringing a group into one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, materialize_measured

_SPLITS = 256


def _inside(value: str) -> Column:
    return (F.col("_lo").isNull() | (F.col(value) > F.col("_lo"))) & (
        F.col("_hi").isNull() | (F.col(value) <= F.col("_hi"))
    )


def _narrow(counts: DataFrame, targets: DataFrame, group: list[str], value: str) -> DataFrame:
    """Replace the value range of every target by the one of 256 sub-ranges that holds its rank."""
    scoped = counts.join(targets, group).filter(_inside(value))
    points = F.array(*[F.lit(i / _SPLITS) for i in range(1, _SPLITS)])
    splits = scoped.groupBy(*group, "_name").agg(
        F.array_distinct(F.percentile_approx(value, points, F.lit(20 * _SPLITS))).alias("_splits")
    )
    slot = F.size(F.filter("_splits", lambda s: s < F.col(value)))
    per_slot = (
        scoped.join(splits, [*group, "_name"])
        .withColumn("_slot", slot)
        .groupBy(*group, "_name", "_slot")
        .agg(
            F.sum("_c").alias("_rows"),
            F.count(F.lit(1)).alias("_values"),
            F.first("_splits").alias("_splits"),
            *[F.first(c).alias(c) for c in ("_n", "_rank", "_base", "_lo", "_hi")],
        )
    )
    below = Window.partitionBy(*group, "_name").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = per_slot.withColumn("_below", F.col("_base") + F.coalesce(F.sum("_rows").over(below), F.lit(0)))
    hit = (F.col("_rank") >= F.col("_below")) & (F.col("_rank") < F.col("_below") + F.col("_rows"))
    return placed.filter(hit).select(
        *group,
        "_name",
        "_n",
        "_rank",
        F.col("_below").alias("_base"),
        F.coalesce(F.get("_splits", F.col("_slot") - 1), F.col("_lo")).alias("_lo"),
        F.coalesce(F.get("_splits", F.col("_slot")), F.col("_hi")).alias("_hi"),
        "_values",
    )


def order_statistics(
    df: DataFrame,
    group: list[str],
    value: str,
    ranks: dict[str, Callable[[Column], Column]],
    task_limit: int = 1_000_000,
) -> DataFrame:
    """The elements at given 0-based ranks of the sorted values of every group: (group, n, one column per name).

    ``ranks`` maps a name to a function of the row count ``n`` giving a rank. Equal values are counted together
    first. A group with more than ``task_limit`` distinct values is narrowed to ever smaller value ranges around
    each rank, and only the last range is sorted.
    """
    keys = group or ["_all"]
    rows = df if group else df.withColumn("_all", F.lit(1))
    present = rows.filter(F.col(value).isNotNull())
    counts = materialize(present.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c")), "value-counts")
    sizes = counts.groupBy(*keys).agg(F.sum("_c").alias("_n"), F.count(F.lit(1)).alias("_values"))
    wanted = F.explode(
        F.array(*[F.struct(F.lit(k).alias("_name"), f(F.col("_n")).cast("bigint").alias("_rank")) for k, f in ranks.items()])
    )
    no_bound = F.lit(None).cast(df.schema[value].dataType)
    targets = sizes.select(*keys, "_n", "_values", wanted.alias("t")).select(
        *keys, "t._name", "_n", "t._rank", F.lit(0).cast("bigint").alias("_base"),
        no_bound.alias("_lo"), no_bound.alias("_hi"), "_values",
    )
    targets, seen = materialize_measured(targets, "rank-targets", widest=F.max("_values"))
    while (widest := seen["widest"] or 0) > task_limit:
        targets, seen = materialize_measured(
            _narrow(counts, targets, keys, value), "rank-targets", widest=F.max("_values")
        )
        if seen["widest"] >= widest:
            raise RuntimeError(f"a range of {widest} values cannot be narrowed to {task_limit}")
    running = Window.partitionBy(*keys, "_name").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    found = (
        counts.join(targets, keys)
        .filter(_inside(value))
        .withColumn("_upto", F.col("_base") + F.sum("_c").over(running))
        .filter((F.col("_upto") > F.col("_rank")) & (F.col("_upto") - F.col("_c") <= F.col("_rank")))
    )
    named = [F.max(F.when(F.col("_name") == name, F.col(value))).alias(name) for name in ranks]
    return found.groupBy(*keys).agg(F.max("_n").alias("n"), *named).select(*group, "n", *ranks)


def latency_summary(df: DataFrame, group: list[str], value: str, task_limit: int = 1_000_000) -> DataFrame:
    """(group, n, p50, p95, p99): the interpolated median and the sorted elements at int(q * n)."""
    ranks = {
        "_low": lambda n: F.floor((n - 1) / 2),
        "_high": lambda n: F.floor(n / 2),
        "p95": lambda n: F.floor(n * F.lit(0.95)),
        "p99": lambda n: F.floor(n * F.lit(0.99)),
    }
    stats = order_statistics(df, group, value, ranks, task_limit)
    return stats.select(*group, "n", ((F.col("_low") + F.col("_high")) / 2).alias("p50"), "p95", "p99")


def smallest(df: DataFrame, score: str, n: int, task_limit: int = 1_000_000) -> DataFrame:
    """The ``n`` rows with the smallest distinct scores, found by a cut-off instead of a global sort."""
    if n <= 0:
        return df.limit(0)
    cut = order_statistics(df, [], score, {"cut": lambda total: F.least(total, F.lit(n)) - 1}, task_limit).first()
    return df.filter(F.col(score) <= cut["cut"]) if cut else df.limit(0)
