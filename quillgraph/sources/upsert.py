"""Keyed merges of node and edge tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import keep_first


def upsert_nodes(current: DataFrame, incoming: DataFrame, key: str, version: str | None = None) -> DataFrame:
    """Merge nodes on one key; incoming properties win, and properties the incoming table lacks are kept.

    Rows without a key are dropped. ``version`` names a column of the incoming table that says which of several
    rows of a key is the last; that row replaces the node, nulls included. Without one, every property takes the smallest value
    that an incoming row of the key has, and keeps the old one if all of them have null.
    """
    rows = incoming.filter(F.col(key).isNotNull())
    properties = [c for c in incoming.columns if c not in (key, version)]
    if version:
        latest = keep_first(rows, [key], [F.col(version).desc_nulls_last()]).drop(version)
    elif properties:
        latest = rows.groupBy(key).agg(*[F.min(c).alias(c) for c in properties])
    else:
        latest = rows.select(key).distinct()
    joined = current.alias("old").join(
        latest.withColumn("_incoming", F.lit(True)).alias("new"), F.col(f"old.{key}") == F.col(f"new.{key}"), "full"
    )

    def newest(name: str) -> Column:
        if name not in latest.columns:
            return F.col(f"old.{name}")
        if name not in current.columns:
            return F.col(f"new.{name}")
        if version:
            return F.when(F.col("_incoming"), F.col(f"new.{name}")).otherwise(F.col(f"old.{name}"))
        return F.coalesce(f"new.{name}", f"old.{name}")

    names = [*current.columns, *[c for c in latest.columns if c not in current.columns]]
    return joined.select(*[(F.coalesce(f"new.{c}", f"old.{c}") if c == key else newest(c)).alias(c) for c in names])


def existing_endpoints(edges: DataFrame, sources: DataFrame, targets: DataFrame) -> DataFrame:
    """Keep the edges whose two endpoints are nodes. Node tables have columns ``id``, edges ``src`` and ``dst``."""
    return edges.join(sources.select(F.col("id").alias("src")), "src", "left_semi").join(
        targets.select(F.col("id").alias("dst")), "dst", "left_semi"
    )


def merged_rows(rows: DataFrame, identity: tuple[str, ...] = ()) -> DataFrame:
    """One row per (src, dst, identity properties), without rows that lack one of these.

    Of several rows the one with the smallest remaining properties is kept, nulls last, so that the result does not depend on
    row order and a row of nulls never wins over a filled one.
    """
    key = ["src", "dst", *identity]
    complete = rows.dropna(subset=key)
    rest = [c for c in rows.columns if c not in key]
    if not rest:
        return complete.dropDuplicates(key)
    return keep_first(complete, key, [F.col(c).asc_nulls_last() for c in rest])


def upsert_edges(
    current: DataFrame | None,
    incoming: DataFrame,
    sources: DataFrame,
    targets: DataFrame,
    identity: tuple[str, ...] = (),
) -> DataFrame:
    """Merge edges: both endpoints must exist, and (src, dst, identity properties) is unique.

    Several incoming rows of one key are merged by :func:`merged_rows`. An incoming edge replaces the properties that its
    table has; those that only the current table has are kept, and a new property is null on edges that do not come in.
    """
    key = ["src", "dst", *identity]
    fresh = existing_endpoints(merged_rows(incoming, identity), sources, targets).select(*incoming.columns)
    if current is None:
        return fresh
    only_old = [c for c in current.columns if c not in incoming.columns]
    if only_old:
        fresh = fresh.join(current.select(*key, *only_old), key, "left")
    kept = current.join(fresh.select(*key), key, "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True)


def rename_same_as(resolved: dict[str, DataFrame], labels: dict[str, str]) -> DataFrame:
    """Same-as tables of several entity types as one edge table (src, dst, label, confidence), ids as text.

    For the graph itself, in which ids keep their type and endpoints must be nodes, see ``Graph.with_same_as``.
    """
    parts = [
        df.select(
            F.col("id_a").cast("string").alias("src"),
            F.col("id_b").cast("string").alias("dst"),
            F.lit(labels[kind]).alias("label"),
            "confidence",
        )
        for kind, df in resolved.items()
    ]
    return reduce(DataFrame.unionByName, parts)
