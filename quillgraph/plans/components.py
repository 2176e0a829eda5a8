"""Connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_materialized, materialize, materialize_measured


def _written(least: DataFrame) -> DataFrame:
    """The table of minima as files: a join with it can split the rows of a hub, which one with an aggregate cannot."""
    return materialize(least, "least")


def _toward_minimum(edges: DataFrame, keep_larger: bool) -> DataFrame:
    """One contraction round over rows (hi, lo), hi > lo.

    ``keep_larger`` links every node's larger neighbours to the smallest node of its neighbourhood; otherwise its smaller
    neighbours and itself are.
    """
    if keep_larger:
        around = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = _written(around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u")))
        moved = around.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    else:
        around = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        least = _written(around.groupBy("u").agg(F.min("v").alias("m")))
        moved = (
            around.join(least, "u")
            .select(F.col("v").alias("hi"), F.col("m").alias("lo"))
            .unionAll(least.select(F.col("u").alias("hi"), F.col("m").alias("lo")))
        )
    return moved.filter("hi > lo").distinct()


def connected_components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(id, component): every node with the smallest id it is connected to, over undirected (src, dst) edges.

    Alternating star contraction (Kiveris et al. 2014): the edge table is rewritten until every component is a star around
    its smallest node. It needs rounds in the order of the logarithm of the size, also for long chains.
    """
    state = edges.filter("src <> dst").select(F.greatest("src", "dst").alias("hi"), F.least("src", "dst").alias("lo"))
    state = state.distinct()
    mark = None
    for _ in range(max_rounds):
        # xor of row hashes with the count: equal for equal edge sets, whatever their order
        wide, before = _toward_minimum(state, keep_larger=True), state
        state, seen = materialize_measured(
            _toward_minimum(wide, keep_larger=False),
            "stars",
            n=F.count(F.lit(1)),
            x=F.bit_xor(F.xxhash64("hi", "lo")),
        )
        if mark is not None:
            drop_materialized(before)
        if (seen["n"], seen["x"]) == mark:
            break
        mark = (seen["n"], seen["x"])
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    stars = state.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
    return nodes.select("id").join(stars, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
