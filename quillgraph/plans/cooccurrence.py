"""Which codes occur together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, tasks_for


#: Pairs that one task forms or counts.
_TASK_PAIRS = 1_000_000


def _count_within(members: DataFrame, formed: int, possible: int) -> DataFrame:
    """(code_a, code_b, co_count) over (src, dst) rows: pairs of codes in the same basket.

    ``formed`` is the number of such pairs, ``possible`` how many different ones there may be. The number of tasks grows with the
    pairs, and Spark does not merge them, since each holds the counts of the pairs it forms. If most pairs are different, counting them
    before the shuffle saves nothing, and they are dealt over as many tasks to be counted; else they are counted map-side first.
    """
    tasks = tasks_for(members.sparkSession, formed, _TASK_PAIRS)
    members = members.repartition(tasks, "src")
    a = members.select("src", F.col("dst").alias("code_a"))
    b = members.select("src", F.col("dst").alias("code_b"))
    met = a.join(b, "src").filter(F.col("code_a") < F.col("code_b")).select("code_a", "code_b")
    if possible > formed:
        met = met.repartition(tasks, "code_a", "code_b")
    return met.groupBy("code_a", "code_b").agg(F.count(F.lit(1)).alias("co_count"))


def _count_across_blocks(members: DataFrame) -> DataFrame:
    """Like :func:`_count_within` for (src, dst, blocks) rows: every basket as the upper triangle of its pairs of blocks.

    The codes of a basket fall into ``blocks`` blocks by hash. A cell of the triangle is a pair of blocks, and each code goes to the
    cells of its block: as a row of the triangle to one side of the join, as a column to the other. So a task forms
    no more pairs at a time than two blocks have, and every pair of a basket stands in one cell.
    """
    placed = members.withColumn("own", F.pmod(F.xxhash64("dst"), "blocks").cast("int"))
    last = F.col("blocks").cast("int") - 1
    a = placed.select("src", F.col("dst").alias("a"), F.col("own").alias("low"), F.explode(F.sequence("own", last)).alias("high"))
    b = placed.select("src", F.col("dst").alias("b"), F.col("own").alias("high"), F.explode(F.sequence(F.lit(0), "own")).alias("low"))
    met = a.join(b, ["src", "low", "high"]).filter((F.col("low") < F.col("high")) | (F.col("a") < F.col("b")))
    ends = F.least("a", "b").alias("code_a"), F.greatest("a", "b").alias("code_b")
    return met.select(*ends).groupBy("code_a", "code_b").agg(F.count(F.lit(1)).alias("co_count"))


def cooccurrence(pairs: DataFrame, min_support: int = 5, block_codes: int = 1_024) -> DataFrame:
    """(code_a, code_b, co_count, log_count) for codes that share at least ``min_support`` baskets, code_a < code_b.

    ``pairs`` holds distinct (src, dst): basket and code. A basket of more than ``block_codes`` codes is dealt over tasks as pairs
    of blocks of about that many (:func:`_count_across_blocks`), without the codes that are in fewer baskets than
    ``min_support`` and so in no pair that counts.
    """
    size = F.col("size")
    sizes = pairs.groupBy("src").agg(F.count(F.lit(1)).alias("size"), F.max("dst").alias("some"))
    seen = sizes.agg(
        F.max("size").alias("most"),
        F.sum(F.when(size <= block_codes, size * (size - 1) / 2).otherwise(0)).cast("bigint").alias("formed"),
        F.approx_count_distinct("some").alias("codes"),  # no more than there are; if far fewer, pairs are counted map-side
    ).first()
    formed, possible = seen["formed"] or 0, seen["codes"] * (seen["codes"] - 1) // 2
    if (seen["most"] or 0) <= block_codes:
        counts = _count_within(pairs, formed, possible)
    else:
        large = materialize(sizes.filter(size > block_codes).select("src", "size"), "large-baskets")
        support = pairs.groupBy("dst").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_support).select("dst")
        members = pairs.join(large, "src").join(materialize(support, "frequent"), "dst", "left_semi")
        blocks = F.ceil(F.col("size") / block_codes).alias("blocks")
        across = _count_across_blocks(members.select("src", "dst", blocks))
        within = _count_within(pairs.join(large, "src", "left_anti"), formed, possible)
        counts = within.unionAll(across).groupBy("code_a", "code_b").agg(F.sum("co_count").alias("co_count"))
    return counts.filter(F.col("co_count") >= min_support).withColumn("log_count", F.log("co_count"))


def with_pmi(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """Add ``pmi``: the log of how much more often two codes meet than they would by chance."""
    baskets = pairs.select("src").distinct().count()
    support = materialize(pairs.groupBy("dst").agg(F.count(F.lit(1)).alias("n")), "support")
    joined = edges.join(support.select(F.col("dst").alias("code_a"), F.col("n").alias("n_a")), "code_a").join(
        support.select(F.col("dst").alias("code_b"), F.col("n").alias("n_b")), "code_b"
    )
    expected = F.col("n_a").cast("double") * F.col("n_b")
    return joined.withColumn("pmi", F.log(F.col("co_count") * F.lit(float(baskets)) / expected)).select(
        *edges.columns, "pmi"
    )


def both_directions(edges: DataFrame, weight: str | None = None) -> DataFrame:
    """(src, dst, w): an undirected edge table as two directed edges per row."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    ends = F.explode(
        F.array(
            F.struct(F.col("code_a").alias("src"), F.col("code_b").alias("dst")),
            F.struct(F.col("code_b").alias("src"), F.col("code_a").alias("dst")),
        )
    )
    return edges.select(ends.alias("e"), w.alias("w")).select("e.src", "e.dst", "w")


def connected_nodes(edges: DataFrame) -> DataFrame:
    """(connected_nodes): how many codes have at least one edge."""
    return both_directions(edges).select("src").distinct().agg(F.count(F.lit(1)).alias("connected_nodes"))


def projection_counts(name: str, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(graph_name, node_count, relationship_count) of a projected graph; an undirected edge counts twice."""
    counted = nodes.select(F.lit(1).alias("n"), F.lit(0).alias("r")).unionAll(
        edges.select(F.lit(0).alias("n"), F.lit(1).alias("r"))
    )
    return counted.agg(F.sum("n").alias("node_count"), F.sum("r").alias("relationship_count")).select(
        F.lit(name).alias("graph_name"), "node_count", "relationship_count"
    )
