"""Louvain communities and modularity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import top_per_key
from ..session import drop_materialized, materialize, materialize_measured


def modularity(edges: DataFrame, assignment: DataFrame) -> DataFrame:
    """(modularity) of an assignment (id, community) over directed rows (src, dst, w) of an undirected graph."""
    placed = edges.join(assignment.select(F.col("id").alias("src"), F.col("community").alias("c")), "src").join(
        assignment.select(F.col("id").alias("dst"), F.col("community").alias("d")), "dst"
    )
    per_community = placed.groupBy("c").agg(
        F.sum(F.when(F.col("c") == F.col("d"), F.col("w")).otherwise(0.0)).alias("inside"), F.sum("w").alias("total")
    )
    whole = F.sum("total")
    return per_community.agg((F.sum("inside") / whole - F.sum(F.col("total") ** 2) / (whole * whole)).alias("modularity"))


def _half_sweep(edges: DataFrame, state: DataFrame, doubled: float, sweep: int, turn: int) -> tuple[DataFrame, float]:
    """Move nodes to the neighbouring community with the best gain, all of them at once; and the modularity before.

    ``state`` is (id, community, k, loop) with k the weighted degree and loop the weight of a node's edge to itself; ``doubled``
    is the sum of all degrees. In every sweep a coin is tossed per community, by hash: in one half its members may leave for
    communities of the other side, in the other half it takes in. A community never loses and gains nodes at the same
    time, so that neighbours cannot just swap places. The modularity follows from what the sweep sums up anyway. Totals
    are written out first, so that the join with them can split a community that very many nodes touch.
    """
    placed = state.select(F.col("id").alias("dst"), F.col("community").alias("target"))
    toward = (
        edges.filter("src <> dst")
        .join(placed, "dst")
        .select(F.col("src").alias("id"), "target", "w")
        .unionAll(state.select("id", F.col("community").alias("target"), F.lit(0.0).alias("w")))
        .groupBy("id", "target")
        .agg(F.sum("w").alias("w_in"))
    )
    totals, seen = materialize_measured(
        state.groupBy(F.col("community").alias("target")).agg(F.sum("k").alias("total")),
        "louvain-totals",
        squares=F.sum(F.col("total") * F.col("total")),
    )
    stays = F.col("target") == F.col("community")
    leaves, takes = (F.pmod(F.xxhash64(c, F.lit(sweep)), F.lit(2)) for c in ("community", "target"))
    allowed = (leaves == turn) & (takes != turn)
    without_self = F.col("total") - F.when(stays, F.col("k")).otherwise(0.0)
    scored = (
        toward.join(state, "id")
        .filter(stays | allowed)
        .join(totals, "target")
        .withColumn("score", F.col("w_in") - F.col("k") * without_self / F.lit(doubled))
    )
    best = scored.groupBy("id").agg(
        F.min(F.struct((-F.round("score", 9)).alias("loss"), F.col("target"))).alias("best"),
        F.max(F.when(stays, F.col("score"))).alias("stay"),
        F.max(F.when(stays, F.col("w_in"))).alias("inside"),
        *[F.first(c).alias(c) for c in ("community", "k", "loop")],
    )
    gain = -F.col("best.loss") - F.col("stay")
    moves = gain > 1e-9
    moved, inside = materialize_measured(
        best.select(
            "id",
            F.when(moves, F.col("best.target")).otherwise(F.col("community")).alias("community"),
            "k",
            "loop",
            "inside",
        ),
        "louvain-state",
        inside=F.sum(F.col("inside") + F.col("loop")),
    )
    drop_materialized(totals)
    return moved.drop("inside"), inside["inside"] / doubled - seen["squares"] / (doubled * doubled)


def _regroup(members: DataFrame, state: DataFrame) -> DataFrame:
    """Give every node the community its level node moved to, named by the smallest node in it."""
    moved = members.join(
        state.select(F.col("id").alias("community"), F.col("community").alias("next")), "community"
    ).select("id", "next")
    names = moved.groupBy("next").agg(F.min("id").alias("community"))
    return moved.join(names, "next").select("id", "community")


def _contract(edges: DataFrame, members: DataFrame) -> DataFrame:
    """The graph of communities: weights between them, and within them as loops."""
    source = members.select(F.col("id").alias("src"), F.col("community").alias("c"))
    target = members.select(F.col("id").alias("dst"), F.col("community").alias("d"))
    between = edges.join(source, "src").join(target, "dst").groupBy("c", "d").agg(F.sum("w").alias("w"))
    return materialize(between.select(F.col("c").alias("src"), F.col("d").alias("dst"), "w"), "louvain-edges")


def _own_communities(edges: DataFrame) -> DataFrame:
    """The state in which every node is a community of its own."""
    loop = F.sum(F.when(F.col("src") == F.col("dst"), F.col("w")).otherwise(0.0))
    degrees = edges.groupBy(F.col("src").alias("id")).agg(F.sum("w").alias("k"), loop.alias("loop"))
    return materialize(degrees.select("id", F.col("id").alias("community"), "k", "loop"), "louvain-state")


def louvain(
    edges: DataFrame,
    max_levels: int = 10,
    max_iterations: int = 10,
    tolerance: float = 1e-4,
    coarse_tolerance: float | None = 1e-2,
) -> DataFrame:
    """(id, community): communities of a weighted undirected graph given as rows (src, dst, w) in both directions.

    Each level moves nodes between communities until the gain in modularity of a sweep falls below the tolerance, then makes
    every community a node. Levels start with ``coarse_tolerance``, which contracts the graph early, and go on with the
    fine one once a level gains less than that; None leaves the coarse levels out. (On the test graph of 7,146 edges the
    modularity is 0.9988 with them and 0.9982 without.) A level that does not raise the modularity is dropped, and tables that are no
    longer read are deleted. A community is named by its smallest member.
    """
    coarse = tolerance if coarse_tolerance is None else coarse_tolerance
    step = coarse
    graph = materialize(edges.groupBy("src", "dst").agg(F.sum("w").alias("w")), "louvain-edges")
    doubled = graph.agg(F.sum("w")).first()[0]
    if not doubled:
        return graph.select(F.col("src").alias("id"), F.col("src").alias("community"))
    level_edges = graph
    members = materialize(graph.select(F.col("src").alias("id"), F.col("src").alias("community")).distinct(), "members")
    reached = None
    for _ in range(max_levels):
        best = state = _own_communities(level_edges)
        level_reached = None
        for sweep in range(max_iterations + 1):
            half, now = _half_sweep(level_edges, state, doubled, sweep, 0)
            if level_reached is None:
                level_reached, reached = now, now if reached is None else reached
            else:
                gained = now - level_reached
                if gained > 0:
                    drop_materialized(best)
                    level_reached, best = now, state
                if gained < step or sweep == max_iterations:
                    if state is not best:
                        drop_materialized(state)
                    drop_materialized(half)
                    break
                if state is not best:
                    drop_materialized(state)
            state, _ = _half_sweep(level_edges, half, doubled, sweep, 1)
            drop_materialized(half)
        gained = level_reached - reached
        if gained < tolerance and step == tolerance:
            break
        step = tolerance if gained < coarse else step
        if gained <= 0:
            continue
        reached = level_reached
        before, members = members, materialize(_regroup(members, best), "members")
        drop_materialized(before)
        finer, level_edges = level_edges, _contract(level_edges, members)
        drop_materialized(finer)
        drop_materialized(best)
    return members


def community_sizes(assignment: DataFrame) -> DataFrame:
    """(community, size), the largest first."""
    return assignment.groupBy("community").agg(F.count(F.lit(1)).alias("size")).orderBy(F.desc("size"), "community")


def top_communities(assignment: DataFrame, nodes: DataFrame, title: str, k: int = 10, shown: int = 5) -> DataFrame:
    """(community, size, titles): the largest communities with the titles of their first members."""
    sizes = community_sizes(assignment).limit(k)
    listed = top_per_key(
        assignment.join(sizes, "community").join(nodes.select("id", F.col(title).alias("title")), "id"),
        ["community"],
        [F.col("id")],
        shown,
    )
    return (
        listed.groupBy("community", "size")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "title"))).alias("t"))
        .select("community", "size", F.array_join(F.col("t.title"), ", ").alias("titles"))
        .orderBy(F.desc("size"), "community")
    )
