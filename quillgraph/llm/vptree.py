"""Nearest vectors by cosine through one vantage-point tree per shard."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

FOUND = "query_id long, vec_id long, score double"
_SLACK = 1e-7


def usable(vector: Column) -> Column:
    """True for vectors that have a direction: no null, no component that is null or not finite, and one that is not zero."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Doubles with every row scaled by a power of two, which changes no cosine and keeps squares finite."""
    vectors = np.asarray(vectors, dtype=np.float64)
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The cosine of one vector with each row, summed in the same order for every row so that equal rows give equal values."""
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    return (vectors * query).sum(axis=1) / (norms * np.sqrt((query * query).sum()))


class VantageTree:
    """A vantage-point tree over the distinct vectors of one shard.

    Distances are those between unit vectors, which rank as the cosine does and obey the triangle inequality. A node
    holds a vantage point and the median distance to it; a leaf holds up to ``leaf`` vectors. Equal vectors are one
    entry with their smallest ids, as many as any answer can need.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, keep: int, leaf: int = 128) -> None:
        vectors = scaled(vectors)
        order = np.argsort(ids, kind="stable")
        ids, vectors = np.asarray(ids)[order], vectors[order]
        _, first, member = np.unique(vectors, axis=0, return_index=True, return_inverse=True)
        by = np.argsort(member.ravel(), kind="stable")
        starts = np.searchsorted(member.ravel()[by], np.arange(len(first)))
        ends = np.append(starts[1:], len(by))
        self.ids = [ids[by[s : min(e, s + keep)]] for s, e in zip(starts, ends, strict=True)]
        self.vectors = vectors[first]
        self.unit = self.vectors / np.sqrt((self.vectors**2).sum(axis=1))[:, None]
        self.leaf = leaf
        self.root = self._build(np.arange(len(first)))

    def _build(self, rows: np.ndarray):
        if len(rows) <= self.leaf:
            return rows
        point, rest = rows[0], rows[1:]
        away = self._distance(self.unit[rest], self.unit[point][None])[:, 0]
        radius = np.median(away)
        inner = away <= radius
        if inner.all():
            inner = away < radius
        if not inner.any() or inner.all():
            return rows
        return point, radius, self._build(rest[inner]), self._build(rest[~inner])

    @staticmethod
    def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> Iterator[tuple[int, int, float]]:
        """(query_id, vec_id, score) of each query's k nearest in the shard, its own row left out.

        A side of a node is passed over if ``factor`` times the query's distance to it, as the triangle inequality gives
        it, is beyond the k-th nearest so far. With factor 1 nothing is lost; above 1 more is passed over.
        """
        queries = scaled(queries)
        unit = queries / np.sqrt((queries**2).sum(axis=1))[:, None]
        near = np.full((len(queries), k + 1), np.inf)
        seen: list[list[np.ndarray]] = [[] for _ in queries]

        def note(active: np.ndarray, rows: np.ndarray) -> np.ndarray:
            away = self._distance(unit[active], self.unit[rows])
            best = np.concatenate([near[active], away], axis=1)
            near[active] = np.partition(best, k, axis=1)[:, : k + 1] if best.shape[1] > k + 1 else np.sort(best, axis=1)
            close = away <= near[active].max(axis=1)[:, None] + _SLACK
            for q, hit in zip(active[close.any(axis=1)], close[close.any(axis=1)], strict=True):
                seen[q].append(rows[hit])
            return away

        def visit(node, active: np.ndarray) -> None:
            if not len(active):
                return
            if isinstance(node, np.ndarray):
                note(active, node)
                return
            point, radius, inner, outer = node
            away = note(active, np.array([point]))[:, 0]
            inside = away <= radius

            def needed(gap: np.ndarray, who: np.ndarray) -> np.ndarray:
                return who[factor * gap <= near[who].max(axis=1) + _SLACK]

            visit(inner, active[inside])
            visit(outer, active[~inside])
            visit(outer, needed((radius - away)[inside], active[inside]))
            visit(inner, needed((away - radius)[~inside], active[~inside]))

        visit(self.root, np.arange(len(queries)))
        for q, own in enumerate(ids):
            rows = np.unique(np.concatenate(seen[q])) if seen[q] else np.empty(0, int)
            hits = [
                (-score, int(i))
                for row, score in zip(rows, cosines(queries[q], self.vectors[rows]), strict=True)
                for i in self.ids[row]
                if i != own
            ]
            for score, i in sorted(hits)[:k]:
                yield int(own), i, -float(score)


def nearest_vectors(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    factor: float = 1.0,
    shard_rows: int = 8192,
    block_rows: int = 512,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest cosine for every row that ``is_query`` picks.

    Every usable row is dealt by its id to a shard of about ``shard_rows``, whose tree is built once and written to the
    shared folder. Queries travel in blocks of ``block_rows`` to every shard, and each shard returns k rows a query.
    ``factor`` 1 makes the search exact; a larger one prunes more and may miss.

    Nearest first, ties to the smaller id, the row of the query's own id left out; fewer rows where there are fewer candidates. Vectors that are
    null, empty, zero or hold null or non-finite components, and rows without an id, take no part, and only
    vectors of equal length are compared. Of rows that repeat an id and vector, each counts as a candidate. Other columns are
    read only as far as ``is_query`` does. An empty table gives no rows.
    """
    found = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"), is_query.alias("is_query")
    ).filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    sizes = found.withColumn("dim", F.size("vector"))
    counted = sizes.groupBy("dim").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("is_query").cast("long")).alias("queries"))
    parts = counted.select(
        "dim",
        F.ceil(F.col("rows") / shard_rows).cast("int").alias("shards"),
        F.ceil(F.greatest("queries", F.lit(1)) / block_rows).cast("int").alias("blocks"),
    )
    dealt = sizes.join(parts, "dim")
    key = F.xxhash64("vec_id")

    def build(group: pd.DataFrame) -> pd.DataFrame:
        tree = VantageTree(group["vec_id"].to_numpy(), np.stack(group["vector"].to_numpy()), k + 1)
        head = group[["dim", "shard"]].iloc[:1]
        return head.assign(tree=[pickle.dumps(tree)])

    def block(group: pd.DataFrame) -> pd.DataFrame:
        rows = (group["vec_id"].to_numpy(), np.stack(group["vector"].to_numpy()))
        return group[["dim", "block", "shards"]].iloc[:1].assign(rows=[pickle.dumps(rows)])

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for tree, rows in zip(batch["tree"], batch["rows"], strict=True):
                hits = pickle.loads(tree).search(*pickle.loads(rows), k, factor)
                yield pd.DataFrame(hits, columns=["query_id", "vec_id", "score"])

    trees = dealt.select("dim", F.pmod(key, "shards").cast("int").alias("shard"), "vec_id", "vector")
    trees = materialize(trees.groupBy("dim", "shard").applyInPandas(build, "dim int, shard int, tree binary"), "trees")
    blocks = dealt.filter("is_query").select(
        "dim", "shards", F.pmod(key, "blocks").cast("int").alias("block"), "vec_id", "vector"
    )
    blocks = blocks.groupBy("dim", "shards", "block").applyInPandas(block, "dim int, block int, shards int, rows binary")
    asked = blocks.select("dim", "rows", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    hits = asked.join(trees, ["dim", "shard"]).select("tree", "rows").mapInPandas(search, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
