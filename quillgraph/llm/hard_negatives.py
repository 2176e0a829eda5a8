"""Hard negatives of anchor vectors by Fagin's threshold algorithm over sorted lists per dimension."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, result_only

_HITS = "anchor_id long, positive_id long, positive_score long, vec_id long, score long"
_FIRST_STEP = 32
_EXACT = 2.0**53


class Ask(NamedTuple):
    """What an anchor looks for: the ``k`` best rows of its label, or of another, with a score from ``low`` to ``high`` in each window."""

    same_label: bool
    low: list[int]
    high: list[int]
    k: int


class SortedLists:
    """The rows of one shard: their scaled components, and for every dimension the rows in ascending order of it."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = np.asarray(ids)[order], np.asarray(labels)[order]
        self.vectors = np.asarray(vectors, np.float64)[order]
        self.lists = np.argsort(self.vectors, axis=0, kind="stable").astype(np.int32)

    def scores(self, anchor: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Integer inner products. Doubles are exact up to 2 ** 53; beyond that Python's integers are used."""
        part = self.vectors[rows]
        if part.size and np.abs(part).max() * np.abs(anchor).sum() >= _EXACT:
            return np.array([sum(int(x) * int(y) for x, y in zip(row, anchor, strict=True)) for row in part], object)
        return (part @ anchor).astype(np.int64)

    def search(self, own: int, label: int, anchor: np.ndarray, ask: Ask) -> list[tuple[int, int, int]]:
        """(window, vec_id, score): each window's best rows of this shard, the row of the anchor's id left out.

        Every list is read from the end that the sign of the anchor's component favours, all to the same depth. A row met for
        the first time is scored on its whole vector. No row that has not been met scores above the threshold, the
        inner product of the anchor with the values the lists have come to. The search ends once that falls strictly below
        the k-th score of every window, or below its lower bound while it holds fewer than k; so ties are complete.
        """
        count, used = len(self.ids), np.flatnonzero(anchor)
        weights, up = anchor[used], anchor[used] > 0
        fits = (self.labels == label) == ask.same_label
        fits &= self.ids != own
        seen, met_rows, met_scores = np.zeros(count, bool), [], []
        depth, step = 0, _FIRST_STEP
        while depth < count:
            to = min(count, depth + step)
            high = self.lists[count - to : count - depth, used[up]]
            low = self.lists[depth:to, used[~up]]
            fresh = np.zeros(count, bool)
            fresh[high.ravel()] = True
            fresh[low.ravel()] = True
            if not len(used):
                fresh[:], to = True, count
            new = np.flatnonzero(fresh & ~seen)
            seen |= fresh
            new = new[fits[new]]
            met_rows.append(new)
            met_scores.append(self.scores(anchor, new))
            depth, step = to, step * 2
            if depth == count:
                break
            at = np.empty(len(used), np.int32)
            at[up], at[~up] = self.lists[count - depth, used[up]], self.lists[depth - 1, used[~up]]
            edge = self.vectors[at, used]
            threshold = float(edge @ weights)
            threshold += np.abs(edge * weights).sum() * 1e-12  # not below the exact value
            if self._done(np.concatenate(met_scores), ask, threshold):
                break
        rows, scores = np.concatenate(met_rows), np.concatenate(met_scores)
        order = np.argsort(rows)  # which is the order of their ids
        order = order[np.argsort(-scores[order], kind="stable")]
        rows, scores = rows[order], scores[order]
        out = []
        for window, (low, high) in enumerate(zip(ask.low, ask.high, strict=True)):
            inside = np.flatnonzero((scores >= low) & (scores <= high))[: ask.k]
            out += [(window, int(self.ids[rows[i]]), int(scores[i])) for i in inside]
        return out

    @staticmethod
    def _done(scores: np.ndarray, ask: Ask, threshold: float) -> bool:
        for low, high in zip(ask.low, ask.high, strict=True):
            if low > high or threshold < low:
                continue
            inside = scores[(scores >= low) & (scores <= high)]
            if len(inside) < ask.k or threshold >= np.sort(inside)[-ask.k]:
                return False
        return True


def usable(vector: Column, scale: int) -> Column:
    """True for vectors that are not null and of whose components none is null or beyond the finite doubles when scaled."""
    size = lambda x: F.abs(x.cast("double") * scale)
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (size(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & good, F.lit(False))


def _matrix(column: pa.ChunkedArray, dim: int, scale: int) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]).to_numpy(zero_copy_only=False)
    return np.floor(flat.astype(np.float64) * scale).reshape(len(column), dim)


@result_only("hard-negatives")
def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
    shard_cells: int = 1 << 19,
    block_cells: int = 1 << 15,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): near rows of another label than their anchor.

    Components are multiplied by ``scale`` and rounded down; a row's score is its integer inner product with the anchor. The first
    ``positives`` rows of the anchor's label are its positives. For each of them the first ``negatives`` rows of other labels
    are returned whose score is from ``low_percent`` to ``high_percent`` hundredths of the positive's. Higher scores come first,
    ties by smaller id; fewer rows where there are fewer. A positive of negative score has an empty window.

    Rows are dealt by their id to shards of about ``shard_cells`` components, anchors to blocks of ``block_cells``. A
    task holds one shard and one block, sorts the shard once for every dimension and runs the threshold algorithm for each
    anchor (:class:`SortedLists`), first for positives and, once the shards' answers are merged, for the windows. A
    shard returns as many rows a window as are asked for.

    Rows whose id, label or vector is null, or that hold null or non-finite components (also after scaling), take no part. Only
    vectors of equal length are compared; the inner product of empty ones is 0. Of rows that repeat an id, the
    least by label and vector counts. Scores must fit 64 bits. Other columns are read only as far as ``is_anchor`` and ``label``
    do. An empty table, or one without anchors, gives no rows.
    """
    vector = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    found = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        vector.alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    )
    found = found.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector"), scale))
    one = found.groupBy("vec_id").agg(F.min(F.struct("label", "vector", "is_anchor")).alias("r"))
    rows = materialize(one.select("vec_id", "r.*", F.size("r.vector").alias("dim")), "vectors")

    def parts(count: Column, cells: int) -> Column:
        return F.greatest(F.ceil(count * F.greatest("dim", F.lit(1)) / cells), F.lit(1)).cast("int")

    counted = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_anchor").alias("anchors"))
    counted = counted.filter("anchors > 0")
    sizes = counted.select("dim", parts(F.col("n"), shard_cells).alias("shards"), parts(F.col("anchors"), block_cells).alias("blocks"))
    dealt = rows.join(sizes, "dim")
    key = F.xxhash64("vec_id")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    at = ["dim", "shard", "block"]
    shards = dealt.select("dim", F.pmod(key, "shards").cast("int").alias("shard"), every("blocks").alias("block"), "vec_id", "label", "vector")

    def asked(anchors: DataFrame) -> DataFrame:
        block = F.pmod(F.xxhash64(F.lit(1), "vec_id"), "blocks").cast("int").alias("block")
        return anchors.select("dim", every("shards").alias("shard"), block, "vec_id", "label", "vector", "low", "high", "positive_id", "positive_score")

    def search(same_label: bool, k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
        def run(shard: pa.Table, block: pa.Table) -> pa.Table:
            out: list[tuple] = []
            if shard.num_rows and block.num_rows:
                dim = shard.column("dim")[0].as_py()
                ids, labels = (shard.column(c).to_numpy() for c in ("vec_id", "label"))
                lists = SortedLists(ids, labels, _matrix(shard.column("vector"), dim, scale))
                anchors = _matrix(block.column("vector"), dim, scale)
                rest = block.drop_columns(["vector"]).to_pylist()
                for anchor, r in zip(anchors, rest, strict=True):
                    ask = Ask(same_label, r["low"], r["high"], k)
                    hits = lists.search(r["vec_id"], r["label"], anchor, ask)
                    out += [(r["vec_id"], r["positive_id"][w], r["positive_score"][w], i, s) for w, i, s in hits]
            columns = zip(*out, strict=True) if out else [()] * 5
            names = [f.split()[0] for f in _HITS.split(", ")]
            return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})

        return run

    def searched(anchors: DataFrame, same_label: bool, k: int) -> DataFrame:
        hits = shards.groupBy(at).cogroup(asked(anchors).groupBy(at)).applyInArrow(search(same_label, k), _HITS)
        order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "vec_id")
        return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    anchors = materialize(dealt.filter("is_anchor"), "anchors")  # a table of its own, so that its columns are no part of the rows
    least, most = F.lit(-(1 << 63)).cast("long"), F.lit((1 << 63) - 1).cast("long")
    open_ = {"low": least, "high": most, "positive_id": F.lit(-1).cast("long"), "positive_score": F.lit(0).cast("long")}
    near = searched(anchors.withColumns({name: F.array(value) for name, value in open_.items()}), True, positives)
    near = materialize(near.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    window = F.struct(
        F.ceil(F.col("positive_score").cast("decimal(24,0)") * low_percent / 100).cast("long").alias("low"),
        F.floor(F.col("positive_score").cast("decimal(24,0)") * high_percent / 100).cast("long").alias("high"),
        "positive_id",
        "positive_score",
    ).alias("w")
    windows = near.select(F.col("anchor_id").alias("vec_id"), window).filter("w.low <= w.high")
    windows = windows.groupBy("vec_id").agg(F.collect_list("w").alias("w"))
    windows = windows.select("vec_id", *[F.col(f"w.{name}").alias(name) for name in open_])
    found = searched(anchors.join(windows, "vec_id"), False, negatives)
    return found.select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
