import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgraph.llm.vptree import VantageTree, nearest_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank int, tree string"


def brute(rows, every, k=5):
    usable = {
        i: np.array(v, np.float64)
        for i, v in rows
        if i is not None and v and None not in v and np.isfinite(np.array(v, np.float64)).all() and any(v)
    }
    out = {}
    for q, a in usable.items():
        if q % every == 0:
            scores = [(-(a @ b) / np.sqrt((a @ a) * (b @ b)), i) for i, b in usable.items() if i != q and len(a) == len(b)]
            out[q] = sorted((round(s, 10), i) for s, i in scores)[:k]
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 0.5, 3, "x") for i, v in rows], SCHEMA)


def messy(count=600, dim=12):
    draw = np.random.default_rng(3)
    rows = [(i, draw.normal(size=dim).astype(np.float32).tolist()) for i in range(count)]
    hot = rows[7][1]
    rows += [(count + i, hot) for i in range(200)]
    rows += [(count + 200 + i, [2 * x for x in rows[i][1]]) for i in range(30)]
    rows += [(2000, None), (2010, [0.0] * dim), (2020, [float("nan")] * dim), (2030, [None] + [1.0] * (dim - 1))]
    rows += [(2040, [float("inf")] + [1.0] * (dim - 1)), (2050, []), (2060, [1.0, 2.0]), (2070, [2.0, 1.0]), (None, hot)]
    return rows


@pytest.mark.parametrize("shard_rows", [10_000, 150])
def test_exact_search(spark, shard_rows):
    rows = messy()
    found = nearest_vectors(table(spark, rows), F.col("vec_id") % 10 == 0, shard_rows=shard_rows, block_rows=16).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((round(-r["score"], 10), r["vec_id"]))
    assert got == brute(rows, 10)


def test_relaxed_search_keeps_recall():
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(20, 16))
    vectors = centres[draw.integers(0, 20, 4000)] + 0.3 * draw.normal(size=(4000, 16))
    tree = VantageTree(np.arange(4000), vectors, 6, leaf=32)
    asked = np.arange(0, 4000, 50)
    exact = {(q, i) for q, i, _ in tree.search(asked, vectors[asked], 5, 1.0)}
    near = {(q, i) for q, i, _ in tree.search(asked, vectors[asked], 5, 1.3)}
    assert len(near & exact) >= 0.9 * len(exact)


def test_empty_table_and_no_queries(spark):
    rows = table(spark, messy(20))
    assert nearest_vectors(rows.filter("vec_id < 0"), F.col("vec_id") % 2 == 0).collect() == []
    assert nearest_vectors(rows, F.col("vec_id") < 0).collect() == []


def test_repeated_rows(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.1]), (2, [1.0, 0.1])]
    found = nearest_vectors(table(spark, rows), F.col("vec_id") == 2).collect()
    assert {(r["query_id"], r["vec_id"]) for r in found} == {(2, 1)}
