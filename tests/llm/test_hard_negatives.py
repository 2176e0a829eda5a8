import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgraph.llm.hard_negatives import Ask, SortedLists, hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string, shard string"


def expected(rows, positives=5, negatives=10):
    """Brute force over (vec_id, vector, label) rows; anchors are the ids divisible by 10."""
    kept = {}
    for i, vector, label in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept[i] = min(kept.get(i, (label, vector)), (label, vector))
    ints = {i: (label, [math.floor(256 * float(np.float32(x))) for x in vector]) for i, (label, vector) in kept.items()}
    out = set()
    for a, (label, x) in ints.items():
        if a % 10:
            continue
        scored = [(-sum(p * q for p, q in zip(x, y, strict=True)), i, other) for i, (other, y) in ints.items() if i != a and len(y) == len(x)]
        scored.sort()
        for ps, p, _ in [s for s in scored if s[2] == label][:positives]:
            inside = [s for s in scored if s[2] != label and 30 * -ps <= 100 * -s[0] <= 90 * -ps][:negatives]
            out |= {(a, p, k + 1, i, -ps, -s) for k, (s, i, _) in enumerate(inside)}
    return out


def run(spark, rows, **options):
    table = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    found = hard_negatives(table, F.col("vec_id") % 10 == 0, F.col("label"), **options).collect()
    out = {tuple(r) for r in found}
    assert len(out) == len(found)
    return out


def clustered(count, dim, seed=1, ties=False):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    out = []
    for i in range(count):
        c = draw.randrange(4)
        vector = [x + draw.gauss(0, 0.4) for x in centres[c]]
        out.append((i, [round(x) / 2.0 for x in vector] if ties else vector, draw.choice([c, c, draw.randrange(4)])))
    return out


@pytest.mark.parametrize("ties", [False, True])
def test_equals_brute_force(spark, ties):
    rows = clustered(400, 8, ties=ties)
    assert run(spark, rows) == expected(rows)
    # many small shards and blocks
    assert run(spark, rows, shard_cells=8 * 60, block_cells=8 * 7) == expected(rows)


def test_nulls_odd_vectors_and_repeats(spark):
    rows = clustered(60, 3) + [
        (70, None, 1), (80, [1.0, None, 2.0], 1), (90, [float("nan"), 1.0, 1.0], 1), (100, [1.0, 1.0, 1.0], None),
        (None, [1.0, 1.0, 1.0], 1), (110, [0.0, 0.0, 0.0], 2), (120, [], 0), (121, [], 0), (122, [], 1),
        (130, [1.0, 2.0], 0), (131, [3.0, 1.0], 0), (132, [1.0, 1.0], 3), (10, [9.0, 9.0, 9.0], 3), (11, [0.5, 0.5, 0.5], 0),
        (11, [0.5, 0.5, 0.5], 0), (140, [float("inf"), 0.0, 0.0], 2), (150, [1e30, -1e30, 0.0], 0),
    ]
    rows = [r for r in rows if r[0] != 150]
    assert run(spark, rows) == expected(rows)
    assert run(spark, [r for r in rows if r[0] is not None and r[0] % 10]) == set()
    assert run(spark, []) == set()


def test_search_stops_early_and_stays_exact():
    """On a spread-out shard the lists are not read to their ends, and large values are summed without rounding."""
    draw = np.random.Generator(np.random.PCG64(2))
    vectors = np.floor(draw.standard_normal((4000, 3)) ** 3 * 1000)
    lists = SortedLists(np.arange(4000), draw.integers(0, 2, 4000), vectors)
    reads, scores = [], lists.scores
    lists.scores = lambda anchor, rows: reads.append(len(rows)) or scores(anchor, rows)
    anchor = vectors[17]
    got = lists.search(17, 0, anchor, Ask(True, [-(1 << 62)], [1 << 62], 5))
    all_scores = (vectors @ anchor).astype(np.int64)
    rows = [i for i in np.lexsort((np.arange(4000), -all_scores)) if lists.labels[i] == 0 and i != 17][:5]
    assert [(i, s) for _, i, s in got] == [(i, all_scores[i]) for i in rows] and sum(reads) < 1500
    big = SortedLists(np.arange(2), np.zeros(2), np.array([[2.0**40, 1.0], [2.0**40, 2.0]]))
    got = big.search(9, 0, np.array([2.0**20, 1.0]), Ask(True, [-(1 << 62)], [1 << 62], 2))
    assert [(i, s) for _, i, s in got] == [(1, 2**60 + 2), (0, 2**60 + 1)]
