"""The forest's votes, its decisions and its metrics, each worked out again from what they are made of."""

import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quillgraph.plans import resolution


@pytest.fixture(scope="module")
def features(spark):
    draw = random.Random(5)
    rows = []
    for i in range(400):
        jw, lev, overlap = (round(draw.random(), 3) for _ in range(3))
        rows.append((i, 1000 + i, jw, lev, overlap, overlap, float(draw.random() < 0.5), float(jw > 0.6 and overlap > 0.3) if draw.random() < 0.95 else 1.0))
    return spark.createDataFrame(rows, "id_a long, id_b long, jw double, lev double, token_overlap double, jaccard_sim double, same_code double, label double")


@pytest.fixture(scope="module")
def trained(features):
    return resolution.train_matcher(features, "X", "rule", trees=7, depth=4)


def votes(model, features):
    """id_a -> the mean over the trees of the share of positives in the leaf that the pair falls into."""
    assembled = model.stages[0].transform(features)
    total = {}
    for tree in model.stages[1].trees:
        for r in tree.transform(assembled).select("id_a", vector_to_array("probability")[1].alias("p")).collect():
            total[r["id_a"]] = total.get(r["id_a"], 0.0) + r["p"]
    return {i: p / len(model.stages[1].trees) for i, p in total.items()}


def test_same_as_is_the_vote_of_the_trees(features, trained):
    model, _ = trained
    want = votes(model, features)
    found = {r["id_a"]: r["confidence"] for r in resolution.same_as(model, features, "X").collect()}
    assert set(found) == {i for i, p in want.items() if p > 0.5} and 20 < len(found) < 380
    assert all(found[i] == pytest.approx(want[i]) for i in found)


def test_metrics_are_those_of_the_held_out_fifth(features, trained):
    model, metrics = trained
    row = metrics.first()
    test = features.filter(resolution.held_out())
    labels = {r["id_a"]: r["label"] for r in test.select("id_a", "label").collect()}
    want = votes(model, test)
    guess = {i: float(p > 0.5) for i, p in want.items()}
    precision = recall = f1 = 0.0
    for c in (0.0, 1.0):
        hits = sum(labels[i] == guess[i] == c for i in labels)
        said, are = sum(g == c for g in guess.values()), sum(l == c for l in labels.values())
        p, r = hits / said if said else 0.0, hits / are if are else 0.0
        weight = are / len(labels)
        precision, recall, f1 = precision + weight * p, recall + weight * r, f1 + weight * (2 * p * r / (p + r) if p + r else 0.0)
    assert (row["weighted_precision"], row["weighted_recall"], row["weighted_f1"]) == pytest.approx((precision, recall, f1))
    pairs = [(want[i], want[j]) for i in labels for j in labels if labels[i] > labels[j]]
    auc = sum((a > b) + 0.5 * (a == b) for a, b in pairs) / len(pairs)
    assert row["auc"] == pytest.approx(auc, abs=1e-6)
    assert row["positives"] + row["negatives"] == 400 and row["weighted_f1"] > 0.8
    assert 0 < len(labels) < 200 and features.filter(F.col("label") == 1).count() == row["positives"]
