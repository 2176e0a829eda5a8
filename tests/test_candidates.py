"""Candidate pairs with their names, held against pairs that are merged by id first."""

import pytest
from pyspark.sql import functions as F

from quillgraph.operators import quantiles
from quillgraph.plans import resolution


def things(spark, rows):
    names = spark.createDataFrame([(i, n, i % 3) for i, n in rows], "key long, name string, code int")
    return resolution.entities(names, "key", F.col("name"), code=F.col("code"))


def merged(df, distance, probes):
    random = resolution.probe_pairs(df, probes).withColumn("jaccard_dist", F.lit(None).cast("double"))
    pairs = resolution.block_pairs(df, distance, lsh=False).unionByName(random)
    return resolution.pair_names(pairs.groupBy("id_a", "id_b").agg(F.max("jaccard_dist").alias("jaccard_dist")), df, "code")


WORDS = [(7 * k, f"{a} {b} {c}") for k, (a, b, c) in enumerate((a, b, c) for a in "abc" for b in "defg" for c in "hij")]
COPIES = [(1000, "h d a"), (1001, "  "), (1002, ""), (1003, "A D H"), (1004, "word " + " ".join(f"w{i}" for i in range(30)))]
SHARED_IDS = [(7, "another name"), (14, "c g j x"), (14, "x j g c")]


@pytest.mark.parametrize("rows", [WORDS + COPIES, WORDS + COPIES + SHARED_IDS], ids=["own ids", "shared ids"])
def test_candidates_are_those_of_merged_pairs(spark, rows):
    df = things(spark, rows)
    columns = ["id_a", "id_b", "name_a", "name_b", "code_a", "code_b", "jaccard_dist"]
    found = sorted(map(repr, resolution.candidate_pairs(df, 0.6, 4, "code").select(columns).collect()))
    assert found == sorted(map(repr, merged(df, 0.6, 4).select(columns).collect()))
    assert any("jaccard_dist=None" in r for r in found) and any("jaccard_dist=0.5" in r for r in found)


def test_similar_pairs_are_not_shuffled(spark, sf):
    from quillgraph import registry

    plan = registry._named_pairs(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [id_a") == 1  # the random pairs, once each


def test_labels_that_all_fit_are_not_ordered(spark, monkeypatch):
    rows = [(i, 100 + i, float(i % 3 == 0) if i else None) for i in range(30)]
    labelled = spark.createDataFrame(rows, "id_a long, id_b long, label double")
    asked, order = [], quantiles.order_statistics
    monkeypatch.setattr(quantiles, "order_statistics", lambda *a, **k: asked.append(1) or order(*a, **k))
    found = sorted(map(tuple, resolution.sampled_labels(labelled).collect()))
    assert found == [r for r in rows if r[2] is not None] and not asked
    capped = resolution.sampled_labels(labelled, 1, 1)
    assert capped.filter("label = 1").count() == 9 == capped.filter("label = 0").count() and asked


def test_pairs_that_no_rule_can_label_are_not_written(spark, monkeypatch):
    rows = [(1, 2, 0.95, 1.0, 0.9), (1, 3, 0.95, 0.0, 0.9), (1, 4, 0.1, 0.0, 0.0), (1, 5, 0.1, 1.0, 0.0), (2, 5, 0.1, 0.0, 0.5)]
    features = spark.createDataFrame(rows, "id_a long, id_b long, jw double, same_code double, token_overlap double")
    written, materialize = [], resolution.materialize
    monkeypatch.setattr(resolution, "materialize", lambda df, tag: written.append(df.count()) or materialize(df, tag))
    found = resolution.gold_labels(features, resolution.MEDICATION_RULE)
    assert sorted(tuple(r) for r in found.select("id_a", "id_b", "label").collect()) == [(1, 2, 1.0), (1, 4, 0.0), (1, 5, 0.0)]
    assert written == [3]
