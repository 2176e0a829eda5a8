import itertools
import random

import pytest
from pyspark.sql import functions as F

from quillgraph.operators import setjoin
from quillgraph.operators.setjoin import distinct_sets, similar_sets, similar_sets_lsh
from quillgraph.operators.sweep import lsh_sweep


def as_sets(spark, rows):
    return distinct_sets(spark.createDataFrame([(i, sorted(s)) for i, s in rows], "id int, tokens array<string>"), "id", "tokens")


def brute(rows, distance):
    found = []
    for (i, s), (j, t) in itertools.combinations(rows, 2):
        apart = 1 - len(s & t) / len(s | t)
        if i != j and s != t and apart < distance - 1e-9:
            found.append((min(i, j), max(i, j), round(apart, 9)))
    return sorted(found)


def listed(df):
    return sorted((r["id_a"], r["id_b"], round(r["jaccard_dist"], 9)) for r in df.collect())


@pytest.fixture
def looked_at(monkeypatch):
    """The numbers of pairs whose sets are looked at."""
    counts, verify = [], setjoin._verify

    def counted(pairs, *args, **options):
        counts.append(pairs.count())
        return verify(pairs, *args, **options)

    monkeypatch.setattr(setjoin, "_verify", counted)
    return counts


def documents(number, seed):
    """Texts that share words by chance, and near copies of a few of them."""
    draw = random.Random(seed)
    rows = [(i, {f"w{draw.randrange(400)}" for _ in range(60)}) for i in range(number)]
    for i, words in list(rows[:10]):
        rows.append((number + i, set(sorted(words)[3:]) | {f"new{i}"}))
    return rows


def test_long_sets_are_looked_at_only_if_they_share_much(spark, looked_at):
    rows = documents(150, 1)
    assert listed(similar_sets(as_sets(spark, rows), 0.3)) == brute(rows, 0.3) != []
    assert sum(looked_at) <= 20


def test_minhash_buckets_do_not_send_sets_for_every_pair(spark, looked_at):
    rows = documents(150, 2)
    found = similar_sets_lsh(as_sets(spark, rows), 0.3, num_tables=20, bucket_limit=10_000)
    assert listed(found.drop("shared_table")) == brute(rows, 0.3) != []
    assert sum(looked_at) <= 20


@pytest.mark.parametrize("distance", [0.4, 0.6])
def test_short_sets_meet_only_if_they_are_similar(spark, looked_at, distance):
    draw = random.Random(3)
    grid = itertools.product(range(4), range(4), range(5), range(6), range(3))
    rows = [(i, {f"{p}{v}" for p, v in zip("abcde", v)}) for i, v in enumerate(draw.sample(sorted(grid), 300))]
    assert listed(similar_sets(as_sets(spark, rows), distance)) == brute(rows, distance) != []
    assert sum(looked_at) == 0


def test_what_short_sets_share_is_worked_out_once(spark):
    """And on numbers: a filter that goes into the join would take the value into each of its terms."""
    rows = [(i, {f"{p}{v}" for p, v in zip("abcde", v)}) for i, v in enumerate(itertools.product(range(2), repeat=5))]
    found = similar_sets(as_sets(spark, rows), 0.4)
    assert listed(found) == brute(rows, 0.4) != []
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_intersect(") == 1


def test_sets_of_one_id(spark):
    draw = random.Random(4)
    rows = [(i % 20, {f"w{draw.randrange(14)}" for _ in range(draw.choice([3, 6, 25]))}) for i in range(60)]
    rows = [(i, s) for s, i in {frozenset(s): i for i, s in rows}.items()]
    sets = spark.createDataFrame([(i, sorted(s), len(s), 1) for i, s in rows], "id int, tokens array<string>, n int, copies long")
    for short in (5, 20):
        assert listed(similar_sets(sets, 0.5, short=short)) == brute(rows, 0.5)


def test_pairs_from_buckets_of_both_kinds_come_once(spark):
    draw = random.Random(5)
    rows = [(i, {f"w{draw.randrange(12)}" for _ in range(8)}) for i in range(120)]
    rows = [(i, s) for k, (i, s) in enumerate(rows) if s not in [t for _, t in rows[:k]]]
    sets = as_sets(spark, rows)
    plain = similar_sets_lsh(sets, 0.5, 4, bucket_limit=10_000).select("id_a", "id_b", "shared_table")
    mixed = similar_sets_lsh(sets, 0.5, 4, bucket_limit=12).select("id_a", "id_b", "shared_table")
    assert sorted(plain.collect()) == sorted(mixed.collect()) != []


def test_the_sweep_writes_no_pairs(spark, monkeypatch):
    """Its pairs are counted where they are formed: at a wide threshold they are far more than the sets."""
    written, materialize = [], setjoin.materialize

    def measured(df, tag):
        table = materialize(df, tag)
        written.append(table.count())
        return table

    monkeypatch.setattr(setjoin, "materialize", measured)
    monkeypatch.setattr("quillgraph.operators.sweep.materialize", measured, raising=False)
    rows = [(i, {f"{p}{v}" for p, v in zip("abc", v)}) for i, v in enumerate(itertools.product(range(6), repeat=3))]
    report = lsh_sweep(as_sets(spark, rows), [(3, 0.6)], num_features=1 << 10).first()
    assert report["exact_pairs"] == len(brute(rows, 0.6)) == 216 * 15 // 2
    assert max(written) < report["exact_pairs"]  # the pairs out of small buckets alone


def test_sets_without_rows(spark):
    empty = as_sets(spark, [(1, {"a"})]).filter(F.lit(False))
    assert similar_sets(empty, 0.4).collect() == [] == similar_sets_lsh(empty, 0.4).collect()
