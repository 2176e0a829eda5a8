import random
import statistics
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from quillgraph.functions.text import token_set
from quillgraph.operators import joins
from quillgraph.operators.mentions import MENTION_SCHEMA, extract_mentions, keyword_dictionary, mentions_per_note
from quillgraph.operators.profile import null_profile
from quillgraph.operators.quantiles import latency_summary, order_statistics, smallest
from quillgraph.operators.setjoin import copy_links, distinct_sets, pair_space, similar_sets, similar_sets_lsh
from quillgraph.operators.spans import span_scores, weighted_scores
from quillgraph.operators.sweep import lsh_sweep, pivot_sweep
from quillgraph.plans import checks
from quillgraph.registry import QUERIES


def sets_of(spark, words):
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(words)], "id bigint, text string")
    return df.select("id", token_set(F.col("text")).alias("tokens"))


def brute(words, distance):
    smallest_id = {}
    for i, w in enumerate(words):
        smallest_id.setdefault(frozenset(w), i)
    out = {}
    for (a, x), (b, y) in combinations([(s, i) for s, i in smallest_id.items() if s], 2):
        d = 1 - len(a & b) / len(a | b)
        if d < distance:
            out[(min(x, y), max(x, y))] = round(d, 9)
    return out


def found(df):
    return {(r["id_a"], r["id_b"]): round(r["jaccard_dist"], 9) for r in df.collect()}


def word_lists(seed, count, vocabulary, longest):
    rng = random.Random(seed)
    lists = []
    for _ in range(count):
        # the first word is in a third of all sets, and a third of all sets are copies
        words = {f"w{int(vocabulary * rng.random() ** 2)}" for _ in range(rng.randint(1, longest))}
        lists.append(sorted(words | {"hot"} if rng.random() < 0.4 else words))
    return lists + lists[: count // 2] + [[]]


@pytest.mark.parametrize("distance", [0.1, 0.3, 0.4, 0.5, 0.65, 0.8, 1.0])
@pytest.mark.parametrize("longest", [6, 30])
def test_exact_join_equals_brute_force(spark, distance, longest):
    words = word_lists(int(distance * 100) + longest, 120, 25, longest)
    sets = distinct_sets(sets_of(spark, words), "id", "tokens")
    assert found(similar_sets(sets, distance)) == brute(words, distance)


def test_lsh_pairs_are_true_and_crowded_buckets_lose_none(spark):
    words = word_lists(5, 150, 30, 8)
    sets = distinct_sets(sets_of(spark, words), "id", "tokens")
    exact = brute(words, 0.5)
    plain = similar_sets_lsh(sets, 0.5, num_tables=12, bucket_limit=10_000)
    crowded = similar_sets_lsh(sets, 0.5, num_tables=12, bucket_limit=3)
    assert found(plain).items() <= exact.items()
    assert len(found(plain)) > 0.9 * len(exact)
    assert {tuple(r) for r in plain.collect()} == {tuple(r) for r in crowded.collect()}


def test_copies_are_linked_to_the_smallest_id(spark):
    rows = sets_of(spark, [["a"], ["b"], ["a"], ["a"], []])
    assert {tuple(r) for r in copy_links(rows, "id", "tokens").collect()} == {(2, 0), (3, 0)}


def test_sweep_counts_match_single_searches(spark):
    words = word_lists(9, 60, 15, 6)
    sets = distinct_sets(sets_of(spark, words), "id", "tokens")
    report = lsh_sweep(sets, [(2, 0.4), (6, 0.4), (6, 0.6)])
    rows = {(r["num_tables"], r["threshold"]): r for r in report.collect()}
    assert rows[(2, 0.4)]["lsh_pairs"] == similar_sets_lsh(sets, 0.4, 2).count()
    assert rows[(6, 0.6)]["exact_pairs"] == len(brute(words, 0.6))
    assert rows[(2, 0.4)]["lsh_pairs"] <= rows[(6, 0.4)]["lsh_pairs"]
    assert pivot_sweep(report).count() == 2


def test_pair_space(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",)], "k string")
    assert pair_space(df).first()["pairs"] == 6
    assert {(r["block"], r["pairs"]) for r in pair_space(df, F.col("k")).collect()} == {("a", 3), ("b", 0)}


@pytest.mark.parametrize("task_limit", [1_000_000, 40])
def test_order_statistics(spark, task_limit):
    rng = random.Random(3)
    values = {"x": [rng.random() for _ in range(2000)], "y": [float(rng.randint(0, 5)) for _ in range(999)], "z": [1.5]}
    values["x"] += [0.5] * 1000
    df = spark.createDataFrame([(g, v) for g, vs in values.items() for v in vs] + [("x", None)], "g string, v double")
    for row in latency_summary(df, ["g"], "v", task_limit).collect():
        ordered = sorted(values[row["g"]])
        assert row["n"] == len(ordered)
        assert row["p50"] == pytest.approx(statistics.median(ordered))
        assert (row["p95"], row["p99"]) == (ordered[int(0.95 * len(ordered))], ordered[int(0.99 * len(ordered))])
    whole = order_statistics(df, [], "v", {"first": lambda n: n * 0, "last": lambda n: n - 1}, task_limit).first()
    everything = sorted(v for vs in values.values() for v in vs)
    assert (whole["first"], whole["last"]) == (everything[0], everything[-1])


def test_smallest(spark):
    df = spark.range(5000).withColumn("s", F.xxhash64("id"))
    expected = sorted(r["s"] for r in df.collect())[:70]
    assert sorted(r["s"] for r in smallest(df, "s", 70, task_limit=100).collect()) == expected
    assert smallest(df, "s", 0).count() == 0 and smallest(df, "s", 9999).count() == 5000


def test_join_variants_agree_on_a_hot_key(spark):
    big = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("row"))
    small = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain = sorted(map(tuple, big.join(small, "k").select("k", "row", "v").collect()))
    for df in (
        joins.salted_join(small, big, "k", ["row"], 5, 0.1),
        joins.broadcast_join(small, big, "k"),
        joins.broadcast_join(small, big, "k", row_limit=10),
        joins.repartitioned_join(small, big, "k", 4),
        joins.range_join_layout(small, big, "k", 4),
        joins.coalesced_join(small, big, "k", 2),
    ):
        assert sorted(map(tuple, df.select("k", "row", "v").collect())) == plain


def test_broadcast_is_measured(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("text"), F.array(F.lit(1.5)).alias("v"))
    assert joins.fits_broadcast(df) and joins.fits_broadcast(df.limit(0))
    assert not joins.fits_broadcast(df, row_limit=99)
    assert not joins.fits_broadcast(df, byte_limit=50_000)


def test_all_layouts_of_the_registered_join_agree(spark, sf):
    keys = ["join_agg_default", "join_agg_broadcast", "join_agg_hash", "join_agg_coalesce", "join_agg_range", "join_salted"]
    results = [sorted(map(tuple, QUERIES[k](spark, sf).collect())) for k in keys]
    assert all(r == results[0] for r in results)


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    found_rows = {r["column_name"]: (r["row_count"], r["null_count"]) for r in null_profile(df).collect()}
    assert found_rows == {"a": (3, 1), "b": (3, 2)}


def test_mentions_have_exact_offsets(spark):
    texts = ["Heart failure; HEART\n\nfailures heart_failure été heart", "   ", None, "heart", "x" * 50 + " " + "heart, " * 200]
    notes = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    titles = spark.createDataFrame([("heart failure of it",)], "t string")
    dictionary = keyword_dictionary(titles, "t")
    rows = extract_mentions(notes, dictionary, "id", "text").collect()
    assert all(texts[r["note_id"]][r["char_start"] : r["char_end"]].lower() == r["name"] for r in rows)
    per_note = {i: sum(r["note_id"] == i for r in rows) for i in range(5)}
    assert per_note == {0: 4, 1: 0, 2: 0, 3: 1, 4: 200}
    summary = mentions_per_note(notes, extract_mentions(notes, dictionary, "id", "text"), "id").first()
    assert (summary["notes"], summary["mentions"], summary["avg_mentions"]) == (5, 205, 41.0)


def test_mentions_of_any_word_of_the_titles(spark):
    """Every word longer than three characters is a name, and is found as a search between word boundaries finds it."""
    import re

    titles = "été12 heart's non-st b12a (acute failure, ---- ab--ab heart ÉTÉS a+b+c .... x-x-x-x"
    names = {w for w in titles.lower().split() if len(w) > 3}
    texts = [
        "Heart's non-st b12a (acute x(acute failure, failure,x a----b ---- ab--ab--ab étés a+b+c 1.... x....y",
        "heart non-sta non-st. NON-ST heart's. b12ab a....b....c x-x-x-x-x-x-x-x ab--ab ab--ab",
        "----", "", "x----", "a----b----c", "été12", "Étés-été12 failure,2failure,3", "\n(acute\n1(acute",
    ]
    notes = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    dictionary = keyword_dictionary(spark.createDataFrame([(titles,)], "t string"), "t")
    assert {r["name"] for r in dictionary.collect()} == names
    check_mentions(notes, dictionary, texts, names)


def check_mentions(notes, dictionary, texts, names):
    """The same rows as a search for each name, whether the dictionary is broadcast or its words are shuffled."""
    import re

    expected = {
        (i, name, m.start(), m.end())
        for i, text in enumerate(texts)
        for name in names
        for m in re.finditer(r"\b" + re.escape(name) + r"\b", text.lower())
    }
    spark = notes.sparkSession
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for limit in (usual, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        rows = extract_mentions(notes, dictionary, "id", "text").collect()
        assert {(r["note_id"], r["name"], r["char_start"], r["char_end"]) for r in rows} == expected and len(rows) == len(expected)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)


def test_mentions_across_runs_and_in_long_pieces(spark):
    """Names that begin in one run of words and end in the next, in texts without any white space, and names that hold some."""
    import random

    draw = random.Random(2)
    texts = ["".join(draw.choices(["ab", "-", "--", "x", "ab-x", "._", "été", "----"], k=300)) for _ in range(6)]
    texts += [" ".join(draw.choices(["ab", "ab-x", "été--ab", "x", "ab--", "----"], k=200)) for _ in range(6)]
    texts += ["x" * 3000 + "-ab-x", "ab-" * 500, "-" * 100, "ab" + "-" * 100 + "ab", "ab\n--\nab x-\tab"]
    names = ["ab-x", "ab--ab", "ab-ab", "----", "--", "-ab", "x-", "été--ab", "ab-ab-x--x", "x" * 40, "ab"]
    notes = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    dictionary = spark.createDataFrame([(f"c{i}", n) for i, n in enumerate(names)], "concept_id string, name string")
    check_mentions(notes, dictionary, texts, names)
    names = [*names, "ab ab", "x ab-x", "ab\n--\nab"]
    dictionary = spark.createDataFrame([(f"c{i}", n) for i, n in enumerate(names)], "concept_id string, name string")
    check_mentions(notes, dictionary, texts, names)


def test_many_hits_in_one_long_text_take_time_in_proportion(spark):
    import time

    dictionary = spark.createDataFrame([("c1", "a-b"), ("c2", "x-x"), ("c3", "--")], "concept_id string, name string")
    took = []
    for size in (2_000, 20_000, 100_000):
        notes = spark.range(1).select("id", F.repeat(F.lit("a-b x-x-x-x a--b\n"), size // 17 * 10).alias("text"))
        started = time.perf_counter()
        found = {r["name"]: r["count"] for r in extract_mentions(notes, dictionary, "id", "text").groupBy("name").count().collect()}
        took.append(time.perf_counter() - started)
        lines = size // 17 * 10
        assert found == {"a-b": lines, "x-x": 2 * lines, "--": lines}
    assert took[2] < 10 * took[1] + 3


def test_long_texts_take_time_in_proportion(spark):
    import time

    took = []
    for words in (100_000, 100_000, 800_000):
        notes = spark.range(1).select("id", F.concat(F.repeat(F.lit("word "), words), F.lit("heart")).alias("text"))
        started = time.perf_counter()
        row = extract_mentions(notes, keyword_dictionary(spark.createDataFrame([("heart",)], "t string"), "t"), "id", "text").first()
        took.append(time.perf_counter() - started)
        assert row["char_start"] == 5 * words
    assert took[2] < 16 * took[1] + 3


def test_extractor_hook_runs_per_partition(spark):
    def shout(batches):
        import pandas as pd

        loaded = "MODEL"  # stands for a model that is loaded once
        for batch in batches:
            yield pd.DataFrame(
                [(n, "C1", loaded, 1.0, 0, len(t), t) for n, t in zip(batch["note_id"], batch["text"])],
                columns=[field.split()[0] for field in MENTION_SCHEMA.split(", ")],
            )

    notes = spark.createDataFrame([(1, "ab"), (2, " ")], "id int, text string")
    rows = extract_mentions(notes, None, "id", "text", shout).collect()
    assert [(r["note_id"], r["char_end"]) for r in rows] == [("1", 2)]


def test_span_and_label_scores(spark):
    keys = ["d", "s", "e"]
    gold = spark.createDataFrame([(1, 0, 4), (1, 5, 9), (2, 0, 4)], "d int, s int, e int")
    guess = spark.createDataFrame([(1, 0, 4), (1, 0, 4), (2, 1, 4)], "d int, s int, e int")
    row = span_scores(guess, gold, keys).first()
    assert (row["tp"], row["fp"], row["fn"]) == (1, 1, 2)
    assert row["f1"] == pytest.approx(0.4, abs=1e-6)
    empty = span_scores(guess.limit(0), gold.limit(0), keys).first()
    assert (empty["tp"], empty["f1"]) == (0, 0.0)

    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    rng = random.Random(1)
    rows = [(float(rng.randint(0, 2)), float(rng.randint(0, 2))) for _ in range(300)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    ours = weighted_scores(df, "label", "prediction").first()
    for name, metric in (("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1", "f1")):
        expected = MulticlassClassificationEvaluator(metricName=metric).evaluate(df)
        assert ours[f"weighted_{name}"] == pytest.approx(expected)


def test_key_uniqueness_finds_duplicates_and_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "id int")
    row = checks.key_uniqueness({"t": (df, ["id"])}).first()
    assert (row["duplicate_keys"], row["null_keys"], row["ok"]) == (1, 1, False)


def test_scratch_scope_leaves_only_what_is_kept(spark):
    import os

    from quillgraph.session import ScratchScope, materialize, result_only, shared_dir

    scratch = os.path.join(shared_dir(spark), spark.sparkContext.applicationId)

    @result_only("inner")
    def inner(df, k):
        return materialize(df, "a").unionByName(materialize(df.filter("id > 3"), "b")).withColumn("k", F.lit(k))

    with ScratchScope(spark) as scope:
        first = inner(spark.range(5), k=7)
        assert [n.split("-")[0] for n in os.listdir(scratch) if n.split("-")[0] in ("a", "b", "inner")] == ["inner"]
        kept = scope.keep(first.filter("id = 4"), "outer")
    assert kept.collect() == [(4, 7), (4, 7)]
    assert not [n for n in os.listdir(scratch) if n.split("-")[0] in ("a", "b", "inner")]
    with pytest.raises(ZeroDivisionError), ScratchScope(spark):
        materialize(spark.range(2), "a")
        raise ZeroDivisionError
    assert not [n for n in os.listdir(scratch) if n.startswith("a-")]
