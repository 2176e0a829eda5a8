"""What set joins write to disk: shuffles and scratch tables."""

import random

import pytest
from pyspark.sql import functions as F

from quillgraph import registry
from quillgraph.operators import setjoin
from quillgraph.operators.setjoin import copy_links, distinct_sets, similar_sets, similar_sets_lsh
from tests.test_set_joins import as_sets, brute, documents, listed


@pytest.fixture
def without_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def shuffled(df):
    """The rows of a plan, and the bytes that its exchanges send."""
    rows, total, plans = df.collect(), 0, [df._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            plans.append(plan.executedPlan())
        elif name.endswith("QueryStageExec"):
            plans.append(plan.plan())
        elif name == "ShuffleExchangeExec":
            total += plan.metrics().get("dataSize").get().value()
        plans += [plan.children().apply(i) for i in range(plan.children().size())]
    assert total
    return rows, total


def family(number, size, seed):
    """Near copies of one text, each without a few of its words and with a word of its own."""
    draw = random.Random(seed)
    words = {f"somewhatlongword{i}" for i in range(size)}
    return [(i, words - set(draw.sample(sorted(words), 3)) | {f"own{i}"}) for i in range(number)]


def test_distinct_sets_are_sent_as_strings(spark):
    rows = family(40, 50, 1)
    found, sent = shuffled(as_sets(spark, rows + [(i + 100, s) for i, s in rows[:5]]))
    assert sorted((r["id"], r["tokens"], r["n"], r["copies"]) for r in found) == [(i, sorted(s), len(s), 1 + (i < 5)) for i, s in rows]
    assert sent < 45 * 48 * 24


def test_a_set_is_not_sent_for_each_of_its_pairs(spark, without_broadcasts):
    rows = family(60, 50, 2)
    result = similar_sets(setjoin.materialize(as_sets(spark, rows), "sets"), 0.3)
    found, sent = shuffled(result)
    assert len(found) == 60 * 59 // 2
    assert sent < 500 * 60 * 59 // 2  # a set takes about 1,000 bytes


def test_links_of_copies_send_no_tokens(spark, without_broadcasts):
    rows = family(40, 50, 3)
    rows += [(i + 100, s) for i, s in rows[:30]]
    df = spark.createDataFrame([(i, sorted(s)) for i, s in rows] + [(500, []), (501, [])], "id int, tokens array<string>")
    for sets in (None, distinct_sets(df, "id", "tokens")):
        links, sent = shuffled(copy_links(df, "id", "tokens", sets and setjoin.materialize(sets, "sets")))
        assert sorted((r["id"], r["rep_id"]) for r in links) == [(i + 100, i) for i in range(30)]
    assert sent < 150 * 72


def test_crowded_buckets_move_few_sets(spark, monkeypatch, without_broadcasts):
    written, materialize = {}, setjoin.materialize

    def kept(df, tag):
        written[tag] = df.schema.names
        return materialize(df, tag)

    rows = family(40, 50, 4) + [(i + 100, s) for i, s in documents(20, 4)]
    sets = materialize(as_sets(spark, rows), "sets")
    monkeypatch.setattr(setjoin, "materialize", kept)
    found = similar_sets_lsh(sets, 0.3, 20, bucket_limit=5).drop("shared_table")
    assert listed(found) == brute(rows, 0.3) != []
    assert not any("tokens" in columns for columns in written.values())


def there(spark, table):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    system = hadoop.FileSystem.getLocal(spark.sparkContext._jsc.hadoopConfiguration())
    return any(system.exists(hadoop.Path(file)) for file in table._jdf.inputFiles())


def test_clusters_drop_the_tokens_of_rows_before_the_set_join(spark, sf, monkeypatch):
    written, seen, materialize, join = {}, [], registry.materialize, registry.similar_sets

    def noted(df, tag):
        return written.setdefault(tag, materialize(df, tag))

    def joined(*args, **options):
        seen.extend(there(spark, table) for table in written.values() if "tokens" in table.columns)
        return join(*args, **options)

    monkeypatch.setattr(registry, "materialize", noted)
    monkeypatch.setattr(registry, "similar_sets", joined)
    assert registry.er_clusters(spark, sf).count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert sum(seen) == 1  # the distinct sets


def test_the_check_leaves_no_tables_of_its_steps(spark, sf, monkeypatch):
    written, materialize = [], setjoin.materialize

    def noted(df, tag):
        written.append(materialize(df, tag))
        return written[-1]

    monkeypatch.setattr(setjoin, "materialize", noted)
    row = registry.pairs_lsh_docs_check(spark, sf).first()
    assert (row["outside"], row["enough"]) == (0, 1)
    assert written and not any(there(spark, table) for table in written)


@pytest.mark.parametrize(("bits", "distance"), [(32, 0.3), (4, 0.3), (4, 0.6)])
def test_pairs_are_whole_however_work_is_cut(spark, monkeypatch, bits, distance):
    """Blocks of few keys, cells of few sets, and sets that share their numbers."""
    for name, value in (("_SENT", 40), ("_FORMED", 30), ("_PART_KEYS", 60), ("_COUNT_KEYS", 50), ("_CELL_SETS", 8), ("_FAMILY_SETS", 4)):
        monkeypatch.setattr(setjoin, name, value)
    numbered = setjoin._numbered
    monkeypatch.setattr(setjoin, "_numbered", lambda sets, width=32: numbered(sets, min(bits, width)))
    draw = random.Random(6)
    rows = family(25, 40, 5) + [(i + 100, s) for i, s in documents(40, 5)]
    rows += [(i + 300, set(draw.sample(sorted(rows[i][1]), draw.randrange(15, 35)))) for i in range(25)]
    rows = [(i, s) for k, (i, s) in enumerate(rows) if s not in [t for _, t in rows[:k]]]
    sets = setjoin.materialize(as_sets(spark, rows), "sets")
    assert listed(similar_sets(sets, distance)) == brute(rows, distance) != []
    carried = similar_sets(sets.withColumn("name", F.concat(F.lit("x"), F.col("id"))), distance, carry=["name"])
    assert all((r["name_a"], r["name_b"]) == (f"x{r['id_a']}", f"x{r['id_b']}") for r in carried.collect())
