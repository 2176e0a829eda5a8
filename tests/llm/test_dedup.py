import pytest
from pyspark.sql import functions as F

from quillgraph.llm.exact_dedup import exact_duplicates, frequent_digests, text_digests
from quillgraph.llm.jaccard_join import jaccard_components
from quillgraph.llm.substring_dedup import repeated_passages
from quillgraph.llm.suffix_dedup import HashedText, repeated_strings

from . import cases

OPERATORS = {
    "exact": exact_duplicates,
    "jaccard": jaccard_components,
    "passages": repeated_passages,
    "strings": repeated_strings,
}


@pytest.fixture(scope="module")
def texts():
    return cases.messy_texts()


@pytest.fixture(scope="module")
def messy(spark, texts):
    return cases.table(spark, texts).cache()


def test_exact_duplicates(messy, texts):
    groups = {}
    for i, t in texts.items():
        groups.setdefault(cases.lower(t), []).append(i)
    want = {
        (i, max(g), len(g), i == max(g), cases.sha(t.encode())) for t, g in groups.items() for i in g
    }
    assert {tuple(r) for r in exact_duplicates(messy).collect()} == want
    # with a support that makes most copies frequent, the broadcast side does the work
    assert {tuple(r) for r in exact_duplicates(messy, support=0.02).collect()} == want


def test_frequent_digests_are_counted_and_bounded(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("text")
    )
    found = frequent_digests(text_digests(docs), 3000, 0.01).collect()
    assert [(r["keep_id"], r["group_size"]) for r in found] == [(2997, 1000)]


def test_exact_duplicates_runs_no_python(messy):
    plan = exact_duplicates(messy)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_jaccard_components(messy, texts):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(messy).collect()}
    assert got == cases.jaccard(texts)


@pytest.mark.parametrize("percent", [60, 95])
def test_jaccard_components_at_other_thresholds(spark, percent):
    docs = {i: " ".join(str((k * 7 + (k // (6 + i % 5)) * (i // 9)) % 61) for k in range(6 + i % 37)) for i in range(1, 120)}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(cases.table(spark, docs), percent=percent).collect()}
    assert got == cases.jaccard(docs, percent)


def test_jaccard_components_of_families_around_the_threshold(spark):
    """Copies with few and many edits, deletions that several copies have in common, and words put in that some share."""
    import random

    draw, docs = random.Random(11), {}
    for size in (40, 150, 400):
        base = [f"w{size}x{draw.randint(0, 900)}" for _ in range(size)]
        for _ in range(70):
            words = list(base)
            for _ in range(draw.randint(0, size // 25)):
                at = draw.randrange(len(words))
                edit = draw.random()
                if edit < 0.4:
                    del words[at]
                elif edit < 0.7:
                    words[at] = f"new{draw.randint(0, 3)}"
                else:
                    words[at] = f"own{draw.random()}"
            docs[len(docs) * 7 + 3] = " ".join(words)
    rows = jaccard_components(cases.table(spark, docs)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == cases.jaccard(docs)


def test_repeated_passages(messy, texts):
    rows = repeated_passages(messy).collect()
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows}
    assert got == cases.passages(texts)
    for r in rows:
        if r["kept_text"] is not None:
            assert cases.sha(r["kept_text"].encode()) == r["kept_sha256"]
        else:
            assert r["n_removed"] == 0


def test_repeated_strings(messy, texts):
    rows = repeated_strings(messy).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}
    assert got == cases.strings(texts)
    for r in rows:
        if r["kept_bytes"] is not None:
            assert cases.sha(bytes(r["kept_bytes"])) == r["kept_sha256"]


def test_suffix_sort_orders_suffixes():
    import numpy as np

    strings = [b"banana", b"bandana", b"ban", b"ananas", b"", b"nab" * 30, b"banana"]
    text = HashedText(strings)
    starts = np.concatenate([np.arange(a, b) for a, b in zip(text.begin, text.end, strict=True)])
    ends = np.concatenate([np.full(b - a, b) for a, b in zip(text.begin, text.end, strict=True)])
    order = text.suffix_sort(starts, ends)
    found = [text.data[starts[i] : ends[i]].tobytes() for i in order]
    assert found == sorted(found)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    empty = cases.table(spark, {1: "a"}).filter("doc_id < 0")
    assert OPERATORS[name](empty).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_only_empty_texts(spark, name):
    rows = OPERATORS[name](cases.table(spark, {4: None, 9: "", 2: " "})).collect()
    assert sorted(r["doc_id"] for r in rows) == [2, 4, 9]


@pytest.mark.parametrize("name", OPERATORS)
def test_null_ids_and_repeated_rows(spark, name):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(None, text), (5, text), (5, text), (6, None), (6, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = OPERATORS[name](docs).collect()
    ids = sorted(r["doc_id"] for r in found if r["doc_id"] is not None)
    if name == "exact":
        assert len(found) == 6 and ids == [5, 5, 6, 6]
        assert {(r["keep_id"], r["group_size"]) for r in found} == {(5, 3), (6, 3)}
    else:
        assert ids == [5, 6] and len(found) == 2


def collision_words(letters="ab", length=4096):
    """Two words that a polynomial hash modulo 2 ** 64 cannot tell apart: the Thue-Morse word and its complement."""
    bits = [bin(i).count("1") % 2 for i in range(length)]
    return ["".join(letters[b ^ flip] for b in bits) for flip in (0, 1)]


def test_long_regular_words_do_not_collide(spark):
    import numpy as np

    from quillgraph.llm.textbytes import word_hashes

    one, two = collision_words()
    data = np.frombuffer(f"{one} {two}".encode(), np.uint8)
    names = word_hashes(data, np.array([0, len(one) + 1]), np.array([len(one), len(data)]), lower=True)
    assert names[0] != names[1]
    words = [f"word{i}" for i in range(12)]
    docs = {i + 1: " ".join(words[:6] + [odd] + words[6:]) for i, odd in enumerate((one, two))}
    table = cases.table(spark, docs)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in repeated_passages(table).collect()}
    assert got == cases.passages(docs) and got[2][1] == 0
    docs |= {3: docs[1].replace("word11", "w"), 4: docs[2].replace("word11", "w")}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(cases.table(spark, docs), percent=60).collect()}
    assert got == cases.jaccard(docs, 60)
