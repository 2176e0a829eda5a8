import random

import numpy as np
import pytest

from quillgraph.llm.minhash import Signer, near_duplicates
from quillgraph.llm.textbytes import mix

from . import cases


def expected(texts, shingle=5, percent=85):
    sets = {i: cases.shingles(t, shingle) for i, t in texts.items()}
    links = {i: {i} for i in sets}
    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                if 100 * len(a & b) >= percent * len(a | b):
                    links[i].add(j)
                    links[j].add(i)
    found = cases.components(links)
    return {i: (len(sets[i]), found[i], i == found[i]) for i in sets}


def result(rows):
    found = rows.collect()
    out = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in found}
    assert len(found) == len(out)
    return out


def test_values_agree_as_often_as_the_sets_are_similar():
    signer = Signer(128, 5)
    for size in (8, 60, 1000):
        agreed = []
        for seed in range(60):
            tokens = np.unique(mix(np.arange(seed * 10_000, seed * 10_000 + size, dtype=np.uint64)))
            other = np.sort(tokens[np.argsort(mix(tokens))][: size * 3 // 4])
            agreed.append((signer.values(tokens) == signer.values(other)).mean())
        assert abs(np.mean(agreed) - 0.75) < 0.05, size


def test_no_bin_stays_empty_with_one_token():
    values = Signer(64, 4).values(np.array([5], np.uint64))
    assert (values == 5).all()
    with pytest.raises(ValueError):
        Signer(100, 5)


def test_messy_texts(spark):
    texts = cases.messy_texts()
    assert result(near_duplicates(cases.table(spark, texts), percent=85)) == expected(texts)


def test_families_around_the_threshold(spark):
    """Copies with few and many edits: most buckets hold several components, with links that no centre has."""
    draw, docs = random.Random(5), {}
    for size in (30, 120, 300):
        base = [f"w{size}x{draw.randint(0, 900)}" for _ in range(size)]
        for _ in range(80):
            words = list(base)
            for _ in range(draw.randint(0, max(1, size // 40))):
                at = draw.randrange(len(words))
                edit = draw.random()
                if edit < 0.4:
                    del words[at]
                elif edit < 0.7:
                    words[at] = f"new{draw.randint(0, 3)}"
                else:
                    words[at] = f"own{draw.random()}"
            docs[len(docs) * 7 + 3] = " ".join(words)
    assert result(near_duplicates(cases.table(spark, docs), percent=85)) == expected(docs)
    assert result(near_duplicates(cases.table(spark, docs))) == expected(docs, percent=80)


def test_a_large_family_that_is_not_quite_linked_forms_few_pairs(spark):
    """600 documents of similarity below the threshold to each other, and two pairs among them that are linked."""
    from quillgraph.llm.jaccard_join import jaccard_components
    from quillgraph.llm.set_links import pairs_around

    draw, docs = random.Random(3), {}
    base = [f"w{i}" for i in range(200)]
    for i in range(600):
        words = list(base)
        for at in draw.sample(range(200), 3):
            words[at] = f"own{i}x{at}"
        docs[i + 1] = " ".join(words)
    for old, new in ((200, 2001), (500, 2002)):
        docs[new] = docs[old] + " tail"
    assert result(near_duplicates(cases.table(spark, docs), percent=85)) == expected(docs)
    rows = jaccard_components(cases.table(spark, docs)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == cases.jaccard(docs)

    tokens = {i: sorted(hash(s) for s in cases.shingles(t, 5)) for i, t in docs.items()}
    sets = spark.createDataFrame([(i, len(t), t) for i, t in tokens.items()], "rep long, n long, tokens array<long>")
    members = spark.createDataFrame([(1, i, i) for i in docs], "pivot long, rep long, component long")
    pairs = pairs_around(members, sets, 85).collect()
    assert {(200, 2001), (500, 2002)} <= {(r["a"], r["b"]) for r in pairs}
    assert len(pairs) < 0.03 * len(docs) ** 2 / 2


def test_nulls_repeats_and_empty(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(None, text), (5, text), (5, text), (5, "short"), (6, None), (6, None), (None, None), (9, text + " more"), (7, "  ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(near_duplicates(docs)) == {5: (56, 5, True), 6: (0, 6, True), 9: (57, 5, False), 7: (0, 7, True)}
    assert result(near_duplicates(docs.filter("doc_id < 0"))) == {}
    assert result(near_duplicates(docs.filter("text IS NULL"))) == {6: (0, 6, True)}
