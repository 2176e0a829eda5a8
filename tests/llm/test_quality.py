import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from quillgraph.llm.quality import classify_quality, gram_counts, keep_good, probabilities, train, trusted_ids

from . import cases


def kneser_ney(texts, order):
    """The interpolated modified Kneser-Ney probability of n-grams of characters, from dictionaries."""
    grams = Counter()
    for text in texts:
        padded = " " * (order - 1) + text.replace("\0", "\ufffd")
        grams.update(padded[i : i + order] for i in range(len(text)))
    levels = {order: grams}
    for n in range(order - 1, 0, -1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])
    facts = {}
    for n, counts in levels.items():
        n1, n2, n3, n4 = (max(1, sum(1 for c in counts.values() if c == i)) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        d = [0, max(0, 1 - 2 * y * n2 / n1), max(0, 2 - 3 * y * n3 / n2), max(0, 3 - 4 * y * n4 / n3)]
        total, off = defaultdict(int), defaultdict(float)
        for g, c in counts.items():
            total[g[:-1]] += c
            off[g[:-1]] += d[min(c, 3)]
        facts[n] = (counts, d, total, off)

    def probability(gram):
        n = len(gram)
        if n == 0:
            return 1 / 0x110000
        counts, d, total, off = facts[n]
        if not total.get(gram[:-1]):
            return probability(gram[1:])
        c = counts.get(gram, 0)
        return (c - d[min(c, 3)] + off[gram[:-1]] * probability(gram[1:])) / total[gram[:-1]]

    return probability


def bits_a_byte(text, probability, order):
    padded = " " * (order - 1) + text.replace("\0", "\ufffd")
    return sum(-math.log2(max(1e-30, probability(padded[i : i + order]))) for i in range(len(text))) / len(text.encode())


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 1, "x") for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long, bits string")


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize(("order", "hot"), [(2, 1 << 20), (3, 1), (5, 200)])
def test_scores_limits_and_decisions_equal_brute_force(spark, order, hot):
    """Perplexities by the formula, limits from the other half's model, whatever n-grams are broadcast."""
    texts = [t for t in list(cases.messy_texts().values())[10:60] if t]
    texts += ["Съешь ещё этих мягких булок", "他们在河边散步，然后回家。", "a\0b", "\U0001f600 smile", "x" * 5000]
    rows = [(i, t, "en" if i % 3 else "de") for i, t in enumerate(texts)]
    good = {i for i in range(len(rows)) if i % 4}
    half = {r["id"]: r["h"] for r in spark.range(len(rows)).selectExpr("id", "pmod(xxhash64(id), 2) h").collect()}
    whole = kneser_ney([texts[i] for i in good], order)
    other = [kneser_ney([texts[i] for i in good if half[i] != h], order) for h in (0, 1)]
    found = classify_quality(frame(spark, rows), labels(spark, [(i, 1, 0) for i in good]), order=order, quantile=0.8, hot=hot)
    found = {r["doc_id"]: r for r in found.collect()}
    limit = {}
    for lang in ("en", "de"):
        steps = sorted(math.ceil(1e4 * bits_a_byte(texts[i], other[half[i]], order)) for i in good if rows[i][2] == lang)
        limit[lang] = next(s for k, s in enumerate(steps, 1) if k >= 0.8 * len(steps))
    assert len(found) == len(rows)
    for i, text, lang in rows:
        bits = bits_a_byte(text, whole, order)
        assert math.log2(found[i]["perplexity"]) == pytest.approx(bits, abs=1e-5)
        assert math.log2(found[i]["limit"]) == pytest.approx(limit[lang] / 1e4, abs=2e-4)
        if abs(bits - limit[lang] / 1e4) > 1e-3:
            assert found[i]["keep"] == (bits < limit[lang] / 1e4)


def test_probabilities_of_a_context_sum_to_one(spark):
    text = "abracadabra banana cabana"
    counts = Counter((" " * 2 + text)[i : i + 3] for i in range(len(text)))
    rows = spark.createDataFrame([(2, g, n) for g, n in counts.items()], "model int, gram string, n long")
    letters = sorted(set(text))
    needed = spark.createDataFrame([(2, "ab" + c) for c in [*letters, "?"]], "model int, gram string")
    found = {r["gram"][-1]: r["p"] for r in probabilities(train(rows, 3), needed).collect()}
    unseen = found.pop("?") * (0x110000 - len(letters))
    assert sum(found.values()) + unseen == pytest.approx(1, abs=1e-9)


def test_counts_tell_all_characters_apart(spark):
    docs = spark.createDataFrame([(1, "Aa1的地", 0), (2, None, 0), (3, "Aa1的地", -1)], "doc_id long, text string, half int").fillna("")
    found = {r["gram"]: (r["half0"], r["half1"], r["other"]) for r in gram_counts(docs, 2).collect()}
    assert found == {g: (1, 0, 1) for g in (" A", "Aa", "a1", "1的", "的地")}


def test_junk_goes_and_prose_stays(spark):
    draw = np.random.default_rng(2)
    words = {"en": ["the", "house", "stands", "near", "green", "river"], "de": ["das", "haus", "steht", "am", "fluss", "grün"]}
    rows = [(i, " ".join(draw.choice(words[lang], 40)), lang) for i, lang in enumerate(["en", "de"] * 100)]
    rows += [(1000, "x#@~ 9&&& q%%% |||| zzxq", "en"), (1001, "ZXQ!! QQX!! JJK!!", None), (1002, None, "fr"), (1003, "", "en")]
    rows += [(1004, "das haus steht am fluss " * 9, "nl"), (None, "das", "de"), (1005, "the house stands " * 9, "en"), (1005, "the house stands " * 9, "en")]
    marks = labels(spark, [(i, 1, 0) for i in range(100)] + [(1000, 0, 0), (150, None, None), (None, 1, 0), (5, 1, None)])
    docs = frame(spark, rows)
    found = classify_quality(docs, marks, quantile=0.99).collect()
    kept = {r["doc_id"] for r in found if r["keep"]}
    assert len(found) == len(rows) - 1
    assert not kept & {1000, 1001} and {1002, 1003, 1004, 1005} <= kept
    assert len(kept & set(range(200))) >= 190
    assert all(r["perplexity"] is None for r in found if r["doc_id"] in (1002, 1003))
    rest = keep_good(docs, marks, quantile=0.99)
    assert rest.columns == docs.columns
    assert sorted(r["doc_id"] for r in rest.collect()) == sorted(r["doc_id"] for r in found if r["keep"])
    assert {r["text"] for r in rest.collect() if r["doc_id"] == 1002} == {None}


def test_without_labels_or_documents(spark):
    docs, none = frame(spark, [(1, "a", "en"), (2, None, None)]), labels(spark, [])
    assert all(r["keep"] for r in classify_quality(docs, none).collect())
    assert classify_quality(docs.filter("doc_id > 9"), labels(spark, [(1, 1, 0)])).collect() == []


def test_trusted_needs_every_label(spark):
    rows = [(1, 1, 0), (2, 1, 1), (3, 0, 0), (4, 1, 0), (4, 0, 0), (5, None, 0), (6, 1, None)]
    assert sorted(r[0] for r in trusted_ids(labels(spark, rows)).collect()) == [1, 6]


def test_held_out_labels(spark):
    """Documents that are not used for training: good ones stay, most of the others go."""
    folder = "/root/testdata/sf0.1"
    docs, marks = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    found = classify_quality(docs, marks.filter("doc_id % 2 = 0")).join(marks.filter("doc_id % 2 = 1"), "doc_id")
    good = found.filter("quality = 1").selectExpr("avg(double(keep))").first()[0]
    bad = found.filter("quality = 0").selectExpr("avg(double(keep))").first()[0]
    assert good >= 0.98 and bad <= 0.2


@pytest.mark.parametrize("trusted", [1, 10])
def test_small_language_gets_no_limit_from_its_few_documents(spark, trusted):
    draw = np.random.default_rng(5)
    english, finnish = (
        ["".join(draw.choice(list(letters), draw.integers(2, 9))) for _ in range(300)] for letters in ("abcdeghinorst", "aijklmntuvyä")
    )
    rows = [(i, " ".join(draw.choice(english, 60)), "en") for i in range(300)]
    rows += [(1000 + i, " ".join(draw.choice(finnish, 60)), "fi") for i in range(trusted + 200)]
    marks = labels(spark, [(i, 1, 0) for i in [*range(300), *range(1000, 1000 + trusted)]])
    found = classify_quality(frame(spark, rows), marks).collect()
    fresh = [r["keep"] for r in found if r["doc_id"] >= 1000 + trusted]
    assert len(fresh) == 200 and np.mean(fresh) >= 0.95
    junk = frame(spark, [*rows, (5000, "q#@~ 9&&& w%%% |||| " * 9, "fi")])
    assert not [r for r in classify_quality(junk, marks).collect() if r["doc_id"] == 5000 and r["keep"]]
