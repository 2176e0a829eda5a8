import random

import pytest
from pyspark.sql import functions as F

from quillgraph.functions.codes import code_chapter
from quillgraph.functions.similarity import (
    jaro_winkler,
    levenshtein_similarity,
    same_first_word,
    same_prefix,
    token_jaccard,
    with_jaro_winkler,
)
from quillgraph.functions.text import block_key, token_set
from quillgraph.functions.times import event_time


def scores(spark, pairs, function):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    rows = df.select("i", function(F.col("a"), F.col("b")).alias("s")).orderBy("i").collect()
    return [row["s"] for row in rows]


def test_jaro_winkler(spark):
    pairs = [
        ("ASPIRIN", "ASPIRIN"), ("ASPIRIN", "WARFARIN"), ("MARTHA", "marhta"), (None, "A"), ("", ""), ("AB", "XY"),
        ("DIXON", "DICKSONX"), ("DWAYNE", "DUANE"),
    ]
    found = scores(spark, pairs, jaro_winkler)
    assert found == pytest.approx([1.0, 0.6071, 0.9611, 0.0, 0.0, 0.0, 0.8133, 0.84], abs=1e-4)


def test_jaro_winkler_on_distinct_pairs_first(spark):
    df = spark.createDataFrame([("A B", "A C")] * 5 + [("X", "X")], "a string, b string")
    rows = with_jaro_winkler(df, "a", "b", "jw", distinct_first=True).collect()
    assert len(rows) == 6 and len({r["jw"] for r in rows}) == 2


def test_levenshtein(spark):
    found = scores(spark, [("kitten", "SITTING"), ("a", "A"), ("", "x"), (None, None)], levenshtein_similarity)
    assert found == pytest.approx([1 - 3 / 7, 1.0, 0.0, 0.0])


def test_token_jaccard(spark):
    pairs = [("HEART FAILURE ACUTE", "HEART FAILURE CHRONIC"), ("a  b", " B A "), ("", "x"), (None, "x"), ("  ", "  ")]
    assert scores(spark, pairs, token_jaccard) == pytest.approx([0.5, 1.0, 0.0, 0.0, 0.0])


def test_prefix_and_first_word(spark):
    assert scores(spark, [("0036-3028-110", "00363028-199"), ("1", "2")], lambda a, b: same_prefix(a, b, 8, "-")) == [1.0, 0.0]
    assert scores(spark, [("Aspirin 81", "aspirin EC"), ("A", "B")], same_first_word) == [True, False]


def test_chapters(spark):
    codes = ["41401", "0010", "0389", "V5861", "0066", " 486 ", "", None, "800", "799"]
    df = spark.createDataFrame(list(enumerate(codes)), "i int, code string")
    found = [r[0] for r in df.orderBy("i").select(code_chapter(F.col("code"))).collect()]
    assert found == [
        "CIRCULATORY", "INFECTIOUS", "INFECTIOUS", "OTHER", "INFECTIOUS", "RESPIRATORY", "UNK", "UNK", "INJURY", "CONGENITAL",
    ]


def test_tokens_and_block_keys(spark):
    names = ["Heparin Sodium", "heparin-sodium", " a  b a ", "", "  ", None]
    df = spark.createDataFrame(list(enumerate(names)), "i int, n string").orderBy("i")
    assert [r[0] for r in df.select(token_set(F.col("n"))).collect()] == [
        ["HEPARIN", "SODIUM"], ["HEPARIN-SODIUM"], ["A", "B"], [], [], [],
    ]
    assert [r[0] for r in df.select(block_key(F.col("n"))).collect()] == [
        "HEPARI", "HEPARI", "A", "UNKNOWN", "UNKNOWN", "UNKNOWN",
    ]


def test_event_time(spark):
    rows = [(0, "2100-01-02 03:04:05", None), (1, "", "2100-01-02"), (2, None, "2100-01-02"), (3, "soon", "2100-01-02"), (4, None, None)]
    df = spark.createDataFrame(rows, "i int, t string, d string").orderBy("i")
    found = [r[0] and str(r[0]) for r in df.select(event_time(F.col("t"), F.col("d"))).collect()]
    assert found == ["2100-01-02 03:04:05", "2100-01-02 00:00:00", "2100-01-02 00:00:00", None, None]


def plain_jaro_winkler(a, b):
    """Pair by pair, as the definition reads."""
    if not a or not b:
        return 0.0
    reach, taken, matched = max(max(len(a), len(b)) // 2 - 1, 0), set(), []
    for i, letter in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if j not in taken and b[j] == letter:
                taken.add(j)
                matched.append(letter)
                break
    m = len(matched)
    if not m:
        return 0.0
    swaps = sum(x != b[j] for x, j in zip(matched, sorted(taken))) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * 0.1 * (1.0 - jaro) if jaro > 0.7 else jaro


def test_jaro_winkler_of_many_pairs_equals_the_definition(spark):
    import random

    draw = random.Random(6)
    word = lambda: "".join(draw.choices(["A", "B", "C", "É", "😀", " "], k=draw.choice([0, 1, 2, 5, 9, 30])))
    pairs = [(word(), word()) for _ in range(3000)] + [("AB" * 400, "BA" * 390), ("X" * 600, "Y" * 600), ("\0", "\0\0"), (None, "A"), ("A" * 513, "A")]
    pairs += [(w, w[: len(w) // 2] + "Z" + w[len(w) // 2 :]) for w, _ in pairs[:500]]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    found = {r["i"]: r["s"] for r in rows.select("i", jaro_winkler(F.col("a"), F.col("b")).alias("s")).collect()}
    assert all(found[i] == plain_jaro_winkler(a, b) for i, (a, b) in enumerate(pairs))


def test_names_are_split_once_for_their_common_words(spark):
    rows = spark.createDataFrame([("a b  c", "B c d"), ("", "a"), ("a", None), ("x", "y"), ("q", "Q q")], "a string, b string")
    found = rows.filter("a <> '?'").select(token_jaccard(F.col("a"), F.col("b")).alias("v"))
    assert [r["v"] for r in found.collect()] == [0.5, 0.0, 0.0, 0.0, 1.0]
    assert rows.select(token_jaccard(F.col("a"), F.col("b")).alias("v"))._jdf.queryExecution().optimizedPlan().toString().count("split(") == 2


def test_jaro_winkler_on_both_sides_of_64_letters(spark):
    """Up to there, places are bits of one number."""

    def plain(a, b):
        reach, taken, hits = max(max(len(a), len(b)) // 2 - 1, 0), set(), []
        for i, letter in enumerate(a):
            at = next((j for j in range(max(i - reach, 0), min(i + reach + 1, len(b))) if j not in taken and b[j] == letter), None)
            if at is not None:
                taken.add(at)
                hits.append(letter)
        if not hits:
            return 0.0
        m, swaps = len(hits), sum(x != b[j] for x, j in zip(hits, sorted(taken))) // 2
        jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
        start = next((k for k in range(4) if k >= min(len(a), len(b)) or a[k] != b[k]), 4)
        return jaro + start * 0.1 * (1 - jaro) if jaro > 0.7 else jaro

    draw = random.Random(6)
    for letters in ("AB", "ABCDÉ", "AБ中"):
        names = ["".join(draw.choice(letters) for _ in range(n)) for n in (1, 2, 33, 63, 64) * 8 + (65, 66, 130) * 3]
        pairs = [(a, b) for a in names for b in draw.sample(names, 5)]
        table = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
        found = {r["i"]: r["v"] for r in table.select("i", jaro_winkler(F.col("a"), F.col("b")).alias("v")).collect()}
        assert all(found[i] == pytest.approx(plain(a, b)) for i, (a, b) in enumerate(pairs))
