import random
import re
import zlib
from collections import Counter

from quillgraph.llm.spelling import near_words, spelling_variants, word_counts

from . import cases

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counts(texts, least=5, shortest=6):
    out = Counter()
    for i, text in texts:
        for run in RUN.findall(text or ""):
            run = cases.lower(run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= shortest and n >= least}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[at + 1 :] == b[at + 1 :] or a[at + 1 :] == b[at:] or a[at:] == b[at + 1 :]


def expected(texts):
    n = counts(texts)
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n.get(form[w]))
    return out


def result(docs):
    rows = spelling_variants(docs).collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def words_of(spark, words):
    return spark.createDataFrame([(w, 5) for w in words], "word string, n long")


def pairs(spark, words):
    return {tuple(r) for r in near_words(words_of(spark, words)).collect()}


def test_near_words_equal_brute_force(spark):
    draw = random.Random(4)
    words = {"".join(draw.choices("abé", k=draw.randint(6, 9))) for _ in range(400)}
    words |= {"aaaaaa" + "a" * k for k in range(12)}  # every one an end on the path of the next
    words |= {"x" * 3000 + "y", "x" * 3000 + "z", "x" * 3001 + "z", "z" + "x" * 3000, "unlike" * 9}
    assert pairs(spark, words) == {(a, b) for a in words for b in words if one_edit(a, b)}


def test_near_words_of_few(spark):
    assert pairs(spark, []) == set()
    assert pairs(spark, ["single"]) == set()
    assert pairs(spark, ["single", "singles"]) == {("single", "singles"), ("singles", "single")}


def test_variants_equal_brute_force(spark):
    draw = random.Random(8)
    stems = ["".join(draw.choices("abcdeéß", k=draw.randint(6, 8))) for _ in range(30)]
    texts = []
    for i in range(300):
        words = []
        for _ in range(200):
            stem = draw.choice(stems[: draw.randint(1, 30)])
            at = draw.randrange(len(stem))
            kind = draw.random()
            if kind < 0.1:
                stem = stem[:at] + stem[at + 1 :]
            elif kind < 0.15:
                stem = stem[:at] + draw.choice("abcx") + stem[at:]
            elif kind < 0.2:
                stem = stem[:at].upper() + stem[at:]
            words.append(stem)
        texts.append((i * 5, " ".join(words)))
    texts += [(None, "nullid " * 7), (3, None), (4, ""), (5, "again again1again " * 3), (5, "again again1again " * 3)]
    texts += [(7, "tracke " * 6 + "tracker " * 40 + "trackers " * 260)]
    docs = spark.createDataFrame([(*t, "x", "y") for t in texts], "doc_id long, text string, n string, word string").repartition(4)
    want = expected(texts)
    assert any(v[0] for v in want.values()) and any(v[0] and v[1] != v[0] for v in want.values())
    assert result(docs) == want


def test_counts_over_messy_texts(spark):
    texts = cases.messy_texts()
    found = {r["word"]: r["n"] for r in word_counts(cases.table(spark, texts).select("doc_id", "text"), shortest=2).collect()}
    assert found == counts(texts.items(), shortest=2)


def test_empty_table(spark):
    docs = cases.table(spark, {1: "a"})
    assert result(docs) == {} and result(docs.filter("doc_id < 0")) == {}
