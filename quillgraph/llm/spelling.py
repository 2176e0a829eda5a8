"""Spelling variants: words one edit apart, found by walking a trie of all words level by level as joins."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import drop_materialized, materialize, materialize_measured, result_only

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_HELD = 200_000
_ROWS = 256
#: Words of one node that a task compares with its edges.
_SHARE = 4096


def _lowered(run: str) -> str:
    return run.lower() if run.isascii() else run.translate(_LOWER)


def word_counts(docs: DataFrame, shortest: int = 6, least: int = 5, every: int = 199) -> DataFrame:
    """(word, n) of (doc_id, text) rows: how often each word of ``shortest`` code points or more occurs, ``least`` times or more.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased. Let h be the CRC-32 of ``<doc_id>:<run>``: if
    ``every`` divides it, the run loses its code point h modulo its length. Every task counts before it sends.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def send() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                rows = batch.slice(at, _ROWS)
                for doc_id, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                    if not text:
                        continue
                    own: Counter[str] = Counter()
                    for run, n in Counter(_RUN.findall(text)).items():
                        if len(run) >= shortest:
                            own[_lowered(run)] += n
                    seed = None if doc_id is None else zlib.crc32(b"%d:" % doc_id)
                    for run, n in own.items():
                        if seed is not None and not (h := zlib.crc32(run.encode(), seed)) % every:
                            gone = h % len(run)
                            run = run[:gone] + run[gone + 1 :]
                            if len(run) < shortest:
                                continue
                        held[run] += n
                    if len(held) >= _HELD:
                        yield send()
                        held.clear()
        if held:
            yield send()

    found = docs.mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _common_prefix(low: Column, high: Column) -> Column:
    """What two different strings have in common from their starts."""
    differs = F.zip_with(F.split(low, ""), F.split(high, ""), lambda x, y: ~x.eqNullSafe(y))
    return F.substring(low, F.lit(1), (F.array_position(differs, True) - 1).cast("int"))


def _rest(word: str = "word", at: str = "at") -> Column:
    return F.substring(F.col(word), F.col(at) + 1, F.length(word))


def _bit(size: Column) -> Column:
    """A long with the bit of a length set, lengths being taken modulo 64."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(size, F.lit(64)).cast("int"))


def trie_edges(frontier: DataFrame) -> DataFrame:
    """(node, first, label, child, words, sizes, shares): the edges out of the nodes that words without an edit have come to.

    The words of a node that go on with the same character share an edge, and its label is all that they have in common
    from there: the common start of the least and the greatest of them. So there is a node where words part or one
    ends, and nowhere else. ``sizes`` has a bit for each length of a word below; ``shares`` into how many parts the
    node's words are dealt.
    """
    on = frontier.filter((F.col("edits") == 0) & (F.col("at") < F.length("word")))
    rest = _rest()
    found = on.groupBy("node", F.substring(rest, 1, 1).alias("first")).agg(
        F.min(rest).alias("low"),
        F.max(rest).alias("high"),
        F.count(F.lit(1)).alias("words"),
        F.bit_or(_bit(F.length("word"))).alias("sizes"),
        F.max("shares").alias("shares"),
    )
    label = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(_common_prefix(F.col("low"), F.col("high")))
    child = F.xxhash64("node", "first").alias("child")
    return found.select("node", "first", label.alias("label"), child, "words", "sizes", "shares")


def _advanced(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """States one edge further on: words without an edit follow their own, words with one where they agree with the label."""
    on = frontier.filter(F.col("at") < F.length("word")).drop("shares").withColumn("first", F.substring(_rest(), 1, 1))
    met = on.join(edges.drop("shares"), ["node", "first"])
    agrees = F.substring(_rest(), F.lit(1), F.length("label")) == F.col("label")
    fits = F.col("sizes").bitwiseAND(_bit(F.col("size"))) != 0
    met = met.filter((F.col("edits") == 0) | (agrees & fits))
    shares = F.ceil(F.col("words") / _SHARE).cast("int")
    return met.select("word", "back", (F.col("at") + F.length("label")).alias("at"), F.col("child").alias("node"), shares.alias("shares"), "edits", "size")


def _edited(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """States with their one edit: at a node, an edge that is not the word's own replaces its next character or follows without it."""
    half = F.when(F.col("back"), F.ceil(F.length("word") / 2)).otherwise(F.floor(F.length("word") / 2))
    on = frontier.filter((F.col("edits") == 0) & (F.col("at") < F.length("word")) & (F.col("at") >= half))
    on = on.withColumn("share", F.pmod(F.xxhash64("word"), F.col("shares")).cast("int")).drop("shares", "edits", "size")
    dealt = edges.withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares", "words")
    rest, length = _rest(), F.length("label")
    met = on.join(dealt, ["node", "share"]).filter(F.col("first") != F.substring(rest, 1, 1))
    size = F.length("word")
    has = lambda n: F.col("sizes").bitwiseAND(_bit(n)) != 0
    replaced = (F.substring(rest, F.lit(2), length - 1) == F.substring("label", F.lit(2), length)) & has(size)
    replaced &= F.length(rest) >= length
    dropped = (F.substring(rest, F.lit(2), length) == F.col("label")) & has(size - 1)
    options = F.array(
        F.struct(replaced.alias("may"), (F.col("at") + length).alias("at"), size.alias("size")),
        F.struct(dropped.alias("may"), (F.col("at") + length + 1).alias("at"), (size - 1).alias("size")),
    )
    made = met.filter(replaced | dropped).select("word", "back", "child", F.explode(F.filter(options, lambda x: x["may"])).alias("x"))
    return made.select("word", "back", "x.at", F.col("child").alias("node"), F.lit(1).alias("shares"), F.lit(1).alias("edits"), "x.size")


def _arrived(frontier: DataFrame) -> DataFrame:
    """(word, back, near): states at the end of a word, with their edit done or with one character too many."""
    ends = frontier.filter((F.col("edits") == 0) & (F.col("at") == F.length("word"))).select("node", F.col("word").alias("near"))
    last = (F.col("edits") == 0) & (F.col("at") + 1 == F.length("word"))
    done = frontier.filter(last | ((F.col("edits") == 1) & (F.col("at") == F.length("word"))))
    return done.join(ends, "node").select("word", "back", "near")


def near_words(words: DataFrame) -> DataFrame:
    """(word, near): for every one of the distinct words, the others that differ by exactly one inserted, deleted or replaced code point.

    A state (word, place, node, edits) says that the word's start up to a place leads to a node of the trie of all words, with
    so many edits. Each round joins the states with the edges of the level they stand on, which the states without an edit
    define themselves, and writes the states of the next level. The first place where two words differ is a node, so edits
    are made at nodes only. States that end where a word ends are neighbours.

    Words are walked from both ends, and an edit is made in the further half only, where few edges leave a node: of two
    neighbours, the half that is alike is walked without branching. Only replaced and dropped characters are looked for; an
    inserted one is a dropped one of the other word. Nodes are numbered by hash; pairs are checked at the end, so a
    collision costs time and changes nothing. Nodes with many words share them out over tasks. The number of rounds
    is that of nodes on one path, not of characters.
    """
    both = F.explode(F.array(F.struct(F.col("word").alias("w"), F.lit(False).alias("back")), F.struct(F.reverse("word").alias("w"), F.lit(True).alias("back"))))
    start = words.select(both.alias("s")).select(F.col("s.w").alias("word"), "s.back")
    start = start.select("word", "back", F.lit(0).alias("at"), F.col("back").cast("long").alias("node"), F.lit(1).alias("shares"), F.lit(0).alias("edits"), F.length("word").alias("size"))
    frontier, found = materialize(start, "frontier"), []
    while not frontier.filter("edits = 0").isEmpty():
        edges = materialize(trie_edges(frontier), "trie-edges")
        found.append(materialize(_arrived(frontier), "arrived"))
        following = materialize(_advanced(frontier, edges).unionByName(_edited(frontier, edges)), "frontier")
        drop_materialized(frontier)
        drop_materialized(edges)
        frontier = following
    drop_materialized(frontier)
    if not found:
        return words.select("word", F.col("word").alias("near")).limit(0)
    pairs = reduce(DataFrame.unionByName, found)
    turned = lambda c: F.when(F.col("back"), F.reverse(c)).otherwise(F.col(c)).alias(c)
    pairs = pairs.select(turned("word"), turned("near")).filter(F.levenshtein("word", "near", 1) == 1)
    pairs = materialize(pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("word").alias("near"))).distinct(), "near-words")
    for done in found:
        drop_materialized(done)
    return pairs


def follow(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of (word, form) rows that each word begins. Chains must not be circular; every round doubles the step."""
    roots, moved = materialize(forms.select("word", F.col("form").alias("root")), "roots"), 1
    while moved:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = roots.join(further, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")
        )
        following, seen = materialize_measured(step, "roots", moved=F.count_if("moved"))
        drop_materialized(roots)
        roots, moved = following.select("word", "root"), seen["moved"]
    return roots


@result_only("spelling")
def spelling_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shortest: int = 6,
    least: int = 5,
    ratio: int = 5,
    every: int = 199,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n): every word of the texts with the form that it is probably a variant of.

    Words and their numbers ``n`` are those of :func:`word_counts`, neighbours those of :func:`near_words`. A word's form is its most
    frequent neighbour, ties to the smallest in code-point order, if it occurs at least ``ratio`` times as often;
    else null. ``root`` is where following the forms ends, the word itself if it has none.

    A null or empty text has no words. A row without an id counts with its words as they are. Rows that repeat an id each count.
    Other columns are not read. An empty table gives no rows.
    """
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    words = materialize(word_counts(given, shortest, least, every), "words")
    near = near_words(words)
    frequency = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = near.join(frequency, "near").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best")
    )
    known = words.join(best, "word", "left")
    better = -F.col("best.n") >= F.col("n") * ratio
    known = known.select(
        "word",
        F.when(better, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(better, -F.col("best.n")).alias("form_n"),
    )
    known = materialize(known, "forms")
    roots = follow(known.filter("form IS NOT NULL"))
    for done in (words, near):
        drop_materialized(done)
    out = known.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
