"""Dictionary mentions in free text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import NOT_WORD, text_chunks, word_offset, words_of_chunk
from ..session import broadcast_limit, materialize_measured, spread

MENTION_SCHEMA = "note_id string, concept_id string, name string, score double, char_start int, char_end int, entity_text string"
_WORD = r"[\p{L}\p{N}_]"
#: White space other than the space, between which no name without white space can stand.
_SPACES = "\t\n\x0b\f\r"
_GROUP = 256


def keyword_dictionary(titles: DataFrame, column: str, longer_than: int = 3) -> DataFrame:
    """(concept_id, name): the distinct words of the titles, split at white space, that are longer than three characters."""
    words = titles.select(F.explode(F.split(F.lower(column), r"\s+")).alias("name"))
    kept = words.filter(F.length("name") > longer_than).distinct()
    return kept.select(F.concat(F.lit("W:"), "name").alias("concept_id"), "name")


def _is_word(character: Column) -> Column:
    return F.coalesce(character.rlike(f"^{_WORD}$"), F.lit(False))


def _anchored(dictionary: DataFrame) -> DataFrame:
    """The dictionary with what every name is found by: its first run of word characters, or the whole of a name without any.

    ``shift`` is where in the name it is, ``folds`` whether two places of the name can overlap.
    """
    word = F.regexp_extract("name", f"({_WORD}+)", 1)
    anchor = F.when(word == "", F.col("name")).otherwise(word)
    sizes = F.sequence(F.lit(1), F.length("name") - 1)
    folds = (word != "") & (word != F.col("name")) & F.exists(sizes, lambda k: F.left("name", k) == F.right("name", k))
    return dictionary.filter(F.length("name") > 0).withColumns(
        {"anchor": anchor, "shift": F.greatest(F.instr(F.col("name"), anchor) - 1, F.lit(0)), "folds": F.coalesce((F.length("name") > 1) & folds, F.lit(False))}
    )


def _in_place(name: Column, anchor: Column, shift: Column, left: Column, right: Column) -> Column:
    """Whether a name stands around its anchor, with a change between word and other characters at both of its ends."""
    prefix, suffix = F.left(name, shift), F.substring(name, shift + F.length(anchor) + 1, F.length(name))
    before = F.when(F.length(left) > shift, F.substring(left, F.length(left) - shift, F.lit(1))).otherwise("")
    after = F.substring(right, F.length(suffix) + 1, F.lit(1))
    ends = (_is_word(before) != _is_word(F.left(name, F.lit(1)))) & (_is_word(F.right(name, F.lit(1))) != _is_word(after))
    return F.endswith(left, prefix) & F.startswith(right, suffix) & ends


def _without_overlaps(found: DataFrame) -> DataFrame:
    """Of the places of one name in one note, from the left those that do not overlap one that is kept.

    The places are gone through in groups, so that what is kept is not copied as a whole for every one of them.
    """
    key = ["note_id", "concept_id", "word"]
    places = found.groupBy(*key).agg(F.array_sort(F.collect_set("char_start")).alias("places"))
    size, none = F.length("word"), F.array().cast("array<int>")

    def kept(last: Column, group: Column) -> Column:
        seed = F.struct(last.alias("last"), none.alias("done"))
        free = lambda acc, at: (at >= acc["last"] + size) | (acc["last"] < 0)
        return F.aggregate(
            group,
            seed,
            lambda acc, at: F.when(
                free(acc, at), F.struct(at.alias("last"), F.concat(acc["done"], F.array(at)).alias("done"))
            ).otherwise(acc),
        )

    groups = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("places") - 1) / _GROUP).cast("int")),
        lambda g: F.slice("places", g * _GROUP + 1, _GROUP),
    )
    start = F.struct(F.lit(-1).alias("last"), F.array().cast("array<array<int>>").alias("all"))

    def step(acc: Column, group: Column) -> Column:
        bound = F.transform(F.array(kept(acc["last"], group)), lambda k: F.struct(k["last"].alias("last"), F.concat(acc["all"], F.array(k["done"])).alias("all")))
        return F.get(bound, F.lit(0))

    left = F.aggregate(groups, start, step, lambda acc: F.flatten(acc["all"]))
    return places.select(*key, F.explode(left).alias("char_start"))


def _occurrences(present: DataFrame, names: DataFrame, about: dict) -> DataFrame:
    """(note_id, concept_id, word, char_start): every place of the names, also places that overlap."""
    margin = (about["longest"] or 0) + 1
    lower = F.lower("text")
    text = lower if about["spaced"] else F.translate(lower, _SPACES, " " * len(_SPACES))
    runs = present.select("note_id", F.posexplode(text_chunks(text, margin)).alias("run", "r"))
    runs = runs.select("note_id", "run", "r.*").withColumn("words", words_of_chunk(F.col("raw")))
    words = runs.withColumn("gap", F.lit(False)).select("*", F.posexplode("words").alias("i", "anchor")).filter("anchor <> ''")
    if about["gaps"]:
        words = words.unionByName(_gaps(runs))
    if not about["broadcast"]:  # only the words are shuffled, and what is found meets its run again
        words = words.select("note_id", "run", "i", "gap", "anchor")
    met = words.join(names, "anchor")
    if not about["broadcast"]:
        met = met.join(runs, ["note_id", "run"])
    offset = F.when(F.col("gap"), F.col("i")).otherwise(word_offset(F.col("words"), F.col("i")))
    met = _once(met, offset=offset.cast("int"))
    around, place = F.concat("before", "raw", "after"), F.length("before") + F.col("offset")
    left = F.right(F.left(around, place), F.lit(margin))
    right = F.substring(around, place + F.length("anchor") + 1, F.lit(margin))
    met = _once(met, left=left, right=right)
    whole = F.col("name") == F.col("anchor")
    met = met.filter(whole | _in_place(F.col("name"), F.col("anchor"), F.col("shift"), F.col("left"), F.col("right")))
    at = (F.col("start") + F.col("offset") - F.col("shift")).cast("int").alias("char_start")
    return met.select("note_id", "concept_id", F.col("name").alias("word"), at)


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """The rows with more columns, each worked out once, where Spark would repeat it wherever it is used."""
    held = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("_once")
    return df.select("*", held).select(*df.columns, "_once.*")


def _gaps(runs: DataFrame) -> DataFrame:
    """The characters between two words of a text, with the offset in the run where they begin, which has to be in the run itself.

    The last character of the word before is looked for in the margin too, and so is the next word.
    """
    last = F.right("before", F.lit(1))
    text = F.concat(last, "raw", "after")
    found = F.regexp_extract_all(text, F.lit(f"{_WORD}+|{NOT_WORD}+"), F.lit(0))
    pieces = runs.withColumn("pieces", found).select("*", F.posexplode("pieces").alias("p", "anchor"))
    begin = F.length(F.array_join(F.slice("pieces", F.lit(1), F.col("p")), "")) - F.length(last)
    pieces = pieces.withColumn("i", begin.cast("int")).withColumn("gap", F.lit(True))
    between = (F.col("p") > 0) & (F.col("p") + 1 < F.size("pieces")) & ~_is_word(F.left("anchor", F.lit(1)))
    inside = (F.col("i") >= 0) & (F.col("i") < F.length("raw"))
    return pieces.filter(between & inside).drop("pieces", "p")


def dictionary_words(notes: DataFrame, dictionary: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(note_id, concept_id, word, char_start): where the names of the dictionary stand in every text as whole words.

    Texts are cut into short runs of words with a margin as long as the longest name (:func:`quillgraph.functions.text.text_chunks`).
    A name is found by its first word, or, if it has none, by the characters between two words; what else there is of it is compared
    with the run and its margin. So no hit meets its whole text again, and time is linear in the length of the texts. A dictionary
    that Spark would broadcast meets the words where they are; for a larger one only words are shuffled, and those
    that are found meet their run again. The dictionary is written out first, so that the join can split the rows
    of a frequent word over tasks.
    """
    names, about = materialize_measured(
        _anchored(dictionary.select("concept_id", "name")),
        "dictionary",
        longest=F.max(F.length("name")),
        bytes=F.sum(F.octet_length("name") * 2 + F.octet_length("concept_id") + 64),
        spaced=F.count_if(F.col("name").rlike(r"\s")),
        gaps=F.count_if(~F.col("anchor").rlike(_WORD)),
        folds=F.count_if("folds"),
    )
    about["broadcast"] = (about["bytes"] or 0) <= broadcast_limit(notes.sparkSession)
    present = notes.filter(F.length(F.trim(text_col)) > 0).select(F.col(id_col).alias("note_id"), F.col(text_col).alias("text"))
    present = spread(present)
    if not about["folds"]:
        return _occurrences(present, names, about)
    once = _occurrences(present, names.filter("NOT folds"), about)
    return once.unionByName(_without_overlaps(_occurrences(present, names.filter("folds"), about | {"gaps": 0})))


def extract_mentions(
    notes: DataFrame,
    dictionary: DataFrame,
    id_col: str,
    text_col: str,
    extractor: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]] | None = None,
) -> DataFrame:
    """Whole-word mentions of dictionary names with 0-based offsets, the end exclusive. Blank notes give none.

    A name is mentioned where the lower-case text has it between word boundaries: at both of its ends a word character
    meets one that is none, or the edge of the text.

    ``extractor`` replaces the dictionary by a model: it gets an iterator over batches with columns ``note_id`` and
    ``text`` once per partition, so that it can load its model once, and yields batches of ``MENTION_SCHEMA``.
    """
    if extractor is not None:
        blank_free = notes.filter(F.length(F.trim(text_col)) > 0)
        batches = blank_free.select(F.col(id_col).cast("string").alias("note_id"), F.col(text_col).alias("text"))
        return batches.mapInPandas(extractor, MENTION_SCHEMA)
    return dictionary_words(notes, dictionary, id_col, text_col).select(
        "note_id",
        "concept_id",
        F.col("word").alias("name"),
        F.lit(1.0).alias("score"),
        "char_start",
        (F.col("char_start") + F.length("word")).alias("char_end"),
        F.col("word").alias("entity_text"),
    )


def mentions_per_note(notes: DataFrame, mentions: DataFrame, id_col: str) -> DataFrame:
    """(notes, mentions, avg_mentions): notes without a mention count as zero."""
    found = mentions.groupBy(F.col("note_id").alias(id_col)).agg(F.count(F.lit(1)).alias("found"))
    return (
        notes.select(id_col)
        .join(found, id_col, "left")
        .agg(
            F.count(F.lit(1)).alias("notes"),
            F.coalesce(F.sum("found"), F.lit(0)).alias("mentions"),
            F.avg(F.coalesce("found", F.lit(0))).alias("avg_mentions"),
        )
    )
