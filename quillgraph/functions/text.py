"""Tokens, blocking keys and word pieces with offsets, all as native columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_WORD = r"[^\p{L}\p{N}_]"
_WORD = r"[\p{L}\p{N}_]"
_CHUNK = 16
_GROUP = 256


def tokens(text: Column) -> Column:
    """Upper-case words split on white space, without empty ones; an empty array for null or blank text."""
    words = F.split(F.upper(F.trim(F.coalesce(text, F.lit("")))), r"\s+")
    return F.filter(words, lambda w: w != "")


def token_set(text: Column) -> Column:
    """Distinct tokens in sorted order, so that equal sets are equal arrays."""
    return F.array_sort(F.array_distinct(tokens(text)))


def block_key(text: Column, length: int = 6) -> Column:
    """The first characters of the first word in upper case; ``UNKNOWN`` for null or blank text."""
    return F.coalesce(F.substring(F.try_element_at(tokens(text), F.lit(1)), 1, length), F.lit("UNKNOWN"))


def _starts(lengths: Column) -> Column:
    """The sum of all lengths before each one."""
    seed = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("done"))
    return F.aggregate(
        lengths,
        seed,
        lambda acc, n: F.struct(
            (acc["at"] + n).cast("int").alias("at"), F.concat(acc["done"], F.array(acc["at"])).alias("done")
        ),
        lambda acc: acc["done"],
    )


def _summed(lengths: Column) -> Column:
    """Like :func:`_starts`, in groups of 256, so that a long text does not copy one long array for every element."""
    groups = F.transform(
        F.sequence(F.lit(0), F.greatest(F.floor((F.size(lengths) - 1) / _GROUP), F.lit(0)).cast("int")),
        lambda g: F.slice(lengths, g * _GROUP + 1, _GROUP),
    )
    sums = F.transform(groups, lambda g: F.aggregate(g, F.lit(0), lambda s, n: (s + n).cast("int")))
    return F.flatten(F.zip_with(groups, _starts(sums), lambda g, at: F.transform(_starts(g), lambda s: s + at)))


def text_chunks(text: Column, margin: int) -> Column:
    """The text as an array of (raw, before, after, start): runs of 16 words, each word with the one character behind it.

    ``before`` and ``after`` are the ``margin`` characters around the run, ``start`` is the 0-based offset of its first character.
    What is done with one run needs nothing else of the text, and all of it takes time in proportion to the text's length.
    """
    around = -(-margin // _CHUNK)  # every run but the last has 16 characters at least

    def parts(raws: Column) -> Column:
        def before(_: Column, i: Column) -> Column:
            some = F.slice(raws, F.greatest(i - around, F.lit(0)) + 1, F.least(i, F.lit(around)))
            return F.right(F.array_join(some, ""), F.lit(margin))

        after = F.transform(raws, lambda _, i: F.left(F.array_join(F.slice(raws, i + 2, around), ""), F.lit(margin)))
        starts = bound(F.transform(raws, lambda raw: F.length(raw)), _summed)
        return F.arrays_zip(raws.alias("raw"), F.transform(raws, before).alias("before"), after.alias("after"), starts.alias("start"))

    pattern = f"(?:{_WORD}*+{NOT_WORD}){{{_CHUNK}}}|(?s:.+)"
    return bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), parts)


def bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once, and not again for every element that ``then`` goes through."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def words_of_chunk(raw: Column) -> Column:
    """The words of a run of :func:`text_chunks`, an empty one between two characters that are no part of a word."""
    return F.split(F.regexp_replace(raw, NOT_WORD, " "), " ")


def word_offset(words: Column, position: Column) -> Column:
    """The offset in its run of the word at a 0-based position."""
    before = F.length(F.array_join(F.slice(words, F.lit(1), position), " ")) + 1
    return F.when(position == 0, F.lit(0)).otherwise(before)
