"""String similarities between two columns, each 0 where either side is null or empty."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import bound, token_set


def _zero_if_blank(a: Column, b: Column, value: Column) -> Column:
    filled = (F.length(a) > 0) & (F.length(b) > 0)
    return F.when(filled, value).otherwise(F.lit(0.0))


def levenshtein_similarity(a: Column, b: Column) -> Column:
    """1 minus the edit distance over the length of the longer string, ignoring case."""
    upper_a, upper_b = F.upper(a), F.upper(b)
    longest = F.greatest(F.length(upper_a), F.length(upper_b))  # upper case may be longer than the text
    return _zero_if_blank(a, b, 1.0 - F.levenshtein(upper_a, upper_b) / longest)


def set_jaccard(left: Column, right: Column) -> Column:
    """Jaccard similarity of two arrays of distinct values; 0 when both are empty."""

    def share(shared: Column) -> Column:
        union = F.size(left) + F.size(right) - shared
        return F.when(union > 0, shared / union).otherwise(F.lit(0.0))

    return bound(F.size(F.array_intersect(left, right)), share)


def token_jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of the word sets of two strings, ignoring case."""
    both = F.struct(token_set(a).alias("a"), token_set(b).alias("b"))
    return _zero_if_blank(a, b, bound(both, lambda sets: set_jaccard(sets["a"], sets["b"])))


def same_prefix(a: Column, b: Column, length: int, strip: str | None = None) -> Column:
    """1.0 where two codes agree in their first characters, after removing the characters in ``strip``; 0.0 if one is null."""
    if strip:
        a, b = (F.regexp_replace(side, f"[{strip}]", "") for side in (a, b))
    return F.coalesce((F.substring(a, 1, length) == F.substring(b, 1, length)).cast("double"), F.lit(0.0))


def same_first_word(a: Column, b: Column) -> Column:
    """True where two strings start with the same word, ignoring case."""
    first = [F.element_at(F.split(F.upper(F.trim(side)), r"\s+"), 1) for side in (a, b)]
    return first[0] == first[1]


def _jaro_winkler_udf():
    # Nested functions travel to the workers by value, so these need no copy of this package.
    import numpy as np

    cells, longest = 1 << 20, 512
    zero, one = np.uint64(0), np.uint64(1)

    def winkler(matched, swaps, len_a, len_b, prefix):
        """From the number of matched letters, those of them out of order, and the common start; all may be arrays."""
        jaro = (matched / len_a + matched / len_b + (matched - swaps) / matched) / 3
        return np.where(jaro > 0.7, jaro + prefix * 0.1 * (1.0 - jaro), jaro)

    def codes(strings, width):
        return np.array(strings, f"U{width}").view(np.uint32).reshape(len(strings), width)

    def narrow(left, right):
        """The same letters in as few bytes as they allow, which is what comparing them takes."""
        least = np.min_scalar_type(max(int(left.max()), int(right.max())))
        return left.astype(least), right.astype(least)

    def met_by_bits(left, right, len_a, len_b, reach):
        """Which letters of both sides are matched, the places of the second side being bits of one number."""
        rows, width = right.shape
        bits = np.zeros((rows, 64), bool)
        free = np.where(len_b < 64, np.left_shift(one, np.minimum(len_b, 63).astype(np.uint64)) - one, ~zero)
        hits = np.zeros(left.shape, bool)
        for i in range(left.shape[1]):
            np.equal(right, left[:, i : i + 1], out=bits[:, :width])
            alike = np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()
            start = np.clip(i - reach, 0, 63).astype(np.uint64)
            stop = i + reach + 1
            window = np.where(stop < 64, np.left_shift(one, np.minimum(stop, 63).astype(np.uint64)) - one, ~zero)
            fits = alike & free & (window >> start << start)
            fits[(i >= len_a) | (i - reach > 63)] = zero
            first = fits & (~fits + one)
            free ^= first
            hits[:, i] = first != zero
        left_over = np.unpackbits(free.astype("<u8").view(np.uint8).reshape(rows, 8), axis=1, bitorder="little")
        return hits, (left_over[:, :width] == 0) & (np.arange(width) < len_b[:, None])

    def met_by_places(left, right, len_a, len_b, reach):
        """The same for strings of any length."""
        place, row = np.arange(right.shape[1]), np.arange(len(left))
        free = place < len_b[:, None]
        hits = np.zeros(left.shape, bool)
        for i in range(left.shape[1]):
            fits = free & (right == left[:, i : i + 1]) & (np.abs(place - i) <= reach[:, None])
            fits[i >= len_a] = False
            at = fits.argmax(axis=1)
            hits[:, i] = fits[row, at]
            free[row[hits[:, i]], at[hits[:, i]]] = False
        return hits, ~free & (place < len_b[:, None])

    def together(a, b):
        """Pairs of non-empty strings of much the same length, letter by letter for all of them at once."""
        len_a, len_b = (np.fromiter(map(len, side), np.int64, len(side)) for side in (a, b))
        left, right = narrow(codes(a, int(len_a.max())), codes(b, int(len_b.max())))
        reach = np.maximum(np.maximum(len_a, len_b) // 2 - 1, 0)
        met = met_by_bits if right.shape[1] <= 64 else met_by_places
        hits, taken = met(left, right, len_a, len_b, reach)
        matched = hits.sum(axis=1)
        # as many letters of one side as of the other, row by row, each side in its own order
        out_of_order = left[hits] != right[taken]
        swaps = np.bincount(np.repeat(np.arange(len(a)), matched)[out_of_order], minlength=len(a)) // 2
        start = min(4, left.shape[1], right.shape[1])
        inside = np.arange(start) < np.minimum(len_a, len_b)[:, None]
        prefix = np.cumprod((left[:, :start] == right[:, :start]) & inside, axis=1).sum(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(matched > 0, winkler(matched, swaps, len_a, len_b, prefix), 0.0)

    def alone(a, b):
        """One pair of long strings, whose letters are looked for by the string search."""
        reach = max(max(len(a), len(b)) // 2 - 1, 0)
        taken, matched = bytearray(len(b)), []
        for i, letter in enumerate(a):
            stop = min(i + reach + 1, len(b))
            j = b.find(letter, max(i - reach, 0), stop)
            while j >= 0 and taken[j]:
                j = b.find(letter, j + 1, stop)
            if j >= 0:
                taken[j] = 1
                matched.append(letter)
        if not matched:
            return 0.0
        swaps = sum(x != y for x, y in zip(matched, (letter for letter, hit in zip(b, taken) if hit))) // 2
        prefix = next((k for k in range(4) if k >= min(len(a), len(b)) or a[k] != b[k]), 4)
        return float(winkler(len(matched), swaps, len(a), len(b), prefix))

    def similarity(a, b):
        out = np.zeros(len(a))
        sizes = np.array([max(len(x), len(y)) if x and y else 0 for x, y in zip(a, b)], np.int64)
        order = np.argsort(sizes, kind="stable")
        order = order[np.searchsorted(sizes[order], 1) :]  # blank ones stay 0
        at, short = 0, int(np.searchsorted(sizes[order], longest, "right"))
        while at < short:
            # so many that the longest of them fit into the cells
            to = at + max(1, int(np.searchsorted(sizes[order[at:short]] * np.arange(1, short - at + 1), cells, "right")))
            some = order[at:to]
            out[some] = together([a[i] for i in some], [b[i] for i in some])
            at = to
        for i in order[short:]:
            out[i] = alone(a[i], b[i])
        return out

    @F.pandas_udf("double")
    def scored(a: pd.Series, b: pd.Series) -> pd.Series:
        upper_a, upper_b = a.fillna("").str.upper(), b.fillna("").str.upper()
        return pd.Series(similarity(upper_a.tolist(), upper_b.tolist()), index=a.index, dtype="float64")

    return scored


def jaro_winkler(a: Column, b: Column) -> Column:
    """Jaro-Winkler similarity ignoring case: an Arrow-batched function, since Spark has none built in.

    A batch goes letter by letter over all of its pairs at once, not pair by pair, but for strings of more than 512 characters.
    """
    return _jaro_winkler_udf()(a, b)


def with_jaro_winkler(pairs: DataFrame, a: str, b: str, name: str, distinct_first: bool = False) -> DataFrame:
    """Add the similarity of two columns. With ``distinct_first``, every distinct pair of strings is scored once."""
    if not distinct_first:
        return pairs.withColumn(name, jaro_winkler(F.col(a), F.col(b)))
    scored = pairs.select(a, b).distinct().withColumn(name, jaro_winkler(F.col(a), F.col(b)))
    return pairs.join(scored, [a, b])
