"""Removal of repeated word passages, found by recompression: equal passages get equal inner symbols."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, result_only
from .sharing import ask_elsewhere, short_names
from .textbytes import Texts, mix, powers, texts, word_hashes, words

_WINDOWS = "part int, block long, told boolean, names binary, ids binary, counts binary"
_LATER = "block long, names binary, ids binary"
_GONE = "doc_id long, gone binary"
_KEPT = "doc_id long, n_removed long, kept_sha256 string, kept_text string"
_ROUNDS = 2
_ONE = np.uint64(1)


class Symbols(NamedTuple):
    """Symbols of one level, in text order.

    ``name`` is global: a hash of what the symbol was made of. Whether a symbol arises depends on the words ``low`` to
    ``high`` only, so wherever these words stand together, the symbol is there as well.
    """

    name: np.ndarray
    low: np.ndarray
    high: np.ndarray
    doc: np.ndarray


def _neighbours(symbols: Symbols, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(same, before, after): whether a symbol and the next are of one document, and how far the neighbours reach.

    Beyond the ends of a document there is nothing, which is something that no window inside it shows.
    """
    same = symbols.doc[1:] == symbols.doc[:-1]
    before, after = first[symbols.doc] - 1, first[symbols.doc + 1] + 1
    before[1:] = np.where(same, symbols.low[:-1], before[1:])
    after[:-1] = np.where(same, symbols.high[1:], after[:-1])
    return same, before, after


def name_runs(symbols: Symbols, first: np.ndarray) -> Symbols:
    """Every maximal run of one symbol becomes a symbol named by what is repeated and how often."""
    if not len(symbols.name):
        return symbols
    same, before, after = _neighbours(symbols, first)
    heads = np.concatenate(([True], ~(same & (symbols.name[1:] == symbols.name[:-1]))))
    at = np.flatnonzero(heads)
    count = np.diff(at, append=len(heads))
    last = at + count - 1
    name = symbols.name[at]
    name = np.where(count > 1, mix(name * np.uint64(3) + count.astype(np.uint64)), name)
    return Symbols(name, before[at], after[last], symbols.doc[at])


def name_pairs(symbols: Symbols, first: np.ndarray, round_: int) -> Symbols:
    """Names fall into left and right ones, by a bit that the round draws; every left one with a right one next to it is a new symbol."""
    if not len(symbols.name):
        return symbols
    same, before, after = _neighbours(symbols, first)
    right = (mix(symbols.name + np.uint64(round_ * 2 + 1)) & _ONE).astype(bool)
    joined = same & ~right[:-1] & right[1:]
    first_of = np.concatenate((joined, [False]))
    second_of = np.concatenate(([False], joined))
    at = np.flatnonzero(~second_of)
    pair = first_of[at]
    mate = np.minimum(at + 1, len(right) - 1)
    name = np.where(pair, mix(symbols.name[at] * np.uint64(5) + mix(symbols.name[mate])), symbols.name[at])
    low = np.where(~pair & right[at], before[at], symbols.low[at])
    high = np.where(pair, symbols.high[mate], np.where(right[at], symbols.high[at], after[at]))
    return Symbols(name, low, high, symbols.doc[at])


def sequence_hashes(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix hashes of a sequence of 64-bit names, and what a span's difference is multiplied by."""
    power, inverse = powers(len(names) + 1)
    prefix = np.zeros(len(names) + 1, np.uint64)
    np.cumsum(names * power[: len(names)], out=prefix[1:])
    return prefix, inverse


class Passages(NamedTuple):
    """The words of a group of documents and the windows over them."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    names: np.ndarray
    others: np.ndarray
    doc: np.ndarray
    whole: np.ndarray


def passages(group: Texts, window: int, twice: bool = False) -> Passages:
    """Words, their names and documents, and for every word whether a window starts at it. ``others`` are independent names, if asked for."""
    starts, ends, first = words(group.data, group.bounds)
    names = word_hashes(group.data, starts, ends, lower=False)
    others = word_hashes(group.data, starts, ends, lower=False, seed=1) if twice else names[:0]
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    whole = np.arange(len(names)) + window <= first[doc + 1]
    return Passages(starts, ends, first, names, others, doc, whole)


def window_keys(p: Passages, window: int) -> np.ndarray:
    """One key for every word, which equal windows starting there have in common; meaningless where none starts.

    Two rounds of naming runs and pairs shorten the text. Of the symbols whose whole support lies in a window, the key
    belongs to one of the highest level there, the one of largest hash: the hash of the words of its support. A window with
    no such symbol, as inside a long run, has itself as key. All of this depends on the window's own words.
    """
    n = len(p.names)
    prefix, inverse = sequence_hashes(p.names)
    place = np.arange(n)
    symbols = Symbols(p.names, place, place + 1, p.doc)
    ranks, lows, lengths = [], [], []
    for level in range(1, _ROUNDS + 1):
        symbols = name_pairs(name_runs(symbols, p.first), p.first, level)
        length = symbols.high - symbols.low
        inside = (length <= window) & (symbols.low >= p.first[symbols.doc]) & (symbols.high <= p.first[symbols.doc + 1])
        low, high, length = symbols.low[inside], symbols.high[inside], length[inside]
        content = mix((prefix[high] - prefix[low]) * inverse[low] + length.astype(np.uint64))
        rank = (content >> np.uint64(2)) | (np.uint64(level) << np.uint64(62))
        ranks.append(rank)
        lows.append(low)
        lengths.append(length)
    rank, low, of_length = np.concatenate(ranks), np.concatenate(lows), np.concatenate(lengths)
    best = np.zeros(n, np.uint64)
    upto = np.zeros(n, np.uint64)
    for length in range(1, window + 1):
        these = np.flatnonzero(of_length == length)
        np.maximum.at(upto, low[these], rank[these])
        shift = window - length
        if shift < n:
            np.maximum(best[: n - shift], upto[shift:], out=best[: n - shift])
    lacking = np.flatnonzero((best == 0) & p.whole)
    best[lacking] = mix((prefix[lacking + window] - prefix[lacking]) * inverse[lacking]) >> np.uint64(2)
    return best


def _window_hashes(names: np.ndarray, window: int, at: np.ndarray) -> np.ndarray:
    prefix, inverse = sequence_hashes(names)
    return mix((prefix[at + window] - prefix[at]) * inverse[at])


def window_names(p: Passages, window: int, at: np.ndarray) -> np.ndarray:
    """Two hashes of each window that starts at one of these words, of independent word hashes, as an (n, 2) array."""
    return np.stack([_window_hashes(names, window, at) for names in (p.names, p.others)], axis=1)


def joined_words(group: Texts, p: Passages, kept: np.ndarray) -> list[bytes]:
    """Per document its kept words, one space between them."""
    index = np.flatnonzero(kept)
    last = np.ones(len(index), bool)
    last[:-1] = p.doc[index[1:]] != p.doc[index[:-1]]
    starts, ends = p.starts[index], p.ends[index] + ~last
    level = np.zeros(len(group.data) + 1, np.int8)
    np.add.at(level, starts, 1)
    np.add.at(level, ends, -1)
    take = np.cumsum(level[:-1], dtype=np.int8).astype(bool)
    data = group.data.copy()
    data[p.ends[index[~last]]] = 0x20
    size = np.bincount(p.doc[index], weights=ends - starts, minlength=len(group.ids)).astype(np.int64)
    flat, at = data[take].tobytes(), np.concatenate(([0], np.cumsum(size)))
    return [flat[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def _words_of(group: Texts, window: int) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Per document: its number of words, the SHA-256 of its words joined by spaces, and the distinct keys of its windows."""
    p = passages(group, window)
    keys = window_keys(p, window)
    new = p.whole.copy()
    new[1:] &= ~((keys[1:] == keys[:-1]) & p.whole[:-1] & (p.doc[1:] == p.doc[:-1]))
    at = np.flatnonzero(new)
    keys, cut = keys[at], np.searchsorted(at, p.first)
    whole = joined_words(group, p, np.ones(len(p.names), bool))
    for i, text in enumerate(whole):
        own = np.unique(keys[cut[i] : cut[i + 1]])
        yield int(p.first[i + 1] - p.first[i]), hashlib.sha256(text).digest(), own


def _rows(part: np.ndarray, block: int, told: bool, names: np.ndarray, ids: np.ndarray) -> Iterator[tuple]:
    """(part, block, told, names, ids, counts) for every part, the names in order of their documents."""
    order = np.lexsort((ids, part))
    part, names, ids = part[order], names[order], ids[order]
    bounds = [*np.flatnonzero(np.diff(part, prepend=-1)).tolist(), len(part)]
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        heads = np.flatnonzero(np.concatenate(([True], ids[a + 1 : b] != ids[a : b - 1])))
        counts = np.diff(heads, append=b - a).astype(np.uint32)
        yield int(part[a]), block, told, names[a:b].tobytes(), ids[a:b][heads].tobytes(), counts.tobytes()


def _window_blocks(batches: Iterator[pa.RecordBatch], window: int, parts: int) -> Iterator[pa.RecordBatch]:
    """The names of the windows whose key occurs elsewhere, split into parts.

    Of equal windows in one block the smallest id alone asks. The others have found an earlier document already and are
    told, so a part gets one entry for a window and block, however common the window.
    """
    task = TaskContext.get().partitionId() << 32
    for block, group in enumerate(texts(batches), task):
        p = passages(group, window, twice=True)
        keys = short_names(window_keys(p, window))
        hot = np.zeros(len(keys), bool)
        for i, blobs in enumerate(group.batch.column(2).to_pylist()):
            own = slice(p.first[i], p.first[i + 1])
            hot[own] = np.isin(keys[own], np.frombuffer(b"".join(blobs), np.uint32))
        at = np.flatnonzero(hot & p.whole)
        if not len(at):
            continue
        names, ids = window_names(p, window, at), group.ids[p.doc[at]]
        order = np.lexsort((ids, names[:, 1], names[:, 0]))
        names, ids = names[order], ids[order]
        head = np.concatenate(([True], (names[1:] != names[:-1]).any(axis=1)))
        new = head | np.concatenate(([True], ids[1:] != ids[:-1]))
        names, ids, head = names[new], ids[new], head[new]
        asked = _rows((names[head, 1] % np.uint64(parts)).astype(np.int64), block, False, names[head], ids[head])
        told = _rows(np.full((~head).sum(), block % parts), block, True, names[~head], ids[~head])
        kinds = (pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary())
        columns = zip(*asked, *told, strict=True)
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in _WINDOWS.split(", ")])


def _later(rows: pa.Table) -> pa.Table:
    """(block, names, ids): for each block that asks a part, the windows that a document of smaller id has."""
    asked, out = [], []
    for row in rows.to_pylist():
        names = np.frombuffer(row["names"], np.uint64).reshape(-1, 2)
        ids = np.repeat(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["counts"], np.uint32))
        if row["told"]:
            out.append((row["block"], names[:, 0], ids))
        else:
            asked.append((row["block"], names, ids))
    if asked:
        sizes = [len(ids) for _, _, ids in asked]
        names, ids = np.concatenate([n for _, n, _ in asked]), np.concatenate([i for _, _, i in asked])
        order = np.lexsort((ids, names[:, 1], names[:, 0]))
        head = np.concatenate(([True], (names[order[1:]] != names[order[:-1]]).any(axis=1)))
        least = np.empty_like(ids)
        least[order] = ids[order][head][np.cumsum(head) - 1]
        ends = np.cumsum(sizes)
        for (block, _, _), b, size in zip(asked, ends, sizes, strict=True):
            own = np.flatnonzero(ids[b - size : b] > least[b - size : b]) + b - size
            out.append((block, names[own, 0], ids[own]))
    found = [(block, names.tobytes(), ids.tobytes()) for block, names, ids in out if len(ids)]
    columns = zip(*found, strict=True) if found else ((), (), ())
    kinds = {"block": pa.int64(), "names": pa.binary(), "ids": pa.binary()}
    return pa.table({name: pa.array(c, kind) for c, (name, kind) in zip(columns, kinds.items(), strict=True)})


def _by_document(rows: pa.Table) -> pa.Table:
    """(doc_id, gone): the names of a block's windows that go, by document."""
    names, ids = (np.frombuffer(b"".join(rows.column(c).to_pylist()), t) for c, t in (("names", np.uint64), ("ids", np.int64)))
    order = np.argsort(ids, kind="stable")
    names, ids = names[order], ids[order]
    heads = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
    ends = (np.append(heads, len(ids)) * 8).astype(np.int32)
    blob = pa.Array.from_buffers(pa.binary(), len(heads), [None, pa.py_buffer(ends), pa.py_buffer(names.tobytes())])
    return pa.table({"doc_id": pa.array(ids[heads], pa.int64()), "gone": blob})


@result_only("passages")
def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text) after removing passages that an earlier document has.

    A word goes if a window of ``window`` words over it also starts in a document of smaller id; all windows are
    judged on the input. Words are runs of characters other than ASCII white space. ``kept_text`` is the kept words
    joined by one space; null if no word goes, when it is the document's words.

    1. One scan names runs and pairs (:func:`window_keys`) and asks which keys occur in other documents; only keys travel.
    2. Documents of equal words are settled by their hash: all but the first lose every word a window covers. Of the others,
       those with a shared key are written out, with the keys.
    3. Their windows with such a key are compared by 128-bit names, in parts by name, which verifies or refutes each.
    4. Documents that have lost windows are read once more for what is left.

    A null text has no words. Rows without an id are left out. Rows that repeat an id count as one document,
    that of the most words. Other columns are not read. An empty table gives an empty result.
    """
    given = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).filter("doc_id IS NOT NULL")
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    answers = ask_elsewhere(given, lambda group: _words_of(group, window), lone=False)
    found = answers.groupBy("doc_id").agg(
        F.max(F.struct("n", "mark")).alias("s"), F.collect_list("names").alias("names")
    )
    found = materialize(found.select("doc_id", "s.n", "s.mark", "names"), "passages")
    firsts = materialize(found.groupBy("mark").agg(F.min("doc_id").alias("rep")), "firsts")
    profile = found.select("doc_id", "n", "mark").join(firsts, "mark")
    asked = found.filter(F.size("names") > 0).join(firsts.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    shared = materialize(given.join(asked.select("doc_id", "names", "mark"), "doc_id").select("doc_id", "text", "names", "mark"), "shared")

    blocks = shared.mapInArrow(lambda batches: _window_blocks(batches, window, parts), _WINDOWS)
    later = blocks.groupBy("part").applyInArrow(_later, _LATER)
    gone = later.groupBy("block").applyInArrow(_by_document, _GONE)
    gone = gone.groupBy("doc_id").agg(F.collect_list("gone").alias("gone"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in texts(batches):
            p = passages(group, window)
            at = np.flatnonzero(p.whole)
            names = _window_hashes(p.names, window, at)
            edges, of = np.searchsorted(at, p.first), group.batch.column(2).to_pylist()
            hit = np.zeros(len(at), bool)
            for i, blobs in enumerate(of):
                own = slice(edges[i], edges[i + 1])
                hit[own] = np.isin(names[own], np.frombuffer(b"".join(blobs), np.uint64))
            level = np.zeros(len(p.names) + window + 1, np.int64)
            np.add.at(level, at[hit], 1)
            np.add.at(level, at[hit] + window, -1)
            kept = np.cumsum(level[: len(p.names)]) == 0
            removed = np.bincount(p.doc[~kept], minlength=len(group.ids))
            rest, marks = joined_words(group, p, kept), group.batch.column(3).to_pylist()
            every = joined_words(group, p, np.ones(len(kept), bool))
            rows = [i for i, text in enumerate(every) if hashlib.sha256(text).digest() == marks[i]]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(group.ids[rows], pa.int64()),
                        pa.array(removed[rows], pa.int64()),
                        pa.array([hashlib.sha256(rest[i]).hexdigest() for i in rows], pa.string()),
                        pa.array([rest[i].decode() for i in rows], pa.string()),
                    ],
                    names=[f.split()[0] for f in _KEPT.split(", ")],
                )

    left = shared.join(gone, "doc_id").select("doc_id", "text", "gone", "mark").mapInArrow(cut, _KEPT)
    left = left.dropDuplicates(["doc_id"])  # of rows that repeat an id
    copy = (F.col("rep") < F.col("doc_id")) & (F.col("n") >= window)
    return profile.join(left, "doc_id", "left").select(
        "doc_id",
        F.col("n").alias("n_words"),
        F.when(copy, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256))
        .otherwise(F.coalesce("kept_sha256", F.lower(F.hex("mark"))))
        .alias("kept_sha256"),
        F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
    )
