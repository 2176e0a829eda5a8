"""Removal of repeated byte strings by a suffix sort whose comparisons are made on hashes."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .sharing import ask_elsewhere, short_names
from .textbytes import Texts, mix, prefix_hashes, span_hashes, texts

_CONTEXTS = "part int, context binary, anchor int, many boolean, doc_id long, start long"
_STARTS = "doc_id long, start long, count long"
_KEPT = "doc_id long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary"
_STRIP = 1 << 20
#: Bits of a place within a strip; the others hold the hash by which anchors are chosen.
_PLACE = 21


class Runs(NamedTuple):
    """Runs of window starts with one anchor: starts ``first`` to ``last``, the anchor's place and hash, and the document."""

    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    key: np.ndarray
    doc: np.ndarray


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum over every ``width`` consecutive values, from running minima within blocks of that width."""
    count = len(values) - width + 1
    blocks = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max)
    blocks[: len(values)] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def anchor_runs(group: Texts, window: int, gram: int) -> Iterator[Runs]:
    """The anchors of all windows of ``window`` bytes within documents, strip by strip.

    The anchor is the ``gram`` bytes of least hash in the window, the first of them if they stand there twice, so equal
    windows have equal anchors at the same place.
    """
    data, width = group.data, window - gram + 1
    ends = group.bounds[1:]
    for low in range(0, max(0, len(data) - window + 1), _STRIP):
        part = data[low : low + _STRIP + window - 1]
        prefixes = prefix_hashes(part)
        place = np.arange(len(part) - gram + 1)
        grams = mix(span_hashes(prefixes, place, place + gram))
        ordered = (grams >> np.uint64(_PLACE) << np.uint64(_PLACE)) | place.astype(np.uint64)
        anchor = (_least(ordered, width) & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
        start = np.arange(len(anchor)) + low
        doc = np.repeat(np.arange(len(ends)), np.diff(np.clip(group.bounds, low, low + len(anchor))))
        whole = start + window <= ends[doc]
        change = np.ones(len(anchor), bool)
        change[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(change & whole)
        if not len(first):
            continue
        stops = np.append(np.flatnonzero(change), len(anchor))
        stop = stops[np.searchsorted(stops, first, "right")]
        last = np.minimum(stop - 1, ends[doc[first]] - window - low)
        yield Runs(first + low, last + low, anchor[first] + low, grams[anchor[first]], doc[first])


def _all_runs(group: Texts, window: int, gram: int) -> Runs:
    empty = np.empty(0, np.int64)
    parts = list(anchor_runs(group, window, gram)) or [Runs(empty, empty, empty, empty.astype(np.uint64), empty)]
    return Runs(*(np.concatenate(column) for column in zip(*parts, strict=True)))


def _keys_of(group: Texts, window: int, gram: int) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Per document: its length, its SHA-256, and the keys of its anchors, one for each place."""
    runs = _all_runs(group, window, gram)
    new = np.ones(len(runs.anchor), bool)
    new[1:] = (runs.anchor[1:] != runs.anchor[:-1]) | (runs.doc[1:] != runs.doc[:-1])
    keys, cut = runs.key[new], np.searchsorted(runs.doc[new], np.arange(len(group.ids) + 1))
    flat = group.data.tobytes()
    for i, (a, b) in enumerate(zip(group.bounds[:-1].tolist(), group.bounds[1:].tolist(), strict=True)):
        yield b - a, hashlib.sha256(flat[a:b]).digest(), keys[cut[i] : cut[i + 1]]


def _contexts(batches: Iterator[pa.RecordBatch], window: int, gram: int, parts: int) -> Iterator[pa.RecordBatch]:
    """The bytes around every anchor that occurs elsewhere, as far as its run of windows reaches.

    Equal bytes within a block are sent once, marked ``many``; their windows are known to be repeated and are told
    (rows without a context).
    """
    for group in texts(batches, 8 << 20):
        runs = _all_runs(group, window, gram)
        names = short_names(runs.key)
        cut = np.searchsorted(runs.doc, np.arange(len(group.ids) + 1))
        shared = np.zeros(len(names), bool)
        for i, blobs in enumerate(group.batch.column(2).to_pylist()):
            own = slice(cut[i], cut[i + 1])
            shared[own] = np.isin(names[own], np.frombuffer(b"".join(blobs), np.uint32))
        index = np.flatnonzero(shared)
        flat, seen = group.data.tobytes(), defaultdict(list)
        spans = zip(runs.first[index].tolist(), (runs.last[index] + window).tolist(), runs.anchor[index].tolist(), strict=True)
        for k, (a, b, anchor) in zip(index.tolist(), spans, strict=True):
            seen[flat[a:b], anchor - a].append(k)
        part = (runs.key % np.uint64(parts)).astype(np.int32)
        begin = runs.first - group.bounds[runs.doc]
        asked = [(part[ks[0]], text, at, len(ks) > 1, ks[0]) for (text, at), ks in seen.items()]
        told = [(ks[0] % parts, None, len(text), True, k) for (text, _), ks in seen.items() if len(ks) > 1 for k in ks]
        if asked:
            columns = list(zip(*asked, *told, strict=True))
            of = np.array(columns[4])
            kinds = (pa.int32(), pa.binary(), pa.int32(), pa.bool_())
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=False)]
            arrays += [pa.array(group.ids[runs.doc[of]], pa.int64()), pa.array(begin[of], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in _CONTEXTS.split(", ")])


class HashedText:
    """Strings end to end with prefix hashes, on which common extensions are found by binary search."""

    def __init__(self, strings: list[bytes]) -> None:
        self.data = np.frombuffer(b"".join(strings), np.uint8)
        self.begin = np.concatenate(([0], np.cumsum([len(s) for s in strings])))[:-1]
        self.end = self.begin + [len(s) for s in strings]
        self.prefixes = prefix_hashes(self.data)

    def common(self, a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray) -> np.ndarray:
        """How many bytes from a and from b on are equal, up to the ends."""
        low, high = np.zeros(len(a), np.int64), np.minimum(a_end - a, b_end - b)
        while (low < high).any():
            middle = (low + high + 1) >> 1
            equal = span_hashes(self.prefixes, a, a + middle) == span_hashes(self.prefixes, b, b + middle)
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        return low

    def suffix_sort(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The order of the strings from ``starts`` to ``ends``, by mergesort.

        Runs of doubling length are merged, all pairs at once: each suffix finds its place in the other run by binary
        search, and a comparison is a common extension and the byte after it.
        """
        count = len(starts)
        order, size = np.arange(count), 1
        while size < count:
            place = np.arange(count)
            block = place // size
            other = (block ^ 1) * size
            low, high = np.minimum(other, count), np.minimum(other + size, count)
            base = low.copy()
            own = order[place]
            first = block % 2 == 0
            while (low < high).any():
                middle = (low + high) >> 1
                mate = order[np.minimum(middle, count - 1)]
                open_ = low < high
                equal = self.common(starts[own], ends[own], starts[mate], ends[mate])
                own_left, mate_left = ends[own] - starts[own] - equal, ends[mate] - starts[mate] - equal
                own_byte = self.data[np.minimum(starts[own] + equal, len(self.data) - 1)]
                mate_byte = self.data[np.minimum(starts[mate] + equal, len(self.data) - 1)]
                both = (own_left > 0) & (mate_left > 0)
                mate_less = np.where(both, mate_byte < own_byte, (mate_left == 0) & (own_left > 0))
                tie = (mate_left == 0) & (own_left == 0)
                goes_before = mate_less | (tie & ~first)
                low = np.where(open_ & goes_before, middle + 1, low)
                high = np.where(open_ & ~goes_before, middle, high)
            merged = np.empty_like(order)
            merged[(block // 2) * 2 * size + (place - block * size) + (low - base)] = own
            order, size = merged, size * 2
        return order


def repeated_starts(contexts: list[bytes], anchors: np.ndarray, window: int) -> list[np.ndarray]:
    """For different contexts, the window starts in each whose window another context has around its anchor.

    The suffixes from the anchors on are sorted; two windows that start ``offset`` bytes before their anchors are equal
    if their suffixes have ``window - offset`` bytes in common, which is a stretch of the order, and the bytes before are
    equal, which their hashes tell. Both findings are checked on the bytes.
    """
    text = HashedText(contexts)
    at = text.begin + anchors
    order = text.suffix_sort(at, text.end)
    a, b = order[:-1], order[1:]
    lcp = text.common(at[a], text.end[a], at[b], text.end[b])
    for i, j, n in zip(at[a].tolist(), at[b].tolist(), lcp.tolist(), strict=True):
        if not np.array_equal(text.data[i : i + n], text.data[j : j + n]):
            return _by_bytes(contexts, anchors, window)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    lowest, highest = np.maximum(0, window - (text.end - at)), anchors
    found: list[list[int]] = [[] for _ in contexts]
    widest: dict[tuple[int, int], int] = {}
    for offset in range(int(highest.max(initial=0)) + 1):
        some = np.flatnonzero((lowest <= offset) & (highest >= offset))
        if len(some) < 2:
            continue
        stretch = np.concatenate(([0], np.cumsum(lcp < window - offset)))[rank[some]].astype(np.uint64)
        before = span_hashes(text.prefixes, at[some] - offset, at[some])
        _, head, of, count = np.unique(
            mix(before + mix(stretch + np.uint64(1))), return_index=True, return_inverse=True, return_counts=True
        )
        hit = np.flatnonzero(count[of] > 1)
        for i, mate in zip(some[hit].tolist(), some[head[of[hit]]].tolist(), strict=True):
            found[i].append(offset)
            widest[i, mate] = offset
    for (i, j), offset in widest.items():
        if contexts[i][anchors[i] - offset : anchors[i]] != contexts[j][anchors[j] - offset : anchors[j]]:
            return _by_bytes(contexts, anchors, window)
    return [anchors[i] - np.array(offsets, np.int64)[::-1] for i, offsets in enumerate(found)]


def _by_bytes(contexts: list[bytes], anchors: np.ndarray, window: int) -> list[np.ndarray]:
    """The same by comparing bytes, should two hashes collide."""
    places = [range(len(c) - window + 1) for c in contexts]
    count = Counter((int(a) - p, c[p : p + window]) for c, a, ps in zip(contexts, anchors, places, strict=True) for p in ps)
    return [
        np.array([p for p in ps if count[int(a) - p, c[p : p + window]] > 1], np.int64)
        for c, a, ps in zip(contexts, anchors, places, strict=True)
    ]


def _decide(rows: pa.Table, window: int, gram: int) -> pa.Table:
    """(doc_id, start, count): runs of window starts whose bytes occur more than once, for one part."""
    column = {name: rows.column(name).to_pylist() for name in rows.column_names}
    out: list[tuple[int, int, int]] = []
    seen: dict[tuple[bytes, int], list[int]] = defaultdict(list)
    for k, (context, anchor) in enumerate(zip(column["context"], column["anchor"], strict=True)):
        if context is None:
            out.append((column["doc_id"][k], column["start"][k], anchor - window + 1))
        else:
            seen[context, anchor].append(k)
    single = {}
    for (context, anchor), ks in seen.items():
        if len(ks) > 1:
            out += [(column["doc_id"][k], column["start"][k], len(context) - window + 1) for k in ks]
        elif not column["many"][ks[0]]:
            single[context, anchor] = ks[0]
    grams = Counter(context[anchor : anchor + gram] for context, anchor in seen)
    contested = [(c, a) for c, a in seen if grams[c[a : a + gram]] > 1]
    if contested:
        contexts, anchors = [c for c, _ in contested], np.array([a for _, a in contested], np.int64)
        for key, starts in zip(contested, repeated_starts(contexts, anchors, window), strict=True):
            if key in single and len(starts):
                k = single[key]
                heads = np.flatnonzero(np.diff(starts, prepend=-2) > 1)
                counts = np.diff(heads, append=len(starts))
                out += [
                    (column["doc_id"][k], column["start"][k] + int(starts[h]), int(n))
                    for h, n in zip(heads, counts, strict=True)
                ]
    names = [f.split()[0] for f in _STARTS.split(", ")]
    columns = zip(*out, strict=True) if out else ([], [], [])
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})


def repeated_strings(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 200, gram: int = 64
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_bytes) after removing every byte string that occurs twice.

    A byte goes if a string of ``window`` bytes over it also starts anywhere else, in its own document or another; strings
    lie within one document and are judged on the input. ``kept_bytes`` is null if no byte goes.

    1. One scan finds every window's anchor, a ``gram``-byte string chosen by its hash, and asks which anchors
       occur elsewhere; only their hashes travel. A window whose anchor occurs once occurs once.
    2. Documents that are equal as a whole lose all bytes if a window fits in. The first of them, and the other documents
       with shared anchors, are written out.
    3. The bytes around shared anchors are dealt out by anchor. Equal ones are settled at once; the others are sorted as
       suffixes from the anchor on (:class:`HashedText`), which shows how far they agree.
    4. Documents with repeated windows are read once more for what is left.

    A null text counts as empty. Rows without an id are left out. Rows that repeat an id count as one document, the
    longest, though a string they share counts as repeated. Other columns are not read. An empty table gives an empty result.
    """
    given = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).filter("doc_id IS NOT NULL")
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    answers = ask_elsewhere(given, lambda group: _keys_of(group, window, gram), lone=False)
    found = answers.groupBy("doc_id").agg(
        F.max(F.struct("n", "mark")).alias("s"), F.collect_list("names").alias("names")
    )
    found = materialize(found.select("doc_id", "s.n", "s.mark", "names"), "anchors")
    groups = found.groupBy("mark").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    groups = materialize(groups, "copies")
    profile = found.select("doc_id", "n", "mark").join(groups, "mark")
    asked = found.filter(F.size("names") > 0).join(groups.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    shared = given.join(asked.select("doc_id", "names", "mark"), "doc_id").select("doc_id", "text", "names", "mark")
    shared = materialize(shared, "shared")

    contexts = shared.mapInArrow(lambda batches: _contexts(batches, window, gram, parts), _CONTEXTS)
    starts = contexts.groupBy("part").applyInArrow(lambda rows: _decide(rows, window, gram), _STARTS)
    ranges = starts.groupBy("doc_id").agg(F.collect_list("start").alias("starts"), F.collect_list("count").alias("counts"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in texts(batches):
            rows = []
            columns = [group.batch.column(i).to_pylist() for i in (2, 3, 4)]
            for i, (starts, counts, mark) in enumerate(zip(*columns, strict=True)):
                data = group.data[group.bounds[i] : group.bounds[i + 1]]
                if hashlib.sha256(data).digest() != mark:
                    continue
                level = np.zeros(len(data) + 1, np.int32)
                starts = np.array(starts)
                np.add.at(level, starts, 1)
                np.add.at(level, starts + np.array(counts) + window - 1, -1)
                gone = np.cumsum(level[:-1]) > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                kept = data[~gone].tobytes()
                rows.append((int(group.ids[i]), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in _KEPT.split(", ")])

    left = shared.join(ranges, "doc_id").select("doc_id", "text", "starts", "counts", "mark").mapInArrow(cut, _KEPT)
    left = left.dropDuplicates(["doc_id"])  # of rows that repeat an id
    copy = (F.col("copies") > 1) & (F.col("n") >= window)
    zero = F.lit(0).cast("long")
    return profile.join(left, "doc_id", "left").select(
        "doc_id",
        F.col("n").alias("n_bytes"),
        F.when(copy, F.col("n")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
        F.when(copy, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", zero)).alias("n_spans"),
        F.when(copy, F.sha2(F.lit(""), 256))
        .otherwise(F.coalesce("kept_sha256", F.lower(F.hex("mark"))))
        .alias("kept_sha256"),
        F.when(copy, F.lit(b"")).otherwise(F.col("kept_bytes")).alias("kept_bytes"),
    )
