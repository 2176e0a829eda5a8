"""Texts of Arrow batches as arrays of bytes, their words and hashes of them, and polynomial hashes of spans."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_RANDOM = np.random.Generator(np.random.PCG64(20_240_607))
#: Odd, so that its powers have inverses modulo 2 ** 64.
_BASE = int(_RANDOM.integers(0, 1 << 63)) * 2 + 1
_LETTER = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + _RANDOM.integers(0, 2, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLOCK = 1 << 20

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


class Texts(NamedTuple):
    """Documents laid end to end: document i is ``data[bounds[i]:bounds[i + 1]]``."""

    ids: np.ndarray
    data: np.ndarray
    bounds: np.ndarray
    batch: pa.RecordBatch


def texts(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[Texts]:
    """The (id, text, ..) rows of each batch in groups of about ``most`` bytes; ``batch`` is the group's rows."""
    for batch in batches:
        column = batch.column(1)
        kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
        _, offsets, data = column.buffers()
        if not len(column):
            continue
        bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
        at = 0
        while at < len(column):
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most, "right")) - 1)
            rows = batch.slice(at, to - at)
            ids = rows.column(0).to_numpy(zero_copy_only=False)
            yield Texts(ids, data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at], rows)
            at = to


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``count`` powers of the base and their inverses."""
    global _powers, _inverses
    if len(_powers) < count:
        count = max(count, 2 * len(_powers))
        steps = np.full(count, _BASE, np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps)
        steps[1:] = pow(_BASE, -1, 1 << 64)
        _inverses = np.cumprod(steps)
    return _powers, _inverses


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes, from the empty one on."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTER[data] * powers(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def span_hashes(prefixes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each span, the same wherever the span stands."""
    return (prefixes[ends] - prefixes[starts]) * powers(len(prefixes))[1][starts]


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits, one to one."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): the runs of bytes other than ASCII white space, none across a bound.

    Words ``first[i]`` to ``first[i + 1]`` are those of document i.
    """
    inside = ~_SPACE[data]
    if not len(inside):
        empty = np.empty(0, np.int64)
        return empty, empty, np.zeros(len(bounds), np.int64)
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    filled = np.flatnonzero(bounds[1:] > bounds[:-1])
    begins[bounds[filled]] = inside[bounds[filled]]
    stops[bounds[filled + 1] - 1] = inside[bounds[filled + 1] - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of every word, with A-Z lower-cased if asked; another ``seed`` gives an independent one.

    Every byte is hashed together with its place in the word, and a word's hash is made of the sum. A polynomial modulo a power of
    two would not do: long regular words of equal length collide under it, whatever its base. Works through blocks of
    words, so that memory follows the words.
    """
    out = np.empty(len(starts), np.uint64)
    at, salt = 0, mix(np.array([seed + 1], np.uint64))
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + _BLOCK, "right")))
        part = data[starts[at] : ends[to - 1]]
        part = part[~_SPACE[part]]
        sizes = ends[at:to] - starts[at:to]
        begin = np.cumsum(sizes) - sizes
        place = (np.arange(len(part)) - np.repeat(begin, sizes)).astype(np.uint64)
        letters = _LETTER[_LOWER[part] if lower else part]
        each = mix((letters ^ salt) + place * np.uint64(0x9E3779B97F4A7C15))
        out[at:to] = mix(np.add.reduceat(each, begin) + sizes.astype(np.uint64))
        at = to
    return out
