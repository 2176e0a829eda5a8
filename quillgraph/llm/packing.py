"""Best-fit packing of encoded documents into sequences of fixed length."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import byte_bpe

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
_NAMES = [field.split()[0] for field in PIECES.split(", ")]


class OpenBins:
    """A fixed number of open bins, found by free space through a bitset.

    Bit f of ``free`` is set while some open bin has f tokens left, so the best fit for an item is the lowest set bit
    from its size up. When a bin is needed and none may be opened, the fullest one is closed.
    """

    def __init__(self, size: int, limit: int) -> None:
        self.size, self.limit = size, limit
        self.free, self.opened = 0, 0
        self.bins: list[list[list]] = [[] for _ in range(size + 1)]

    def _take(self, space: int) -> list:
        items = self.bins[space].pop()
        if not self.bins[space]:
            self.free &= ~(1 << space)
        self.opened -= 1
        return items

    def add(self, item: tuple, length: int) -> Iterator[list]:
        """Puts the item away and yields the bins that this closes."""
        fits = self.free >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            items = self._take(space)
        else:
            space, items = self.size, []
            if self.opened >= self.limit:
                yield self._take((self.free & -self.free).bit_length() - 1)
        items.append((item, self.size - space))
        left = space - length
        if left:
            self.bins[left].append(items)
            self.free |= 1 << left
            self.opened += 1
        else:
            yield items

    def rest(self) -> Iterator[list]:
        """The bins that are still open."""
        while self.free:
            yield self._take((self.free & -self.free).bit_length() - 1)


def pieces_of(doc_id: int, ids: np.ndarray, size: int) -> Iterator[tuple]:
    """(doc_id, piece, start, length, crc) of a document; one that is too long is cut so that its first piece is the short one."""
    start, end = 0, len(ids) % size or min(size, len(ids))
    piece = 0
    while start < len(ids):
        part = ids[start:end].astype("<u4")
        yield doc_id, piece, start, end - start, zlib.crc32(part.tobytes())
        start, end, piece = end, end + size, piece + 1


def _pack(pieces: Iterable[tuple], size: int, limit: int, first_id: int, last: bool) -> Iterator[tuple]:
    """Piece rows with sequence and offset; those of bins still open at the end get none unless this is the last round."""
    bins, number = OpenBins(size, limit), first_id
    for piece in pieces:
        for full in bins.add(piece, piece[3]):
            yield from ((*p, number, at) for p, at in full)
            number += 1
    for items in bins.rest():
        yield from ((*p, number if last else None, at if last else None) for p, at in items)
        number += 1


def _batches(rows: Iterator[tuple], count: int = 20_000) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=_NAMES)

    for row in rows:
        held.append(row)
        if len(held) == count:
            yield batch()
            held = []
    if held:
        yield batch()


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 1024,
    end_id: int = 2,
    open_bins: int = 4096,
    fan_in: int = 16,
    path: str | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): every document's pieces and where they lie.

    A document is its byte-level BPE ids and ``end_id``. Each task encodes its rows and packs the pieces, by their
    lengths, with at most ``open_bins`` open sequences. What lies in sequences that are still open at the end of a task is
    packed again by ``fan_in`` times fewer tasks, until one task's share is left: it gets no more than ``fan_in *
    open_bins`` sequences of pieces, whatever the size of the corpus. Ids never leave the task that made them.

    A null text counts as empty and gives one piece with ``end_id`` alone. Rows without an id take no part. Rows that
    repeat an id are packed as documents of their own. Other columns are not read. An empty table gives no pieces.
    """
    path, pattern = path or byte_bpe.default_path(), pattern or byte_bpe.default_pattern()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        encoder = byte_bpe.load(path, pattern)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(byte_bpe.encode(encoder, text.as_py()), np.uint32(end_id))
                yield from pieces_of(doc_id, ids, size)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        yield from _batches(_pack(encoded(batches), size, open_bins, at, False))

    def again(round_: int, last: bool):
        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at = (round_ << 56) + (TaskContext.get().partitionId() << 32)
            rows = [r for b in batches for r in zip(*[c.to_pylist() for c in b.columns[:5]], strict=True)]
            rows.sort(key=lambda r: (-r[3], r[0], r[1], r[2]))
            yield from _batches(_pack(rows, size, open_bins, at, last))

        return packed

    given = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    table = materialize(given.mapInArrow(first, PIECES), "pieces")
    done = [table.filter("sequence_id IS NOT NULL")]
    round_, open_ = 1, table.filter("sequence_id IS NULL")
    left = open_.agg(F.sum("length")).first()[0] or 0
    while left:
        tasks = max(1, left // (size * open_bins * fan_in // 2))
        dealt = open_.repartition(tasks, F.xxhash64("doc_id", "piece"))
        table = materialize(dealt.mapInArrow(again(round_, tasks == 1), PIECES), "pieces")
        done.append(table.filter("sequence_id IS NOT NULL"))
        open_ = table.filter("sequence_id IS NULL")
        left = 0 if tasks == 1 else open_.agg(F.sum("length")).first()[0] or 0
        round_ += 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out
