"""Which of a document's keys occur elsewhere too, asked and answered in blocks of keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .textbytes import Texts, mix, texts

_ASKED = "part int, block long, names binary, owners binary, known binary, ids binary, sizes binary, marks binary"
_HEARD = "block long, owners binary, names binary, ids binary, sizes binary, marks binary"
ANSWER = "doc_id long, n long, mark binary, lone long, names binary"
#: Names held before they are sent.
_FLUSH = 1 << 19
#: Documents of a block, so that 16 bits number them.
_DOCUMENTS = 1 << 16

#: Per document: (size, mark of fixed width, keys).
KeysOf = Callable[[Texts], Iterator[tuple[int, bytes, np.ndarray]]]


def short_names(keys: np.ndarray) -> np.ndarray:
    """What stands for keys in answers: 32 bits of them.

    The part of a key takes other bits of it. Two keys with one name make a key look shared that is not, which costs a
    later exact step some time and changes no result.
    """
    return (mix(keys) >> np.uint64(32)).astype(np.uint32)


def _cut(parts: np.ndarray, count: int, *columns: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    order = np.argsort(parts, kind="stable")
    return np.searchsorted(parts[order], np.arange(count + 1)), [c[order] for c in columns]


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], names=[name for name, _ in fields]
    )


class Requests:
    """The keys of a block of documents, split into parts by hash, as one row for each part.

    A key that occurs twice in the block is settled here: its documents are told, and its part only learns that it
    exists. So a part gets one entry for a key and block at most, however common the key.
    """

    def __init__(self, parts: int, lone: bool) -> None:
        self.parts, self.lone = parts, lone
        self.blocks = TaskContext.get().partitionId() << 32
        self.clear()

    def clear(self) -> None:
        self.ids, self.sizes, self.marks, self.keys, self.held = [], [], [], [], 0

    def full(self) -> bool:
        return self.held >= _FLUSH or len(self.ids) == _DOCUMENTS

    def add(self, doc_id: int, size: int, mark: bytes, keys: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.sizes.append(size)
        self.marks.append(mark)
        self.keys.append(keys)
        self.held += len(keys)

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.ids:
            return
        owner = np.repeat(np.arange(len(self.ids), dtype=np.uint16), [len(k) for k in self.keys])
        keys = np.concatenate(self.keys)
        values, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        names, part = short_names(values), (mix(values) % np.uint64(self.parts)).astype(np.int64)
        alone = counts == 1
        first = np.empty(len(values), np.uint16)
        first[inverse] = owner
        at, (asked, asking) = _cut(part[alone], self.parts, names[alone], first[alone])
        known_at, (known,) = _cut(part[~alone], self.parts, names[~alone])
        told, hearing = names[:0], owner[:0]
        if not self.lone:
            several = ~alone[inverse]
            pairs = np.unique((owner[several].astype(np.uint64) << np.uint64(32)) | names[inverse[several]])
            told, hearing = pairs.astype(np.uint32), (pairs >> np.uint64(32)).astype(np.uint16)
        whole = [np.array(self.ids, np.int64).tobytes(), np.array(self.sizes, np.int64).tobytes(), b"".join(self.marks)]
        rows = [(self.blocks % self.parts, self.blocks, told.tobytes(), hearing.tobytes(), None, *whole)]
        for p in range(self.parts):
            own, also = slice(at[p], at[p + 1]), known[known_at[p] : known_at[p + 1]]
            if at[p] == at[p + 1] and not len(also):
                continue
            rows.append((p, self.blocks, asked[own].tobytes(), asking[own].tobytes(), also.tobytes(), None, None, None))
        yield _batch(_ASKED, rows)
        self.blocks += 1
        self.clear()


def _joined(blobs: list[bytes], kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), kind)


def _answer(rows: pa.Table, lone: bool) -> pa.Table:
    """For each block that asks a part: the owners of names that occur once and how many, or the names that occur again."""
    every = rows.to_pylist()
    asked = [r for r in every if r["ids"] is None]
    names, owners = _joined([r["names"] for r in asked], np.uint32), _joined([r["owners"] for r in asked], np.uint16)
    values, inverse, counts = np.unique(names, return_inverse=True, return_counts=True)
    single = counts == 1
    single &= ~np.isin(values, _joined([r["known"] for r in asked], np.uint32))
    hit = single[inverse] if lone else ~single[inverse]
    ends = np.cumsum([len(r["owners"]) // 2 for r in asked]).tolist()
    out = []
    for r, low, high in zip(asked, [0, *ends], ends, strict=False):
        own, some = names[low:high][hit[low:high]], owners[low:high][hit[low:high]]
        if lone:
            some, found = np.unique(some, return_counts=True)
            own = found.astype(np.uint32)
        out.append((r["block"], some.tobytes(), own.tobytes(), None, None, None))
    out += [
        (r["block"], r["owners"], r["names"], r["ids"], r["sizes"], r["marks"])
        for r in every
        if r["ids"] is not None
    ]
    return pa.Table.from_batches([_batch(_HEARD, out)])


def _gather(rows: pa.Table, lone: bool) -> pa.Table:
    """The answers to one block, by document."""
    column = {name: rows.column(name).to_pylist() for name in rows.column_names}
    home = next(i for i, ids in enumerate(column["ids"]) if ids is not None)
    ids, sizes = (np.frombuffer(column[c][home], np.int64) for c in ("ids", "sizes"))
    marks = column["marks"][home]
    width = len(marks) // len(ids)
    owners, names = _joined(column["owners"], np.uint16), _joined(column["names"], np.uint32)
    counts = np.bincount(owners, weights=names if lone else None, minlength=len(ids)).astype(np.int64)
    found = pa.nulls(len(ids), pa.binary())
    if not lone:
        ends = np.zeros(len(ids) + 1, np.int32)
        np.cumsum(counts * 4, out=ends[1:])
        flat = names[np.argsort(owners, kind="stable")].tobytes()
        found = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(ends), pa.py_buffer(flat)])
    return pa.table(
        {
            "doc_id": ids,
            "n": sizes,
            "mark": pa.array([marks[i : i + width] for i in range(0, len(marks), width)], pa.binary()),
            "lone": counts if lone else counts * 0,
            "names": found,
        }
    )


def ask_elsewhere(docs: DataFrame, keys_of: KeysOf, lone: bool) -> DataFrame:
    """(doc_id, n, mark, lone, names), a row for each (doc_id, text) row.

    With ``lone``, that is how many of the document's keys occur once in the whole table; else ``names`` has the
    :func:`short_names` of those that occur more often. ``keys_of`` gives a key as often as it counts.

    Every scan task sends its keys in blocks to as many parts as there are shuffle partitions, and the parts' answers
    come together by block; texts are not shuffled. A block must be the same if its task runs again, so the rows of
    ``docs`` must come in one order, as those of files do.
    """
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        requests = Requests(parts, lone)
        for group in texts(batches):
            for doc_id, (size, mark, keys) in zip(group.ids.tolist(), keys_of(group), strict=True):
                requests.add(doc_id, size, mark, keys)
                if requests.full():
                    yield from requests.rows()
        yield from requests.rows()

    asked = docs.mapInArrow(ask, _ASKED)
    heard = asked.groupBy("part").applyInArrow(lambda rows: _answer(rows, lone), _HEARD)
    return heard.groupBy("block").applyInArrow(lambda rows: _gather(rows, lone), ANSWER)
