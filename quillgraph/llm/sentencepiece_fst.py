"""SentencePiece encoding and decoding by a weighted transducer and its shortest path."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

SPACE = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE = 1, 2, 3, 4, 6
_UNIGRAM, _BPE = 1, 2
#: What the encoder of unigram models adds to the worst score for a character that no piece covers.
_PENALTY = 10.0
#: Ways of cutting a normalised text, the finest first: at spaces and between letters and others, or at spaces alone.
_UNITS = (
    f"{SPACE}*[^\\W\\d_²]+|{SPACE}*(?:[^\\w{SPACE}\n]|[_²])+|{SPACE}*\\d|{SPACE}+|\n",
    f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n",
)
_OUT = ""
#: Units remembered in each of two generations; when the younger is full it becomes the older one, so frequent units stay.
_REMEMBER = 400_000

ENCODED = "doc_id long, ids array<int>, n_ids long, round_trip boolean"


def default_path() -> str:
    """The installed model of 32,000 pieces."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Transducer:
    """Normaliser, pieces and byte fallback of one model, composed lazily with an input.

    A path through the composition spells the normalised input and outputs piece ids. Its weight is the sum of its arcs',
    and the encoding is the path of least weight.

    Unigram models: an arc weighs the negative score of its piece; a character without a piece goes through the arcs of its bytes.

    BPE models: the weight cannot lie on single pieces, for merging is no sum of scores. But a sequence of pieces is
    what merging yields just when every two neighbours are what merging yields on the two alone. So the state after a
    piece remembers it, an arc to a piece that it may not stand beside has infinite weight, every other has weight zero,
    and one path of finite weight is left at every place of the input.
    """

    def __init__(self, model: bytes) -> None:
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(model)
        rules = spec.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models whose normaliser keeps characters and white space are supported")
        if spec.trainer_spec.model_type not in (_UNIGRAM, _BPE):
            raise ValueError("only unigram and BPE models are supported")
        self.bpe = spec.trainer_spec.model_type == _BPE
        self.prefix = SPACE if rules.add_dummy_prefix else ""
        self.text = [p.piece for p in spec.pieces]
        self.kind = [p.type for p in spec.pieces]
        self.score = [p.score for p in spec.pieces]
        self.ids = {p.piece: i for i, p in enumerate(spec.pieces) if p.type in (_NORMAL, _USER)}
        self.start: dict = {}
        for piece, i in self.ids.items():
            state = self.start
            for character in piece:
                state = state.setdefault(character, {})
            state[_OUT] = i
        self.unknown = next(i for i, k in enumerate(self.kind) if k == _UNKNOWN)
        self.bytes = {int(t[1:-1], 16): i for i, (t, k) in enumerate(zip(self.text, self.kind, strict=True)) if k == _BYTE}
        self.worst = min((self.score[i] for i in self.ids.values()), default=0.0)
        self.beside: dict[tuple[int, int], bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.alone: dict[int, bool] = {}
        self.units = next((u for u in map(re.compile, _UNITS) if self._never_crossed(u)), None)

    def _never_crossed(self, units: re.Pattern) -> bool:
        """Whether no piece holds two characters between which the pattern cuts, so that every path goes through its cuts."""
        pairs = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        return all(units.fullmatch(p) for p in pairs)

    def normalise(self, text: str) -> str:
        return self.prefix + text.replace(" ", SPACE) if text else ""

    def fallback(self, character: str) -> tuple[int, ...]:
        """The output of an arc over a character without a piece: its bytes, or the unknown id."""
        if not self.bytes:
            return (self.unknown,)
        return tuple(self.bytes[b] for b in character.encode())

    def merged(self, text: str) -> list[int]:
        """The pieces that merging ends with: the pair of best score first, the leftmost of equal ones."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                piece = self.ids.get(parts[i] + parts[i + 1])
                if piece is not None and (best is None or self.score[piece] > best):
                    best, at = self.score[piece], i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ids.get(p, -1) for p in parts]

    def may_follow(self, left: int, right: int) -> bool:
        key = (left, right)
        known = self.beside.get(key)
        if known is None:
            if len(self.beside) > 3 * _REMEMBER:
                self.beside.clear()
            known = self.beside[key] = self.merged(self.text[left] + self.text[right]) == [left, right]
        return known

    def stands_alone(self, piece: int) -> bool:
        known = self.alone.get(piece)
        if known is None:
            known = self.alone[piece] = self.merged(self.text[piece]) == [piece]
        return known

    def _bpe_path(self, unit: str) -> tuple[int, ...]:
        count, start, beside = len(unit), self.start, self.beside
        last: list = [None] * (count + 1)
        last[0] = (-1, 0)
        for i in range(count):
            if last[i] is None:
                continue
            left = last[i][0]
            state = start.get(unit[i])
            if state is None or _OUT not in state:
                last[i + 1] = (-2, i)
            j = i + 1
            while state is not None:
                piece = state.get(_OUT)
                if piece is not None and last[j] is None:
                    if left < 0:
                        stable = self.alone.get(piece)
                        if stable is None:
                            stable = self.stands_alone(piece)
                    else:
                        stable = beside.get((left, piece))
                        if stable is None:
                            stable = self.may_follow(left, piece)
                    if stable:
                        last[j] = (piece, i)
                if j == count:
                    break
                state = state.get(unit[j])
                j += 1
        return self._outputs(unit, last)

    def _unigram_path(self, unit: str) -> tuple[int, ...]:
        count = len(unit)
        # In single precision like the scores, so that paths of nearly equal weight are told apart as the library does.
        weight: list = [np.float32(0.0)] + [np.float32(np.inf)] * count
        last: list = [None] * (count + 1)
        unknown = np.float32(_PENALTY) - np.float32(self.worst)
        for i in range(count):
            state, j = self.start.get(unit[i]), i + 1
            while state is not None:
                piece = state.get(_OUT)
                if piece is not None and weight[i] - np.float32(self.score[piece]) < weight[j]:
                    weight[j], last[j] = weight[i] - np.float32(self.score[piece]), (piece, i)
                if j == count:
                    break
                state = state.get(unit[j])
                j += 1
            if unit[i] not in self.ids and weight[i] + unknown < weight[i + 1]:
                weight[i + 1], last[i + 1] = weight[i] + unknown, (-2, i)
        return self._outputs(unit, last)

    def _outputs(self, unit: str, last: list) -> tuple[int, ...]:
        out: list[tuple[int, ...]] = []
        at = len(unit)
        while at:
            piece, before = last[at]
            out.append((piece,) if piece >= 0 else self.fallback(unit[before:at]))
            at = before
        return tuple(i for part in reversed(out) for i in part)

    def path(self, unit: str) -> tuple[int, ...]:
        return self._bpe_path(unit) if self.bpe else self._unigram_path(unit)

    def encode(self, text: str) -> list[int]:
        """The ids of the least path. The input is cut where every path passes, and what was composed once is remembered."""
        normal = self.normalise(text)
        if not normal:
            return []
        if self.units is None or not self.bpe and not self.bytes:
            return list(self.path(normal))
        known, out = self.known, []
        for unit in self.units.findall(normal):
            ids = known.get(unit)
            if ids is None:
                ids = self.recall(unit)
                known = self.known
            out += ids
        return out

    def recall(self, unit: str) -> tuple[int, ...]:
        """The output of the least path over a unit that the younger generation does not know."""
        ids = self.older.get(unit) or self.path(unit)
        if len(self.known) >= _REMEMBER:
            self.older, self.known = self.known, {}
        self.known[unit] = ids
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of ids: spaces for their mark, bytes joined, control ids left out, and the space put before it taken off."""
        out: list[str] = []
        held = bytearray()
        for i in [*ids, -1]:
            if i >= 0 and self.kind[i] == _BYTE:
                held.append(int(self.text[i][1:-1], 16))
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            if i < 0 or self.kind[i] == _CONTROL:
                continue
            out.append(" ⁇ " if self.kind[i] == _UNKNOWN else self.text[i])
        text = "".join(out)
        if self.prefix and text.startswith(SPACE):
            text = text[1:]
        return text.replace(SPACE, " ")


@lru_cache(maxsize=2)
def load(path: str) -> Transducer:
    with open(path, "rb") as source:
        return Transducer(source.read())


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def encode_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, ids, n_ids, round_trip): the pieces of every text, and whether decoding gives the text again.

    A null or empty text has no ids. Decoding turns the mark of a space into a space, so a text that holds this mark itself
    does not come back. Rows are encoded where they lie; each task keeps a bounded memory of units. Null ids and repeated
    rows are passed on. Other columns are not read. An empty table gives no rows.
    """
    path = path or default_path()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in _slices(batches):
            texts = batch.column(1).to_pylist()
            found = [model.encode(t or "") for t in texts]
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            flat = np.fromiter((i for ids in found for i in ids), np.int32, int(ends[-1]))
            same = [model.decode(ids) == (t or "") for ids, t in zip(found, texts, strict=True)]
            columns = [
                batch.column(0),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                pa.array(np.diff(ends).astype(np.int64)),
                pa.array(same, pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "n_ids", "round_trip"])

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(encode, ENCODED)


def decode_ids(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """(doc_id, text): the text of every list of ids; null counts as empty, null or unknown entries as the unknown id."""
    path = path or default_path()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        size = len(model.text)
        for batch in _slices(batches):
            found = [
                model.decode([i if i is not None and 0 <= i < size else model.unknown for i in ids or []])
                for ids in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["doc_id", "text"])

    given = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return given.mapInArrow(decode, "doc_id long, text string")
