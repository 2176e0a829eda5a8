"""Large CSV files whose quoted fields hold line breaks, read by many tasks."""

from __future__ import annotations

import csv
import io
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import materialize

_HEAD = 1 << 16
_WHOLE, _END, _BEGIN = 0, 1, 2
_CUT = "file string, block long, kind int, record string"
_EFFECT = "file string, block long, outside boolean, inside boolean"


class Dialect:
    """Separator, quote and escape of a file, as Spark's reader names them."""

    def __init__(self, sep: str = ",", quote: str = '"', escape: str = '"') -> None:
        self.sep, self.quote, self.escape = sep, quote, escape

    @classmethod
    def of(cls, options: dict) -> Dialect:
        named = {name.lower(): value for name, value in options.items()}
        return cls(str(named.get("sep", named.get("delimiter", ","))), str(named.get("quote", '"')), str(named.get("escape", '"')))

    def ends_inside(self, line: str, inside: bool) -> bool:
        """Whether a line ends within a quoted field, if it begins within one or at the start of a field.

        A quote opens a field at its start only, so that quotes in the middle of an unquoted one count for nothing.
        """
        quote, at = self.quote, 0
        if not quote or (quote not in line):
            return inside
        while True:
            if not inside:
                if not line.startswith(quote, at):
                    at = line.find(self.sep, at) + len(self.sep)
                    if at < len(self.sep):
                        return False
                    continue
                at += len(quote)
            inside = True
            closing = self._closing(line, at)
            if closing < 0:
                return True
            inside = False
            at = line.find(self.sep, closing) + len(self.sep)
            if at < len(self.sep):
                return False

    def _closing(self, line: str, at: int) -> int:
        """Behind the quote that ends the field, or -1."""
        quote, escape = self.quote, self.escape
        while True:
            found = line.find(quote, at)
            if found < 0:
                return -1
            if escape and escape != quote:
                back = found
                while back > at and line.startswith(escape, back - len(escape)):
                    back -= len(escape)
                if (found - back) // len(escape) % 2:
                    at = found + len(quote)
                    continue
            elif line.startswith(quote, found + len(quote)):
                at = found + 2 * len(quote)
                continue
            return found + len(quote)

    def names(self, head: str) -> list[str]:
        """The column names in the first record of a text."""
        if len(self.sep) != 1:
            return [name.strip(self.quote) for name in head.split("\n", 1)[0].rstrip("\r").split(self.sep)]
        doubled = self.escape == self.quote
        rows = csv.reader(
            io.StringIO(head, newline=""), delimiter=self.sep, quotechar=self.quote or None, doublequote=doubled, escapechar=None if doubled else self.escape or None,
            quoting=csv.QUOTE_MINIMAL if self.quote else csv.QUOTE_NONE,
        )
        return next(rows, [])


def file_heads(spark: SparkSession, files: list[str], encoding: str = "UTF-8") -> list[tuple[str, int, bool]]:
    """(head, size, plain) of each file: its first characters, its bytes, and whether it is not compressed. Nothing else is read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    found = []
    for file in files:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        system = path.getFileSystem(conf)
        codec, raw = codecs.getCodec(path), system.open(path)
        stream = raw if codec is None else codec.createInputStream(raw)
        try:
            head = bytes(stream.readNBytes(_HEAD))
        finally:
            stream.close()
        found.append((head.decode(encoding, "replace").removeprefix("﻿"), int(system.getFileStatus(path).getLen()), codec is None))
    return found


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """(value, file, block): the lines of each split in their order."""
    text = spark.read.option("lineSep", "\n").text(files)
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _each_line(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], str]]:
    for batch in batches:
        for value, file, block in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            yield (file, block), value


def block_effects(lines: DataFrame, dialect: Dialect) -> DataFrame:
    """(file, block, outside, inside): whether a block ends within quotes, if it begins outside or inside of them.

    Each block is gone through alone. Lines without a quote change nothing and are passed over at once.
    """

    def effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list[bool]] = {}
        for batch in batches:
            keys = set(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True))
            for key in keys:
                found.setdefault(key, [False, True])
            quoted = batch.filter(pc.match_substring(batch.column(0), dialect.quote)) if dialect.quote else batch.slice(0, 0)
            for key, value in _each_line(iter([quoted])):
                state = found[key]
                state[:] = [dialect.ends_inside(value, begin) for begin in state]
        rows = [(file, block, *state) for (file, block), state in found.items()]
        kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_())
        columns = zip(*rows, strict=True) if rows else [()] * 4
        names = [f.split()[0] for f in _EFFECT.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return lines.mapInArrow(effects, _EFFECT)


def blocks_inside(effects: DataFrame) -> DataFrame:
    """(file, block): the blocks that begin within quotes, from the effects of those before them in the file."""
    ordered = effects.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("block", "outside", "inside"))).alias("all"))
    after = F.transform(
        "all",
        lambda b, i: F.aggregate(
            F.slice("all", F.lit(1), i), F.lit(False), lambda state, e: F.when(state, e["inside"]).otherwise(e["outside"])
        ),
    )
    begins = ordered.select("file", F.explode(F.arrays_zip(F.col("all.block").alias("block"), after.alias("begins"))).alias("z"))
    return begins.filter("z.begins").select("file", "z.block")


def cut_records(lines: DataFrame, dialect: Dialect, inside: set[tuple[str, int]]) -> DataFrame:
    """(file, block, kind, record): the records of each block, and the ends and beginnings of those that cross its bounds.

    The header, the first record of a file, is left out, as are empty lines.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        at, parts, within, kind, header = None, [], False, _WHOLE, False

        def finish(complete: bool) -> None:
            nonlocal header, kind
            record = "\n".join(parts)
            record = record.removesuffix("\r") if complete else record
            if header and complete:
                header = False
            elif kind == _END or not complete or record:
                out.append((*at, kind if complete or kind == _END else _BEGIN, record))
            kind = _WHOLE
            parts.clear()

        def rows() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.string())
            columns = zip(*out, strict=True) if out else [()] * 4
            names = [f.split()[0] for f in _CUT.split(", ")]
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
            out.clear()
            return batch

        for key, value in _each_line(batches):
            if key != at:
                if parts:
                    finish(False)
                at, within = key, key in inside
                kind, header = (_END if within else _WHOLE), key[1] == 0
            parts.append(value)
            within = dialect.ends_inside(value, within)
            if not within:
                finish(True)
            if len(out) >= 10_000:
                yield rows()
        if parts:
            finish(False)
        yield rows()

    return lines.mapInArrow(cut, _CUT)


def whole_records(cut: DataFrame) -> DataFrame:
    """(record): the records, those in pieces put together: each begins in one block and goes on through the ones after it."""
    pieces = cut.filter(F.col("kind") != _WHOLE)
    order = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, 0)
    numbered = pieces.withColumn("number", F.sum((F.col("kind") == _BEGIN).cast("int")).over(order))
    together = numbered.groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("block", "kind", "record"))).alias("p"))
    joined = F.regexp_replace(F.array_join(F.col("p.record"), "\n"), "\r\\z", "")
    return cut.filter(F.col("kind") == _WHOLE).select("record").unionByName(together.select(joined.alias("record")))


def read_split(spark: SparkSession, files: list[str], layout: StructType, options: dict) -> DataFrame:
    """Rows of CSV files with a header, in UTF-8 and not compressed, each of them read by as many tasks as it has splits.

    Whether a split begins within a quoted field is found by going through all of them alone, under both assumptions, and
    composing the effects of those before it. What the driver gets is the list of splits that do, which is shorter than the list of
    splits it plans the scan with. Then every split is cut into records, the few that cross a bound are put
    together, and Spark parses each with the caller's options.
    """
    dialect = Dialect.of(options)
    effects = materialize(block_effects(_lines(spark, files), dialect), "csv-blocks")
    inside = {(r["file"], r["block"]) for r in blocks_inside(effects).collect()}
    cut = cut_records(_lines(spark, files), dialect, inside)
    crossing = materialize(cut.filter(F.col("kind") != _WHOLE), "csv-crossing")
    records = cut.filter(F.col("kind") == _WHOLE).select("record").unionByName(whole_records(crossing))
    skipped = {"header", "multiline", "encoding", "charset", "inferschema", "lineSep".lower()}
    parsing = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items() if k.lower() not in skipped}
    parsed: Column = F.from_csv("record", F.lit(layout.toDDL()), parsing)
    return records.select(parsed.alias("r")).select("r.*")
