"""Exact histogram of encoded lengths and what its suffix sums answer for every context limit."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import byte_bpe


def encoded_lengths(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """(doc_id, length): the number of byte-level BPE ids of every text; a null text has none."""
    path, pattern = path or byte_bpe.default_path(), pattern or byte_bpe.default_pattern()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe.load(path, pattern)
        for batch in batches:
            lengths = [len(byte_bpe.encode(encoder, text.as_py())) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64())], ["doc_id", "length"])

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(count, "doc_id long, length long")


def length_histogram(lengths: DataFrame, length_col: str = "length") -> DataFrame:
    """(length, n_docs), counted in each task before anything is shuffled; null lengths are left out."""
    given = lengths.select(F.col(length_col).cast("long").alias("length")).filter("length IS NOT NULL")
    return given.groupBy("length").agg(F.count(F.lit(1)).alias("n_docs"))


def context_limits(histogram: DataFrame, block: int = 1024) -> DataFrame:
    """Answers at every length that occurs, read as a context limit.

    (length, n_docs, n_tokens) are the documents of just this length and their ids; (longer_docs, longer_tokens) the
    suffix sums over greater lengths; ``truncated_tokens`` what is left if every document is cut to this length;
    (total_docs, total_tokens) the whole corpus; ``share`` the part of the documents that are no longer than this, so
    that the q-quantile is the least length with ``share >= q``. Between two lengths that occur, the longer documents are those of the
    lower one and ``truncated_tokens`` grows by their number for every token of the limit.

    Sums run within blocks of ``block`` lengths, then over the block totals, of which there is one for every
    ``block`` tokens of the longest document at most. An empty histogram gives an empty result.
    """
    rows = materialize(histogram, "histogram").select(  # read twice below, so that texts are not encoded twice
        "length",
        "n_docs",
        (F.col("length") * F.col("n_docs")).alias("n_tokens"),
        F.floor(F.col("length") / block).alias("block"),
    )
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("block_docs"), F.sum("n_tokens").alias("block_tokens"))
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    totals = blocks.select(
        "block",
        F.coalesce(F.sum("block_docs").over(after), zero).alias("docs_after"),
        F.coalesce(F.sum("block_tokens").over(after), zero).alias("tokens_after"),
        F.sum("block_docs").over(everywhere).alias("total_docs"),
        F.sum("block_tokens").over(everywhere).alias("total_tokens"),
    )
    within = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.join(totals, "block").select(
        "length",
        "n_docs",
        "n_tokens",
        (F.coalesce(F.sum("n_docs").over(within), zero) + F.col("docs_after")).alias("longer_docs"),
        (F.coalesce(F.sum("n_tokens").over(within), zero) + F.col("tokens_after")).alias("longer_tokens"),
        "total_docs",
        "total_tokens",
    )
    cut = F.col("total_tokens") - F.col("longer_tokens") + F.col("longer_docs") * F.col("length")
    share = (F.col("total_docs") - F.col("longer_docs")) / F.col("total_docs")
    return sums.withColumn("truncated_tokens", cut).withColumn("share", share)
