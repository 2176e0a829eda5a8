"""Exact deduplication of texts with the frequent digests split off, in DataFrame functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z and nothing else. A text of one byte per character takes the faster ``lower``."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def text_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_sha256): the SHA-256 of every normalised text, a null text counting as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.sha2(lower_ascii(text), 256).alias("text_sha256"))


def frequent_digests(digests: DataFrame, rows: int, support: float) -> DataFrame:
    """(text_sha256, keep_id, group_size) of every digest that more than ``support`` of the rows hold.

    ``freqItems`` keeps the Misra-Gries counters: at most ``1 / support`` candidates, among them every digest above the
    support. Their true counts then throw out the false ones, so at most ``1 / support`` rows are left.
    """
    candidates = digests.stat.freqItems(["text_sha256"], support).select(
        F.explode("text_sha256_freqItems").alias("text_sha256")
    )
    return (
        digests.join(F.broadcast(candidates), "text_sha256", "left_semi")
        .groupBy("text_sha256")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter(F.col("group_size") > support * rows)
    )


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = 1 / 4096
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per input row; of equal texts the largest id stays.

    Texts are read once, for their digests, which go to the shared folder. The winners of digests held by more than
    ``support`` of all rows, at most ``1 / support`` of them, are broadcast, so rows of large groups are settled where
    they lie. Only the other digests are shuffled, and no group of theirs is larger than ``support`` of the rows.

    A null text equals an empty one. An id that is null loses to any other; a group without any id has a null
    ``keep_id`` and keeps its rows. Rows that repeat id and text are all returned, counted and judged alike. Other
    columns of ``docs`` are not read, whatever their names. An empty table gives an empty result.
    """
    digests = materialize(text_digests(docs, id_col, text_col), "digests")
    rows = digests.count()
    winners = F.broadcast(materialize(frequent_digests(digests, rows, support), "winners"))
    same = Window.partitionBy("text_sha256")
    rare = (
        digests.join(winners, "text_sha256", "left_anti")
        .withColumn("keep_id", F.max("doc_id").over(same))
        .withColumn("group_size", F.count(F.lit(1)).over(same))
    )
    columns = ["doc_id", "keep_id", "group_size", "text_sha256"]
    both = digests.join(winners, "text_sha256").select(columns).unionByName(rare.select(columns))
    return both.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
