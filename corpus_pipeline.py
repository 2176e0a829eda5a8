"""A training corpus from raw documents, stage by stage.

Every stage but the last returns the columns of ``documents``; a stage works on all that the one before it kept. Rows without an id
take no part: they are left out from the first stage on. A null text counts as empty. Further columns are passed through,
whatever they are called. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.llm.exact_dedup import exact_duplicates, lower_ascii
from quillgraph.llm.jaccard_join import jaccard_components
from quillgraph.llm.packing import pack_documents
from quillgraph.llm.quality import keep_good
from quillgraph.llm.substring_dedup import repeated_passages
from quillgraph.session import ScratchScope, drop_materialized, materialize


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose perplexity is beyond their language's limit."""
    docs = docs.filter("doc_id IS NOT NULL")
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def rows_of(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text): the rows with an id, each as one struct, so that no column of theirs meets one of a stage."""
    return docs.filter("doc_id IS NOT NULL").select(F.struct(*docs.columns).alias("row"), "doc_id", "text")


def least_rows(rows: DataFrame, key: list[str]) -> DataFrame:
    """One row for every key, the least in the order of its columns, so that it is the same on any layout."""
    return rows.groupBy(key).agg(F.min("row").alias("row"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of equal texts, one of the largest id; of rows that repeat id and text, the least.

    Only what goes is written and joined, the minority, so that texts are shuffled only if that is too large to broadcast.
    """
    key = ["doc_id", "digest"]
    rows = rows_of(docs)
    found = exact_duplicates(rows).withColumnRenamed("text_sha256", "digest").groupBy(key)
    odd = found.agg(F.count(F.lit(1)).alias("n"), F.bool_or("kept").alias("kept")).filter("n > 1 OR NOT kept")
    odd = materialize(odd, "copies")
    rows = rows.withColumn("digest", F.sha2(lower_ascii(F.coalesce("text", F.lit(""))), 256))
    once = rows.join(odd, key, "left_anti").select("row.*")
    repeated = odd.filter("n > 1 AND kept")
    if repeated.isEmpty():
        return once
    return once.unionByName(least_rows(rows.join(repeated, key, "left_semi"), key).select("row.*"))


def keyed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """(row, key, text) with a key for each different (id, text), in the order of id and text digest; and whether ids repeat.

    It is the id itself unless ids repeat. Then the keys are numbered after a sort, and texts join them by id and digest.
    """
    rows = rows_of(docs)
    if rows.groupBy("doc_id").count().filter("count > 1").isEmpty():
        return rows.withColumnRenamed("doc_id", "key"), False
    both = ["doc_id", "digest"]
    rows = rows.withColumn("digest", F.sha2(F.coalesce("text", F.lit("")), 256))
    numbers = rows.select(both).distinct().orderBy(both).withColumn("key", F.monotonically_increasing_id())
    numbers = materialize(numbers, "row-keys")
    return materialize(rows.join(numbers, both).select("row", "key", "text"), "keyed"), True


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group linked by sets of five-word shingles of similarity 0.8 or more, that of the smallest id.

    Every row is judged by its own text, also if another has its id; rows that repeat id and text are one, the least.
    """
    rows, repeat = keyed(docs)
    found = jaccard_components(rows, id_col="key", shingle=5, percent=80)
    gone = materialize(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("key")), "near-copies")
    left = rows.join(gone, "key", "left_anti")
    return (least_rows(left, ["key"]) if repeat else left).select("row.*")


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the passages that an earlier one has. One that loses words has the rest joined by spaces.

    Of two texts under one id, that of the smaller digest is the earlier one.
    """
    rows, _ = keyed(docs)
    found = repeated_passages(rows, id_col="key").filter("n_removed > 0")
    changed = materialize(found.select(F.col("doc_id").alias("key"), "kept_text"), "changed")
    joined = rows.select("row", "key").join(changed, "key", "left")
    own = {name: F.col("row").getField(name) for name in docs.columns}
    text = F.coalesce("kept_text", own["text"])
    own["text"] = text
    if "n_chars" in own:
        length = F.when(F.col("kept_text").isNull(), own["n_chars"]).otherwise(F.length(text))
        own["n_chars"] = length.cast(docs.schema["n_chars"].dataType)
    return joined.select(*[column.alias(name) for name, column in own.items()])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of 1024 tokens."""
    return pack_documents(docs)


STAGES = [
    ("quality classifier", filter_quality),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", cut_passages),
    ("best-fit packing", pack),
]

#: Scores and tokens are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next; nothing else that it wrote remains."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        with ScratchScope(spark) as scope:
            docs = scope.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            drop_materialized(before)
        before = docs
    return docs
