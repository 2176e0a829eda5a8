"""Publishing, parsing and landing a stream of note messages.

Sources and sinks are named by format and options, so a message broker, files or any other connector on the
class path serve alike; all a source has to offer is a column ``value``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.times import event_time
from ..operators.mentions import extract_mentions

#: The fields of a note message.
NOTE_SCHEMA = (
    "row_id string, subject_id string, hadm_id string, charttime string, category string, description string, text string"
)
RECORDS_PER_TRIGGER = 5_000


def messages(rows: DataFrame, key: str, fields: list[str], order: Column | None = None, limit: int | None = None) -> DataFrame:
    """(key, value): the key as text and the fields as one JSON object of strings, in the order given by ``order``."""
    texts = F.struct(*[F.col(name).cast("string").alias(name) for name in fields])
    ordered = rows.orderBy(order, key) if order is not None else rows
    out = ordered.select(
        F.col(key).cast("string").alias("key"), F.to_json(texts, {"ignoreNullFields": "false"}).alias("value")
    )
    return out.limit(limit) if limit else out


def note_messages(notes: DataFrame, limit: int | None = None) -> DataFrame:
    """Messages of the note table, by event time; column names may be in any case."""
    lower = notes.toDF(*[c.lower() for c in notes.columns])
    charttime = F.coalesce(F.nullif(F.col("charttime"), F.lit("")), F.col("chartdate"))
    at = event_time(F.col("charttime"), F.col("chartdate"))
    fields = [name.split()[0] for name in NOTE_SCHEMA.split(", ")]
    rows = lower.withColumn("_at", at).withColumn("charttime", charttime)
    return messages(rows, "subject_id", fields, F.col("_at").asc_nulls_last(), limit)


def parse_messages(raw: DataFrame, schema: str) -> DataFrame:
    """The typed fields of JSON messages; a message that is no JSON object gives a row of nulls."""
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("data")).select("data.*")


def malformed_count(parsed: DataFrame) -> DataFrame:
    """(messages, malformed): how many messages had no readable field."""
    empty = F.coalesce(*[F.col(c).cast("string") for c in parsed.columns]).isNull()
    return parsed.agg(F.count(F.lit(1)).alias("messages"), F.count_if(empty).alias("malformed"))


def note_stream(spark: SparkSession, format: str, schema: str = NOTE_SCHEMA, path: str | None = None, **options) -> DataFrame:
    """A stream of parsed messages with the time they came in."""
    reader = spark.readStream.format(format).options(**options)
    if format == "kafka":
        reader = reader.option("startingOffsets", options.get("startingOffsets", "earliest")).option(
            "maxOffsetsPerTrigger", options.get("maxOffsetsPerTrigger", RECORDS_PER_TRIGGER)
        )
    raw = reader.load(path) if path else reader.load()
    return parse_messages(raw, schema).withColumn("ingested_at", F.current_timestamp())


def _write_batch(df: DataFrame, target: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")


def land(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    every: str | None = "10 seconds",
    then: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Start writing every micro-batch to its own directory of a Parquet table, which a repeated batch overwrites.

    ``every`` is the trigger interval; None processes what is there and ends. ``then`` is called with each landed
    batch, read back from the table.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        _write_batch(batch, target, batch_id)
        if then is not None:
            spark = batch.sparkSession
            then(spark.read.schema(batch.schema).parquet(f"{target}/batch_id={batch_id}"), batch_id)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def mentions_of_batches(dictionary: DataFrame, id_col: str, text_col: str, target: str) -> Callable[[DataFrame, int], None]:
    """A step for :func:`land` that writes the concept mentions of every landed batch."""

    def extract(batch: DataFrame, batch_id: int) -> None:
        _write_batch(extract_mentions(batch, dictionary, id_col, text_col), target, batch_id)

    return extract


def read_landed(spark: SparkSession, target: str) -> DataFrame:
    """The landed table over all batches."""
    return spark.read.parquet(target).drop("batch_id")


def finish(query: StreamingQuery, timeout: float | None = None) -> None:
    """Wait for a query to end; after ``timeout`` seconds stop it once its current data is processed."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.processAllAvailable()
        query.stop()
