"""Comparison of predicted and gold text spans, and metrics of predicted labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SMOOTH = 1e-9


def span_scores(predicted: DataFrame, gold: DataFrame, keys: list[str]) -> DataFrame:
    """Precision, recall and F1 over exact spans; ``keys`` are the document and the two offsets."""
    sides = (
        predicted.select(*keys, F.lit(1).alias("p"), F.lit(0).alias("g"))
        .unionByName(gold.select(*keys, F.lit(0).alias("p"), F.lit(1).alias("g")))
        .groupBy(*keys)
        .agg(F.max("p").alias("p"), F.max("g").alias("g"))
    )
    counts = sides.agg(
        F.coalesce(F.sum(F.col("p") * F.col("g")), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.col("p") * (1 - F.col("g"))), F.lit(0)).alias("fp"),
        F.coalesce(F.sum((1 - F.col("p")) * F.col("g")), F.lit(0)).alias("fn"),
    )
    precision = F.col("tp") / (F.col("tp") + F.col("fp") + F.lit(_SMOOTH))
    recall = F.col("tp") / (F.col("tp") + F.col("fn") + F.lit(_SMOOTH))
    scored = counts.withColumn("precision", precision).withColumn("recall", recall)
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + F.lit(_SMOOTH))
    return scored.withColumn("f1", f1)


def weighted_scores(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall and F1 averaged over the classes, weighted by their number of rows."""
    confusion = df.groupBy(F.col(label).alias("l"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = confusion.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("l").alias("class"),
                    F.col("n").alias("actual"),
                    F.lit(0).cast("bigint").alias("claimed"),
                    F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0).alias("hit"),
                ),
                F.struct(
                    F.col("p").alias("class"),
                    F.lit(0).cast("bigint").alias("actual"),
                    F.col("n").alias("claimed"),
                    F.lit(0).cast("bigint").alias("hit"),
                ),
            )
        ).alias("s")
    ).select("s.*")
    classes = sides.groupBy("class").agg(
        F.sum("actual").alias("actual"), F.sum("claimed").alias("claimed"), F.sum("hit").alias("hit")
    )
    precision = F.when(F.col("claimed") > 0, F.col("hit") / F.col("claimed")).otherwise(F.lit(0.0))
    recall = F.when(F.col("actual") > 0, F.col("hit") / F.col("actual")).otherwise(F.lit(0.0))
    scored = classes.withColumn("precision", precision).withColumn("recall", recall)
    f1 = F.when(
        F.col("precision") + F.col("recall") > 0,
        2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")),
    ).otherwise(F.lit(0.0))
    scored = scored.withColumn("f1", f1)
    total = F.sum("actual")
    return scored.agg(
        total.alias("n_rows"),
        *[(F.sum(F.col("actual") * F.col(m)) / total).alias(f"weighted_{m}") for m in ("precision", "recall", "f1")],
    )
