"""Comparison of MinHash settings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .setjoin import similar_sets, similar_sets_lsh

REPORT = (
    "num_tables int, threshold double, lsh_pairs bigint, exact_pairs bigint, all_pairs bigint, pair_ratio double, recall double"
)


def lsh_sweep(
    sets: DataFrame, settings: list[tuple[int, float]], num_features: int = 1 << 18, seed: int = 42
) -> DataFrame:
    """One row per (number of tables, distance threshold): pairs found, their share of all pairs, and the true recall.

    All settings are answered by one search with the most tables and the widest threshold: a pair is found with fewer
    tables if the first table it shares is among them. Pairs are counted where they are formed and not written.
    """
    spark = sets.sparkSession
    widest = max(threshold for _, threshold in settings)
    most = max(tables for tables, _ in settings)
    total = sets.count()
    found = similar_sets_lsh(sets, widest, most, num_features, seed)
    exact = similar_sets(sets, widest)
    near = lambda threshold: F.col("jaccard_dist") < threshold
    found_counts = found.agg(
        *[F.count_if((F.col("shared_table") < tables) & near(t)).alias(f"c{i}") for i, (tables, t) in enumerate(settings)]
    ).first()
    exact_counts = exact.agg(*[F.count_if(near(t)).alias(f"c{i}") for i, (_, t) in enumerate(settings)]).first()
    all_pairs = total * (total - 1) // 2
    rows = []
    for i, (tables, threshold) in enumerate(settings):
        hits, truth = found_counts[f"c{i}"], exact_counts[f"c{i}"]
        ratio = min(hits / all_pairs, 1.0) if all_pairs else 0.0
        rows.append((tables, threshold, hits, truth, all_pairs, ratio, hits / truth if truth else 1.0))
    return spark.createDataFrame(rows, REPORT)


def pivot_sweep(report: DataFrame, value: str = "lsh_pairs") -> DataFrame:
    """The report with one row per number of tables and one column per threshold."""
    label = F.concat(F.lit("t_"), F.regexp_replace(F.col("threshold").cast("string"), r"\.", "_"))
    return report.withColumn("label", label).groupBy("num_tables").pivot("label").agg(F.max(value))
