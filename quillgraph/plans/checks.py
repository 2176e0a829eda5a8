"""Graph statistics and integrity checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import tasks_for
from .graph import Graph

#: Rows of which one task finds the distinct ones.
_TASK_ROWS = 1_000_000


def _tagged_count(df: DataFrame, kind: str, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), F.lit(name).alias("name"), "n")


def graph_stats(graph: Graph, labels: list[str] | None = None, types: list[str] | None = None) -> DataFrame:
    """(kind, name, n): node counts per label and edge counts per type."""
    labels = labels or [rule.label for rule in graph.ontology.nodes]
    types = types or [rule.type for rule in graph.ontology.edges]
    parts = [_tagged_count(graph.nodes(label), "node", label) for label in labels]
    parts += [_tagged_count(graph.links(type), "edge", type) for type in types]
    return reduce(DataFrame.unionAll, parts)


def orphans(graph: Graph, type: str) -> DataFrame:
    """Nodes of an edge type's target label that no such edge reaches."""
    reached = graph.raw_edges(type).select(F.col("dst").alias("id")).distinct()
    return graph.nodes(graph.ontology.edge(type).dst_label).join(reached, "id", "left_anti")


def orphan_counts(graph: Graph, limits: dict[str, int]) -> DataFrame:
    """(check_name, orphans, ok): ``limits`` maps an edge type to the first number of orphans that fails."""
    parts = []
    for type, limit in limits.items():
        label = graph.ontology.edge(type).dst_label
        count = orphans(graph, type).agg(F.count(F.lit(1)).alias("orphans"))
        parts.append(
            count.select(F.lit(f"no orphan {label}").alias("check_name"), "orphans", (F.col("orphans") < limit).alias("ok"))
        )
    return reduce(DataFrame.unionAll, parts)


def key_uniqueness(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """(check_name, duplicate_keys, null_keys, ok) for named tables with their key columns."""
    parts = []
    for name, (df, keys) in tables.items():
        no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).withColumn("no_key", no_key)
        found = per_key.agg(
            F.count_if((F.col("n") > 1) & ~F.col("no_key")).alias("duplicate_keys"),
            F.coalesce(F.sum(F.when(F.col("no_key"), F.col("n"))), F.lit(0)).alias("null_keys"),
        )
        parts.append(
            found.select(
                F.lit(name).alias("check_name"),
                "duplicate_keys",
                "null_keys",
                ((F.col("duplicate_keys") == 0) & (F.col("null_keys") == 0)).alias("ok"),
            )
        )
    return reduce(DataFrame.unionAll, parts)


def node_key_tables(graph: Graph) -> dict[str, tuple[DataFrame, list[str]]]:
    """The node tables with their key, for :func:`key_uniqueness`."""
    return {rule.label: (graph.nodes(rule.label), ["id"]) for rule in graph.ontology.nodes}


def subgraph_counts(graph: Graph, patients: DataFrame | None = None) -> DataFrame:
    """(patient, admissions, diagnoses, medications): distinct nodes around every patient.

    Each branch is reduced to distinct (patient, node) by itself, so the branches never multiply each other. They are dealt over
    as many tasks as their edges call for.
    """
    stays = graph.pairs("HAS_ADMISSION").select(F.col("src").alias("patient"), F.col("dst").alias("admission"))
    if patients is not None:
        stays = stays.join(patients.select(F.col("id").alias("patient")), "patient", "left_semi")

    def branch(type: str) -> DataFrame:
        edges = graph.raw_edges(type).select(F.col("src").alias("admission"), F.col("dst").alias("node"))
        return stays.join(edges, "admission").select("patient", F.lit(type).alias("kind"), "node")

    found = (
        stays.select("patient", F.lit("HAS_ADMISSION").alias("kind"), F.col("admission").alias("node"))
        .unionAll(branch("HAS_DIAGNOSIS"))
        .unionAll(branch("PRESCRIBED"))
    )
    rows = sum(graph.table_edges(type).count() for type in ("HAS_ADMISSION", "HAS_DIAGNOSIS", "PRESCRIBED"))
    found = found.repartition(tasks_for(found.sparkSession, rows, _TASK_ROWS), *found.columns).distinct()
    return found.groupBy("patient").agg(
        F.count_if(F.col("kind") == "HAS_ADMISSION").alias("admissions"),
        F.count_if(F.col("kind") == "HAS_DIAGNOSIS").alias("diagnoses"),
        F.count_if(F.col("kind") == "PRESCRIBED").alias("medications"),
    )


def integrity_report(
    graph: Graph, labels: list[str], types: list[str], orphan_limits: dict[str, int]
) -> DataFrame:
    """(check_name, ok, detail) over all checks: tables filled, no orphans, unique keys, every patient connected."""
    stats = graph_stats(graph, labels, types)
    filled = stats.select(
        F.concat("name", F.when(F.col("kind") == "node", " nodes loaded").otherwise(" edges exist")).alias("check_name"),
        (F.col("n") > 0).alias("ok"),
        F.concat(F.lit("count="), F.col("n").cast("string")).alias("detail"),
    )
    orphaned = orphan_counts(graph, orphan_limits).select(
        "check_name", "ok", F.concat(F.lit("orphans="), F.col("orphans").cast("string")).alias("detail")
    )
    keys = key_uniqueness({label: (graph.nodes(label), ["id"]) for label in labels}).select(
        F.concat(F.lit("unique "), "check_name").alias("check_name"),
        "ok",
        F.concat(F.lit("duplicates="), F.col("duplicate_keys").cast("string")).alias("detail"),
    )
    lonely = (
        graph.nodes("Patient")
        .join(graph.raw_edges("HAS_ADMISSION").select(F.col("src").alias("id")).distinct(), "id", "left_anti")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.lit("patients have a subgraph").alias("check_name"),
            (F.col("n") == 0).alias("ok"),
            F.concat(F.lit("without="), F.col("n").cast("string")).alias("detail"),
        )
    )
    return filled.unionAll(orphaned).unionAll(keys).unionAll(lonely)


def load_volume(admissions: DataFrame, diagnoses: DataFrame, prescriptions: DataFrame, key: str, item: str) -> DataFrame:
    """(part, row_count): rows that a graph load has to write, after deduplication and endpoint checks."""
    stays = admissions.dropDuplicates()
    ids = stays.select(key)
    parts = {
        "admissions": stays,
        "diagnoses": diagnoses.join(ids, key),
        "prescriptions": prescriptions.join(ids, key).filter(F.col(item).isNotNull()),
    }
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("part"), "row_count")
        for name, df in parts.items()
    ]
    each = reduce(DataFrame.unionAll, counted)
    return each.unionAll(each.agg(F.sum("row_count").alias("row_count")).select(F.lit("total").alias("part"), "row_count"))
