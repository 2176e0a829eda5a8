"""Pattern queries on a graph. Each returns a DataFrame; nothing runs before an action, but for the path search, the codes and
neighbours of one admission, and a count of prescriptions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import top_per_key
from ..session import materialize, materialize_measured, tasks_for
from .graph import Graph


#: Prescriptions that one task joins with diagnoses.
_TASK_ROWS = 1_000_000

TypedLinks = list[tuple[str, str, Callable[[], DataFrame]]]


def _seed(spark, label: str, node: str) -> DataFrame:
    named = [F.lit(label).alias("label"), F.lit(node).alias("node")]
    return spark.range(1).select(*named, F.array(F.struct(*named)).alias("path"))


def _step(frontier: DataFrame, labels: set[str], links: TypedLinks) -> tuple[DataFrame | None, set[str]]:
    """(label, node, path) one step away in either direction, one path per node, and the labels it can have.

    Only edge types that touch a label of the frontier are read.
    """
    reached, found = [], set()
    for src_label, dst_label, rows in links:
        for here, there, from_label, to_label in (("src", "dst", src_label, dst_label), ("dst", "src", dst_label, src_label)):
            if from_label not in labels:
                continue
            at = frontier.filter(F.col("label") == from_label).select(F.col("node").alias(here), "path")
            onward = rows().join(at, here).select(F.lit(to_label).alias("label"), F.col(there).alias("node"), "path")
            reached.append(onward)
            found.add(to_label)
    if not reached:
        return None, found
    each = reduce(DataFrame.unionAll, reached).groupBy("label", "node").agg(F.min("path").alias("path"))
    return each.withColumn("path", F.concat("path", F.array(F.struct("label", "node")))), found


def shortest_path(links: TypedLinks, start: tuple[str, str], goal: tuple[str, str], max_hops: int = 6) -> DataFrame:
    """(source, target, path_length, path) of a shortest undirected path, or no row within ``max_hops``.

    Ends are (label, id), and ``path`` lists the nodes as (label, node). The search runs from both of them and always extends the smaller frontier by one step, so it
    covers the neighbourhoods of half the distance. Frontiers are tables in the shared folder; only their sizes and the
    final path reach the driver.
    """
    spark = links[0][2]().sparkSession
    names = [f"{label}:{node}" for label, node in (start, goal)]
    result = "source string, target string, path_length int, path array<struct<label: string, node: string>>"
    if start == goal:
        return spark.createDataFrame([(*names, 0, [(start[0], str(start[1]))])], result)
    sides = []
    for label, node in (start, goal):
        seed = _seed(spark, label, str(node))
        sides.append({"frontier": seed, "seen": seed, "labels": {label}, "size": 1, "depth": 0})
    while sides[0]["depth"] + sides[1]["depth"] < max_hops:
        near = min(sides, key=lambda side: side["size"])
        step, near["labels"] = _step(near["frontier"], near["labels"], links)
        if step is None:
            break
        fresh = step.join(near["seen"].select("label", "node"), ["label", "node"], "left_anti")
        near["frontier"], counted = materialize_measured(fresh, "frontier", nodes=F.count(F.lit(1)))
        near["size"] = counted["nodes"]
        if near["size"] == 0:
            break
        near["depth"] += 1
        near["seen"] = near["seen"].unionAll(near["frontier"])
        onto, back = (side["frontier"].withColumnRenamed("path", name) for side, name in zip(sides, ("onto", "back")))
        whole = F.concat("onto", F.slice(F.reverse("back"), 2, max_hops + 1))
        best = onto.join(back, ["label", "node"]).agg(F.min(whole).alias("path")).first()["path"]
        if best is not None:
            return spark.createDataFrame([(*names, sides[0]["depth"] + sides[1]["depth"], best)], result)
    return spark.createDataFrame([], result)


def q1_patient_connection(
    graph: Graph, patient_a, patient_b, max_hops: int = 6, types: list[str] | None = None
) -> DataFrame:
    """Shortest connection of two patients over edges of any type, or of the listed ones."""
    ends = ("Patient", str(patient_a)), ("Patient", str(patient_b))
    return shortest_path(graph.typed_links(types), *ends, max_hops)


def _top_nodes(counts: DataFrame, count: str, nodes: DataFrame, prop: str, key: str, name: str, k: int) -> DataFrame:
    """The ``k`` nodes with the highest count, with one of their properties; ties go to the smaller key."""
    top = counts.orderBy(F.desc(count), "id").limit(k)
    named = top.join(nodes.select("id", prop), "id").select(F.col("id").alias(key), F.col(prop).alias(name), count)
    return named.orderBy(F.desc(count), key).limit(k)


def q2_differential_diagnosis(graph: Graph, concept_names: list[str], title: str, top_k: int = 10) -> DataFrame:
    """(code, title, support): diagnoses of the admissions whose notes mention any of the concepts."""
    concepts = graph.nodes("Concept").filter(F.col("name").isin(*concept_names)).select(F.col("id").alias("dst"))
    notes = graph.raw_edges("MENTIONS").join(concepts, "dst", "left_semi").select(F.col("src").alias("note"))
    documented = graph.raw_edges("DOCUMENTED_IN")
    stays = documented.join(notes, documented["dst"] == notes["note"], "left_semi").select("src")
    support = (
        graph.raw_edges("HAS_DIAGNOSIS")
        .select("src", "dst")
        .join(stays, "src", "left_semi")
        .distinct()
        .groupBy(F.col("dst").alias("id"))
        .agg(F.count(F.lit(1)).alias("support"))
    )
    return _top_nodes(support, "support", graph.nodes("Diagnosis"), title, "code", "title", top_k)


def q2b_top_diagnoses(graph: Graph, title: str, top_k: int = 10) -> DataFrame:
    """(code, title, support): the most frequent diagnoses overall."""
    support = graph.links("HAS_DIAGNOSIS").groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("support"))
    return _top_nodes(support, "support", graph.nodes("Diagnosis"), title, "code", "title", top_k)


def q3_similar_cohort(graph: Graph, admission, threshold: float = 0.4, top_k: int = 20) -> DataFrame:
    """(admission, jaccard): admissions whose set of codes is similar to that of one admission.

    Only admissions that share a code with it are looked at, and only their set sizes are counted. Its codes, and these admissions,
    are written first, so that Spark knows how few they are and broadcasts them instead of shuffling and sorting all edges.
    """
    rows = graph.table_edges("HAS_DIAGNOSIS").select("src", "dst")
    own = rows.filter(F.col("src") == F.lit(admission)).select("src").distinct()
    wanted = graph.raw_edges("HAS_DIAGNOSIS", own).select("dst").distinct()
    wanted, size = materialize_measured(wanted, "wanted", ref_size=F.count(F.lit(1)))
    near = rows.filter(F.col("src") != F.lit(admission)).join(wanted, "dst", "left_semi").select("src").distinct()
    others = graph.raw_edges("HAS_DIAGNOSIS", materialize(near, "near")).select("src", "dst").distinct()
    meeting = others.join(wanted, "dst", "left_semi")
    shared = meeting.groupBy("src").agg(F.count(F.lit(1)).alias("shared"))
    sizes = others.join(shared, "src").groupBy("src", "shared").agg(F.count(F.lit(1)).alias("size"))
    scored = sizes.withColumn("ref_size", F.lit(size["ref_size"])).select(
        F.col("src").alias("admission"),
        (F.col("shared") / (F.col("size") + F.col("ref_size") - F.col("shared"))).alias("jaccard"),
    )
    return scored.filter(F.col("jaccard") > threshold).orderBy(F.desc("jaccard"), "admission").limit(top_k)


def q4_medication_diagnoses(graph: Graph, medication, title: str, top_k: int = 15) -> DataFrame:
    """(code, title, co_count): diagnoses on the admissions that got a medication."""
    stays = graph.pairs("PRESCRIBED").filter(F.col("dst") == F.lit(medication)).select("src")
    counts = (
        graph.links("HAS_DIAGNOSIS", near=stays)
        .groupBy(F.col("dst").alias("id"))
        .agg(F.count(F.lit(1)).alias("co_count"))
    )
    return _top_nodes(counts, "co_count", graph.nodes("Diagnosis"), title, "code", "title", top_k)


def q5_top_drugs(graph: Graph, diagnosis, name: str, top_k: int = 10) -> DataFrame:
    """(medication, drug, rx_count): medications given on the admissions with a diagnosis.

    The edges to the one diagnosis are counted per admission first; the count weighs each prescription.
    """
    stays = (
        graph.links("HAS_DIAGNOSIS")
        .filter(F.col("dst") == F.lit(diagnosis))
        .groupBy("src")
        .agg(F.count(F.lit(1)).alias("weight"))
    )
    counts = (
        graph.pairs("PRESCRIBED", near=stays)
        .join(stays, "src")
        .groupBy(F.col("dst").alias("id"))
        .agg(F.sum("weight").alias("rx_count"))
    )
    return _top_nodes(counts, "rx_count", graph.nodes("Medication"), name, "medication", "drug", top_k)


def top_medications_per_diagnosis(diagnoses: DataFrame, prescriptions: DataFrame, k: int = 3) -> DataFrame:
    """(diagnosis, medication, rx_count, rank): the set form of Q5, over every diagnosis at once.

    Inputs are distinct (src, diagnosis) and (src, medication). Counts are reduced before the ranking, so a frequent
    diagnosis brings one row per medication to the window. A task counts what it joins, so there are more tasks for more rows.
    """
    tasks = tasks_for(prescriptions.sparkSession, prescriptions.count(), _TASK_ROWS)
    diagnoses, prescriptions = diagnoses.repartition(tasks, "src"), prescriptions.repartition(tasks, "src")
    counts = (
        diagnoses.join(prescriptions, "src")
        .groupBy("diagnosis", "medication")
        .agg(F.count(F.lit(1)).alias("rx_count"))
    )
    return top_per_key(counts, ["diagnosis"], [F.desc("rx_count"), F.col("medication")], k)


def patient_subgraph(graph: Graph, patient, title: str, drug: str, limit: int | None = 80) -> DataFrame:
    """(src, adm, diag, med) rows around one patient, with readable node names; ``med`` may be null."""
    stays = graph.pairs("HAS_ADMISSION").filter(F.col("src") == F.lit(patient))
    stays = stays.select(F.col("src").alias("patient"), F.col("dst").alias("admission"))
    near = stays.select(F.col("admission").alias("src"))
    dx = graph.pairs("HAS_DIAGNOSIS", near).select(F.col("src").alias("admission"), F.col("dst").alias("diagnosis"))
    rx = graph.pairs("PRESCRIBED", near).select(F.col("src").alias("admission"), F.col("dst").alias("medication"))
    titles = graph.nodes("Diagnosis").select(F.col("id").alias("diagnosis"), F.col(title).alias("title"))
    drugs = graph.nodes("Medication").select(F.col("id").alias("medication"), F.col(drug).alias("drug"))
    rows = (
        stays.join(dx, "admission")
        .join(titles, "diagnosis")
        .join(rx, "admission", "left")
        .join(drugs, "medication", "left")
    )
    named = rows.select(
        F.concat(F.lit("Patient_"), F.col("patient").cast("string")).alias("src"),
        F.concat(F.lit("Admission_"), F.col("admission").cast("string")).alias("adm"),
        F.concat(F.lit("Diagnosis_"), F.col("diagnosis").cast("string"), F.lit(": "), "title").alias("diag"),
        F.when(F.col("medication").isNotNull(), F.concat(F.lit("Med: "), "drug")).alias("med"),
    )
    return named.orderBy("adm", "diag", "med").limit(limit) if limit else named
