"""The registered queries: every operator of the library, run over the tables of a folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.codes import code_chapter
from .functions.similarity import levenshtein_similarity, token_jaccard, with_jaro_winkler
from .functions.text import block_key, token_set
from .functions.times import event_time
from .operators import joins
from .operators.dedup import keep_first
from .operators.mentions import extract_mentions, keyword_dictionary, mentions_per_note
from .operators.profile import key_frequency, mean_and_deviation, null_profile, table_counts
from .operators.quantiles import latency_summary
from .operators.sampling import hash_sample
from .operators.setjoin import copy_links, distinct_sets, pair_space, similar_sets, similar_sets_lsh
from .operators.spans import span_scores, weighted_scores
from .operators.sweep import lsh_sweep, pivot_sweep
from .plans import checks, communities, patterns, resolution
from .plans.centrality import pagerank, top_ranked
from .plans.components import connected_components
from .plans.cooccurrence import both_directions, connected_nodes, cooccurrence, projection_counts, with_pmi
from .plans.graph import detach_delete, fill_properties, orders_graph
from .plans.ontology import co_occurs_rule
from .session import ScratchScope, drop_materialized, materialize, scratch_path
from .sources.files import read_bucket_of, read_delimited, read_table, write_bucketed, write_table
from .sources.upsert import rename_same_as, upsert_edges, upsert_nodes
from .sources.versioned import VersionedTable, merge_edges, merge_nodes
from .streaming import notes

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]
CONCEPT_NAMES = ["thin", "rest", "edst"]
PATH_TYPES = ["HAS_ADMISSION", "HAS_DIAGNOSIS", "PRESCRIBED"]
ITEM_DISTANCE = 0.4
ITEM_PROBES = 4
DOC_DISTANCE = 0.3
TITLE_DISTANCE = 0.7
TITLE_RULE = resolution.DIAGNOSIS_RULE
ITEM_RULE = resolution.LabelRule(positive_jw=0.9, negative_jw=0.6, negative_overlap=0.2)
SWEEP = [(tables, threshold) for tables in (3, 5, 10, 15) for threshold in (0.3, 0.4, 0.5, 0.6)]


def _rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


# --- sources and sinks ---------------------------------------------------------------------------------------------


def _fingerprints(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("text_md5"))


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    path = scratch_path(spark, "csv")
    docs.toDF(*[c.upper() for c in docs.columns]).write.option("header", True).option("escape", '"').csv(path)
    return _fingerprints(read_delimited(spark, path, "doc_id bigint, text string, lang string, source string, n_chars bigint"))


def parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "parquet")
    write_table(read_table(spark, sf, "documents"), path)
    return _fingerprints(spark.read.parquet(path))


def partitioned_pruned_read(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "bucketed")
    write_bucketed(read_table(spark, sf, "orders"), path, "o_custkey", 8)
    rows = read_bucket_of(spark, path, "o_custkey", 1, 8, "bigint")
    return rows.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


def all_table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return table_counts({name: read_table(spark, sf, name) for name in TABLES})


def orders_null_profile(spark: SparkSession, sf: str) -> DataFrame:
    orders, lines = read_table(spark, sf, "orders"), read_table(spark, sf, "lineitem")
    joined = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left")
    return _rounded(null_profile(joined), "null_share")


def supplier_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return key_frequency(read_table(spark, sf, "lineitem", "l_suppkey"), "l_suppkey")


def price_mean_std(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_table(spark, sf, "lineitem", "l_returnflag", "l_extendedprice")
    return _rounded(mean_and_deviation(lines, "l_returnflag", F.col("l_extendedprice")), "mean_value", "sd_value", places=4)


def event_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(latency_summary(read_table(spark, sf, "events", "event_type", "value"), ["event_type"], "value"), "p50")


# --- messages ------------------------------------------------------------------------------------------------------

EVENT_FIELDS = ["event_id", "user_id", "event_type", "value", "props"]


def publish_events(spark: SparkSession, sf: str) -> DataFrame:
    return notes.messages(read_table(spark, sf, "events"), "user_id", EVENT_FIELDS, F.col("ts"))


def parse_event_times(spark: SparkSession, sf: str) -> DataFrame:
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    kind = F.col("event_type")
    events = read_table(spark, sf, "events", "event_id", "ts", "event_type").select(
        "event_id",
        F.when(kind.isin("click", "view"), stamp).when(kind == "error", "not a time").otherwise("").alias("charttime"),
        F.substring(stamp, 1, 10).alias("chartdate"),
    )
    at = event_time(F.col("charttime"), F.col("chartdate"))
    return events.select("event_id", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("event_time"))


def parse_events(spark: SparkSession, sf: str) -> DataFrame:
    sent = notes.messages(read_table(spark, sf, "events"), "user_id", EVENT_FIELDS)
    damaged = F.when(F.col("value").contains('"error"'), F.substring("value", 1, 12)).otherwise(F.col("value"))
    parsed = notes.parse_messages(sent.select(damaged.alias("value")), ", ".join(f"{f} string" for f in EVENT_FIELDS))
    return parsed.select(
        F.col("event_id").cast("bigint"),
        F.col("user_id").cast("bigint"),
        "event_type",
        F.col("value").cast("double"),
        F.from_json("props", "k bigint")["k"].alias("k"),
    )


def _document_messages(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "messages")
    sent = notes.messages(read_table(spark, sf, "documents"), "doc_id", ["doc_id", "text", "lang", "source"])
    sent.select("value").write.text(path)
    return path


DOC_SCHEMA = "doc_id string, text string, lang string, source string"


def stream_ingest_notes(spark: SparkSession, sf: str) -> DataFrame:
    stream = notes.note_stream(spark, "text", DOC_SCHEMA, _document_messages(spark, sf), maxFilesPerTrigger=2)
    target = scratch_path(spark, "landed")
    notes.finish(notes.land(stream, target, scratch_path(spark, "progress"), every=None))
    landed = notes.read_landed(spark, target)
    return landed.select(F.col("doc_id").cast("bigint"), "lang", "source", F.md5("text").alias("text_md5"))


def stream_mentions(spark: SparkSession, sf: str) -> DataFrame:
    stream = notes.note_stream(spark, "text", DOC_SCHEMA, _document_messages(spark, sf), maxFilesPerTrigger=2)
    target = scratch_path(spark, "landed-mentions")
    step = notes.mentions_of_batches(materialize(_dictionary(spark, sf), "dictionary"), "doc_id", "text", target)
    notes.finish(notes.land(stream, scratch_path(spark, "landed"), scratch_path(spark, "progress"), None, step))
    return _mention_rows(notes.read_landed(spark, target))


# --- text ----------------------------------------------------------------------------------------------------------


def _dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return keyword_dictionary(read_table(spark, sf, "benchmark", "text"), "text")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "documents", "doc_id", "text")


def _mentions(spark: SparkSession, sf: str) -> DataFrame:
    return extract_mentions(_documents(spark, sf), _dictionary(spark, sf), "doc_id", "text")


def _mention_rows(mentions: DataFrame) -> DataFrame:
    return mentions.select(
        F.col("note_id").cast("bigint").alias("note_id"),
        "concept_id",
        F.col("char_start").cast("bigint").alias("char_start"),
        F.col("char_end").cast("bigint").alias("char_end"),
        "entity_text",
    )


def mentions_extract(spark: SparkSession, sf: str) -> DataFrame:
    return _mention_rows(_mentions(spark, sf))


def note_mention_average(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf)
    return _rounded(mentions_per_note(docs, _mentions(spark, sf), "doc_id"), "avg_mentions")


def span_f1(spark: SparkSession, sf: str) -> DataFrame:
    """The dictionary of long words as a prediction of the mentions of the whole dictionary."""
    docs, spans = _documents(spark, sf), ["note_id", "char_start", "char_end"]
    gold = extract_mentions(docs, _dictionary(spark, sf), "doc_id", "text").select(*spans, "name")
    part_words = read_table(spark, sf, "part", "p_name")
    guess = keyword_dictionary(part_words, "p_name").select("concept_id", "name")
    long_words = _dictionary(spark, sf).filter(F.length("name") > 6)
    predicted = extract_mentions(docs, long_words.unionByName(guess).distinct(), "doc_id", "text")
    return _rounded(span_scores(predicted, gold, spans), "precision", "recall", "f1")


def quality_weighted_prf(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = read_table(spark, sf, "documents", "doc_id", "n_chars"), read_table(spark, sf, "labels", "doc_id", "quality")
    rows = labels.join(docs, "doc_id").select("quality", (F.col("n_chars") > 1000).cast("int").alias("guess"))
    return _rounded(
        weighted_scores(rows, "quality", "guess"), "weighted_precision", "weighted_recall", "weighted_f1"
    )


def part_token_sets(spark: SparkSession, sf: str) -> DataFrame:
    parts = read_table(spark, sf, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return parts.select("p_partkey", F.array_join(token_set(_part_name()), ",").alias("tokens"))


def part_block_keys(spark: SparkSession, sf: str) -> DataFrame:
    parts = read_table(spark, sf, "part", "p_partkey", "p_name")
    return parts.select("p_partkey", block_key(F.col("p_name")).alias("block_key"))


def part_chapters(spark: SparkSession, sf: str) -> DataFrame:
    """Part keys and brands written as codes: padded numbers, numbers with blanks, letters, and empty ones."""
    key = F.col("p_partkey").cast("string")
    code = (
        F.when(F.col("p_type") == "ECONOMY", F.lpad(key, 4, "0"))
        .when(F.col("p_type") == "SMALL", F.concat(F.lit(" "), F.reverse(key), F.lit(" ")))
        .when(F.col("p_type") == "LARGE", F.concat(F.lit("V"), key))
        .when(F.col("p_type") == "PROMO", F.lit(""))
        .otherwise(F.concat(F.col("p_size").cast("string"), F.lpad(key, 5, "0")))
    )
    parts = read_table(spark, sf, "part", "p_partkey", "p_type", "p_size").select("p_partkey", code.alias("code"))
    return parts.select("p_partkey", "code", code_chapter(F.col("code")).alias("chapter"))


# --- entity resolution ---------------------------------------------------------------------------------------------


def _part_name():
    return F.concat_ws(" ", "p_name", "p_brand", "p_type", F.col("p_size").cast("string"))


def _items(spark: SparkSession, sf: str) -> DataFrame:
    parts = read_table(spark, sf, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return resolution.entities(parts, "p_partkey", _part_name(), code=F.col("p_brand"), kind=F.col("p_type"))


def _named_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Candidate pairs of entities with their names: all similar ones and some random ones."""
    return resolution.candidate_pairs(_items(spark, sf), ITEM_DISTANCE, ITEM_PROBES, "code", "kind")


def _item_features(spark: SparkSession, sf: str) -> DataFrame:
    return resolution.pair_features(_named_pairs(spark, sf), "code", 9, "-")


def sim_jaro_winkler(spark: SparkSession, sf: str) -> DataFrame:
    scored = with_jaro_winkler(_named_pairs(spark, sf), "name_a", "name_b", "jw")
    return _rounded(scored.select("id_a", "id_b", "jw"), "jw")


def sim_levenshtein(spark: SparkSession, sf: str) -> DataFrame:
    lev = levenshtein_similarity(F.col("name_a"), F.col("name_b")).alias("lev")
    return _rounded(_named_pairs(spark, sf).select("id_a", "id_b", lev), "lev")


def sim_token_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    overlap = token_jaccard(F.col("name_a"), F.col("name_b")).alias("token_overlap")
    return _rounded(_named_pairs(spark, sf).select("id_a", "id_b", overlap), "token_overlap")


def er_features_names(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(
        _item_features(spark, sf).select("id_a", "id_b", *resolution.FEATURES, "label"), *resolution.FEATURES
    )


def er_rule_labels(spark: SparkSession, sf: str) -> DataFrame:
    named = _named_pairs(spark, sf)
    scored = with_jaro_winkler(named, "name_a", "name_b", "jw")
    overlap = token_jaccard(F.col("name_a"), F.col("name_b"))
    same_kind = (F.substring("kind_a", 1, 3) == F.substring("kind_b", 1, 3)).cast("double")
    return scored.select(
        "id_a",
        "id_b",
        resolution.name_rule(F.col("jw"), F.col("name_a"), F.col("name_b")).alias("name_label"),
        resolution.family_rule(same_kind, overlap).alias("family_label"),
    )


def _titles(spark: SparkSession, sf: str) -> DataFrame:
    """The second kind of entities: titles, with their category."""
    parts = read_table(spark, sf, "part", "p_partkey", "p_name", "p_type")
    return resolution.entities(parts, "p_partkey", F.col("p_name"), kind=F.col("p_type"))


def _title_features(spark: SparkSession, sf: str) -> DataFrame:
    """Titles from start to end: similar and random pairs, names, features with the category prefix."""
    pairs = resolution.candidate_pairs(_titles(spark, sf), TITLE_DISTANCE, ITEM_PROBES, "kind")
    return resolution.pair_features(pairs, "kind", 3)


def er_title_features(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["jw", "lev", "token_overlap", "same_code"]
    return _rounded(_title_features(spark, sf).select("id_a", "id_b", *columns), *columns)


def er_title_labels(spark: SparkSession, sf: str) -> DataFrame:
    return resolution.gold_labels(_title_features(spark, sf), TITLE_RULE).select("id_a", "id_b", "label")


def er_training_counts(spark: SparkSession, sf: str) -> DataFrame:
    """(positives, negatives, held_out) of the pairs that the matcher is trained and tested on."""
    features = _item_features(spark, sf)
    rule = resolution.name_rule(F.col("jw"), F.col("name_a"), F.col("name_b"))
    rows = resolution.sampled_labels(features.withColumn("label", rule))
    return rows.agg(
        F.count_if(F.col("label") == 1.0).alias("positives"),
        F.count_if(F.col("label") == 0.0).alias("negatives"),
        F.count_if(resolution.held_out()).alias("held_out"),
    )


def er_gold_labels(spark: SparkSession, sf: str) -> DataFrame:
    return resolution.gold_labels(_item_features(spark, sf), ITEM_RULE).select("id_a", "id_b", "label")


def _matcher(spark: SparkSession, sf: str):
    rule = resolution.name_rule(F.col("jw"), F.col("name_a"), F.col("name_b"))
    features = materialize(_item_features(spark, sf).withColumn("label", rule).drop("name_a", "name_b"), "features")
    model, metrics = resolution.train_matcher(
        resolution.sampled_labels(features, written=True), "MEDICATION", "name rule", trees=100, depth=6
    )
    return features, model, metrics


def er_train_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _matcher(spark, sf)[2]


def _title_matcher(spark: SparkSession, sf: str):
    """The second kind of entities: features of title pairs, labelled by category and common words, and a matcher of its own."""
    features = materialize(_title_features(spark, sf), "title-features")
    rule = resolution.family_rule(F.col("same_code"), F.col("token_overlap"))
    model, metrics = resolution.train_matcher(
        resolution.sampled_labels(features.withColumn("label", rule)), "DIAGNOSIS", "family_rule"
    )
    return features, model, metrics


def er_title_train_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _title_matcher(spark, sf)[2]


def same_as_all_types(spark: SparkSession, sf: str) -> DataFrame:
    """Same-as edges of both kinds of entities as one edge table."""
    resolved = {}
    for kind, matcher in (("medications", _matcher), ("diagnoses", _title_matcher)):
        features, model, _ = matcher(spark, sf)
        resolved[kind] = resolution.same_as(model, features, kind)
    return rename_same_as(resolved, {"medications": "Medication", "diagnoses": "Diagnosis"})


def same_as_edges(spark: SparkSession, sf: str) -> DataFrame:
    features, model, _ = _matcher(spark, sf)
    edges = rename_same_as({"medications": resolution.same_as(model, features, "MEDICATION")}, {"medications": "Medication"})
    return _rounded(edges, "confidence")


def _item_sets(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(distinct_sets(_items(spark, sf), "id", "tokens"), "item-sets")


def _doc_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf).select(F.col("doc_id").alias("id"), token_set(F.col("text")).alias("tokens"))


def pairs_bruteforce(spark: SparkSession, sf: str) -> DataFrame:
    return pair_space(read_table(spark, sf, "part", "p_partkey"))


def pairs_blocked(spark: SparkSession, sf: str) -> DataFrame:
    return pair_space(read_table(spark, sf, "part", "p_name"), F.substring("p_name", 1, 1))


def pairs_exact_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(similar_sets(_item_sets(spark, sf), ITEM_DISTANCE), "jaccard_dist")


def pairs_lsh(spark: SparkSession, sf: str) -> DataFrame:
    found = similar_sets_lsh(_item_sets(spark, sf), ITEM_DISTANCE, num_tables=15)
    return _rounded(found.drop("shared_table"), "jaccard_dist")


def pairs_exact_docs(spark: SparkSession, sf: str) -> DataFrame:
    sets = materialize(distinct_sets(_doc_tokens(spark, sf), "id", "tokens"), "doc-sets")
    return _rounded(similar_sets(sets, DOC_DISTANCE), "jaccard_dist")


def pairs_lsh_docs(spark: SparkSession, sf: str) -> DataFrame:
    sets = materialize(distinct_sets(_doc_tokens(spark, sf), "id", "tokens"), "doc-sets")
    return _rounded(similar_sets_lsh(sets, DOC_DISTANCE), "jaccard_dist")


def pairs_lsh_docs_check(spark: SparkSession, sf: str) -> DataFrame:
    """(outside, enough): MinHash pairs that the exact join does not have, and whether nearly all of its pairs are found."""
    sets = materialize(distinct_sets(_doc_tokens(spark, sf), "id", "tokens"), "doc-sets")
    with ScratchScope(spark) as scope:
        found = scope.keep(similar_sets_lsh(sets, DOC_DISTANCE).select("id_a", "id_b"), "found")
    with ScratchScope(spark) as scope:
        exact = scope.keep(similar_sets(sets, DOC_DISTANCE).select("id_a", "id_b"), "exact")
    outside = found.join(exact, ["id_a", "id_b"], "left_anti").agg(F.count(F.lit(1)).alias("outside"))
    missed = exact.join(found, ["id_a", "id_b"], "left_anti").agg(F.count(F.lit(1)).alias("missed"))
    total = exact.count()
    return outside.crossJoin(missed).select("outside", (F.col("missed") <= 0.1 * total).cast("int").alias("enough"))


def lsh_sweep_truth(spark: SparkSession, sf: str) -> DataFrame:
    """What of the sweep does not depend on the hashes, and whether the rest is possible."""
    report = lsh_sweep(_item_sets(spark, sf), SWEEP)
    possible = (F.col("lsh_pairs") <= F.col("exact_pairs")) & (F.col("recall") <= 1.0)
    return report.select("num_tables", F.round("threshold", 6).alias("threshold"), "exact_pairs", "all_pairs", possible.cast("int").alias("possible"))


def same_as_check(spark: SparkSession, sf: str) -> DataFrame:
    """(outside, doubtful): same-as edges that are no candidate pair, and edges of low confidence."""
    features, model, _ = _matcher(spark, sf)
    edges = materialize(resolution.same_as(model, features, "MEDICATION"), "same-as")
    outside = edges.join(features.select("id_a", "id_b"), ["id_a", "id_b"], "left_anti").count()
    return edges.agg(F.count_if(F.col("confidence") < 0.5).alias("doubtful")).select(F.lit(outside).cast("bigint").alias("outside"), "doubtful")


def document_copies(spark: SparkSession, sf: str) -> DataFrame:
    return copy_links(_doc_tokens(spark, sf), "id", "tokens")


def item_lsh_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(lsh_sweep(_item_sets(spark, sf), SWEEP), "pair_ratio", "recall")


def item_lsh_sweep_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return pivot_sweep(lsh_sweep(_item_sets(spark, sf), SWEEP))


def er_clusters(spark: SparkSession, sf: str) -> DataFrame:
    rows = materialize(_doc_tokens(spark, sf), "doc-tokens")
    sets = materialize(distinct_sets(rows, "id", "tokens"), "doc-sets")
    copies = copy_links(rows, "id", "tokens", sets).select(F.col("rep_id").alias("id_a"), F.col("id").alias("id_b"))
    copies, nodes = materialize(copies, "copies"), materialize(rows.select("id"), "doc-ids")
    drop_materialized(rows)  # the set join needs their disk
    alike = similar_sets(sets, DOC_DISTANCE).select("id_a", "id_b")
    return resolution.entity_clusters(nodes, materialize(copies.unionByName(alike), "same-as"))


# --- graph ---------------------------------------------------------------------------------------------------------


def nodes_of(label: str):
    return lambda spark, sf: orders_graph(spark, sf).nodes(label)


def merged_edges_of(type: str):
    return lambda spark, sf: orders_graph(spark, sf).merged_edges(type)


def edges_documented_in(spark: SparkSession, sf: str) -> DataFrame:
    g = orders_graph(spark, sf)
    return reduce(
        DataFrame.unionAll,
        [
            g.links(type).select(F.lit(type).alias("type"), F.col("src").cast("string"), F.col("dst").cast("string"))
            for type in ("DOCUMENTED_IN", "UNDERWENT")
        ],
    )


def edges_lab_result(spark: SparkSession, sf: str) -> DataFrame:
    return orders_graph(spark, sf).merged_edges("HAD_LAB_RESULT").select("src", "dst", "value", "event_id")


def node_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Customers, updated from all their orders: the last order sets the segment and adds a property."""
    current = orders_graph(spark, sf).nodes("Patient")
    incoming = read_table(spark, sf, "orders").select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderpriority").alias("segment"),
        F.col("o_totalprice").alias("last_price"),
        F.col("o_orderkey").alias("version"),
    )
    return upsert_nodes(current, incoming, "id", "version")


def edge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    g = orders_graph(spark, sf)
    sources = g.nodes("Admission").filter(F.col("status") != "P")
    targets = read_table(spark, sf, "supplier").filter(F.col("s_acctbal") > 0).select(F.col("s_suppkey").alias("id"))
    returned = g.raw_edges("PRESCRIBED").filter(F.col("route") == "R")
    kept = g.raw_edges("PRESCRIBED").filter(F.col("route") != "R")
    first = upsert_edges(None, kept, sources, targets)
    return upsert_edges(first, returned, sources, targets)


def node_upsert_versions(spark: SparkSession, sf: str) -> DataFrame:
    """As ``node_upsert``, into a stored table: the orders come in two batches, each of which makes a version."""
    table = VersionedTable.create(orders_graph(spark, sf).nodes("Patient"), scratch_path(spark, "patients"), ("id",), 16)
    orders = read_table(spark, sf, "orders").select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderpriority").alias("segment"),
        F.col("o_totalprice").alias("last_price"),
        F.col("o_orderkey").alias("version"),
    )
    middle = orders.agg(F.avg("version")).first()[0]
    for batch in (orders.filter(F.col("version") <= middle), orders.filter(F.col("version") > middle)):
        table = merge_nodes(table, batch, "version")
    return table.read()


def edge_upsert_versions(spark: SparkSession, sf: str) -> DataFrame:
    """As ``edge_upsert``, into a stored table."""
    g = orders_graph(spark, sf)
    sources = g.nodes("Admission").filter(F.col("status") != "P")
    targets = read_table(spark, sf, "supplier").filter(F.col("s_acctbal") > 0).select(F.col("s_suppkey").alias("id"))
    rows = g.raw_edges("PRESCRIBED")
    first = upsert_edges(None, rows.filter(F.col("route") != "R"), sources, targets)
    table = VersionedTable.create(first, scratch_path(spark, "prescribed"), ("src", "dst"), 16)
    return merge_edges(table, rows.filter(F.col("route") == "R"), sources, targets).read()


def node_upsert_unversioned(spark: SparkSession, sf: str) -> DataFrame:
    """Customers, updated from their orders, some of which have no value for the segment."""
    urgent = F.when(F.col("o_orderpriority").startswith("1"), F.col("o_orderpriority"))
    incoming = read_table(spark, sf, "orders").select(
        F.col("o_custkey").alias("id"), urgent.alias("segment"), F.col("o_orderstatus").alias("last_status")
    )
    return upsert_nodes(orders_graph(spark, sf).nodes("Patient"), incoming, "id")


def edge_upsert_properties(spark: SparkSession, sf: str) -> DataFrame:
    """Kept lines, updated from returned ones, which lack one of their properties and bring another."""
    g = orders_graph(spark, sf)
    sources, targets, rows = g.nodes("Admission"), g.nodes("Medication"), g.raw_edges("PRESCRIBED")
    current = upsert_edges(None, rows.filter(F.col("route") != "R"), sources, targets)
    returned = rows.filter(F.col("route") == "R").select("src", "dst", "dose", F.lit("returned").alias("flag"))
    return upsert_edges(current, returned, sources, targets)


def dangling_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of a graph from which orders are missing that lines, events and documents still name."""
    g = orders_graph(spark, sf, only={"orders": "o_orderstatus <> 'P'"})
    counted = checks.graph_stats(g, ["Admission"], [rule.type for rule in g.ontology.edges if rule.type != "MENTIONS"])
    alone = checks.orphan_counts(g, {"DOCUMENTED_IN": 1, "HAS_DIAGNOSIS": 1, "PRESCRIBED": 1})
    return counted.unionAll(alone.select(F.lit("orphan").alias("kind"), F.col("check_name").alias("name"), F.col("orphans").alias("n")))


def _same_named(spark: SparkSession, sf: str) -> DataFrame:
    """(id_a, id_b, confidence): pairs that the name rule takes for one thing."""
    scored = with_jaro_winkler(_named_pairs(spark, sf), "name_a", "name_b", "jw")
    alike = resolution.name_rule(F.col("jw"), F.col("name_a"), F.col("name_b")) == 1.0
    return scored.filter(alike).select("id_a", "id_b", F.round("jw", 6).alias("confidence"))


def edges_same_as(spark: SparkSession, sf: str) -> DataFrame:
    """Same-as edges in a graph from which some of the nodes are missing."""
    g = orders_graph(spark, sf, only={"part": "p_size > 10"}).with_same_as("Diagnosis", _same_named(spark, sf))
    return g.merged_edges("SAME_AS_DIAGNOSIS")


def edges_co_occurs(spark: SparkSession, sf: str) -> DataFrame:
    counted = _rounded(cooccurrence(_code_pairs(spark, sf), 3), "log_count")
    return orders_graph(spark, sf).with_edges(co_occurs_rule(), counted).merged_edges("CO_OCCURS_WITH")


def nodes_with_rank(spark: SparkSession, sf: str) -> DataFrame:
    """Medications with their rank as a property."""
    ranks = _prescription_ranks(spark, sf).filter(F.col("id").startswith("M:"))
    values = ranks.select(F.substring("id", 3, 30).cast("bigint").alias("id"), F.round("rank", 9).alias("rank"))
    return orders_graph(spark, sf).with_property("Medication", values, "rank", "rank").nodes("Medication")


def nodes_filled(spark: SparkSession, sf: str) -> DataFrame:
    """Admissions as a load writes them that fills nulls in texts; prices of low orders are nulled first."""
    nodes = orders_graph(spark, sf).nodes("Admission").select("id", F.nullif("status", F.lit("O")).alias("status"), "priority")
    return fill_properties(nodes)


def graph_detach_delete(spark: SparkSession, sf: str) -> DataFrame:
    g = orders_graph(spark, sf)
    nodes = {label: g.nodes(label) for label in ("Patient", "Admission", "Diagnosis", "Medication")}
    edges = {type: g.links(type) for type in PATH_TYPES}
    nodes, edges = detach_delete(nodes, edges, g.ontology, "Medication")
    tagged = [df.select(F.lit(name).alias("name")) for name, df in [*nodes.items(), *edges.items()]]
    return reduce(DataFrame.unionAll, tagged).groupBy("name").agg(F.count(F.lit(1)).alias("n"))


def dedup_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_table(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey")
    order = [F.col("l_linenumber"), F.col("l_suppkey")]
    return keep_first(lines, ["l_orderkey", "l_partkey"], order)


def graph_prep_counts(spark: SparkSession, sf: str) -> DataFrame:
    stays = read_table(spark, sf, "orders", "o_orderkey", "o_custkey").withColumnRenamed("o_orderkey", "key")
    dx = read_table(spark, sf, "lineitem", "l_orderkey", "l_partkey").withColumnRenamed("l_orderkey", "key")
    rx = read_table(spark, sf, "lineitem", "l_orderkey", "l_suppkey").withColumnRenamed("l_orderkey", "key")
    return checks.load_volume(stays, dx, rx, "key", "l_suppkey")


def whole_graph_stats(spark: SparkSession, sf: str) -> DataFrame:
    return checks.graph_stats(orders_graph(spark, sf))


def _flags(df: DataFrame) -> DataFrame:
    return df.withColumn("ok", F.col("ok").cast("int"))


def key_checks(spark: SparkSession, sf: str) -> DataFrame:
    tables = checks.node_key_tables(orders_graph(spark, sf))
    tables["line numbers"] = (read_table(spark, sf, "lineitem", "l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])
    return _flags(checks.key_uniqueness(tables))


ORPHAN_LIMITS = {"HAS_ADMISSION": 1, "DOCUMENTED_IN": 100, "HAS_DIAGNOSIS": 1, "PRESCRIBED": 1}


def orphan_checks(spark: SparkSession, sf: str) -> DataFrame:
    g = orders_graph(spark, sf)
    lines = g.raw_edges("HAS_DIAGNOSIS").select(F.col("src").alias("id")).distinct()
    empty = g.nodes("Admission").join(lines, "id", "left_anti").agg(F.count(F.lit(1)).alias("orphans"))
    extra = empty.select(F.lit("no empty Admission").alias("check_name"), "orphans", (F.col("orphans") == 0).alias("ok"))
    return _flags(checks.orphan_counts(g, ORPHAN_LIMITS).unionAll(extra))


REPORT_LABELS = ["Patient", "Admission", "Diagnosis", "Medication", "LabTest", "ClinicalNote", "Concept", "Caregiver"]
REPORT_TYPES = ["HAS_ADMISSION", "HAS_DIAGNOSIS", "PRESCRIBED", "MENTIONS"]


def integrity_report(spark: SparkSession, sf: str) -> DataFrame:
    limits = {"HAS_ADMISSION": 1, "DOCUMENTED_IN": 100}
    return _flags(checks.integrity_report(orders_graph(spark, sf), REPORT_LABELS, REPORT_TYPES, limits))


def patient_subgraph_counts(spark: SparkSession, sf: str) -> DataFrame:
    return checks.subgraph_counts(orders_graph(spark, sf))


def patient_subgraph_edges(spark: SparkSession, sf: str) -> DataFrame:
    return patterns.patient_subgraph(orders_graph(spark, sf), 1, "title", "drug", 80)


# --- pattern queries -----------------------------------------------------------------------------------------------


def q1_shortest_path(spark: SparkSession, sf: str) -> DataFrame:
    found = patterns.q1_patient_connection(orders_graph(spark, sf), 0, 1, 6)
    return found.select("source", "target", F.col("path_length").cast("bigint").alias("path_length"))


def q2_differential_dx(spark: SparkSession, sf: str) -> DataFrame:
    return patterns.q2_differential_diagnosis(orders_graph(spark, sf), CONCEPT_NAMES, "title", 10)


def q2b_top_diagnoses(spark: SparkSession, sf: str) -> DataFrame:
    return patterns.q2b_top_diagnoses(orders_graph(spark, sf), "title", 10)


def q3_similar_cohort(spark: SparkSession, sf: str) -> DataFrame:
    first = read_table(spark, sf, "lineitem", "l_orderkey").agg(F.min("l_orderkey")).first()[0]
    return _rounded(patterns.q3_similar_cohort(orders_graph(spark, sf), first, 0.1, 20), "jaccard")


def q4_medication_diagnoses(spark: SparkSession, sf: str) -> DataFrame:
    return patterns.q4_medication_diagnoses(orders_graph(spark, sf), 1, "title", 15)


def q5_top_drugs(spark: SparkSession, sf: str) -> DataFrame:
    return patterns.q5_top_drugs(orders_graph(spark, sf), 1, "drug", 10)


def _brand_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct (src, dst): order and brand."""
    parts = read_table(spark, sf, "part", "p_partkey", "p_brand")
    lines = read_table(spark, sf, "lineitem", "l_orderkey", "l_partkey")
    joined = lines.join(parts, lines["l_partkey"] == parts["p_partkey"])
    return joined.select(F.col("l_orderkey").alias("src"), F.col("p_brand").alias("dst")).distinct()


def _code_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct (src, dst): order and part."""
    return orders_graph(spark, sf).pairs("HAS_DIAGNOSIS", dealt=True)


def top_k_per_key(spark: SparkSession, sf: str) -> DataFrame:
    dx = _brand_pairs(spark, sf).withColumnRenamed("dst", "diagnosis")
    rx = orders_graph(spark, sf).pairs("PRESCRIBED").withColumnRenamed("dst", "medication")
    ranked = patterns.top_medications_per_diagnosis(dx, rx, 3)
    return ranked.withColumn("rank", F.col("rank").cast("bigint"))


# --- joins ---------------------------------------------------------------------------------------------------------


def _join_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders = read_table(spark, sf, "orders", "o_orderkey", "o_custkey").withColumnRenamed("o_orderkey", "key")
    lines = read_table(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_linenumber").withColumnRenamed("l_orderkey", "key")
    return orders, lines


def _per_customer(joined: DataFrame) -> DataFrame:
    return joined.groupBy("o_custkey").agg(
        F.count("l_partkey").alias("total_codes"), F.count_distinct("l_partkey").alias("unique_codes")
    )


def join_agg(strategy: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        orders, lines = _join_sides(spark, sf)
        width = int(spark.conf.get("spark.sql.shuffle.partitions"))
        if strategy == "broadcast":
            joined = joins.broadcast_join(orders, lines, "key")
        elif strategy == "hash":
            joined = joins.repartitioned_join(orders, lines, "key", width)
        elif strategy == "coalesce":
            joined = joins.coalesced_join(orders, lines, "key", width)
        elif strategy == "range":
            joined = joins.range_join_layout(orders, lines, "key", width)
        elif strategy == "salted":
            joined = joins.salted_join(orders, lines, "key", ["key", "l_partkey", "l_linenumber"], 10)
        else:
            joined = lines.join(orders, "key")
        return _per_customer(joined)

    return run


def order_sample(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    return hash_sample(orders, "o_orderkey", 0.3)


# --- analytics -----------------------------------------------------------------------------------------------------


def brand_cooccurrence(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(cooccurrence(_brand_pairs(spark, sf), 5), "log_count")


def code_cooccurrence_pmi(spark: SparkSession, sf: str) -> DataFrame:
    pairs = materialize(_code_pairs(spark, sf), "code-pairs")
    return _rounded(with_pmi(cooccurrence(pairs, 2), pairs), "log_count", "pmi")


def _code_edges(spark: SparkSession, sf: str, support: int) -> DataFrame:
    return materialize(cooccurrence(_code_pairs(spark, sf), support), "code-edges")


def projections(spark: SparkSession, sf: str) -> DataFrame:
    g = orders_graph(spark, sf)
    codes = projection_counts("diagnosis", g.nodes("Diagnosis"), both_directions(_code_edges(spark, sf, 2)))
    both = g.nodes("Medication").select("id").unionAll(g.nodes("Admission").select("id"))
    return codes.unionAll(projection_counts("medication", both, g.pairs("PRESCRIBED", dealt=True)))


def code_connected_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return connected_nodes(_code_edges(spark, sf, 2))


def code_components(spark: SparkSession, sf: str) -> DataFrame:
    edges = _code_edges(spark, sf, 3).select(F.col("code_a").alias("src"), F.col("code_b").alias("dst"))
    return connected_components(orders_graph(spark, sf).nodes("Diagnosis"), edges)


def _prescription_ranks(spark: SparkSession, sf: str) -> DataFrame:
    g = orders_graph(spark, sf)
    named = lambda label, c: F.concat(F.lit(label), F.col(c).cast("string"))
    nodes = g.nodes("Admission").select(named("A:", "id").alias("id")).unionAll(
        g.nodes("Medication").select(named("M:", "id").alias("id"))
    )
    edges = g.pairs("PRESCRIBED").select(named("A:", "src").alias("src"), named("M:", "dst").alias("dst"))
    return pagerank(nodes, edges)


def pagerank_bipartite(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_prescription_ranks(spark, sf), "rank", places=9)


def pagerank_top(spark: SparkSession, sf: str) -> DataFrame:
    drugs = read_table(spark, sf, "supplier").select(
        F.concat(F.lit("M:"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("drug")
    )
    return _rounded(top_ranked(_prescription_ranks(spark, sf), drugs, "drug", 20), "rank", places=9)


def pagerank_cooccurrence(spark: SparkSession, sf: str) -> DataFrame:
    edges = both_directions(_code_edges(spark, sf, 3))
    return _rounded(pagerank(edges.select(F.col("src").alias("id")).distinct(), edges, max_iterations=5), "rank", places=9)


def brand_modularity(spark: SparkSession, sf: str) -> DataFrame:
    edges = both_directions(cooccurrence(_brand_pairs(spark, sf), 5), "co_count")
    brands = read_table(spark, sf, "part", "p_brand").distinct()
    assignment = brands.select(F.col("p_brand").alias("id"), F.substring("p_brand", -1, 1).alias("community"))
    return _rounded(communities.modularity(edges, assignment), "modularity", places=9)


def _code_communities(spark: SparkSession, sf: str) -> DataFrame:
    return communities.louvain(both_directions(_code_edges(spark, sf, 2), "co_count"))


def code_louvain(spark: SparkSession, sf: str) -> DataFrame:
    return _code_communities(spark, sf)


def louvain_check(spark: SparkSession, sf: str) -> DataFrame:
    """(misnamed, split, better): communities not named by their smallest member, those that are not connected, and whether
    the modularity beats that of single nodes."""
    edges = materialize(both_directions(_code_edges(spark, sf, 2), "co_count"), "edges")
    found = materialize(communities.louvain(edges), "communities")
    names = found.groupBy("community").agg(F.min("id").alias("least"))
    misnamed = names.filter("community <> least").count()
    ends = edges.join(found.withColumnRenamed("id", "src"), "src").withColumnRenamed("community", "c")
    inner = ends.join(found.withColumnRenamed("id", "dst"), "dst").filter("c = community").select("src", "dst")
    pieces = connected_components(found.select("id"), inner).select("component").distinct().count()
    alone = found.select("id", F.col("id").alias("community"))
    better = communities.modularity(edges, found).first()[0] > communities.modularity(edges, alone).first()[0]
    return spark.createDataFrame([(misnamed, pieces - names.count(), int(better))], "misnamed bigint, split bigint, better int")


def code_top_communities(spark: SparkSession, sf: str) -> DataFrame:
    return communities.top_communities(_code_communities(spark, sf), orders_graph(spark, sf).nodes("Diagnosis"), "title")


QUERIES = {
    "csv_roundtrip": csv_roundtrip,
    "parquet_roundtrip": parquet_roundtrip,
    "partitioned_pruned_read": partitioned_pruned_read,
    "table_counts": all_table_counts,
    "null_profile": orders_null_profile,
    "key_frequency": supplier_frequency,
    "group_mean_std": price_mean_std,
    "latency_percentiles": event_percentiles,
    "publish_messages": publish_events,
    "event_time_parse": parse_event_times,
    "parse_json_events": parse_events,
    "stream_ingest_notes": stream_ingest_notes,
    "stream_mentions": stream_mentions,
    "nodes_patient": nodes_of("Patient"),
    "nodes_admission": nodes_of("Admission"),
    "nodes_diagnosis": nodes_of("Diagnosis"),
    "nodes_medication": nodes_of("Medication"),
    "nodes_concept": nodes_of("Concept"),
    "nodes_lab_test": nodes_of("LabTest"),
    "nodes_procedure": nodes_of("Procedure"),
    "nodes_caregiver": nodes_of("Caregiver"),
    "nodes_note": nodes_of("ClinicalNote"),
    "nodes_filled": nodes_filled,
    "nodes_with_rank": nodes_with_rank,
    "edges_has_admission": merged_edges_of("HAS_ADMISSION"),
    "edges_same_as": edges_same_as,
    "edges_co_occurs": edges_co_occurs,
    "dangling_edges": dangling_edges,
    "node_upsert_unversioned": node_upsert_unversioned,
    "edge_upsert_properties": edge_upsert_properties,
    "er_title_features": er_title_features,
    "er_title_labels": er_title_labels,
    "er_training_counts": er_training_counts,
    "pairs_lsh_docs_check": pairs_lsh_docs_check,
    "lsh_sweep_truth": lsh_sweep_truth,
    "same_as_check": same_as_check,
    "louvain_check": louvain_check,
    "edges_has_diagnosis": merged_edges_of("HAS_DIAGNOSIS"),
    "edges_prescribed": merged_edges_of("PRESCRIBED"),
    "edges_mentions": merged_edges_of("MENTIONS"),
    "edges_documented_in": edges_documented_in,
    "edges_lab_result": edges_lab_result,
    "node_upsert": node_upsert,
    "node_upsert_versions": node_upsert_versions,
    "edge_upsert_versions": edge_upsert_versions,
    "edge_upsert": edge_upsert,
    "graph_detach_delete": graph_detach_delete,
    "dedup_by_key": dedup_lines,
    "graph_prep_counts": graph_prep_counts,
    "graph_stats": whole_graph_stats,
    "key_uniqueness": key_checks,
    "orphan_checks": orphan_checks,
    "integrity_report": integrity_report,
    "patient_subgraph_counts": patient_subgraph_counts,
    "patient_subgraph_edges": patient_subgraph_edges,
    "q1_shortest_path": q1_shortest_path,
    "q2_differential_dx": q2_differential_dx,
    "q2b_top_diagnoses": q2b_top_diagnoses,
    "q3_similar_cohort": q3_similar_cohort,
    "q4_medication_diagnoses": q4_medication_diagnoses,
    "q5_top_drugs": q5_top_drugs,
    "top_k_per_key": top_k_per_key,
    "join_agg_default": join_agg("default"),
    "join_agg_broadcast": join_agg("broadcast"),
    "join_agg_hash": join_agg("hash"),
    "join_agg_coalesce": join_agg("coalesce"),
    "join_agg_range": join_agg("range"),
    "join_salted": join_agg("salted"),
    "hash_sample": order_sample,
    "token_sets": part_token_sets,
    "block_keys": part_block_keys,
    "code_chapter_lookup": part_chapters,
    "keyword_dictionary": _dictionary,
    "mentions_extract": mentions_extract,
    "mentions_per_note": note_mention_average,
    "span_f1": span_f1,
    "weighted_prf": quality_weighted_prf,
    "sim_jaro_winkler": sim_jaro_winkler,
    "sim_levenshtein": sim_levenshtein,
    "sim_token_jaccard": sim_token_jaccard,
    "er_features_names": er_features_names,
    "er_rule_labels": er_rule_labels,
    "er_gold_labels": er_gold_labels,
    "er_train_metrics": er_train_metrics,
    "same_as_edges": same_as_edges,
    "er_title_train_metrics": er_title_train_metrics,
    "same_as_all_types": same_as_all_types,
    "pairs_bruteforce": pairs_bruteforce,
    "pairs_blocked": pairs_blocked,
    "pairs_exact_jaccard": pairs_exact_jaccard,
    "pairs_lsh": pairs_lsh,
    "pairs_exact_docs": pairs_exact_docs,
    "pairs_lsh_docs": pairs_lsh_docs,
    "copy_links": document_copies,
    "lsh_sweep": item_lsh_sweep,
    "lsh_sweep_pivot": item_lsh_sweep_pivot,
    "er_clusters": er_clusters,
    "cooccurrence": brand_cooccurrence,
    "cooccurrence_pmi": code_cooccurrence_pmi,
    "projection_counts": projections,
    "connected_nodes": code_connected_nodes,
    "wcc": code_components,
    "pagerank_bipartite": pagerank_bipartite,
    "pagerank_cooccurrence": pagerank_cooccurrence,
    "pagerank_top": pagerank_top,
    "modularity": brand_modularity,
    "louvain": code_louvain,
    "top_communities": code_top_communities,
}
