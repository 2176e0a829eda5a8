"""Entity resolution: candidates, features, labels, a random forest, same-as edges and clusters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import md5_number
from ..functions.similarity import levenshtein_similarity, same_first_word, same_prefix, set_jaccard, token_jaccard, with_jaro_winkler
from ..functions.text import token_set
from ..operators.quantiles import smallest
from ..operators.setjoin import distinct_sets, similar_sets, similar_sets_lsh
from ..operators.spans import weighted_scores
from ..session import materialize, materialize_measured
from ..sources.files import path_exists
from .components import connected_components

FEATURES = ["jw", "lev", "token_overlap", "jaccard_sim", "same_code"]


@dataclass(frozen=True)
class LabelRule:
    """Thresholds of the heuristic labels. Those below are fixed values, which decide what the labels mean."""

    positive_jw: float
    negative_jw: float
    negative_overlap: float
    negatives_per_positive: int = 3


MEDICATION_RULE = LabelRule(positive_jw=0.9, negative_jw=0.5, negative_overlap=0.2)
DIAGNOSIS_RULE = LabelRule(positive_jw=0.92, negative_jw=0.4, negative_overlap=0.1)


def entities(df: DataFrame, id_col: str, name: Column, **properties: Column) -> DataFrame:
    """(id, name, tokens, properties): one row per distinct name, that of its smallest id. Null names are left out."""
    rows = df.select(F.col(id_col).alias("id"), name.alias("name"), *[c.alias(k) for k, c in properties.items()])
    per_name = (
        rows.filter(F.col("id").isNotNull() & F.col("name").isNotNull())
        .groupBy("name")
        .agg(F.min("id").alias("id"), *[F.min_by(k, "id").alias(k) for k in properties])
    )
    return per_name.select("id", "name", token_set(F.col("name")).alias("tokens"), *properties)


def block_pairs(things: DataFrame, max_distance: float, lsh: bool = True, **knobs) -> DataFrame:
    """(id_a, id_b, jaccard_dist) over entities whose token sets are closer than ``max_distance``."""
    sets = materialize(distinct_sets(things, "id", "tokens"), "token-sets")
    found = similar_sets_lsh(sets, max_distance, **knobs) if lsh else similar_sets(sets, max_distance)
    return found.select("id_a", "id_b", "jaccard_dist")


def probe_pairs(things: DataFrame, probes: int) -> DataFrame:
    """(id_a, id_b): about ``probes`` random partners per entity, the same ones on every run.

    Every entity draws ``probes`` slots among as many slots as there are entities, and meets the entities whose own hash falls
    in them. These pairs supply the clear non-matches that candidate search, by its nature, does not find.
    """
    total = things.count()
    if total == 0:
        return things.select(F.col("id").alias("id_a"), F.col("id").alias("id_b"))
    slots = F.lit(total)
    drawn = things.select(
        F.col("id").alias("x"), F.explode(F.sequence(F.lit(1), F.lit(probes))).alias("draw")
    ).select("x", (md5_number("x", "draw") % slots).alias("slot"))
    homes = things.select(F.col("id").alias("y"), (md5_number("id") % slots).alias("slot"))
    met = drawn.join(homes, "slot").filter("x <> y")
    return met.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()


def pair_names(pairs: DataFrame, things: DataFrame, *properties: str) -> DataFrame:
    """Attach the name and properties of both entities of a pair, with suffixes ``_a`` and ``_b``."""
    out = pairs
    for side in ("a", "b"):
        named = things.select(
            F.col("id").alias(f"id_{side}"),
            F.col("name").alias(f"name_{side}"),
            *[F.col(p).alias(f"{p}_{side}") for p in properties],
        )
        out = out.join(named, f"id_{side}")
    return out


def candidate_pairs(things: DataFrame, max_distance: float, probes: int, *properties: str) -> DataFrame:
    """(id_a, id_b, jaccard_dist, names and properties of both): all similar pairs, and some random ones without a distance.

    The names of similar pairs come along with the sets, and of a random pair its own sets tell whether it is a similar one, so
    similar pairs, of which there may be very many, are not shuffled. Only ids that stand for several names need that: the
    pairs are merged by id then, before they get all names of an id.
    """
    things = materialize(things, "things")
    random = probe_pairs(things, probes)
    if not things.groupBy("id").count().filter("count > 1").isEmpty():
        similar = block_pairs(things, max_distance, lsh=False)
        pairs = similar.unionByName(random.withColumn("jaccard_dist", F.lit(None).cast("double")))
        return pair_names(pairs.groupBy("id_a", "id_b").agg(F.max("jaccard_dist").alias("jaccard_dist")), things, *properties)
    sets = materialize(distinct_sets(things, "id", "tokens"), "token-sets")
    carry = ["name", *properties]
    similar = similar_sets(materialize(sets.join(things.drop("tokens"), "id"), "named-sets"), max_distance, carry=carry)
    stands = things.join(sets.select("id", F.lit(True).alias("stands")), "id", "left")
    distance = 1.0 - set_jaccard(F.col("tokens_a"), F.col("tokens_b"))
    known = F.coalesce(F.col("stands_a") & F.col("stands_b") & (distance < max_distance), F.lit(False))
    other = pair_names(random, stands, "tokens", "stands", *properties).filter(~known)
    return similar.unionByName(other.drop("tokens_a", "tokens_b", "stands_a", "stands_b"), allowMissingColumns=True)


def pair_features(named: DataFrame, code: str, prefix: int, strip: str | None = None) -> DataFrame:
    """The feature row of every pair; ``code`` is the property whose prefix decides ``same_code``.

    ``named`` has a ``jaccard_dist`` per pair, or null where the pair came from no set join. The label is left open.
    """
    a, b = F.col("name_a"), F.col("name_b")
    overlap = F.col("token_overlap")
    scored = with_jaro_winkler(named, "name_a", "name_b", "jw").withColumn("token_overlap", token_jaccard(a, b))
    return scored.select(
        "id_a",
        "id_b",
        "jw",
        levenshtein_similarity(a, b).alias("lev"),
        overlap,
        F.coalesce(1.0 - F.col("jaccard_dist"), overlap).alias("jaccard_sim"),
        same_prefix(F.col(f"{code}_a"), F.col(f"{code}_b"), prefix, strip).alias("same_code"),
        F.lit(None).cast("double").alias("label"),
        *[c for c in named.columns if c.startswith("name_")],
    )


def name_rule(jw: Column, a: Column, b: Column) -> Column:
    """1.0 where names are nearly equal and start with the same word (0.88 is a fixed value)."""
    return ((jw > 0.88) & same_first_word(a, b)).cast("double")


def family_rule(same_code: Column, overlap: Column) -> Column:
    """1.0 where two entries share a category or at least 40 % of their words (a fixed value)."""
    return ((same_code == 1.0) | (overlap >= 0.4)).cast("double")


def _cap_by_hash(rows: DataFrame, limit: int) -> DataFrame:
    scored = rows.withColumn("_score", md5_number("id_a", "id_b"))
    return smallest(scored, "_score", limit).drop("_score")


def gold_labels(features: DataFrame, rule: LabelRule) -> DataFrame:
    """Heuristic labels: alike pairs with the same code are positive, clearly different ones negative.

    Negatives are capped at a multiple of the positives, in the order of a hash of the pair.
    """
    overlap = F.col("token_overlap") < rule.negative_overlap
    # decided by what costs little: pairs that can be neither are not scored, nor written
    features = materialize(features.filter((F.col("same_code") == 1.0) | overlap), "features")
    positive = features.filter((F.col("same_code") == 1.0) & (F.col("jw") > rule.positive_jw))
    negative = features.filter((F.col("jw") < rule.negative_jw) & overlap)
    capped = _cap_by_hash(negative, rule.negatives_per_positive * positive.count())
    return positive.withColumn("label", F.lit(1.0)).unionByName(capped.withColumn("label", F.lit(0.0)))


def sampled_labels(
    labelled: DataFrame, negatives_per_positive: int = 4, least_negatives: int = 20, written: bool = False
) -> DataFrame:
    """All positives, and a bounded sample of the negatives, in the order of a hash.

    There are ``negatives_per_positive`` of them for each positive, but no fewer than ``least_negatives`` if there are as many. If all
    of them fit, none has to be ordered. ``written`` says that the pairs are read from a table, so that they are not written again.
    """
    labelled = labelled if written else materialize(labelled, "labelled")
    seen = labelled.agg(F.count_if(F.col("label") == 1.0).alias("positives"), F.count_if(F.col("label") == 0.0).alias("negatives")).first()
    limit = max(negatives_per_positive * seen["positives"], least_negatives)
    if seen["negatives"] <= limit:
        return labelled.filter("label IN (0, 1)")
    return labelled.filter("label = 1").unionByName(_cap_by_hash(labelled.filter("label = 0"), limit))


def held_out(a: str = "id_a", b: str = "id_b") -> Column:
    """True for the fifth of all pairs that a hash keeps from training."""
    return md5_number(a, b, digits=7) % 100 >= 80


def labels_or_heuristic(spark, path: str, features: DataFrame, rule: LabelRule) -> tuple[DataFrame, str]:
    """A table of manual labels if there is one, else heuristic labels; and which of the two it is."""
    if path_exists(spark, path):
        return spark.read.parquet(path), "manual"
    return gold_labels(features, rule), "heuristic"


def train_matcher(
    labelled: DataFrame,
    entity_type: str,
    label_source: str,
    columns: list[str] = FEATURES,
    trees: int = 100,
    depth: int = 8,
    seed: int = 42,
    holdout: bool = True,
) -> tuple[PipelineModel, DataFrame]:
    """A random forest, and one row of metrics on the fifth of the pairs that :func:`held_out` keeps from training.

    With ``holdout`` off, for very few labels, the metrics are those of the training pairs, and ``in_sample`` tells so. The
    labels are functions of the features, so high scores say that the forest learnt the rule, not that the rule is right.
    """
    data, seen = materialize_measured(
        labelled.select("id_a", "id_b", *columns, "label", held_out().alias("held_out"))
        .repartition(F.col("id_a"), F.col("id_b"))
        .sortWithinPartitions("id_a", "id_b"),
        "training",
        positives=F.count_if(F.col("label") == 1.0),
        total=F.count(F.lit(1)),
    )
    train = data.filter(~F.col("held_out")) if holdout else data
    test = data.filter("held_out") if holdout else data
    assembler = VectorAssembler(inputCols=columns, outputCol="features_vec")
    forest = RandomForestClassifier(featuresCol="features_vec", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed)
    model = Pipeline(stages=[assembler, forest]).fit(train)
    chance = F.get(vector_to_array("probability"), F.lit(1)).alias("chance")
    predicted = materialize(model.transform(test).select("label", chance, "prediction"), "predicted")
    auc = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="chance").evaluate(predicted)
    metrics = weighted_scores(predicted, "label", "prediction").select(
        F.lit(entity_type).alias("entity_type"),
        F.lit(seen["positives"]).cast("bigint").alias("positives"),
        F.lit(seen["total"] - seen["positives"]).cast("bigint").alias("negatives"),
        F.lit(float(auc)).alias("auc"),
        "weighted_precision",
        "weighted_recall",
        "weighted_f1",
        F.lit(label_source).alias("label_source"),
        F.lit(not holdout).alias("in_sample"),
    )
    return model, metrics


def same_as(model: PipelineModel, features: DataFrame, entity_type: str) -> DataFrame:
    """(id_a, id_b, confidence, entity_type) of all pairs the model takes for the same entity."""
    scored = model.transform(features).filter(F.col("prediction") == 1.0)
    confidence = F.get(vector_to_array("probability"), F.lit(1))
    return scored.select("id_a", "id_b", confidence.alias("confidence"), F.lit(entity_type).alias("entity_type"))


def entity_clusters(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, cluster): entities joined by same-as edges (id_a, id_b) share the smallest id of their group."""
    links = edges.select(F.col("id_a").alias("src"), F.col("id_b").alias("dst"))
    return connected_components(nodes, links).withColumnRenamed("component", "cluster")
