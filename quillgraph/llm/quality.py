"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model's n-grams are of characters (code points), none folded together. All tables - counts, estimates and the
probabilities that the documents need - grow with the texts and stay on Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .textbytes import Texts, texts

#: Steps of a bit in which scores are compared, so that quantiles come from a histogram of bounded size.
STEPS_PER_BIT = 10_000
#: Steps that the histogram sums up before it looks into one such block.
_STEPS = 256
#: Trusted ids up to this number are broadcast to the scan; more are joined by a shuffle, with the same result.
BROADCAST_IDS = 4_000_000
#: Up to so many n-grams, those looked up most often, are broadcast. The others are joined.
HOT = 1 << 19
#: Below all orders, every code point is equally likely.
UNIFORM = 1.0 / 0x110000
#: No probability counts as less: where so little is trusted that nothing is discounted, an unseen n-gram has none left.
LEAST = 1e-30
#: Bits are summed as whole numbers of this part of one, so that sums are the same in any order.
PARTS_OF_BIT = 1 << 20
#: The model of all trusted documents. Models 0 and 1 are trained without the half of that number.
WHOLE = 2
_BLOCK = 1 << 20
_HELD = 1 << 19
_PAD = 32
#: What a scan sends: of each row its sums, under a key that no n-gram has, and its n-grams that are not broadcast.
_SCAN = "doc_id long, mark long, lang string, half int, n_bytes long, rows long, gram string, n long, bits long, apart long"


class Model(NamedTuple):
    """Per order, from 1: (model, gram, share) of the n-grams seen and (model, context, rest) of their contexts.

    ``share`` is the discounted part of the probability and ``rest`` what the context leaves to the next lower order.
    """

    shares: list[DataFrame]
    rests: list[DataFrame]


class Grams(NamedTuple):
    """The n-grams that end at the characters of a group of texts: their strings, and for each character which and in what text."""

    names: np.ndarray
    which: np.ndarray
    doc: np.ndarray


def _points(raw: bytes) -> np.ndarray:
    points = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    return np.where(points == 0, np.uint32(0xFFFD), points)


def grams_of(group: Texts, order: int) -> Grams:
    """The n-grams of a group. The start of a text is padded with spaces; a null character counts as U+FFFD."""
    raw, ends = group.data.tobytes(), group.bounds.tolist()
    each = [_points(raw[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
    sizes = np.array([len(p) for p in each])
    pad = np.full(order - 1, _PAD, np.uint32)
    laid = np.concatenate([part for p in each for part in (pad, p)])
    symbols, alphabet = pd.factorize(laid)
    length = len(laid) - order + 1
    codes, top = symbols[:length].astype(np.int64), len(alphabet)
    for step in range(1, order):
        if top * len(alphabet) >= 1 << 62:
            codes, names = pd.factorize(codes)
            top = len(names)
        codes = codes * len(alphabet) + symbols[step : step + length]
        top *= len(alphabet)
    doc = np.repeat(np.arange(len(each)), sizes)
    starts = np.arange(len(doc)) + doc * (order - 1)
    which, found = pd.factorize(codes[starts])
    first = np.empty(len(found), np.int64)
    first[which[::-1]] = starts[::-1]
    spelt = np.ascontiguousarray(laid[first[:, None] + np.arange(order)])
    names = spelt.view(f"<U{order}").reshape(-1).astype(object) if len(found) else np.empty(0, object)
    return Grams(names, which, doc)


def _halves(group: Texts) -> np.ndarray:
    return group.batch.column(group.batch.schema.get_field_index("half")).to_numpy(zero_copy_only=False)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Names and counts of several groups as one, every name once."""
    at, names = pd.factorize(np.concatenate([names for names, _ in parts]))
    times = np.concatenate([times for _, times in parts])
    return names, np.stack([np.bincount(at, weights=times[:, k], minlength=len(names)) for k in range(3)], axis=1).astype(np.int64)


def gram_counts(given: DataFrame, order: int) -> DataFrame:
    """(gram, half0, half1, other): how often each n-gram occurs in the texts of (doc_id, text, half, ..) rows.

    Apart for the documents of each half of the trusted ones and for all others, whose half is -1. Counted in each task first.
    """
    fields = ["gram", "half0", "half1", "other"]

    def sent(names: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *map(pa.array, times.T)], names=fields)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for group in texts(batches, _BLOCK):
            grams, kind = grams_of(group, order), _halves(group) % 3
            times = np.bincount(grams.which * 3 + kind[grams.doc], minlength=3 * len(grams.names))
            parts.append((grams.names, times.reshape(-1, 3)))
            if sum(len(names) for names, _ in parts) > _HELD:
                parts = [_summed(parts)]
                if len(parts[0][0]) > _HELD // 2:
                    yield sent(*parts.pop())
        if parts:
            yield sent(*_summed(parts))

    found = given.mapInArrow(count, "gram string, half0 long, half1 long, other long")
    return found.groupBy("gram").agg(*[F.sum(c).alias(c) for c in fields[1:]])


def discounts(counts: DataFrame) -> dict[int, list[float]]:
    """By model, what modified Kneser-Ney takes off a count of 1, 2 and of 3 or more, from the numbers of n-grams seen 1 to 4 times."""
    seen = [F.count(F.when(F.col("n") == i, 1)).alias(f"n{i}") for i in (1, 2, 3, 4)]
    out = {}
    for row in counts.groupBy("model").agg(*seen).collect():  # one row for each model
        n1, n2, n3, n4 = (max(1, row[f"n{i}"]) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        out[row["model"]] = [max(0.0, i - (i + 1) * y * b / a) for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return out


def train(counts: DataFrame, order: int) -> Model:
    """The models of (model, gram, n) counts of n-grams of ``order`` characters.

    The highest order counts occurrences, the lower ones in how many different n-grams one longer an n-gram stands at the
    end. Counts are joined with the sums of their contexts, both spread by context; the sums are a written table, so that
    Spark can split a frequent context.
    """
    shares, rests = [], []
    for n in range(order, 0, -1):
        taken = F.lit(0.0)
        for model, d in discounts(counts).items():
            own = F.element_at(F.array(*map(F.lit, d)), F.least(F.col("n"), F.lit(3)).cast("int"))
            taken = F.when(F.col("model") == model, own).otherwise(taken)
        rows = counts.select("model", "gram", "n", taken.alias("d"), F.substring("gram", 1, n - 1).alias("context"))
        sums = rows.groupBy("model", "context").agg(F.sum("n").alias("all"), F.sum("d").alias("off"))
        sums = materialize(sums, "contexts")
        share = ((F.col("n") - F.col("d")) / F.col("all")).alias("share")
        shares.append(materialize(rows.join(sums, ["model", "context"]).select("model", "gram", share), "shares"))
        rests.append(sums.select("model", "context", (F.col("off") / F.col("all")).alias("rest")))
        if n > 1:
            shorter = counts.groupBy("model", F.substring("gram", 2, n - 1).alias("gram"))
            counts = materialize(shorter.agg(F.count(F.lit(1)).alias("n")), "shorter")
    return Model(shares[::-1], rests[::-1])


def probabilities(model: Model, needed: DataFrame) -> DataFrame:
    """(model, gram, p) of the distinct (model, gram) rows: the interpolated probability of the last character after the others.

    From the lowest order up, each n-gram is joined with its share, the rest of its context and the probability of itself
    without its first character.
    """
    order = len(model.shares)
    wanted = [needed.select("model", "gram")]
    for n in range(order - 1, 0, -1):
        shorter = wanted[0].select("model", F.substring("gram", 2, n).alias("gram")).distinct()
        wanted.insert(0, materialize(shorter, "wanted"))
    lower = None
    for n, (rows, share, rest) in enumerate(zip(wanted, model.shares, model.rests, strict=True), 1):
        rows = rows.join(share, ["model", "gram"], "left").withColumn("context", F.substring("gram", 1, n - 1))
        rows = rows.join(rest, ["model", "context"], "left")
        below = F.lit(UNIFORM)
        if lower is not None:
            rows = rows.withColumn("end", F.substring("gram", 2, n - 1))
            rows = rows.join(lower.select("model", F.col("gram").alias("end"), F.col("p").alias("below")), ["model", "end"])
            below = F.col("below")
        p = F.coalesce("share", F.lit(0.0)) + F.coalesce("rest", F.lit(1.0)) * below
        lower = materialize(rows.select("model", "gram", p.alias("p")), "probabilities")
    return lower


def _by_model(counts: DataFrame, *n: Column) -> DataFrame:
    """(model, gram, n) of the n-grams of (gram, ..) rows for models 0, 1 and 2, where ``n`` is not 0."""
    rows = [F.struct(F.lit(m).alias("model"), times.alias("n")) for m, times in enumerate(n)]
    return counts.select("gram", F.explode(F.array(*rows)).alias("r")).select("r.model", "gram", "r.n").filter("n > 0")


def gram_bits(counts: DataFrame, order: int) -> DataFrame:
    """(gram, n, bits0, bits1, bits2) of every n-gram of (gram, half0, half1, other) counts.

    Each half is looked up in the model trained without it, and all documents in the model of both; a null means that a
    model is not asked. ``n`` is how often the n-gram occurs; bits are in ``PARTS_OF_BIT``.
    """
    one, two = F.col("half0"), F.col("half1")
    training = materialize(_by_model(counts, two, one, one + two), "training")
    needed = materialize(_by_model(counts, one, two, one + two + F.col("other")), "needed")
    found = probabilities(train(training, order), needed)
    bits = F.round(-F.log2(F.greatest("p", F.lit(LEAST))) * PARTS_OF_BIT).cast("long")
    rows = needed.join(found, ["model", "gram"]).withColumn("bits", bits).groupBy("gram")
    every = F.max(F.when(F.col("model") == WHOLE, F.col("n"))).alias("n")
    return rows.agg(every, *[F.max(F.when(F.col("model") == m, F.col("bits"))).alias(f"bits{m}") for m in range(3)])


def least_frequent(bits: DataFrame, hot: int) -> int | None:
    """The least ``n`` of the most frequent n-grams, of which there are at most ``hot``; null for none. From classes of ``n``."""
    classes = bits.groupBy(F.floor(F.log2("n") * 16).alias("class")).agg(F.count(F.lit(1)).alias("grams"), F.min("n").alias("least"))
    out, held = None, 0
    for row in sorted(classes.collect(), reverse=True):  # at most 64 * 16
        held += row["grams"]
        if held > hot:
            break
        out = row["least"]
    return out


def score(given: DataFrame, bits: DataFrame, order: int, hot: int = HOT) -> DataFrame:
    """(doc_id, mark, lang, half, n_bytes, rows, bits, apart) of the different (doc_id, mark) of (doc_id, text, lang, mark, half) rows.

    ``rows`` is how many rows there are of it, ``bits`` the mean bits a byte by the whole model and ``apart`` by the one that
    was trained without the document's half; null for an empty text, or without a half.

    The scan adds up the n-grams that occur most often, at most ``hot``, which are broadcast. Of the others a document sends
    each once, with its count, to be joined; none of these is frequent. Sums are of whole numbers, so the result does not
    depend on ``hot``.
    """
    spark = given.sparkSession
    least = least_frequent(bits, hot)
    frequent = F.lit(False) if least is None else F.col("n") >= least
    common = bits.filter(frequent).select("gram", *[F.coalesce(f"bits{m}", F.lit(0)).cast("int").alias(f"bits{m}") for m in range(3)]).toArrow()
    shared = spark.sparkContext.broadcast(common)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = pd.Index(shared.value.column("gram").to_numpy(), dtype=object)
        cost = np.zeros((len(index) + 1, 3), np.int32)
        for m in range(3):
            cost[:-1, m] = shared.value.column(f"bits{m}").to_numpy()
        for group in texts(batches, _BLOCK):
            grams, halves = grams_of(group, order), _halves(group)
            lang, mark, half = (group.batch.column(group.batch.schema.get_field_index(c)) for c in ("lang", "mark", "half"))
            at, count, kinds = index.get_indexer(grams.names), len(group.ids), max(1, len(grams.names))
            sums = [np.bincount(grams.doc, weights=cost[at, m][grams.which], minlength=count).astype(np.int64) for m in range(3)]
            apart = np.where(halves == 0, sums[0], np.where(halves == 1, sums[1], 0))
            salt = pa.array([f"{m:x}" for m in mark.to_pylist()], pa.string())
            ones, none = pa.array(np.ones(count, np.int64)), pa.nulls(count, pa.int64())
            whole = [group.batch.column(0), mark, lang, half, pa.array(np.diff(group.bounds)), ones, salt, none, pa.array(sums[WHOLE]), pa.array(apart)]
            yield pa.RecordBatch.from_arrays(whole, names=fields)
            sent = np.flatnonzero((at < 0)[grams.which])
            if len(sent):
                pairs, times = np.unique(grams.doc[sent] * kinds + grams.which[sent], return_counts=True)
                own, named, none = pa.array(pairs // kinds), pa.array(grams.names[pairs % kinds].tolist()), pa.nulls(len(pairs), pa.int64())
                part = [group.batch.column(0).take(own), mark.take(own), pa.nulls(len(pairs), pa.string()), half.take(own)]
                yield pa.RecordBatch.from_arrays([*part, none, none, named, pa.array(times), none, none], names=fields)

    fields = [field.split()[0] for field in _SCAN.split(", ")]
    found = given.select("doc_id", "text", "lang", "mark", "half").mapInArrow(rate, _SCAN)
    others = bits.filter(~frequent).select("gram", *[f"bits{m}" for m in range(3)])
    joined = found.join(others, "gram", "left")
    own = F.when(F.col("half") == 0, F.col("bits0")).when(F.col("half") == 1, F.col("bits1"))
    sums = joined.groupBy("doc_id", "mark").agg(
        *[F.max(c).alias(c) for c in ("lang", "half", "n_bytes")],
        F.sum("rows").alias("rows"),
        F.sum(F.coalesce("bits", F.col("n") * F.col("bits2"))).alias("bits"),
        F.sum(F.coalesce("apart", F.col("n") * own)).alias("apart"),
    )
    each = F.when(F.col("n_bytes") > 0, F.col("rows") * F.col("n_bytes") * F.lit(float(PARTS_OF_BIT)))
    apart = F.when(F.col("half") >= 0, F.col("apart") / each).alias("apart")
    return sums.select("doc_id", "mark", "lang", "half", "n_bytes", "rows", (F.col("bits") / each).alias("bits"), apart)


def trusted_ids(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id) of the documents whose labels all say good quality and none says toxic."""
    rows = labels.groupBy(F.col(id_col).cast("long").alias("doc_id"))
    judged = rows.agg(F.min(F.coalesce("quality", F.lit(0))).alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
    return judged.filter((F.col("q") == 1) & (F.col("t") == 0) & F.col("doc_id").isNotNull()).select("doc_id")


def _step(bits: Column) -> Column:
    return F.ceil(bits * STEPS_PER_BIT)


def few_rows(rows: Column, quantile: float) -> Column:
    """Whether so few rows cannot carry the quantile, which is then no more than their maximum."""
    return rows * (1.0 - quantile) < 1 - 1e-9


def thresholds(scores: DataFrame, quantile: float) -> DataFrame:
    """(lang, all, middle, limit, most): for each language, and for a null one over all, its rows and three steps of theirs.

    ``middle`` is the least step that half of the rows do not exceed, ``limit`` the least that ``quantile`` of them do not,
    ``most`` the largest. From (lang, bits, rows) through a histogram of (language, step). Steps are summed up in blocks
    first, and only the steps of one block meet in a window.
    """
    steps = scores.filter("bits IS NOT NULL").select("lang", "rows", _step(F.col("bits")).alias("step"))
    every = F.explode(F.when(F.col("lang").isNull(), F.array(F.lit(None))).otherwise(F.array("lang", F.lit(None))))
    counted = steps.groupBy("lang", "step").agg(F.sum("rows").alias("n")).select(every.alias("lang"), "step", "n")
    block = F.floor(F.col("step") / _STEPS).alias("block")
    counted = materialize(counted.groupBy("lang", "step").agg(F.sum("n").alias("n")).select("*", block), "steps")
    blocks = counted.groupBy("lang", "block").agg(F.sum("n").alias("m"))
    upto = Window.partitionBy("lang").orderBy("block")
    blocks = blocks.select(
        "lang", "block", F.sum("m").over(Window.partitionBy("lang")).alias("all"), (F.sum("m").over(upto) - F.col("m")).alias("before")
    )
    within = Window.partitionBy("lang", "block").orderBy("step")
    sums = counted.select("lang", "block", "step", F.sum("n").over(within).alias("inside"))
    met = sums.alias("s").join(blocks.alias("b"), F.col("s.lang").eqNullSafe(F.col("b.lang")) & (F.col("s.block") == F.col("b.block")))
    met = met.select("s.lang", "step", "all", (F.col("inside") + F.col("before")).alias("upto"))

    def reached(share: float) -> Column:
        return F.min(F.when(F.col("upto") >= F.col("all") * share, F.col("step")))

    return met.groupBy("lang").agg(
        F.max("all").alias("all"), reached(0.5).alias("middle"), reached(quantile).alias("limit"), F.max("step").alias("most")
    )


def limits_of(scores: DataFrame, quantile: float) -> DataFrame:
    """(lang, limit) from the scores of the trusted documents; a null language is all of them.

    They are scored by models that did not see them. A language with fewer than ``1 / (1 - quantile)`` documents takes the
    largest of the maximum of these, the limit over all, and their median plus the distance from the median over all to
    that limit.
    """
    apart = scores.filter("half >= 0").select("lang", F.col("apart").alias("bits"), "rows")
    found = materialize(thresholds(apart, quantile), "quantiles")
    overall = found.filter("lang IS NULL").first()
    if overall is None:
        return found.select("lang", "limit")
    wider = F.greatest(F.col("most"), F.lit(overall["limit"]), F.col("middle") + F.lit(overall["limit"] - overall["middle"]))
    few = few_rows(F.col("all"), quantile) & F.col("lang").isNotNull()
    return found.select("lang", F.when(few, wider).otherwise(F.col("limit")).alias("limit"))


def _marked(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(doc_id, text, lang, mark): a row's mark tells it from others of its id."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lang = F.col(lang_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), lang.alias("lang"), F.xxhash64(text, lang).alias("mark"))
    return rows.filter("doc_id IS NOT NULL")


def judge(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str, order: int, quantile: float, hot: int = HOT
) -> DataFrame:
    """(doc_id, mark, lang, n_bytes, rows, perplexity, limit, keep): the scores of all documents against their languages' limits.

    Trains on the documents that the labels trust, each half apart and both together, and takes the limits from them.
    """
    ids = materialize(trusted_ids(labels), "trusted").withColumn("half", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int"))
    good = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    given = _marked(docs, id_col, text_col, lang_col).join(good, "doc_id", "left")
    given = given.withColumn("half", F.coalesce("half", F.lit(-1)))
    counts = materialize(gram_counts(given.select("doc_id", "text", "half"), order), "grams")
    bits = materialize(gram_bits(counts, order), "bits")
    scores = materialize(score(given, bits, order, hot), "scores")
    limits = materialize(limits_of(scores, quantile), "limits")
    overall = limits.filter("lang IS NULL").first()
    own = limits.filter("lang IS NOT NULL").withColumnRenamed("limit", "own")
    limit = F.coalesce("own", F.lit(overall["limit"] if overall else None).cast("long"))
    return scores.join(own, "lang", "left").select(
        *["doc_id", "mark", "lang", "n_bytes", "rows"],
        F.pow(F.lit(2.0), "bits").alias("perplexity"),
        F.pow(F.lit(2.0), limit / STEPS_PER_BIT).alias("limit"),
        F.coalesce(_step(F.col("bits")) <= limit, F.lit(True)).alias("keep"),
    )


def classify_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    order: int = 4,
    quantile: float = 0.995,
    hot: int = HOT,
) -> DataFrame:
    """(doc_id, lang, n_bytes, perplexity, limit, keep) of every document.

    The model is trained on the whole text of every document that ``labels`` (doc_id, quality, toxic) trust. A document
    is kept if its perplexity a byte is no more than what the ``quantile`` of the trusted documents of its language stay
    within, each scored by a model of the other half of them; a language without trusted documents, or none, takes the
    limit over all of them, and one with fewer than ``1 / (1 - quantile)`` a limit no lower than that (:func:`limits_of`).

    An empty or null text has no perplexity and is kept, as are all documents if none is trusted. Rows without an id are
    left out; rows that repeat an id are judged each. Other columns are not read. An empty table gives an empty result.
    """
    found = judge(docs, labels, id_col, text_col, lang_col, order, quantile, hot)
    again = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    return again.select("doc_id", "lang", "n_bytes", "perplexity", "limit", "keep")


def keep_good(docs: DataFrame, labels: DataFrame, order: int = 4, quantile: float = 0.995) -> DataFrame:
    """The rows of (doc_id, text, lang, ..) documents that :func:`classify_quality` keeps, with all their columns.

    They are joined with what goes, the minority. Rows without an id are left out.
    """
    gone = judge(docs, labels, "doc_id", "text", "lang", order, quantile).filter("NOT keep").select("doc_id", "mark")
    gone = materialize(gone, "rejected")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text, F.col("lang").cast("string")).alias("mark")
    )
    return rows.filter("doc_id IS NOT NULL").join(gone, ["doc_id", "mark"], "left_anti").select("row.*")
