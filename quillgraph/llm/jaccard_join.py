"""Join of documents whose word n-gram sets have a high Jaccard similarity: size-aware, heavy and light sets apart."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.components import connected_components
from ..session import drop_materialized, materialize, result_only
from .set_links import links_of, pairs_around, reaches
from .sharing import ask_elsewhere
from .textbytes import Texts, mix, texts, word_hashes, words

_SETS = "rep long, mark binary, n long, tokens array<long>"


def shingle_sets(group: Texts, shingle: int) -> Iterator[np.ndarray]:
    """Each document's distinct shingle hashes in ascending order; fewer words than ``shingle`` make one, none makes none."""
    starts, ends, first = words(group.data, group.bounds)
    hashes = word_hashes(group.data, starts, ends, lower=True)
    factors = mix(np.arange(1, shingle + 2, dtype=np.uint64)) | np.uint64(1)
    whole = np.zeros(max(0, len(hashes) - shingle + 1), np.uint64)
    for i in range(shingle):
        whole += hashes[i : i + len(whole)] * factors[i]
    whole = mix(whole)
    for low, high in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if high - low >= shingle:
            found = np.sort(whole[low : high - shingle + 1])
            yield found[np.concatenate(([True], found[1:] != found[:-1]))]
        elif high > low:
            few = np.append(hashes[low:high], np.uint64(high - low))
            yield mix((few * np.append(factors[: high - low], factors[shingle])).sum(keepdims=True))
        else:
            yield hashes[:0]


def set_mark(tokens: np.ndarray) -> bytes:
    """A 128-bit hash of a set."""
    return xxhash.xxh3_128_digest(tokens.tobytes())


def token_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(rep, mark, n, tokens): the sets of the (doc_id, mark) rows that are wanted, from (doc_id, text) rows."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in texts(batches):
            found = list(shingle_sets(group, shingle))
            marks = group.batch.column(2).to_pylist()
            rows = [i for i, tokens in enumerate(found) if set_mark(tokens) == marks[i]]
            if rows:
                ends = np.cumsum([0, *(len(found[i]) for i in rows)]).astype(np.int32)
                flat = np.concatenate([found[i] for i in rows]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(group.ids[rows], pa.int64()),
                        pa.array([marks[i] for i in rows], pa.binary()),
                        pa.array(np.diff(ends).astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    ],
                    names=["rep", "mark", "n", "tokens"],
                )

    rows = docs.join(wanted, "doc_id").select("doc_id", "text", "mark").mapInArrow(gather, _SETS)
    return rows.dropDuplicates(["rep"])  # rows that repeat an id and a text


def set_profiles(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(doc_id, n, mark, lone) of (doc_id, text) rows: the set's size, a 128-bit hash of it, and a number of tokens of its own.

    ``lone`` counts, among the smallest hashes of the set, those that no other document has. The part looked at is over
    twice as long as the number of tokens a set may lack in a partner, so most sets that resemble none exceed it.
    """

    def keys_of(group: Texts) -> Iterator[tuple[int, bytes, np.ndarray]]:
        for tokens in shingle_sets(group, shingle):
            yield len(tokens), set_mark(tokens), tokens[: 2 * (len(tokens) * (100 - percent) // 100) + 2]

    answers = ask_elsewhere(docs, keys_of, lone=True)
    one = answers.groupBy("doc_id").agg(F.max(F.struct("n", "mark", "lone")).alias("s"))
    return one.select("doc_id", "s.n", "s.mark", "s.lone")


def _allowed(n: Column, percent: int) -> Column:
    """How many tokens a set of n may lack in any set that it is linked with."""
    return F.floor(n * (100 - percent) / 100).cast("int")


def ranked_sets(sets: DataFrame) -> DataFrame:
    """(rep, n, ranked): every set's tokens that other sets have too, rarest first, as (count, token).

    The tokens that are left out are the rarest of all: ``n`` minus the length of ``ranked`` of them come before it.
    """
    each = sets.select("rep", "n", F.explode("tokens").alias("token"))
    counts = materialize(each.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "token-counts")
    held = each.join(counts, "token").groupBy("rep", "n")
    ranked = materialize(held.agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("ranked")), "ranked")
    drop_materialized(counts)
    return ranked


def boundary(ranked: DataFrame, percent: int, entry: int = 4) -> int:
    """The size up to which pairs of prefix tokens are cheaper than scanning the lists of single ones.

    For every class of sizes (powers of 1.1, so a bounded number of rows comes to the driver) the two costs are summed:
    the number of pairs in the prefix that has two tokens in common with every partner, and the entries of the lists
    of the prefix that has one, times ``entry``: as single tokens are in more sets than pairs are, most entries
    lead to a comparison with the list's pivot.
    """
    lone = F.col("n") - F.size("ranked")
    one = F.greatest(_allowed(F.col("n"), percent) + 1 - lone, F.lit(0)).cast("long")
    two = F.greatest(_allowed(F.col("n"), percent) + 2 - lone, F.lit(0)).cast("long")
    lists = one * entry
    size_class = F.floor(F.log(F.col("n")) / F.log(F.lit(1.1)))
    rows = (
        ranked.select(size_class.alias("class"), "n", (two * (two - 1) / 2).alias("subsets"), lists.alias("lists"))
        .groupBy("class")
        .agg(F.max("n").alias("upto"), F.sum("subsets").alias("subsets"), F.sum("lists").alias("lists"))
        .orderBy("class")
        .collect()
    )
    best, at, cost = 0.0, 0, 0.0
    for row in rows:
        cost += row["subsets"] - row["lists"]
        if cost < best:
            best, at = cost, row["upto"]
    return at


def prefix_keys(ranked: DataFrame, percent: int, light: int) -> DataFrame:
    """(key, pairs, rep, n, lone, apart): the keys of which two linked sets share one at least.

    Two light sets, up to ``light`` tokens, share two tokens of their longer prefix, so all its pairs are
    their keys. A heavy set shares one token of its prefix with any partner; light sets large enough to be one join its lists.
    ``apart`` is less, the more sets a set's tokens are in on average.
    """
    allowed, lone = _allowed(F.col("n"), percent), F.col("n") - F.size("ranked")
    spread = F.aggregate("ranked", F.lit(0).cast("long"), lambda s, t: s + t["df"])
    about = ["rep", "n", lone.alias("lone"), (-spread / F.col("n")).alias("apart")]
    one = F.slice("ranked", 1, F.greatest(allowed + 1 - lone, F.lit(0)).cast("int"))
    two = F.transform(F.slice("ranked", 1, F.greatest(allowed + 2 - lone, F.lit(0)).cast("int")), lambda t: t["token"])
    tails = F.transform(two, lambda t, i: F.struct(t.alias("a"), F.slice(two, i + 2, F.size(two)).alias("rest")))
    pairs = F.flatten(F.transform(tails, lambda x: F.transform(x["rest"], lambda b: F.xxhash64(F.least(x["a"], b), F.greatest(x["a"], b)))))
    small = ranked.filter(F.col("n") <= light).select(F.explode(pairs).alias("key"), F.lit(True).alias("pairs"), *about)
    near = ranked.filter(F.col("n") * 100 >= light * percent)
    large = near.select(F.explode(F.transform(one, lambda t: t["token"])).alias("key"), F.lit(False).alias("pairs"), *about)
    return small.unionByName(large)


def _may_link(a: str, b: str, percent: int) -> Column:
    """Whether two sets can be linked: neither has more in common with the other than it has with all sets."""
    most = F.least(F.col(f"n_{a}") - F.col(f"lone_{a}"), F.col(f"n_{b}") - F.col(f"lone_{b}"))
    return reaches(most, F.col(f"n_{a}"), F.col(f"n_{b}"), percent)


@result_only("near-copies")
def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, percent: int = 85
) -> DataFrame:
    """(doc_id, n_shingles, component_id): the size of every document's shingle set and the smallest id its links reach.

    Two documents are linked when the common shingles are at least ``percent`` hundredths of the union. Words are runs of
    characters other than ASCII white space, with A-Z lower-cased; a shingle is ``shingle`` consecutive words.

    1. One scan gives each set's size and hash and asks, for the smallest hashes of each set, which occur elsewhere. A set
       that has more tokens of its own than a link allows is linked with no other set and is left at that.
    2. Equal sets are one from here on. The sets still open are ordered by how rare their tokens are among them.
    3. Light and heavy sets get their keys (:func:`prefix_keys`), the boundary chosen by :func:`boundary`.
    4. First every set of a key is compared with one of them only, its pivot, that whose tokens most sets have. Where a key still
       has sets of several components, those that may be linked with each other are found from their differences with
       the pivot (:func:`quillgraph.llm.set_links.pairs_around`). Nothing else can change a component, so none of a
       group's other pairs is formed.

    A null text counts as empty; a document without words has no shingles and is its own component. Rows without an id
    are left out; rows that repeat an id are one document, that of the largest set. Other columns are not read. An empty table
    gives an empty result.
    """
    given = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).filter("doc_id IS NOT NULL")
    profiles = materialize(set_profiles(given, shingle, percent), "profiles")
    groups = profiles.filter("n > 0").groupBy("mark").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.min("lone").alias("lone")
    )
    open_ = groups.filter(F.col("lone") <= _allowed(F.col("n"), percent)).select(F.col("rep").alias("doc_id"), "mark")

    sets = materialize(token_sets(given, open_, shingle), "sets")
    ranked = ranked_sets(sets.select("rep", "n", "tokens"))
    keys = materialize(prefix_keys(ranked, percent, boundary(ranked, percent)), "keys")

    own = F.min(F.struct("apart", "rep", "n", "lone")).alias("p")
    pivots = keys.groupBy("key", "pairs").agg(own, F.count(F.lit(1)).alias("m")).filter("m > 1")
    pivots = materialize(
        pivots.select("key", "pairs", F.col("p.rep").alias("a"), F.col("p.n").alias("n_a"), F.col("p.lone").alias("lone_a")),
        "pivots",
    )
    member = keys.select("key", "pairs", F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("lone").alias("lone_b"))
    star = member.join(pivots, ["key", "pairs"]).filter((F.col("a") != F.col("b")) & _may_link("a", "b", percent))
    star = materialize(star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "stars")
    links = materialize(links_of(star, sets, percent), "links")
    nodes = sets.select(F.col("rep").alias("id"))
    ends = links.select(F.col("a").alias("src"), F.col("b").alias("dst"))
    first = materialize(connected_components(nodes, ends), "components")

    placed = keys.join(first.withColumnRenamed("id", "rep"), "rep")
    mixed = placed.groupBy("key", "pairs").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = mixed.filter("low < high").join(pivots, ["key", "pairs"]).select("key", "pairs", F.col("a").alias("pivot"))
    mixed = materialize(mixed, "mixed")
    members = placed.join(mixed, ["key", "pairs"]).select("pivot", "rep", "component").distinct()
    across = pairs_around(members, sets, percent)
    more = materialize(links_of(across, sets, percent), "more-links")
    last = first
    if not more.isEmpty():
        ends = links.unionByName(more).select(F.col("a").alias("src"), F.col("b").alias("dst"))
        last = connected_components(nodes, ends)

    named = groups.select("mark", "rep").join(last.withColumnRenamed("id", "rep"), "rep", "left")
    named = materialize(named.select("mark", F.coalesce("component", "rep").alias("component_id")), "marks")
    for done in (sets, ranked, keys, pivots, star, links, first, mixed, across, more):
        drop_materialized(done)
    out = profiles.join(named, "mark", "left")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
