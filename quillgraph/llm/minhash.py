"""Near duplicates by one-permutation MinHash: optimal densification, banded buckets, star-shaped candidate edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.components import connected_components
from ..session import drop_materialized, materialize, result_only
from .jaccard_join import set_mark, shingle_sets, token_sets
from .set_links import compared, links_of, pairs_around, reaches
from .textbytes import mix, texts

_PROFILES = "doc_id long, n long, mark binary, keys array<long>"
_TRIES = 16


class Signer:
    """Band keys of token sets.

    The tokens are hashes, so their leading bits deal them to ``bins`` bins and the smallest of each bin is the bin's
    value: one pass over the ascending set. An empty bin asks other bins, in an order that is its own and the same for all
    documents, until one is filled, and takes that one's value. So a value agrees in two sets with a probability equal to their
    similarity, also in sets of fewer tokens than bins. ``rows`` values make a band; its key is their hash.
    """

    def __init__(self, bins: int, rows: int) -> None:
        if bins & (bins - 1) or not 1 <= rows <= bins <= 1 << 16:
            raise ValueError("the number of bins must be a power of two up to 65,536, with at least a band in it")
        self.bins, self.rows, self.bands = bins, rows, bins // rows
        self.shift = np.uint64(64 - bins.bit_length() + 1)
        self.factors = mix(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)

    def _asked(self, empty: np.ndarray, step: int) -> np.ndarray:
        turns = np.arange(step, step + _TRIES, dtype=np.uint64)
        draws = mix((empty.astype(np.uint64)[:, None] << np.uint64(32)) + turns + np.uint64(1))
        return (draws % np.uint64(self.bins)).astype(np.int64)

    def values(self, tokens: np.ndarray) -> np.ndarray:
        """The value of every bin, for a set of one token at least."""
        bins = (tokens >> self.shift).astype(np.int64) if self.bins > 1 else np.zeros(len(tokens), np.int64)
        at = np.flatnonzero(np.diff(bins, prepend=-1))
        filled, out = np.zeros(self.bins, bool), np.zeros(self.bins, np.uint64)
        filled[bins[at]], out[bins[at]] = True, tokens[at]
        empty, step = np.flatnonzero(~filled), 0
        while len(empty):
            asked = self._asked(empty, step)
            hit = filled[asked]
            first = hit.argmax(axis=1)
            found = hit[np.arange(len(empty)), first]
            out[empty[found]] = out[asked[np.arange(len(empty)), first][found]]
            empty, step = empty[~found], step + _TRIES
        return out

    def keys(self, tokens: np.ndarray) -> np.ndarray:
        """One key for each band."""
        values = self.values(tokens)[: self.bands * self.rows].reshape(self.bands, self.rows)
        return mix((values * self.factors).sum(axis=1, dtype=np.uint64) + mix(np.arange(self.bands, dtype=np.uint64)))


def set_profiles(docs: DataFrame, shingle: int, percent: int, bins: int, rows: int) -> DataFrame:
    """(doc_id, n, mark, keys) of (doc_id, text) rows: the set's size, a 128-bit hash of it, and its band keys.

    A set that is too small to be linked with any but equal ones has no keys.
    """
    signer = Signer(bins, rows)

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in texts(batches):
            sizes, marks, keys = [], [], []
            for tokens in shingle_sets(group, shingle):
                linked = len(tokens) * 100 >= (len(tokens) + 1) * percent
                sizes.append(len(tokens))
                marks.append(set_mark(tokens))
                keys.append(signer.keys(tokens) if linked else tokens[:0])
            ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            flat = np.concatenate(keys).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(group.ids, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(marks, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                ],
                names=["doc_id", "n", "mark", "keys"],
            )

    found = docs.mapInArrow(profile, _PROFILES)
    return found.groupBy("doc_id").agg(F.max(F.struct("n", "mark", "keys")).alias("s")).select("doc_id", "s.*")


@result_only("near-duplicates")
def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
    bins: int = 128,
    rows: int = 5,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): near copies are linked, and one document of each component is kept.

    Two documents that share a bucket are linked when the common shingles are at least ``percent`` hundredths of the union, on
    the full sets. Words are runs of characters other than ASCII white space, with A-Z lower-cased; a shingle is ``shingle``
    consecutive words, of a shorter text all of them. A pair of similarity s shares none of the ``bins // rows`` buckets with
    probability (1 - s ** rows) ** (bins // rows): 5e-5 at 0.8 and 4e-7 at 0.85 with the defaults.

    1. One scan gives each set's size, 128-bit hash and band keys. Equal sets are one from here on.
    2. The smallest id of a bucket is its centre, and candidate edges lead from it to the other members only: their number
       is at most that of the bucket's rows. They are confirmed on the full sets; components follow.
    3. Where a bucket still holds several components, the members that may be linked with each other are found from their
       differences with the centre (:func:`quillgraph.llm.set_links.pairs_around`) and compared. So no link within
       a bucket is lost, without listing the pairs of a bucket.

    A null text counts as empty; a document without words has no shingles and is its own component. Rows without an id are left
    out; rows that repeat an id are one document, that of the largest set. Other columns are not read. An empty table
    gives an empty result. ``kept`` is true for the smallest id of a component.
    """
    given = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).filter("doc_id IS NOT NULL")
    profiles = materialize(set_profiles(given, shingle, percent, bins, rows), "profiles")
    groups = profiles.filter("n > 0").groupBy("mark")
    classes = materialize(groups.agg(F.min("doc_id").alias("rep"), F.first("keys").alias("keys")), "classes")

    banded = classes.select("rep", F.explode("keys").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("rep").alias("a"), F.max("rep").alias("b"), F.count(F.lit(1)).alias("m"))
    buckets = materialize(buckets.filter("m > 1"), "buckets")
    crowded = materialize(banded.join(buckets.filter("m > 2").select("key", "a"), "key"), "crowded")
    edges = buckets.filter("m = 2").select("a", "b").unionByName(crowded.filter("a <> rep").select("a", F.col("rep").alias("b")))
    edges = materialize(edges.distinct(), "edges")

    nodes = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    nodes = materialize(nodes, "nodes")
    wanted = nodes.join(classes.select(F.col("rep").alias("id"), "mark"), "id")
    sets = token_sets(given, wanted.select(F.col("id").alias("doc_id"), "mark"), shingle)
    sets = materialize(sets, "sets")
    stars = compared(edges, sets).filter(reaches(F.col("common"), F.col("n_a"), F.col("n_b"), percent))
    links = materialize(stars.select(F.col("a").alias("src"), F.col("b").alias("dst")), "links")
    first = materialize(connected_components(nodes, links), "components")

    placed = crowded.join(first.withColumnRenamed("id", "rep"), "rep")
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = materialize(mixed.filter("low < high").select("key"), "mixed")
    members = placed.join(mixed, "key", "left_semi").select(F.col("a").alias("pivot"), "rep", "component").distinct()
    around = pairs_around(members, sets, percent)
    more = materialize(links_of(around, sets, percent), "more-links")
    last = first
    if not more.isEmpty():
        every = links.unionByName(more.select(F.col("a").alias("src"), F.col("b").alias("dst")))
        last = connected_components(nodes, every)

    named = classes.select("mark", "rep").join(last.withColumnRenamed("id", "rep"), "rep", "left")
    named = materialize(named.select("mark", F.coalesce("component", "rep").alias("component_id")), "marks")
    for done in (classes, buckets, crowded, edges, nodes, sets, links, first, mixed, around, more):
        drop_materialized(done)
    out = profiles.join(named, "mark", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    kept = (F.col("doc_id") == F.col("component_id")).alias("kept")
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept)
