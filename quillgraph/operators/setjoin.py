"""Similarity joins of token sets: an exact one, and MinHash LSH candidates.

Both work on *distinct* sets. Copies of a set are linked to one representative (:func:`copy_links`), a number of
links equal to the number of copies, where listing all pairs of copies would be quadratic; the pairs of copies
follow from the links.
"""

from __future__ import annotations

import itertools
import math
import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import HashingTF, MinHashLSH
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from ..session import materialize, tasks_for

_MARGIN = 1e-9
#: Keys of a set of few tokens, for partners of one size.
_KEYS = 16
#: Sets of few tokens whose keys one task joins, where only similar sets meet.
_TASK_SETS = 20_000
#: Counters by which tokens are ordered.
_SLOTS = 1 << 20
#: What stands between the tokens of a set in one string.
_BREAK = "\n"
#: First tokens that two sets must share to be looked at, where they must share as many.
_SHARED = 8
#: Keys that meet in one task, and keys a task for the counts of what has met.
_PART_KEYS, _COUNT_KEYS = 500_000, 200_000
#: Keys that are sent at once, and pairs that are formed at once.
_SENT, _FORMED = 1 << 19, 1 << 22
#: Bits by which sets that are in no pair are told apart.
_BITS = 1 << 23
#: Sets compared in one task, and of one family in a cell.
_CELL_SETS, _FAMILY_SETS = 2_000, 1_000


def distinct_sets(df: DataFrame, id_col: str, tokens_col: str) -> DataFrame:
    """(id, tokens, n, copies): the distinct non-empty token sets, each with the smallest id that has it.

    ``tokens_col`` must be sorted, distinct and without line breaks in a token, as :func:`quillgraph.functions.text.token_set`
    returns it. Sets are shuffled as one string each, which takes less than half of the disk that arrays take.
    """
    return (
        df.filter(F.size(tokens_col) > 0)
        .groupBy(_joined(tokens_col).alias("_joined"))
        .agg(F.min(id_col).alias("id"), F.count(F.lit(1)).alias("copies"))
        .select("id", F.split("_joined", _BREAK).alias("tokens"), "copies")
        .select("id", "tokens", F.size("tokens").alias("n"), "copies")
    )


def _joined(tokens_col: str) -> Column:
    return F.array_join(tokens_col, _BREAK)


def copy_links(df: DataFrame, id_col: str, tokens_col: str, sets: DataFrame | None = None) -> DataFrame:
    """(id, rep_id): every row whose token set equals that of a row with a smaller id.

    Sets are known by their SHA-256, so that no tokens are shuffled. ``sets`` are the :func:`distinct_sets`, if they are at hand.
    """
    digest = lambda column: F.unhex(F.sha2(_joined(column), 256)).alias("digest")
    rows = df.filter(F.size(tokens_col) > 0).select(F.col(id_col).alias("id"), digest(tokens_col))
    if sets is None:
        reps = rows.groupBy("digest").agg(F.min("id").alias("rep_id"), F.count(F.lit(1)).alias("copies"))
    else:
        reps = sets.select(F.col("id").alias("rep_id"), digest("tokens"), "copies")
    reps = reps.filter(F.col("copies") > 1).select("rep_id", "digest")
    return rows.join(reps, "digest").filter(F.col("id") != F.col("rep_id")).select("id", "rep_id")


def _by_rarity(sets: DataFrame) -> DataFrame:
    """``sets`` with ``ranked``: the tokens of every set as numbers, one for each token, the rarest over all sets first."""
    rows = sets.select("*", F.explode("tokens").alias("_token"))
    counted = rows.groupBy("_token").agg(F.count(F.lit(1)).alias("_df"))
    frequency = materialize(counted.withColumn("_code", F.monotonically_increasing_id()), "token-counts")
    ordered = F.array_sort(F.collect_list(F.struct("_df", "_code")))
    ranked = rows.join(frequency, "_token").groupBy(*sets.columns).agg(ordered.alias("_by_rarity"))
    return ranked.select(*sets.columns, F.col("_by_rarity._code").alias("ranked"))


def _similar_size(similarity: float) -> Column:
    return F.least("na", "nb") >= F.lit(similarity) * F.greatest("na", "nb")


def _needed_overlap(similarity: float, na: Column, nb: Column) -> Column:
    """How many tokens two sets of sizes ``na`` and ``nb`` must share."""
    return F.greatest(F.ceil(F.lit(similarity / (1.0 + similarity)) * (na + nb)), F.lit(1))


def _key_size(similarity: float, n: int, m: int) -> tuple[int, int]:
    """(tokens in a key, tokens needed) for sets of ``n`` and ``m`` tokens.

    Keys are as long as the number of them that the larger set has allows; the more tokens, the fewer sets meet in vain.
    """
    needed = max(math.ceil(similarity / (1.0 + similarity) * (n + m)), 1)
    longest = [k for k in range(1, min(needed, n, m) + 1) if math.comb(max(n, m) - needed + k, k) <= _KEYS]
    return (longest[-1] if longest else 1), needed


def _short_pairs(
    light: DataFrame, rows: int, similarity: float, max_distance: float, sizes: list[int], carry: list[str]
) -> DataFrame:
    """(id_a, id_b, jaccard_dist) and what is carried of both, over sets of few tokens, whose numbers are ``sizes``.

    Sets that must share t tokens share the first k of those that they share, and have them among the first n - t + k of each.
    A pair is kept at the key of just these tokens, so it comes once, and with both sets at hand. What it shares is worked out
    once, in an ``explode`` of one value: a filter on a plain column would go into the join, and the value into each of its terms.
    If every key is all that a pair must share, only similar sets meet, and keys are dealt over tasks in proportion to the ``rows``;
    else Spark may split a key that many sets hold in vain.
    """
    choices, whole = [], True
    for n, m in itertools.product(sizes, sizes):
        k, needed = _key_size(similarity, n, m)
        if min(n, m) >= max(similarity * max(n, m), needed):
            choices.append((n, m, [list(c) for c in itertools.combinations(range(n - needed + k), k)]))
            whole = whole and k == needed
    chosen = light.sparkSession.createDataFrame(choices, "n int, m int, places array<array<int>>")
    keyed = light.join(F.broadcast(chosen), "n").withColumn("places", F.explode("places"))
    keys = keyed.withColumn("key", F.transform("places", lambda i: F.get("ranked", i))).withColumn(
        "ends", F.least("n", "m") * 1000 + F.greatest("n", "m")
    )
    if whole:
        keys = keys.repartition(tasks_for(light.sparkSession, rows, _TASK_SETS), "key", "ends")
    a, b = (
        keys.select("key", "ends", *[F.col(c).alias(f"{c}_{side}") for c in ("id", "n", "m", "ranked", *carry)]) for side in "ab"
    )
    met = a.join(b, ["key", "ends"]).filter("id_a < id_b AND n_a = m_b AND n_b = m_a")
    shared = F.col("shared")
    compared = met.withColumn("shared", F.explode(F.array(F.array_intersect("ranked_a", "ranked_b"))))
    distance = 1.0 - F.size(shared) / (F.col("n_a") + F.col("n_b") - F.size(shared))
    first = compared.filter(F.slice(shared, F.lit(1), F.size("key")) == F.col("key")).withColumn("jaccard_dist", distance)
    return first.filter(F.col("jaccard_dist") < max_distance).select("id_a", "id_b", "jaccard_dist", *_both(carry))


def _both(carry: list[str]) -> list[str]:
    return [f"{c}_{side}" for side in "ab" for c in carry]


def _no_pairs(sets: DataFrame, carry: list[str]) -> DataFrame:
    sides = [F.col(c).alias(f"{c}_{side}") for side in "ab" for c in carry]
    return sets.limit(0).select(F.col("id").alias("id_a"), F.col("id").alias("id_b"), F.lit(0.0).alias("jaccard_dist"), *sides)


def _prefix_length(similarity: float, n: Column) -> Column:
    return F.greatest(n - F.greatest(F.ceil(F.lit(similarity) * n), F.lit(1)) + 1, F.lit(1))


def _numbered(sets: DataFrame, bits: int = 32) -> DataFrame:
    """``sets`` with ``no``: a hash of the tokens. Where several sets have one number, what is done for it is done for all of them."""
    return sets.withColumn("no", F.xxhash64("tokens").bitwiseAND(F.lit((1 << bits) - 1)) if bits < 64 else F.xxhash64("tokens"))


def _token_weights(hashed: DataFrame) -> np.ndarray:
    """How many of all tokens have each residue of their hash."""
    parts, width = 64, _SLOTS // 64

    # Nested functions travel to the workers by value, so these need no copy of this package.
    def count(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        seen = np.zeros(parts * width, np.int64)
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            seen += np.bincount(flat & (len(seen) - 1), minlength=len(seen))
        blobs = [zlib.compress(seen[p * width : (p + 1) * width].tobytes(), 1) for p in range(parts)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(parts, dtype=np.int32)), pa.array(blobs, pa.binary())], ["part", "counts"])

    def total(rows):
        import zlib

        import numpy as np
        import pyarrow as pa

        whole = sum(np.frombuffer(zlib.decompress(b), np.int64) for b in rows.column("counts").to_pylist())
        blob = pa.array([zlib.compress(whole.tobytes(), 1)], pa.binary())
        return pa.table({"part": rows.column("part").combine_chunks().slice(0, 1), "counts": blob})

    schema = "part int, counts binary"
    found = hashed.select("hashes").mapInArrow(count, schema).groupBy("part").applyInArrow(total, schema).toArrow()
    weights = np.zeros(_SLOTS, np.int64)
    for part, blob in zip(found["part"].to_pylist(), found["counts"].to_pylist(), strict=True):
        weights[part * width : (part + 1) * width] = np.frombuffer(zlib.decompress(blob), np.int64)
    return weights


def _prefix_keys(shared, similarity: float, parts: int, most: int):
    """Blocks of first tokens as (part, size, keys, numbers and sizes of sets, places); a token that one set alone has is left out."""

    def keys(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        weights, held = shared.value, []

        def block():
            part, key, *others = (np.concatenate(c) for c in zip(*held, strict=True))
            held.clear()
            order = np.lexsort((key, part))
            part, key, others = part[order], key[order], [c[order] for c in others]
            cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1)).tolist()
            ranges = list(zip(cuts[:-1], cuts[1:], strict=True))
            steps = [np.diff(key[low:high], prepend=np.uint32(0)) for low, high in ranges]
            blobs = [[zlib.compress(s.tobytes(), 1) for s in steps]] + [[zlib.compress(c[low:high].tobytes(), 1) for low, high in ranges] for c in others]
            sizes = [pa.array([part[low] for low, _ in ranges], pa.int32()), pa.array([high - low for low, high in ranges], pa.int32())]
            return pa.RecordBatch.from_arrays([*sizes, *(pa.array(b, pa.binary()) for b in blobs)], ["part", "size", "key", "no", "n", "place"])

        for batch in (whole.slice(at, 1000) for whole in batches for at in range(0, whole.num_rows, 1000)):
            hashes, n = batch.column("hashes"), batch.column("n").to_numpy().astype(np.int32)
            flat = hashes.flatten().to_numpy(zero_copy_only=False)
            sizes = hashes.value_lengths().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(sizes)), sizes)
            flat = flat[np.lexsort((flat, weights[flat & (len(weights) - 1)], row))]
            place = np.arange(1, len(flat) + 1) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            length = np.maximum(n - np.maximum(np.ceil(similarity * n), 1) + 1, 1)
            kept = (place <= length[row]) & (weights[flat & (len(weights) - 1)] > 1)
            if not kept.any():
                continue
            row, flat = row[kept], flat[kept].view(np.uint64)
            part = ((flat >> np.uint64(44)) % np.uint64(parts)).astype(np.int64)
            number = batch.column("no").to_numpy().astype(np.uint32)[row]
            held.append((part, (flat >> np.uint64(12)).astype(np.uint32), number, n[row], place[kept].astype(np.int32)))
            if sum(len(h[0]) for h in held) >= most:
                yield block()
        if held:
            yield block()

    return keys


def _met(similarity: float, longer_than: int, shared: int, ends: int, most: int):
    """Blocks of meetings as (end, size, numbers of both sets, how many meetings they need)."""

    def met(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        def read(blob, kind):
            return np.frombuffer(zlib.decompress(blob), kind)

        found = [[] for _ in range(4)]
        for batch in batches:
            for row in batch.to_pylist():
                key = np.cumsum(read(row["key"], np.uint32), dtype=np.uint32).astype(np.uint64) | np.uint64(row["part"] << 32)
                for column, value in zip(found, (key, read(row["no"], np.uint32), read(row["n"], np.int32), read(row["place"], np.int32)), strict=True):
                    column.append(value)
        if not found[0]:
            return
        key, no, n, place = (np.concatenate(c) for c in found)
        order = np.lexsort((no, n, key))
        key, no, n, place = key[order], no[order].astype(np.uint64), n[order].astype(np.int64), place[order]
        ratio = similarity / (1.0 + similarity)
        prefix = np.maximum(n - np.maximum(np.ceil(similarity * n), 1) + 1, 1).astype(np.int64)

        def needed(total):
            return np.maximum(np.ceil(ratio * total), 1).astype(np.int64)

        # rows of one key stand by size, so the larger sets that fit are a range behind each row
        list_of, wide = np.cumsum(np.diff(key, prepend=key[:1]) != 0), int(n.max()) + 1
        largest = np.minimum(np.floor(n / similarity).astype(np.int64) + 1, wide - 1) if similarity > 0 else wide - 1
        upto = np.searchsorted(list_of * wide + n, list_of * wide + largest, side="right")
        first = place <= n - needed(2 * n) + shared
        ahead = np.cumsum(np.where(first, upto - np.arange(len(n)) - 1, 0))
        kept, held, at = [], 0, 0

        def block():
            pair, least = (np.concatenate(c) for c in zip(*kept, strict=True))
            order = np.argsort(pair)
            pair, least = pair[order], least[order]
            a = pair >> np.uint64(32)
            end = ((a * np.uint64(ends)) >> np.uint64(32)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(end, prepend=-1, append=-1)).tolist()
            ranges = list(zip(cuts[:-1], cuts[1:], strict=True))
            columns = [[np.diff(a[low:high].astype(np.uint32), prepend=np.uint32(0)) for low, high in ranges]]
            columns += [[c[low:high] for low, high in ranges] for c in (pair.astype(np.uint32), least)]
            blobs = [pa.array([zlib.compress(v.tobytes(), 1) for v in c], pa.binary()) for c in columns]
            sizes = [pa.array([end[low] for low, _ in ranges], pa.int32()), pa.array([high - low for low, high in ranges], pa.int32())]
            return pa.RecordBatch.from_arrays([*sizes, *blobs], ["end", "size", "a", "b", "least"])

        while at < len(n):
            before = ahead[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ahead, before + most, side="right")))
            counts = np.diff(ahead[at:to], prepend=before)
            i = np.repeat(np.arange(at, to), counts)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(counts) - counts, counts)
            at = to
            need = needed(n[i] + n[j])
            least = np.clip(need - np.maximum(n[i] - prefix[i], n[j] - prefix[j]), 1, shared)
            fits = (n[i] >= similarity * n[j]) & (n[j] > longer_than)
            fits &= (place[i] <= n[i] - need + least) & (place[j] <= n[j] - need + least)
            i, j = no[i[fits]], no[j[fits]]
            kept.append(((np.minimum(i, j) << np.uint64(32)) | np.maximum(i, j), least[fits].astype(np.uint8)))
            held += len(i)
            if held >= most:
                yield block()
                kept, held = [], 0
        if held:
            yield block()

    return met


def _often_met():
    """The pairs of numbers that meet as often as they must, as (a, b)."""

    def often(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        pairs, leasts = [], []
        for batch in batches:
            for row in batch.to_pylist():
                a = np.cumsum(np.frombuffer(zlib.decompress(row["a"]), np.uint32), dtype=np.uint32).astype(np.uint64)
                pairs.append((a << np.uint64(32)) | np.frombuffer(zlib.decompress(row["b"]), np.uint32))
                leasts.append(np.frombuffer(zlib.decompress(row["least"]), np.uint8))
        if not pairs:
            return
        pair, least = np.concatenate(pairs), np.concatenate(leasts)
        order = np.argsort(pair)
        pair, least = pair[order], least[order]
        starts = np.flatnonzero(np.diff(pair, prepend=~pair[:1]))
        often = np.diff(starts, append=len(pair)) >= np.minimum.reduceat(least, starts)
        pair = pair[starts[often]]
        for at in range(0, len(pair), 10_000):
            some = pair[at : at + 10_000]
            columns = [(some >> np.uint64(32)).astype(np.int64), some.astype(np.uint32).astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b"])

    return often


def _meeting(sets: DataFrame, keys: int, similarity: float, longer_than: int) -> DataFrame:
    """(a, b): numbers of sets of fitting sizes that share as many of their first tokens as similar ones do.

    One of the two at least must have more than ``longer_than`` tokens. ``keys`` is the number of first tokens of all sets.

    Tokens are ordered by how many of all tokens have the same residue of their hash, then by hash. Any one order of all tokens
    makes the join exact, and this one needs a table of fixed size, which goes to every task, in place of shuffles of all tokens.
    Of two sets of m and n tokens that share t, the one lacks no more than m - t of the other's tokens, so k of its first
    m - t + k are shared, and likewise k of the other's first n - t + k. The prefix that ends first by the order shares none that are
    behind the other's. So sets meet within these prefixes only, and must do so k times, with k up to ``_SHARED``, or less where
    prefixes are shorter. Keys and meetings are sent in compressed blocks, as a few bytes each.
    """
    hashed = _numbered(sets).select("no", "n", F.transform("tokens", lambda t: F.xxhash64(t)).alias("hashes"))
    spark = sets.sparkSession
    shared = spark.sparkContext.broadcast(_token_weights(hashed))
    parts, ends = tasks_for(spark, keys, _PART_KEYS), tasks_for(spark, keys, _COUNT_KEYS)
    sent = hashed.mapInArrow(
        _prefix_keys(shared, similarity, parts, _SENT), "part int, size int, key binary, no binary, n binary, place binary"
    )
    met = sent.repartition(parts, "part").mapInArrow(
        _met(similarity, longer_than, _SHARED, ends, _FORMED), "end int, size int, a binary, b binary, least binary"
    )
    return met.repartition(ends, "end").mapInArrow(_often_met(), "a bigint, b bigint")


def _maybe_paired(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """``sets`` without most of those that are in no pair: a table of bits of fixed size tells them, so their tokens are not shuffled."""
    bits = pairs.select(F.explode(F.array("a", "b")).alias("no")).select(F.col("no").bitwiseAND(F.lit(_BITS - 1)).alias("bit"))
    words = bits.groupBy(F.expr("cast(shiftright(bit, 6) AS int)").alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 AS int)))").alias("word"))
    found, table = words.toArrow(), np.zeros(_BITS // 64, np.int64)
    table[found["at"].to_numpy()] = found["word"].to_numpy()
    one = sets.sparkSession.createDataFrame(pa.table({"bits": pa.array([table], pa.list_(pa.int64()))}))
    place = F.col("no").bitwiseAND(F.lit(_BITS - 1))
    word = F.get("bits", F.floor(place / 64).cast("int"))
    kept = F.call_function("shiftrightunsigned", word, F.pmod(place, F.lit(64)).cast("int")).bitwiseAND(F.lit(1)) == 1
    return sets.crossJoin(F.broadcast(one)).filter(kept).drop("bits")


def _verify(pairs: DataFrame, sets: DataFrame, max_distance: float, carry: list[str] | None = None) -> DataFrame:
    """(id_a, id_b, na, nb, jaccard_dist), what is carried of both sets, and other columns of the pairs that are below the distance.

    ``pairs`` has the numbers ``a`` and ``b`` of two sets, each pair once, and ``sets`` their number ``no``. Pairs are looked at in
    cells, so a set is sent once to each of its cells, and not for each of its pairs: the pairs of near copies of one set
    have the same smallest neighbour, most of them, and those of one smallest neighbour make a cell. A large family is dealt over
    cells of pairs of blocks.
    """
    pairs, carry = materialize(pairs, "candidates"), carry or []
    spark, more = pairs.sparkSession, [c for c in pairs.columns if c not in ("a", "b")]
    ends = F.explode(F.array(F.struct(F.col("a").alias("no"), F.col("b").alias("other")), F.struct(F.col("b").alias("no"), F.col("a").alias("other"))))
    least = pairs.select(ends.alias("e")).groupBy("e.no").agg(F.min("e.other").alias("other"))
    least = materialize(least.select("no", F.least("no", "other").alias("least")), "least")
    homes = pairs
    for side in ("a", "b"):
        homes = homes.join(least.select(F.col("no").alias(side), F.col("least").alias(f"least_{side}")), side)
    homes = homes.select("a", "b", *more, F.least("least_a", "least_b").alias("home"))
    homes = materialize(homes, "homes")
    at_home = homes.select("home", F.explode(F.array("a", "b")).alias("no")).distinct().groupBy("home").agg(F.count(F.lit(1)).alias("sets"))
    blocks = F.ceil(F.col("sets") / _FAMILY_SETS)
    families = materialize(at_home.select("home", "sets", blocks.alias("blocks")), "families")
    cells = tasks_for(spark, families.agg(F.sum(F.col("sets") * F.col("blocks"))).first()[0] or 0, _CELL_SETS)
    placed = homes.join(families.filter("blocks > 1").select("home", "blocks"), "home", "left")
    block = lambda c: F.pmod(F.xxhash64(c), F.coalesce("blocks", F.lit(1)))
    i, j = block("a"), block("b")
    cell = F.pmod(F.xxhash64("home", F.least(i, j), F.greatest(i, j)), F.lit(cells)).cast("int").alias("cell")
    placed = placed.select(cell, "a", "b", *more)
    places = placed.select(F.col("cell").alias("place"), F.explode(F.array("a", "b")).alias("no")).distinct()
    sent = _maybe_paired(sets, pairs).select("no", "id", _joined("tokens").alias("joined"), *carry).join(places, "no")
    both = {c: sets.schema[c].dataType for c in ("id", *carry)}
    types = [("na", IntegerType()), ("nb", IntegerType()), ("jaccard_dist", DoubleType()), *((c, pairs.schema[c].dataType) for c in more)]
    types += [(f"{c}_{side}", kind) for side in "ab" for c, kind in both.items()]
    found = (
        placed.groupBy("cell")
        .cogroup(sent.groupBy("place"))
        .applyInArrow(_compared(max_distance, more, [*both], _BREAK), StructType([StructField(*t) for t in types]))
    )
    swapped = F.col("id_a") > F.col("id_b")
    other = {c: f"{c[:-1]}{'ab'['ba'.index(c[-1])]}" for c in ("na", "nb", *(f"{c}_{side}" for side in "ab" for c in both))}
    ordered = found.filter("id_a <> id_b").select(
        *[F.when(swapped, F.col(other[c])).otherwise(F.col(c)).alias(c) if c in other else F.col(c) for c in found.columns]
    )
    return ordered.select("id_a", "id_b", "na", "nb", "jaccard_dist", *more, *_both(carry))


def _compared(max_distance: float, more: list[str], both: list[str], mark: str):
    def compared(pairs, sets):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        sets = sets.take(pa.array(np.argsort(sets.column("no").to_numpy(), kind="stable"))).combine_chunks()
        no = sets.column("no").to_numpy()
        words = pc.split_pattern(sets.column("joined"), mark).combine_chunks()
        words = words.chunk(0) if isinstance(words, pa.ChunkedArray) and words.num_chunks else words
        sizes = np.zeros(0, np.int64) if not len(no) else words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        codes = np.zeros(0, np.int64) if not len(no) else words.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        starts = np.cumsum(sizes) - sizes

        # every set of the one number with every set of the other
        a, b = (pairs.column(c).to_numpy() for c in "ab")
        low_a, low_b = np.searchsorted(no, a), np.searchsorted(no, b)
        of_a, of_b = np.searchsorted(no, a, side="right") - low_a, np.searchsorted(no, b, side="right") - low_b
        pair = np.repeat(np.arange(len(a)), of_a * of_b)
        nth = np.arange(len(pair)) - np.repeat(np.cumsum(of_a * of_b) - of_a * of_b, of_a * of_b)
        i, j = low_a[pair] + nth // of_b[pair], low_b[pair] + nth % of_b[pair]
        kept = (a[pair] != b[pair]) | (i < j)
        order = np.argsort(i[kept], kind="stable")
        pair, i, j = pair[kept][order], i[kept][order], j[kept][order]

        shared, marked = np.zeros(len(i), np.int64), np.zeros(int(codes.max()) + 1 if len(codes) else 0, bool)
        cuts = np.flatnonzero(np.diff(i, prepend=-1, append=-1)).tolist()
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            own = codes[starts[i[low]] : starts[i[low]] + sizes[i[low]]]
            marked[own] = True
            for at in range(low, high, 1000):  # a set may have very many partners
                some = j[at : min(at + 1000, high)]
                n = sizes[some]
                first = np.cumsum(n) - n
                place = np.arange(int(n.sum())) + np.repeat(starts[some] - first, n)
                shared[at : at + len(some)] = np.add.reduceat(marked[codes[place]], first, dtype=np.int64)
            marked[own] = False

        distance = 1.0 - shared / (sizes[i] + sizes[j] - shared)
        near = distance < max_distance
        columns = [pa.array(sizes[i[near]].astype(np.int32)), pa.array(sizes[j[near]].astype(np.int32)), pa.array(distance[near])]
        pair, i, j = (pa.array(x[near]) for x in (pair, i, j))
        columns += [pairs.column(c).take(pair) for c in more]
        columns += [sets.column(c).take(at) for at in (i, j) for c in both]
        return pa.table(columns, names=["na", "nb", "jaccard_dist", *more, *(f"{c}_{side}" for side in "ab" for c in both)])

    return compared


def similar_sets(sets: DataFrame, max_distance: float, short: int = 20, carry: list[str] | None = None) -> DataFrame:
    """(id_a, id_b, jaccard_dist): all pairs of distinct sets closer than ``max_distance``, id_a < id_b. Exact.

    Prefix filtering (Chaudhuri et al. 2006, Bayardo et al. 2007): two sets that must share t tokens have one in common among
    the first n - t + 1 of each, if both are sorted by one global order. With the rarest tokens first, a token that a third
    of all sets hold is almost never joined on. Two sets of up to ``short`` tokens meet by k tokens out of the first
    n - t + k (Wang et al. 2012), with k as large as the number of such keys allows: t of them, where sets have few
    tokens, so that only similar ones meet. A longer set meets any other by single tokens, and only pairs that share enough
    of these are looked at. Columns of ``sets`` in ``carry`` are added for both sets of a pair, as ``<name>_a`` and ``<name>_b``.
    """
    carry = carry or []
    similarity = 1.0 - max_distance - _MARGIN
    short = 0 if similarity <= 0 else short
    light = F.col("n") <= short
    near = F.col("n") >= F.lit(similarity * short)
    seen = sets.agg(
        F.collect_set(F.when(light, F.col("n"))).alias("sizes"),
        F.max("n").alias("most"),
        F.count_if(light).alias("light"),
        F.sum(F.when(near, _prefix_length(similarity, F.col("n")))).alias("keys"),
    ).first()
    found = []  # at most ``short`` sizes
    if seen["sizes"]:
        ranked = materialize(_by_rarity(sets.filter(light)), "ranked-sets")
        found.append(_short_pairs(ranked, seen["light"], similarity, max_distance, sorted(seen["sizes"]), carry))
    if (seen["most"] or 0) > short:
        met = _meeting(sets.filter(near), seen["keys"], similarity, short)
        measured = _verify(met, _numbered(sets), max_distance, carry).filter(F.greatest("na", "nb") > short)
        found.append(measured.select("id_a", "id_b", "jaccard_dist", *_both(carry)))
    return reduce(DataFrame.unionAll, found) if found else _no_pairs(sets, carry)


def minhash_rows(sets: DataFrame, num_tables: int, num_features: int = 1 << 18, seed: int = 42) -> DataFrame:
    """(id, n, tokens, hashes): the MinHash value of every set in each table, over hashed term vectors."""
    vectors = HashingTF(inputCol="tokens", outputCol="features", numFeatures=num_features, binary=True).transform(sets)
    model = MinHashLSH(inputCol="features", outputCol="minhash", numHashTables=num_tables, seed=seed).fit(vectors)
    hashes = F.transform("minhash", lambda v: F.get(vector_to_array(v), F.lit(0)).cast("bigint"))
    return model.transform(vectors).select("id", "n", "tokens", hashes.alias("hashes"))


def first_shared_table(left: Column, right: Column, num_tables: int) -> Column:
    """The number of the first of so many tables in which two rows of hashes agree, from 0; null if there is none."""
    return F.coalesce(*[F.when(F.get(left, F.lit(i)) == F.get(right, F.lit(i)), F.lit(i)) for i in range(num_tables)])


def _with_parities(rows: DataFrame) -> DataFrame:
    """``rows`` with ``bits`` in place of ``tokens``: for each of 1,024 bits, whether an odd number of the tokens falls on it, as 16 numbers."""

    def marked(batches):
        import numpy as np
        import pyarrow as pa

        for batch in (whole.slice(at, 1000) for whole in batches for at in range(0, whole.num_rows, 1000)):
            slots = batch.column("slots")
            row = np.repeat(np.arange(batch.num_rows), slots.value_lengths().to_numpy(zero_copy_only=False))
            flat = slots.flatten().to_numpy(zero_copy_only=False)
            odd = np.bincount(row * 1024 + flat, minlength=batch.num_rows * 1024) & 1
            words = np.packbits(odd.astype(np.uint8)).view(np.int64)
            bits = pa.ListArray.from_arrays(pa.array(np.arange(0, len(words) + 1, 16, dtype=np.int32)), pa.array(words))
            kept = [batch.column(name) for name in batch.schema.names[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, bits], [*batch.schema.names[:-1], "bits"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "tokens")
    slots = F.transform("tokens", lambda t: F.xxhash64(t).bitwiseAND(F.lit(1023)).cast("int"))
    return rows.withColumn("slots", slots).drop("tokens").mapInArrow(marked, f"{fields}, bits array<bigint>")


def _fewest_different(left: str, right: str) -> Column:
    """How many tokens two sets differ in at least: each flips one bit of :func:`_with_parities`."""
    each = [F.bit_count(F.get(left, F.lit(i)).bitwiseXOR(F.get(right, F.lit(i)))) for i in range(16)]
    return reduce(lambda x, y: x + y, each)


def similar_sets_lsh(
    sets: DataFrame,
    max_distance: float,
    num_tables: int = 5,
    num_features: int = 1 << 18,
    seed: int = 42,
    bucket_limit: int = 100,
) -> DataFrame:
    """(id_a, id_b, jaccard_dist, shared_table): pairs that share a MinHash bucket and are closer than the distance.

    Only ids, hashes and 1,024 bits for each set are shuffled. Two sets whose bits differ in more places than similar sets differ
    in tokens are no pair; what is left is merged if it meets in several tables, before sets are looked at.
    ``shared_table`` tells the first of them, which makes the result for fewer tables a filter on it. Buckets with more
    than ``bucket_limit`` sets are not paired up: the sets in them go through the exact join instead, which finds
    all of their pairs; their hashes go with them.
    """
    found = ["id_a", "id_b", "jaccard_dist", "shared_table"]
    rows = minhash_rows(sets, num_tables, num_features, seed)
    rows = materialize(_with_parities(_numbered(rows, 64)).select("id", "n", "no", "hashes", "bits"), "minhash")
    slots = rows.select("id", "n", "no", "bits", F.posexplode("hashes").alias("slot", "hash"))
    crowded = (
        slots.groupBy("slot", "hash")
        .agg(F.count(F.lit(1)).alias("members"))
        .filter(F.col("members") > bucket_limit)
        .select("slot", "hash")
    )
    any_crowded = not crowded.isEmpty()
    paired = slots.withColumn("inside", F.lit(False))
    if any_crowded:
        crowded = materialize(crowded, "crowded")
        members = materialize(slots.select("no", "slot", "hash").join(crowded, ["slot", "hash"], "left_semi").select("no").distinct(), "members")
        inside = members.withColumn("inside", F.lit(True))
        paired = slots.join(crowded, ["slot", "hash"], "left_anti").join(inside, "no", "left")
        paired = paired.withColumn("inside", F.coalesce("inside", F.lit(False)))
    a, b = (
        paired.select("slot", "hash", F.col("n").alias(f"n{side}"), *[F.col(c).alias(f"{c}_{side}") for c in ("id", "no", "bits", "inside")])
        for side in "ab"
    )
    similarity = 1.0 - max_distance - _MARGIN
    total = F.col("na") + F.col("nb")
    most_different = total - 2 * _needed_overlap(similarity, F.col("na"), F.col("nb"))
    candidates = (
        a.join(b, ["slot", "hash"])
        .filter((F.col("id_a") < F.col("id_b")) & ~(F.col("inside_a") & F.col("inside_b")) & _similar_size(similarity))
        .filter(F.lit(similarity <= 0) | (_fewest_different("bits_a", "bits_b") <= most_different))
        .groupBy(F.least("no_a", "no_b").alias("a"), F.greatest("no_a", "no_b").alias("b"))
        .agg(F.min("slot").cast("int").alias("shared_table"))
    )
    numbered = _numbered(sets, 64)
    near = _verify(candidates, numbered, max_distance).select(*found)
    if not any_crowded:
        return near
    within = numbered.withColumnRenamed("no", "mark")
    if 2 * members.count() < rows.count():  # else what is not crowded is joined in vain, which takes less than moving all others
        some = numbered.select("no", "id", _joined("tokens").alias("joined")).join(members, "no")
        some = some.select("id", F.split("joined", _BREAK).alias("tokens"), F.col("no").alias("mark"))
        within = materialize(some.withColumn("n", F.size("tokens")), "crowded-sets")
    exact = similar_sets(within, max_distance, carry=["mark"])
    hashes = materialize(rows.join(members, "no", "left_semi").select("no", "hashes"), "crowded-hashes")
    for side in "ab":
        exact = exact.join(hashes.select(F.col("no").alias(f"mark_{side}"), F.col("hashes").alias(f"hashes_{side}")), f"mark_{side}")
    first = first_shared_table(F.col("hashes_a"), F.col("hashes_b"), num_tables)
    return near.unionByName(exact.withColumn("shared_table", first).filter(F.col("shared_table").isNotNull()).select(*found))


def pair_space(df: DataFrame, block: Column | None = None) -> DataFrame:
    """Number of unordered pairs of rows, in all or per value of ``block``, from counts alone."""
    keyed = df.select((block if block is not None else F.lit("*")).alias("block"))
    sizes = keyed.groupBy("block").agg(F.count(F.lit(1)).alias("members"))
    return sizes.withColumn("pairs", (F.col("members") * (F.col("members") - 1) / 2).cast("bigint"))
