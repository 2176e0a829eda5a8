"""Links between token sets: comparison of given pairs, and what is left to compare around a pivot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import drop_materialized, materialize


def reaches(common: Column, a: Column, b: Column, percent: int) -> Column:
    """Whether sets of sizes ``a`` and ``b`` are linked if they have ``common`` tokens in common."""
    return common * 100 >= (a + b - common) * percent


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b, common) of pairs of sets: the sizes, and how many tokens they have in common."""
    left = sets.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("t_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("t_b"))
    common = F.size(F.array_intersect("t_a", "t_b")).alias("common")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", common)


def links_of(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): those of the pairs whose sets are linked."""
    rows = compared(pairs, sets)
    return rows.filter(reaches(F.col("common"), F.col("n_a"), F.col("n_b"), percent)).select("a", "b")


def pairs_around(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of members of one pivot and of different components that may be linked; none that are linked are left out.

    ``members`` has distinct (pivot, rep, component). Every set that is linked with a pivot must be in the pivot's component.

    Let d(u) be the symmetric difference of a set u and the pivot. Sets u and v of sizes m and n are linked if and only
    if their own symmetric difference, |d(u)| + |d(v)| - 2 |d(u) & d(v)|, is at most t (m + n) with t = (1 - s) / (1 + s), so
    their differences must have need = (|d(u)| + |d(v)| - t (m + n)) / 2 elements in common. For members of
    different components, of which one at least is not linked with the pivot, need is above 0. So members meet by the
    elements of their differences, under prefix filtering by rarity around the pivot: a set needs |d(u)| - (1 - s) m / s elements
    at least, elements that no other member of the pivot has are worth nothing, and a pair is formed only where the
    elements from the common one on would suffice. What is common to a family is in no difference, so a large family
    of sets that are not quite linked forms few pairs.
    """
    whole = sets.select("rep", "n", "tokens")
    own = whole.select("rep", "n", F.col("tokens").alias("own"))
    of = whole.select(F.col("rep").alias("pivot"), F.col("tokens").alias("of"))
    delta = F.concat(F.array_except("own", "of"), F.array_except("of", "own"))
    rows = members.filter("pivot <> rep").join(own, "rep").join(of, "pivot")
    rows = materialize(rows.select("pivot", "rep", "component", "n", delta.alias("delta")), "deltas")
    about = ["pivot", "rep", "component", "n", F.size("delta").alias("d")]
    each = rows.select(*about, F.explode("delta").alias("token"))
    counts = each.groupBy("pivot", "token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    counts = materialize(counts, "delta-counts")
    held = each.join(counts, ["pivot", "token"]).groupBy("pivot", "rep", "component", "n", "d")
    held = held.agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("ranked"))
    least = F.greatest(F.lit(1), F.col("d") - F.floor(F.col("n") * (100 - percent) / F.lit(percent)).cast("int"))
    shared = F.size("ranked")
    prefix = F.transform(F.slice("ranked", F.lit(1), F.greatest(shared - least + 1, F.lit(0))), lambda x: x["token"])
    keys = held.filter(shared >= least).select(
        "pivot", "rep", "component", "n", "d", shared.alias("shared"), F.posexplode(prefix).alias("at", "token")
    )
    keys = keys.select("pivot", "token", "rep", "component", "n", "d", (F.col("shared") - F.col("at")).alias("left"))
    keys = materialize(keys, "delta-keys")

    def side(x: str) -> DataFrame:
        return keys.select("pivot", "token", *[F.col(c).alias(f"{c}_{x}") for c in ("rep", "component", "n", "d", "left")])

    need = (F.col("d_a") + F.col("d_b")) * (100 + percent) - (F.col("n_a") + F.col("n_b")) * (100 - percent)
    may = (need <= F.least("left_a", "left_b") * 2 * (100 + percent)) & (
        F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    )
    met = side("a").join(side("b"), ["pivot", "token"])
    met = met.filter((F.col("rep_a") < F.col("rep_b")) & (F.col("component_a") != F.col("component_b")) & may)
    pairs = materialize(met.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct(), "around")
    for done in (rows, counts, keys):
        drop_materialized(done)
    return pairs
