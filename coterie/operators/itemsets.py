"""Frequent itemsets over baskets held as one (basket_id, item) row per distinct item.

Mining counts itemsets on bitmaps of basket ranges (``vertical``). Baskets themselves stay exploded:
none is collected into one row except where FP-growth's input format asks for it.
"""

from dataclasses import dataclass
from functools import reduce
from math import floor

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coterie.operators.heavy_join import heavy_join
from coterie.operators.indexing import index_within
from coterie.operators.lineage import cut
from coterie.operators.skew import salted_join
from coterie.operators.vertical import VerticalIndex, index_of_sets, vertical_index


def dedupe_baskets(rows: DataFrame) -> DataFrame:
    """Repeated items of a basket collapsed, with the number of copies."""
    return rows.groupBy("basket_id", "item").agg(F.count(F.lit(1)).alias("n_copies"))


def basket_stats(rows: DataFrame, sizes: list[int]) -> DataFrame:
    """Largest basket, baskets, items, and the number of baskets above each size."""
    per_basket = rows.groupBy("basket_id").agg(F.count(F.lit(1)).alias("n_items"))
    above = [F.count_if(F.col("n_items") > size).alias(f"above_{size}") for size in sizes]
    return per_basket.agg(
        F.max("n_items").alias("largest_basket"),
        F.count(F.lit(1)).alias("n_baskets"),
        F.sum("n_items").alias("n_items"),
        *above,
    )


def head_baskets(baskets: DataFrame, n: int) -> DataFrame:
    """The first ``n`` baskets by id, with all their items."""
    first = baskets.groupBy("basket_id").agg(F.count(F.lit(1)).alias("n_items"))
    first = first.orderBy("basket_id").limit(n)
    return baskets.join(first, "basket_id")


def item_support(baskets: DataFrame) -> DataFrame:
    """Number of baskets each item is in."""
    return baskets.groupBy("item").agg(F.count(F.lit(1)).alias("support"))


def least_support(min_support: int, strict: bool) -> int:
    """The smallest support that passes; ``strict`` asks for more than ``min_support``."""
    return min_support + 1 if strict else min_support


def basket_pairs(baskets: DataFrame) -> DataFrame:
    """Every pair of items of every basket, as (basket_id, item_a, item_b) with item_a < item_b.

    A basket that holds many of all rows is cut into tiles.
    """
    a = baskets.select("basket_id", F.col("item").alias("item_a"))
    b = baskets.select("basket_id", F.col("item").alias("item_b"))
    met = heavy_join(a, b, ["basket_id"], "item_a", "item_b")
    return met.where(F.col("item_a") < F.col("item_b"))


def bucket_counts(pairs: DataFrame, bucket: Column) -> DataFrame:
    """Number of pair occurrences that hash to each bucket."""
    return pairs.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("cnt"))


def containment_counts(baskets: DataFrame, itemsets: DataFrame) -> DataFrame:
    """Support of given itemsets (one ``itemset`` array per row), zero included.

    Only the items that some itemset names are indexed; all itemsets are counted on their bitmaps.
    """
    wanted = cut(itemsets.select("itemset").distinct())
    members = cut(wanted.select("itemset", F.explode(F.array_distinct("itemset")).alias("item")))
    named = members.select("item").distinct()
    index = vertical_index(baskets.join(named, "item", "left_semi"), 1)
    numbers = index.items.select("item", "item_no")
    # a set with an item that no basket holds has fewer numbers than items
    candidates = cut(
        salted_join(members, numbers, ["item"], "itemset")
        .groupBy("itemset")
        .agg(F.array_sort(F.collect_list("item_no")).alias("items"))
        .where(F.size("items") == F.size(F.array_distinct("itemset")))
    )
    counts = index.candidate_counts(candidates.select("items").distinct())
    support = counts.groupBy("items").agg(F.sum("n").alias("support"))
    found = candidates.join(support, "items").select("itemset", "support")
    return wanted.join(found, "itemset", "left").select(
        "itemset", F.coalesce("support", F.lit(0)).alias("support")
    )


@dataclass
class BucketPruning:
    """Hash-bucket pruning of candidates at some levels.

    The counts of all candidates of a level are first added up by bucket, and only candidates of
    buckets that reach the support are added up one by one.
    """

    n_buckets: int
    levels: tuple[int, ...] = (2,)


def _prune(counts: DataFrame, support: int, rule: BucketPruning) -> DataFrame:
    """Drop the counts whose bucket stays below the support."""
    bucket = F.pmod(F.xxhash64("items"), F.lit(rule.n_buckets)).alias("bucket")
    possible = (
        counts.groupBy(bucket)
        .agg(F.sum("n").alias("cnt"))
        .where(F.col("cnt") >= support)
        .select("bucket")
    )
    return counts.withColumn("bucket", bucket).join(possible, "bucket", "left_semi").drop("bucket")


def _extended(level: DataFrame, k: int) -> DataFrame:
    """k-item candidates from frequent sets of k - 1 items that differ in the last one."""
    parts = level.select(
        F.slice("items", 1, k - 2).alias("prefix"), F.col("items")[k - 2].alias("last")
    )
    a, b = parts, parts.withColumnRenamed("last", "next")
    return (
        heavy_join(a, b, ["prefix"], "last", "next")
        .where(F.col("last") < F.col("next"))
        .select(F.concat("prefix", F.array("last", "next")).alias("items"))
    )


def frequent_levels(
    index: VerticalIndex, max_k: int | None = None, pruning: BucketPruning | None = None
) -> DataFrame:
    """(items, support) of all frequent itemsets, level by level, items by number.

    Without ``pruning`` this is A-Priori, with it PCY. The driver only learns whether a level is
    empty.
    """
    level = index.items.select(F.array("item_no").alias("items"), "support")
    found = level
    k = 1
    while max_k is None or k < max_k:
        k += 1
        if k == 2:
            counts = index.pair_counts()
        else:
            counts = index.candidate_counts(cut(_extended(level, k)))
        if pruning and k in pruning.levels:
            counts = _prune(cut(counts), index.support, pruning)
        level = cut(index.frequent(counts))
        if level.isEmpty():
            break
        found = found.unionByName(level)
    return found


def frequent_itemsets(
    baskets: DataFrame,
    min_support: int,
    max_k: int | None = None,
    strict: bool = False,
    pruning: BucketPruning | None = None,
) -> DataFrame:
    """All frequent itemsets as (k, itemset, support)."""
    index = vertical_index(baskets, least_support(min_support, strict))
    return index.named(frequent_levels(index, max_k, pruning))


def pcy_candidate_counts(
    baskets: DataFrame, min_support: int, bucket: Column, strict: bool = False
) -> DataFrame:
    """One row: candidate pairs of frequent items before and after the bucket test.

    ``candidates_before`` is the number of pairs the frequent items form;
    ``candidates_after`` counts the pairs that some basket holds and whose bucket is frequent.
    ``bucket`` is an expression over ``item_a`` and ``item_b``.
    """
    support = least_support(min_support, strict)
    frequent = item_support(baskets).where(F.col("support") >= support).select("item")
    full = bucket_counts(basket_pairs(baskets), bucket).where(F.col("cnt") >= support)
    pairs = (
        basket_pairs(baskets.join(frequent, "item", "left_semi"))
        .groupBy("item_a", "item_b")
        .agg(F.count(F.lit(1)).alias("support"))
        .withColumn("bucket", bucket)
        .join(full.select("bucket"), "bucket", "left_semi")
    )
    zero, one = F.lit(0), F.lit(1)
    tallies = frequent.select(
        one.alias("item"), zero.alias("pair"), zero.alias("frequent_pair")
    ).unionByName(
        pairs.select(
            zero.alias("item"),
            one.alias("pair"),
            (F.col("support") >= support).cast("int").alias("frequent_pair"),
        )
    )
    return tallies.agg(
        F.sum("item").alias("n"),
        F.sum("pair").alias("candidates_after"),
        F.sum("frequent_pair").alias("frequent_pairs"),
    ).select(
        F.expr("n * (n - 1) div 2").alias("candidates_before"),
        "candidates_after",
        "frequent_pairs",
    )


def adaptive_threshold(
    baskets: DataFrame, start: int, target_k: int
) -> tuple[DataFrame, list[tuple[int, int, int, int]]]:
    """Lower the support by a quarter until a set of ``target_k`` items is frequent.

    Returns the itemsets of the last round and the trace: (round, threshold, k, sets found). What
    was counted is kept with its support, frequent or not, so a lower threshold only counts the
    candidates that have newly become possible and each candidate is counted once.
    """
    index = vertical_index(baskets, 1)
    level = index.items.select(F.array("item_no").alias("items"), "support")
    known = {1: level} | {k: level.limit(0) for k in range(2, target_k + 1)}
    trace = []
    threshold = start
    step = 0
    while True:
        step += 1
        enough = F.col("support") >= threshold
        found = level = known[1].where(enough)
        n_found = level.count()
        for k in range(1, target_k + 1):
            if k > 1:
                candidates = cut(_extended(level, k).join(known[k], "items", "left_anti"))
                if not candidates.isEmpty():
                    counts = index.candidate_counts(candidates)
                    summed = counts.groupBy("items").agg(F.sum("n").alias("n"))
                    new = candidates.join(summed, "items", "left").select(
                        "items", F.coalesce("n", F.lit(0)).alias("support")
                    )
                    known[k] = cut(known[k].unionByName(new))
                level = known[k].where(enough)
                n_found = level.count()
                found = found.unionByName(level)
            if n_found == 0:
                break
            trace.append((step, threshold, k, n_found))
        if n_found and k == target_k or threshold <= 1:
            return index.named(found), trace
        threshold = floor(threshold - threshold / 4)


def support_histogram(itemsets: DataFrame) -> DataFrame:
    """Number of itemsets at each support."""
    return itemsets.groupBy("k", "support").agg(F.count(F.lit(1)).alias("n_itemsets"))


def max_frequency_sets(itemsets: DataFrame) -> DataFrame:
    """All itemsets that have the highest support of their size."""
    top = itemsets.groupBy("k").agg(F.max("support").alias("support"))
    return itemsets.join(top, ["k", "support"]).select("k", "itemset", "support")


def best_itemset_per_size(itemsets: DataFrame) -> DataFrame:
    """One itemset per size: highest support, ties to the first in item order."""
    best = F.min(F.struct((-F.col("support")).alias("neg"), "itemset")).alias("best")
    return itemsets.groupBy("k").agg(best).select(
        "k", F.col("best.itemset").alias("itemset"), (-F.col("best.neg")).alias("support")
    )


def maximal_itemsets(baskets: DataFrame, min_support: int, strict: bool = False) -> DataFrame:
    """Frequent itemsets that no other frequent set contains, as (k, itemset, support).

    Searches from every first item, all searches a step deeper at a time. A node is a frequent set,
    its head, with the later items that keep it frequent, its tail. If head and tail together are
    frequent, everything below the node is a part of that set and is never listed.
    """
    index = vertical_index(baskets, least_support(min_support, strict))
    singles = index.items.select("item_no", "support")
    pairs = index.frequent(index.pair_counts()).select(
        F.col("items")[0].alias("item_no"), F.struct(F.col("items")[1].alias("item"), "support").alias("later")
    )
    tails = pairs.groupBy("item_no").agg(F.array_sort(F.collect_list("later")).alias("tail"))
    no_tail = F.array().cast("array<struct<item:int,support:bigint>>")
    nodes = cut(
        singles.join(tails, "item_no", "left").select(
            F.array("item_no").alias("head"), "support", F.coalesce("tail", no_tail).alias("tail")
        )
    )
    whole = F.concat("head", F.col("tail.item"))
    found = []
    while True:
        found.append(nodes.where(F.size("tail") == 0).select(F.col("head").alias("items"), "support"))
        growing = nodes.where(F.size("tail") > 0)
        candidates = cut(growing.select(whole.alias("items")).distinct())
        if candidates.isEmpty():
            break
        ahead = cut(index.frequent(index.candidate_counts(candidates)))
        found.append(ahead)
        closed = ahead.select(F.col("items").alias("whole"))
        growing = cut(
            growing.withColumn("whole", whole).join(closed, "whole", "left_anti").drop("whole")
        )
        nodes = cut(_children(index, growing, no_tail))
    every = cut(reduce(DataFrame.unionByName, found).distinct())
    return index.named(_not_contained(index, every))


def _children(index: VerticalIndex, nodes: DataFrame, no_tail: Column) -> DataFrame:
    """The nodes one item deeper, with the tails that their counts allow."""
    first = nodes.select("head", "tail", F.posexplode("tail").alias("at", "next"))
    grown = first.select(
        F.concat("head", F.array("next.item")).alias("head"),
        F.col("next.support").alias("support"),
        F.slice("tail", F.col("at") + 2, F.size("tail")).alias("later"),
    )
    candidates = cut(
        grown.select(
            F.explode(F.transform("later.item", lambda x: F.concat("head", F.array(x)))).alias("items")
        )
    )
    counted = index.frequent(index.candidate_counts(candidates)).select(
        F.slice("items", F.lit(1), F.size("items") - 1).alias("head"),
        F.struct(F.element_at("items", -1).alias("item"), "support").alias("later"),
    )
    tails = counted.groupBy("head").agg(F.array_sort(F.collect_list("later")).alias("tail"))
    return grown.join(tails, "head", "left").select(
        "head", "support", F.coalesce("tail", no_tail).alias("tail")
    )


def _not_contained(index: VerticalIndex, itemsets: DataFrame) -> DataFrame:
    """The sets that are not part of another one: as candidates over the sets as baskets, they are
    held once, by themselves."""
    counts = index_of_sets(itemsets, index.items).candidate_counts(itemsets.select("items"))
    alone = counts.groupBy("items").agg(F.sum("n").alias("n")).where(F.col("n") == 1)
    return itemsets.join(alone.select("items"), "items")


def fpgrowth_itemsets(baskets: DataFrame, min_support: int, strict: bool = False) -> DataFrame:
    """Frequent itemsets of every size by Spark ML's FP-growth, as (k, itemset, support).

    Only frequent items are gathered into a basket's array, so their number bounds its size.
    """
    support = least_support(min_support, strict)
    frequent = item_support(baskets).where(F.col("support") >= support).select("item")
    transactions = cut(
        baskets.join(frequent, "item", "left_semi")
        .groupBy("basket_id")
        .agg(F.collect_list("item").alias("items"))
        .select("items")
    )
    total = transactions.count()
    if total < support:  # nothing can be frequent, and FP-growth refuses a share above one
        empty = f"k int, itemset array<{baskets.schema['item'].dataType.simpleString()}>, support bigint"
        return baskets.sparkSession.createDataFrame([], empty)
    # half a basket below the count, so that rounding the fraction cannot raise the bound
    model = FPGrowth(itemsCol="items", minSupport=(support - 0.5) / total).fit(transactions)
    return (
        model.freqItemsets.select(
            F.array_sort("items").alias("itemset"), F.col("freq").alias("support")
        )
        .where(F.col("support") >= support)
        .select(F.size("itemset").alias("k"), "itemset", "support")
    )


def frequency_ordered_baskets(baskets: DataFrame, min_support: int, strict: bool) -> DataFrame:
    """Frequent items of each basket numbered by falling support, ties by item."""
    support = least_support(min_support, strict)
    frequent = item_support(baskets).where(F.col("support") >= support)
    return index_within(
        baskets.join(frequent, "item"), ["basket_id"], [F.desc("support"), "item"], "position"
    ).select("basket_id", "position", "item", "support")


def set_overlap(left: DataFrame, right: DataFrame, key: str, member: str) -> DataFrame:
    """Sizes of the intersection and union of the two member sets of each key, in one shuffle."""
    tagged = left.select(key, member, F.lit(1).alias("side")).unionByName(
        right.select(key, member, F.lit(2).alias("side"))
    )
    per_member = tagged.groupBy(key, member).agg(
        (F.max(F.when(F.col("side") == 1, 1).otherwise(0))).alias("in_left"),
        (F.max(F.when(F.col("side") == 2, 1).otherwise(0))).alias("in_right"),
    )
    return per_member.groupBy(key).agg(
        F.sum(F.col("in_left") * F.col("in_right")).alias("n_common"),
        F.count(F.lit(1)).alias("n_union"),
    )
