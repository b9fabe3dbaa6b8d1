"""Supports of itemsets counted on bitmaps: which baskets of a range hold an item.

Baskets with the same frequent items are one, with their number as its weight. They are dealt to
ranges by a hash of the items and numbered inside them by falling weight. A range is one row: the
compressed bitmap of each frequent item over the range's baskets, and of each binary digit of the
weights. An itemset's support in a range is the population count of its items' bitmaps after AND,
once for each digit, and ranges add up. No basket is joined with itself, so a basket of any size
costs a bit for each of its items.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coterie.operators.indexing import dense_index
from coterie.operators.lineage import cut
from coterie.operators.skew import salted_join

RANGE_BYTES = 4 << 20
MOST_RANGE_BASKETS = 1 << 20
CANDIDATES_PER_PASS = 1 << 19
STEP_BYTES = 16 << 20
WORD_BITS = 64


def _pack_range(n_items: int):
    """One range's bitmaps from its (items, weight) rows: of all items, then of the weights' digits."""

    def bitmaps(numbers: np.ndarray, places: np.ndarray, n_rows: int, n_words: int) -> np.ndarray:
        bits = np.left_shift(np.uint64(1), (places % WORD_BITS).astype(np.uint64))
        words = np.zeros(n_rows * n_words, np.uint64)
        np.bitwise_or.at(words, numbers.astype(np.int64) * n_words + places // WORD_BITS, bits)
        return words.reshape(n_rows, n_words)

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("weight", "descending")])
        lists = rows.column("items").combine_chunks()
        weights = rows.column("weight").to_numpy()
        n_words = -(-len(weights) // WORD_BITS)
        basket = np.repeat(np.arange(len(weights)), lists.value_lengths().to_numpy())
        words = bitmaps(lists.flatten().to_numpy(), basket, n_items, n_words)
        n_digits = int(weights[0]).bit_length()
        digit, place = np.nonzero((weights >> np.arange(n_digits)[:, None]) & 1)
        words = np.concatenate((words, bitmaps(digit, place, n_digits, n_words)))
        codec = pa.Codec("zstd", 1)
        packed = [codec.compress(w.tobytes(), asbytes=True) for w in words]
        return pa.table(
            [
                pa.array([n_words], pa.int32()),
                pa.array([n_digits], pa.int32()),
                pa.array([packed], pa.list_(pa.binary())),
            ],
            ["n_words", "n_digits", "bitmaps"],
        )

    return pack


def _words(row: dict) -> tuple[np.ndarray, list[np.ndarray]]:
    """A range's bitmaps as items by words, and those of the weights' digits up to the last word set."""
    codec, size = pa.Codec("zstd", 1), row["n_words"] * 8
    raw = b"".join(codec.decompress(bitmap, size, asbytes=True) for bitmap in row["bitmaps"])
    words = np.frombuffer(raw, np.uint64).reshape(len(row["bitmaps"]), row["n_words"])
    n_items = len(words) - row["n_digits"]
    digits = [digit[: np.flatnonzero(digit)[-1] + 1] if digit.any() else digit[:0] for digit in words[n_items:]]
    return words[:n_items], digits


def _weight(words: np.ndarray, digits: list[np.ndarray]) -> np.ndarray:
    """The weight of the baskets in each row of bitmaps."""
    total = np.zeros(len(words), np.int64)
    for place, digit in enumerate(digits):
        ones = np.bitwise_count(words[:, : len(digit)] & digit).sum(axis=1, dtype=np.int64)
        total += ones << place
    return total


def _item_lists(items: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(items) + 1, dtype=np.int32) * items.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(items.ravel().astype(np.int32)))


COUNTED = "items array<int>, n bigint"


def _counted(items: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    held = n > 0
    return pa.RecordBatch.from_arrays(
        [_item_lists(items[held]), pa.array(n[held])], names=["items", "n"]
    )


def _pairs_function(batches):
    """The pairs of items that share a basket of a range, and in how many."""
    for batch in batches:
        for row in batch.to_pylist():
            words, digits = _words(row)
            for first in range(len(words) - 1):
                n = _weight(words[first + 1 :] & words[first], digits)
                later = np.flatnonzero(n)
                pairs = np.stack([np.full(len(later), first), later + first + 1], axis=1)
                yield _counted(pairs, n[later])


def _candidates_function(batches):
    """Counts of the candidates that come with each range."""
    for batch in batches:
        for row in batch.to_pylist():
            words, digits = _words(row)
            lengths = np.frombuffer(row["lengths"], np.int32)
            flat = np.frombuffer(row["flat"], np.int32)
            starts = np.cumsum(lengths) - lengths
            step = max(1, STEP_BYTES // (8 * words.shape[1]))
            for length in np.unique(lengths):
                those = starts[lengths == length]
                items = flat[those[:, None] + np.arange(length)]
                for at in range(0, len(items), step):
                    part = items[at : at + step]
                    common = words[part[:, 0]]
                    for place in range(1, length):
                        common = common & words[part[:, place]]
                    yield _counted(part, _weight(common, digits))


def _pack_candidates(rows: pa.Table) -> pa.Table:
    lists = rows.column("items").combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy()).astype(np.int32)
    flat = lists.flatten().to_numpy().astype(np.int32)
    columns = [rows.column("pass")[:1].combine_chunks()]
    columns += [pa.array([a.tobytes()], pa.binary()) for a in (lengths, flat)]
    return pa.table(columns, ["pass", "lengths", "flat"])


@dataclass
class VerticalIndex:
    """``items`` (item, support, item_no) and one row of bitmaps for each range of baskets."""

    items: DataFrame
    ranges: DataFrame
    support: int

    def pair_counts(self) -> DataFrame:
        """(items, n): the pairs of each range, to be added up."""
        return self.ranges.mapInArrow(_pairs_function, COUNTED)

    def candidate_counts(self, candidates: DataFrame) -> DataFrame:
        """(items, n): each candidate's count in each range that holds it, to be added up.

        ``candidates`` is a table of different ``items``, sets of any sizes, in rising order.
        They go out in passes of a fixed number, so that what is broadcast is bounded.
        """
        n_passes = max(1, -(-candidates.count() // CANDIDATES_PER_PASS))
        # by hash: half as many again is the most that a pass can be expected to hold
        number = F.pmod(F.xxhash64("items"), F.lit(n_passes)).cast("int").alias("pass")
        packed = cut(
            candidates.select(number, "items")
            .groupBy("pass")
            .applyInArrow(_pack_candidates, "pass int, lengths binary, flat binary")
        )
        counts = None
        for number in range(n_passes):
            ranges = self.ranges.withColumn("pass", F.lit(number))
            met = ranges.join(F.broadcast(packed.where(F.col("pass") == number)), "pass")
            found = met.mapInArrow(_candidates_function, COUNTED)
            counts = found if counts is None else counts.unionAll(found)
        return counts

    def frequent(self, counts: DataFrame) -> DataFrame:
        """(items, support) of the itemsets whose counts add up to the support."""
        summed = counts.groupBy("items").agg(F.sum("n").alias("support"))
        return summed.where(F.col("support") >= self.support)

    def named(self, itemsets: DataFrame) -> DataFrame:
        """(k, itemset, support) of (items, support): items by name, in their order."""
        exploded = itemsets.select("items", "support", F.posexplode("items").alias("at", "item_no"))
        names = self.items.select("item_no", "item")
        listed = salted_join(exploded, names, ["item_no"], "items")
        return (
            listed.groupBy("items", "support")
            .agg(F.array_sort(F.collect_list(F.struct("at", "item"))).alias("names"))
            .select(F.size("items").alias("k"), F.col("names.item").alias("itemset"), "support")
        )


def vertical_index(baskets: DataFrame, support: int) -> VerticalIndex:
    """The bitmaps of all items in at least ``support`` baskets.

    ``baskets`` is (basket_id, item), an item at most once in a basket. Items are numbered in their
    own order. Only frequent items are gathered into a basket's array, so their number bounds its
    size.
    """
    singles = baskets.groupBy("item").agg(F.count(F.lit(1)).alias("support"))
    singles = singles.where(F.col("support") >= support)
    items = cut(dense_index(singles, ["item"], "item_no"))
    items = items.select("item", "support", F.col("item_no").cast("int").alias("item_no"))
    kept = salted_join(baskets, items.select("item", "item_no"), ["item"], "basket_id")
    lists = kept.groupBy("basket_id").agg(F.array_sort(F.collect_set("item_no")).alias("items"))
    return VerticalIndex(items, _ranges(lists.select("items"), items.count()), support)


def _ranges(lists: DataFrame, n_items: int) -> DataFrame:
    """The bitmaps of ``items``, an array a basket, in ranges whose bitmaps stay within a fixed size."""
    weighed = cut(lists.groupBy("items").agg(F.count(F.lit(1)).alias("weight")))
    n_baskets = weighed.count()
    tasks = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = min(MOST_RANGE_BASKETS, max(WORD_BITS, 8 * RANGE_BYTES // max(n_items, 1)))
    n_ranges = max(1, -(-n_baskets // most), min(tasks, n_baskets // WORD_BITS))
    return cut(
        weighed.withColumn("range", F.pmod(F.xxhash64("items"), F.lit(n_ranges)))
        .groupBy("range")
        .applyInArrow(_pack_range(n_items), "n_words int, n_digits int, bitmaps array<binary>")
    )


def index_of_sets(itemsets: DataFrame, items: DataFrame) -> VerticalIndex:
    """The bitmaps of different ``items`` arrays of item numbers, each as a basket of its own."""
    return VerticalIndex(items, _ranges(itemsets.select("items"), items.count()), 1)
