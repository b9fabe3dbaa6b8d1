"""The mining algorithms against each other and against brute force."""

import random
from collections import Counter
from itertools import combinations

import pytest

from coterie.operators import itemsets as ops
from coterie.operators import vertical


def brute_force(baskets, support):
    counts = Counter()
    for items in baskets.values():
        for k in range(1, len(items) + 1):
            counts.update(combinations(sorted(items), k))
    return {key: n for key, n in counts.items() if n >= support}


def frame(spark, baskets):
    rows = [(key, item) for key, items in baskets.items() for item in items]
    return spark.createDataFrame(rows, "basket_id bigint, item string")


def found(itemsets):
    return {tuple(row["itemset"]): row["support"] for row in itemsets.collect()}


@pytest.fixture(scope="module")
def baskets():
    chance = random.Random(7)
    small = {i: set(chance.sample("abcdef", chance.randint(1, 4))) for i in range(40)}
    return small | {100: set("abcdefgh"), 101: set("abcdefh")}


SUPPORT = 5


@pytest.mark.parametrize("range_bytes,per_pass", [(4 << 20, 1 << 19), (8, 3)])
@pytest.mark.parametrize("pruning", [None, ops.BucketPruning(7, levels=(2, 3))])
def test_levels(spark, monkeypatch, baskets, range_bytes, per_pass, pruning):
    """One range and pass, and many."""
    monkeypatch.setattr(vertical, "RANGE_BYTES", range_bytes)
    monkeypatch.setattr(vertical, "CANDIDATES_PER_PASS", per_pass)
    result = ops.frequent_itemsets(frame(spark, baskets), SUPPORT, pruning=pruning)
    assert found(result) == brute_force(baskets, SUPPORT)


def test_fpgrowth_equals_apriori(spark, baskets):
    result = ops.fpgrowth_itemsets(frame(spark, baskets), SUPPORT)
    assert found(result) == brute_force(baskets, SUPPORT)


def test_nothing_frequent(spark, baskets):
    for mine in (ops.frequent_itemsets, ops.fpgrowth_itemsets, ops.maximal_itemsets):
        assert mine(frame(spark, baskets), 1000).count() == 0
        assert mine(frame(spark, baskets).limit(0), 1).count() == 0


def test_basket_of_five_thousand_items(spark):
    """Its items are rare but for three, which meet in other baskets too."""
    rows = [(0, f"i{n}") for n in range(5000)]
    rows += [(b, f"i{n}") for b in range(1, 130) for n in (7, 8, 9 if b % 2 else 10)]
    data = spark.createDataFrame(rows, "basket_id bigint, item string")
    got = found(ops.frequent_itemsets(data, 66))
    want = {("i7",): 130, ("i8",): 130, ("i7", "i8"): 130}
    assert got == want | {("i9",): 66, ("i7", "i9"): 66, ("i8", "i9"): 66, ("i7", "i8", "i9"): 66}
    assert found(ops.maximal_itemsets(data, 66)) == {("i7", "i8", "i9"): 66}
    every = ops.frequent_itemsets(data, 1, max_k=1)
    assert every.count() == 5000


def brute_maximal(baskets, support):
    frequent = brute_force(baskets, support)
    return {a: n for a, n in frequent.items() if not any(set(a) < set(b) for b in frequent)}


@pytest.mark.parametrize("support", [1, 2, 5, 9, 20])
def test_maximal(spark, baskets, support):
    assert found(ops.maximal_itemsets(frame(spark, baskets), support)) == brute_maximal(baskets, support)


def test_maximal_set_of_thirty_items(spark):
    """Its two to the power of thirty parts are never listed."""
    names = [f"n{i:02d}" for i in range(30)]
    chance = random.Random(2)
    rows = [(b, name) for b in range(6) for name in names]
    rows += [(b, name) for b in range(6, 40) for name in chance.sample([*names, "x", "y"], 2)]
    data = spark.createDataFrame(rows, "basket_id bigint, item string")
    got = found(ops.maximal_itemsets(data, 6))
    assert got.pop(tuple(names)) == 6
    assert all(set(a) & {"x", "y"} for a in got)


def test_strict_threshold(spark, baskets):
    result = ops.frequent_itemsets(frame(spark, baskets), SUPPORT, strict=True)
    assert found(result) == brute_force(baskets, SUPPORT + 1)


def test_containment_counts_zero_and_single_items(spark, baskets):
    wanted = spark.createDataFrame([(["a"],), (["c", "a", "b"],), (["a", "zz"],)], "itemset array<string>")
    expected = {
        ("a",): sum("a" in items for items in baskets.values()),
        ("c", "a", "b"): sum({"a", "b", "c"} <= items for items in baskets.values()),
        ("a", "zz"): 0,
    }
    assert found(ops.containment_counts(frame(spark, baskets), wanted)) == expected


def test_repeated_items_collapse(spark):
    rows = spark.createDataFrame([(1, "a")] * 3 + [(1, "b")], "basket_id bigint, item string")
    pairs = ops.basket_pairs(ops.dedupe_baskets(rows)).collect()
    assert [(row["item_a"], row["item_b"]) for row in pairs] == [("a", "b")]


def test_adaptive_threshold_stops_at_the_first_set(spark, baskets):
    trace = ops.adaptive_threshold(frame(spark, baskets), 30, target_k=3)[1]
    best = max(n for key, n in brute_force(baskets, 1).items() if len(key) == 3)
    last = trace[-1]
    assert last[2] == 3 and last[1] <= best
    assert all(row[2] < 3 for row in trace if row[0] < last[0])


def test_adaptive_threshold_counts_no_candidate_twice(spark, baskets, monkeypatch):
    counted = []
    count = vertical.VerticalIndex.candidate_counts

    def listed(index, candidates):
        counted.extend(tuple(row["items"]) for row in candidates.collect())
        return count(index, candidates)

    monkeypatch.setattr(vertical.VerticalIndex, "candidate_counts", listed)
    sets, trace = ops.adaptive_threshold(frame(spark, baskets), 30, target_k=3)
    assert len(counted) == len(set(counted)) > 0
    want = {key: n for key, n in brute_force(baskets, trace[-1][1]).items() if len(key) <= 3}
    assert found(sets) == want
    for step, threshold, k, n in trace:
        assert n == sum(len(key) == k for key in brute_force(baskets, threshold))


def test_equal_baskets_are_one_row_of_bitmaps(spark):
    """Copies of few baskets take no more words than the baskets that differ."""
    kinds = [("a", "b", "c"), ("a", "b"), ("b", "c", "d"), ("d",)]
    rows = [(n, item) for n in range(1000) for item in kinds[min(n % 7, 3)]]
    data = spark.createDataFrame(rows, "basket_id bigint, item string")
    index = vertical.vertical_index(data, 1)
    assert sum(row["n_words"] for row in index.ranges.collect()) == 1
    baskets = {n: kinds[min(n % 7, 3)] for n in range(1000)}
    assert found(ops.frequent_itemsets(data, 1)) == brute_force(baskets, 1)
    assert found(ops.maximal_itemsets(data, 100)) == brute_maximal(baskets, 100)
