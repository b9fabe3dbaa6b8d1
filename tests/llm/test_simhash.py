"""SimHash components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from test_operators import ROWS, SCHEMA, UPPER, multiset

from coterie.llm import simhash
from coterie.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fingerprint(text):
    words = WORD.findall((text or "").translate(UPPER))
    runs = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(run.encode(), 42) for run in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """The label of each print: the least index among the prints its links reach."""
    distinct = np.array(sorted(set(prints)), np.uint64)
    label = {int(p): i for i, p in enumerate(distinct)}
    parent = list(range(len(distinct)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(distinct)):
        for j in np.flatnonzero(np.bitwise_count(distinct ^ distinct[i]) <= 3):
            parent[root(int(j))] = root(i)
    return [root(label[p]) for p in prints]


def want_rows(rows):
    prints = [brute_fingerprint(text) for _, text in rows]
    groups = brute_components(prints)
    least = {}
    for (doc_id, _), group in zip(rows, groups):
        if doc_id is not None:
            least[group] = min(least.get(group, doc_id), doc_id)
    return [(d, p, least.get(g)) for (d, _), p, g in zip(rows, prints, groups)]


def got_rows(frame):
    return [(d, p % (1 << 64), c) for d, p, c in frame.collect()]


def test_odd_documents(spark):
    rows = [row[:2] for row in ROWS] + [(500, "word " * 700_000), (501, "x" * 3_000_000)]
    odd = [(d, t, None, None, None, None, None) for d, t in rows]
    found = simhash.near_copies(spark.createDataFrame(odd, SCHEMA).repartition(3))
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert multiset(got_rows(found)) == multiset(want_rows(rows))
    assert simhash.near_copies(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = want_rows([(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()])
    found = QUERIES["op12_simhash_near_dedup"].run(spark, "/root/testdata/sf0.001").collect()
    assert multiset((d, int(p, 16), c) for d, p, c in found) == multiset(want)
    assert all(re.fullmatch("[0-9a-f]{16}", r.fingerprint) for r in found)
    assert len({c for *_, c in want}) < len(want)


@pytest.mark.parametrize("tile_rows", [4096, 40])
def test_dense_and_sparse_fingerprints(spark, monkeypatch, tile_rows):
    """Chains and balls of many different fingerprints, with hot buckets cut into tiles."""
    monkeypatch.setattr(simhash, "TILE_ROWS", tile_rows)
    random.seed(3)
    prints = [random.getrandbits(64) for _ in range(300)]
    for base in (0, prints[0], prints[1]):
        at = base
        for _ in range(200):
            prints.append(base ^ sum(1 << b for b in random.sample(range(64), random.randint(1, 6))))
            at ^= sum(1 << b for b in random.sample(range(64), random.randint(2, 4)))
            prints.append(at)
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fingerprint bigint")
    edges = [(a % (1 << 64), b % (1 << 64)) for a, b in simhash.fingerprint_links(frame).collect()]
    place = {p: i for i, p in enumerate(prints)}
    a, b = (np.array([place[edge[side]] for edge in edges]) for side in (0, 1))
    label = simhash.lowest_reached(len(prints), a, b)
    want = brute_components(prints)
    assert len({(x, y) for x, y in zip(label.tolist(), want)}) == len(set(want)) == len(set(label.tolist()))
    if tile_rows == 4096:  # one shard, whose links are a forest
        assert len(edges) == len(prints) - len(set(want))


def test_search_follows_only_near_edges():
    values = np.array([0, 1, 3, (1 << 64) - 1, 7 << 20], np.uint64)
    forest = simhash.BKForest(values, np.array([0, 0, 0, 0, 1]))
    found = [pair for block in forest.search(values, np.array([0, 0, 0, 0, 1]), 1) for pair in zip(*block)]
    assert {(int(q), int(n)) for q, n in found} == {(0, 0), (0, 1), (1, 0), (1, 1), (1, 2), (2, 1), (2, 2), (3, 3), (4, 4)}
    assert list(forest.search(values[:1], np.array([9]), 64)) == []
