"""Near copies by SimHash fingerprints, linked by searches in BK-trees.

Two 64-bit fingerprints that differ in at most ``radius`` bits agree in one of ``radius + 1``
blocks of bits. Each distinct fingerprint therefore goes to one bucket per block, and buckets are
dealt to shards of bounded size. A shard grows a BK-tree in each of its buckets, where a child hangs
on its parent by their distance, and every fingerprint searches the tree of its bucket along the
edges that the radius allows. A hot bucket is cut into tiles; the tree of a tile goes to all tiles
that search it. Copies of one fingerprint are one node throughout.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coterie.llm.buffers import NOT_SPACE, TO_LOWER, byte_view, pieces, ranges, words
from coterie.operators.graph import connected_components
from coterie.operators.lineage import cut
from coterie.operators.skew import salted_join

SHINGLE_WORDS = 3
SEED = 42
BITS = 64
RADIUS = 3
VOTE_ROWS = 1 << 15
TILE_ROWS = 4096
SHARD_ROWS = 1 << 15
SEARCH_ROWS = 1 << 18

FINGERPRINT_TYPE = "fingerprint bigint"


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, width: int):
    """(hashes, bounds): the XXH64 of every shingle of each row, in order, repeats included."""
    lower = TO_LOWER[data]
    starts, ends, bounds = words(lower, offsets, NOT_SPACE)
    # every word with one space after it, so that a shingle is a slice
    lengths = ends - starts + 1
    spaced = np.full(int(lengths.sum()), 0x20, np.uint8)
    firsts = np.cumsum(lengths) - lengths
    spaced[ranges(firsts, lengths - 1)] = lower[ranges(starts, lengths - 1)]
    n_words = np.diff(bounds)
    n_shingles = np.where(n_words, np.maximum(n_words - width + 1, 1), 0)
    at = ranges(bounds[:-1], n_shingles)
    last = at + np.repeat(np.minimum(n_words, width), n_shingles) - 1
    raw, digest = spaced.tobytes(), xxhash.xxh64_intdigest
    spans = zip(firsts[at].tolist(), (firsts[last] + lengths[last] - 1).tolist(), strict=True)
    hashes = np.fromiter((digest(raw[a:b], SEED) for a, b in spans), np.uint64, len(at))
    return hashes, np.concatenate(([0], np.cumsum(n_shingles)))


def majority_bits(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The fingerprint of each row: the bits that are set in over half of its hashes."""
    n_rows = len(bounds) - 1
    votes = np.zeros((n_rows, BITS), np.int64)
    row_of = np.repeat(np.arange(n_rows), np.diff(bounds))
    for at in range(0, len(hashes), VOTE_ROWS):
        part = np.ascontiguousarray(hashes[at : at + VOTE_ROWS], "<u8").view(np.uint8)
        bits = np.unpackbits(part.reshape(-1, 8), axis=1, bitorder="little")
        rows = row_of[at : at + VOTE_ROWS]
        first = np.flatnonzero(np.diff(rows, prepend=-1))
        votes[rows[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    chosen = 2 * votes > np.diff(bounds)[:, None]
    return np.packbits(chosen, axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fingerprint): the SimHash of every row's whole text, as a signed 64-bit number.

    Null and empty texts and texts without words have fingerprint zero.
    """

    def compute(batches):
        for batch in pieces(batches, "text"):
            data, offsets = byte_view(batch.column("text"))
            found = majority_bits(*shingle_hashes(data, offsets, width))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.view(np.int64))],
                names=["doc_id", "fingerprint"],
            )

    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return ids.mapInArrow(compute, "doc_id bigint, " + FINGERPRINT_TYPE)


class BKForest:
    """BK-trees over groups of fingerprints, built level by level.

    The first row of a group is its root; the others become one group per distance to it, and so
    on. Children of a node are kept together, ordered by distance: ``edges`` holds
    parent * 128 + distance in rising order and ``children`` the node each edge leads to.
    """

    def __init__(self, values: np.ndarray, groups: np.ndarray):
        self.values = values
        order = np.argsort(groups, kind="stable")
        groups = groups[order]
        opens = np.flatnonzero(np.diff(groups, prepend=-1))
        self.root_groups, self.roots = groups[opens], order[opens]
        edges, children = [], []
        rows = order
        while len(rows):
            sizes = np.diff(np.append(opens, len(rows)))
            parents = np.repeat(rows[opens], sizes)
            keep = np.ones(len(rows), bool)
            keep[opens] = False
            rows, parents = rows[keep], parents[keep]
            key = parents * 128 + np.bitwise_count(values[rows] ^ values[parents])
            order = np.argsort(key, kind="stable")
            rows, key = rows[order], key[order]
            opens = np.flatnonzero(np.diff(key, prepend=-1))
            edges.append(key[opens])
            children.append(rows[opens])
        edges = np.concatenate(edges) if edges else np.zeros(0, np.int64)
        children = np.concatenate(children) if children else np.zeros(0, np.int64)
        order = np.argsort(edges, kind="stable")
        self.edges, self.children = edges[order], children[order]

    def search(self, values: np.ndarray, groups: np.ndarray, radius: int):
        """(query, node) pairs within the radius, in blocks of bounded size."""
        place = np.searchsorted(self.root_groups, groups)
        place = np.minimum(place, len(self.roots) - 1)
        known = np.flatnonzero(self.root_groups[place] == groups)
        waiting = [(known, self.roots[place[known]])]
        while waiting:
            query, node = waiting.pop()
            if len(query) > SEARCH_ROWS:
                waiting.append((query[SEARCH_ROWS:], node[SEARCH_ROWS:]))
                query, node = query[:SEARCH_ROWS], node[:SEARCH_ROWS]
            distance = np.bitwise_count(values[query] ^ self.values[node]).astype(np.int64)
            near = distance <= radius
            if near.any():
                yield query[near], node[near]
            low = np.searchsorted(self.edges, node * 128 + np.maximum(distance - radius, 0))
            high = np.searchsorted(self.edges, node * 128 + distance + radius, side="right")
            if (high > low).any():
                lengths = high - low
                waiting.append((np.repeat(query, lengths), self.children[ranges(low, lengths)]))


def lowest_reached(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node that each of ``n`` nodes is linked to, directly or not."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _link_function(radius: int):
    """Edges (a, b) that tie together what the searches of one shard link."""

    def link(rows: pa.Table) -> pa.Table:
        values = rows.column("fingerprint").to_numpy().view(np.uint64)
        groups = np.unique(rows.column("bucket").to_numpy(), return_inverse=True)[1]
        grown = np.flatnonzero(rows.column("in_tree").to_numpy(zero_copy_only=False))
        asks = np.flatnonzero(rows.column("asks").to_numpy(zero_copy_only=False))
        unique, node = np.unique(values, return_inverse=True)
        label = np.arange(len(unique))
        if len(grown) and len(asks):
            forest = BKForest(values[grown], groups[grown])
            for query, found in forest.search(values[asks], groups[asks], radius):
                a, b = node[asks[query]], node[grown[found]]
                apart = label[a] != label[b]
                if apart.any():
                    merged = lowest_reached(len(unique), label[a[apart]], label[b[apart]])
                    label = merged[label]
        tied = np.flatnonzero(label != np.arange(len(unique)))
        a, b = unique[tied].view(np.int64), unique[label[tied]].view(np.int64)
        return pa.table([pa.array(a), pa.array(b)], ["a", "b"])

    return link


def _buckets(distinct: DataFrame, radius: int) -> DataFrame:
    """(fingerprint, bucket): the block values of each fingerprint, with the block's number."""
    rows = []
    for block in range(radius + 1):
        start, end = BITS * block // (radius + 1), BITS * (block + 1) // (radius + 1)
        mask = (1 << (end - start)) - 1
        value = F.shiftrightunsigned("fingerprint", start).bitwiseAND(F.lit(mask))
        rows.append(F.xxhash64(F.lit(block), value))
    return distinct.select("fingerprint", F.explode(F.array(*rows)).alias("bucket"))


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): edges that connect all fingerprints within ``radius`` bits of each other.

    ``distinct`` has each ``fingerprint`` once. The edges are a forest of each shard's links, so
    a dense group costs edges in its number of fingerprints, not of its pairs.
    """
    if not 0 <= radius < BITS // 2:
        raise ValueError("the radius must be between 0 and 31 bits")
    placed = cut(_buckets(distinct, radius))
    sizes = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = cut(sizes.withColumn("tiles", F.ceil(F.col("n") / TILE_ROWS).cast("int")))
    n_rows = sizes.agg(F.sum(F.col("n") * F.col("tiles"))).first()[0] or 0
    n_shards = max(1, -(-n_rows // SHARD_ROWS))
    rows = salted_join(placed, sizes, ["bucket"], "fingerprint").withColumn(
        "tile", F.pmod(F.xxhash64(F.lit("tile"), "fingerprint"), F.col("tiles")).cast("int")
    )
    # the tree of tile t is asked by the tiles 0 to t
    meetings = F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1),
        lambda other: F.struct(
            F.greatest("tile", other).alias("tree"),
            F.least("tile", other).alias("asking"),
            (other <= F.col("tile")).alias("in_tree"),
            (other >= F.col("tile")).alias("asks"),
        ),
    )
    met = rows.select("fingerprint", "bucket", "tiles", F.inline(meetings)).select(
        "fingerprint",
        F.when(F.col("tiles") == 1, F.col("bucket"))
        .otherwise(F.xxhash64("bucket", "tree", "asking"))
        .alias("bucket"),
        "in_tree",
        "asks",
    )
    return (
        met.withColumn("shard", F.pmod(F.xxhash64("bucket"), F.lit(n_shards)))
        .groupBy("shard")
        .applyInArrow(_link_function(radius), "a bigint, b bigint")
    )


def near_copies(docs: DataFrame, width: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    ``fingerprint`` is a signed number; ``component_id`` is the smallest doc_id that links
    reach, links being fingerprints that differ in at most ``radius`` bits. Rows of one text or
    without words (null, empty or blank: fingerprint zero) are linked like any others, and texts of
    any length are read whole. Rows that share a doc_id are fingerprinted apart. Rows without
    doc_id take part in links; their component_id is null if no row with an id is reached. Other
    columns are left out. No rows give no rows.
    """
    marked = fingerprints(docs, width)
    marked = cut(marked.withColumn("_row", F.monotonically_increasing_id()))
    nodes = cut(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")))
    links = cut(fingerprint_links(nodes.select("fingerprint"), radius))
    ends = links.select("a").unionAll(links.select("b")).distinct().toDF("id")
    found = connected_components(ends, links)
    placed = nodes.join(found, nodes["fingerprint"] == found["id"], "left").select(
        "fingerprint", F.coalesce("component", "fingerprint").alias("component"), "least_id"
    )
    placed = cut(placed)
    least = placed.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = salted_join(placed, least, ["component"], "fingerprint")
    named = named.select("fingerprint", "component_id")
    return salted_join(marked, named, ["fingerprint"], "_row").select(
        "doc_id", "fingerprint", "component_id"
    )
