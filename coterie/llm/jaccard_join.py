"""Linking documents of similar word shingles by parity sketches and pigeonhole keys."""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coterie.llm.buffers import (
    NOT_SPACE,
    TO_LOWER,
    SpanHash,
    byte_view,
    mixed,
    pieces,
    ranges,
    window_hash,
    words,
)
from coterie.llm.exchange import (
    NO_ID,
    ROWS,
    bucket_count,
    bucket_of,
    bucket_of_ids,
    by_bucket,
    keyed,
    pack,
    rows_batch,
    text_blocks,
    texts_by_bucket,
    unpack,
)
from coterie.operators.graph import connected_components
from coterie.operators.lineage import cut
from coterie.operators.skew import salted_join

SHINGLE_WORDS = 5
PERCENT = 75
CELL_BITS = 22
SLICE_CELLS = 1 << 16
PARTS_SUMMED = 1000
FLUSH_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
HOT_MEMBERS = 64
CHUNK_NODES = 1000
FILTER_CELLS = 1 << 26
FILTER_SLICE = 1 << 16
SKETCH_BITS = 1024
SINGLE_BELOW = 64  # sets below this size have a word for each shingle
SPARE_BITS = 2  # larger ones four words per shingle of the band's smallest set

KEY, STAR, NODE = 0, 1, 2
COUNT_TYPES = [("count", "i8")]
# 40 bits of a key, besides its bucket: keys that agree in them only bring sets together
KEY_TYPES = [("high", "u4"), ("low", "u1"), ("node", "i8")]
PAIR_TYPES = [("hub", "i8"), ("member", "i8")]


def shingle_sets(data, offsets, hasher: SpanHash, width: int):
    """(hashes, bounds): the distinct shingle hashes of each text, in order.

    Texts of fewer words than ``width``, but not none, have the whole sequence as one shingle.
    """
    data = TO_LOWER[data]
    starts, ends, bounds = words(data, offsets, NOT_SPACE)
    hasher.load(data)
    hashes = hasher(starts, ends)
    n_words = np.diff(bounds)
    found, row = [], []
    for length in range(1, width + 1):
        rows = np.flatnonzero(n_words >= width if length == width else n_words == length)
        if len(rows):
            each = n_words[rows] - length + 1
            found.append(window_hash(hashes, length)[ranges(bounds[rows], each)])
            row.append(np.repeat(rows, each))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    found, row = np.concatenate(found), np.concatenate(row)
    order = np.lexsort((found, row))
    found, row = found[order], row[order]
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] != found[:-1]) | (row[1:] != row[:-1])
    return found[keep], np.searchsorted(row[keep], np.arange(len(offsets)))


def largest_difference(smaller, larger, percent: int):
    """The most shingles in which linked sets of these sizes can differ.

    100 * both >= percent * union gives union <= 100 * (a + b) / (100 + percent), and the
    difference is 2 * union - (a + b).
    """
    return (smaller + larger) * (100 - percent) // (100 + percent)


def pigeonhole_keys(hashes, bounds, levels, percent: int):
    """(row, key): words of the rows' parity sketches, of which linked rows share at least one.

    Sets are in bands by powers of two of their size. A band's sketch deals the shingles to words
    and keeps in each word the XOR of their hashes, so ``d`` differing shingles change at most
    ``d`` words. In a common order of all words, two sketches that differ in at most ``d`` of the
    words either one has must agree in one of the first ``d + 1`` of both. The order puts words
    whose shingles are frequent in the corpus (``levels``, by hash cell) last. Sets that can be
    linked to the band below are sketched for that band as well.
    """
    sizes = np.diff(bounds)
    rows = np.flatnonzero(sizes)
    band = np.floor(np.log2(np.maximum(sizes[rows], 1))).astype(np.int64)
    low = np.int64(1) << band
    most = largest_difference(sizes[rows], sizes[rows] * 100 // percent, percent)
    down = (band > 0) & (-(-sizes[rows] * percent // 100) <= low - 1)
    most_down = largest_difference(low - 1, sizes[rows], percent)
    row = np.concatenate((rows, rows[down]))
    band = np.concatenate((band, band[down] - 1))
    most = np.concatenate((most, most_down[down]))
    each = sizes[row]
    index = ranges(bounds[row], each)
    sketch = np.repeat(np.arange(len(row)), each)
    shift = np.where((1 << band) < SINGLE_BELOW, 0, 64 - band - SPARE_BITS).astype(np.uint64)
    values = hashes[index]
    word = values >> shift[sketch]
    opens = np.ones(len(index), bool)
    opens[1:] = (sketch[1:] != sketch[:-1]) | (word[1:] != word[:-1])
    begin = np.flatnonzero(opens)
    if not len(begin):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums = np.bitwise_xor.reduceat(mixed(values + np.uint64(0x5851F42D4C957F2D)), begin)
    level = np.minimum.reduceat(levels[values >> np.uint64(64 - CELL_BITS)], begin)
    sketch, word = sketch[begin], word[begin]
    keys = mixed(mixed(sums + word) + band[sketch].astype(np.uint64))
    order = np.lexsort((keys, level, sketch))
    first = np.searchsorted(sketch, np.arange(len(row)))
    if (np.diff(np.append(first, len(sketch))) <= most).any():
        raise RuntimeError("a sketch has too few words in use")  # hashes would have to collide
    place = np.arange(len(sketch)) - first[sketch]
    chosen = place <= most[sketch]
    return row[sketch[chosen]], keys[order][chosen]


def _count_function(width: int):
    """How many sets have a shingle in each cell of the hash space, for a whole task."""

    def count(batches):
        hasher, counts = SpanHash(), np.zeros(1 << CELL_BITS, np.int64)
        for batch in pieces(batches, "text"):
            hashes, _ = shingle_sets(*byte_view(batch.column("text")), hasher, width)
            cells = (hashes >> np.uint64(64 - CELL_BITS)).astype(np.int64)
            counts += np.bincount(cells, minlength=len(counts))
        part = TaskContext.get().partitionId() // PARTS_SUMMED
        slices = counts.reshape(-1, SLICE_CELLS)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part] * len(slices), pa.int32()),
                pa.array(range(len(slices)), pa.int32()),
                pa.array([pack([s], COUNT_TYPES) for s in slices], pa.binary()),
            ],
            names=["part", "slice", "counts"],
        )

    return count


def _sum_slices(table: pa.Table) -> pa.Table:
    total = sum(unpack([b.as_py()], COUNT_TYPES)["count"] for b in table.column("counts"))
    columns = [table.column(n)[:1] for n in ("part", "slice")]
    packed = pa.array([pack([total], COUNT_TYPES)], pa.binary())
    return pa.table([*columns, packed], table.column_names)


def shingle_levels(docs: DataFrame, width: int) -> np.ndarray:
    """Four times the logarithm of each cell's count over all documents.

    Tasks give one array of fixed size each, which are added up in two rounds; the driver gets
    one array, whatever the size of the corpus, and opens a slice of its counts at a time.
    """
    schema = "part int, slice int, counts binary"
    slices = docs.mapInArrow(_count_function(width), schema)
    parts = slices.groupBy("part", "slice").applyInArrow(_sum_slices, schema)
    summed = parts.groupBy("slice").applyInArrow(_sum_slices, schema).collect()
    return levels_of((row["slice"], row["counts"]) for row in summed)


def levels_of(slices) -> np.ndarray:
    """The levels of all cells, of (slice, packed counts); cells of no slice count 0."""
    levels = np.zeros(1 << CELL_BITS, np.uint8)
    for number, packed in slices:
        counts = unpack([packed], COUNT_TYPES)["count"]
        at = number * SLICE_CELLS
        levels[at : at + SLICE_CELLS] = np.minimum(255, 4 * np.log2(1.0 + counts)).astype(np.uint8)
    return levels


def set_nodes(hashes, bounds, rows) -> np.ndarray:
    """The node of each of the ``rows``, none of them empty: a hash of the whole set."""
    sizes = np.diff(bounds)[rows]
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
    sums = np.add.reduceat(mixed(hashes[ranges(bounds[rows], sizes)] + np.uint64(1)), starts)
    return mixed(sums + sizes.astype(np.uint64)).view(np.int64)


def _key_function(levels, width: int, percent: int, n_buckets: int):
    """The node of each document, a hash of its whole set, and the keys of the nodes.

    So equal sets are one node from here on; within a task a key that is hot goes on only from
    its first node, the others being tied to that.
    """

    def send(batches):
        hasher, held, size = SpanHash(), [], 0

        def flush():
            ids = np.concatenate([h[0] for h in held])
            hashes = np.concatenate([h[1] for h in held])
            bounds = np.concatenate(([0], np.cumsum(np.concatenate([h[2] for h in held]))))
            sizes = np.diff(bounds)
            full = np.flatnonzero(sizes)
            out = []
            if len(full):
                nodes = set_nodes(hashes, bounds, full)
                out += _pairs(NODE, nodes, ids[full], n_buckets)
                nodes, lead = np.unique(nodes, return_index=True)
                kept = full[lead]
                index = ranges(bounds[kept], sizes[kept])
                limits = np.concatenate(([0], np.cumsum(sizes[kept])))
                row, keys = pigeonhole_keys(hashes[index], limits, levels.value, percent)
                docs = nodes[row]
                order = np.lexsort((docs, keys))
                keys, docs = keys[order], docs[order]
                begin = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
                count = np.diff(np.append(begin, len(keys)))
                hot = np.repeat(count >= HOT_MEMBERS, count)
                hot[begin] = False
                hub = np.repeat(docs[begin], count)
                out += _pairs(STAR, hub[hot], docs[hot], n_buckets)  # never the hub itself
                keys, docs = keys[~hot], docs[~hot]
                columns = [keys >> np.uint64(32), keys >> np.uint64(24) & np.uint64(255), docs]
                packed = by_bucket(bucket_of(keys, n_buckets), columns, KEY_TYPES)
                out += [(KEY, b, blob) for b, blob in packed]
            return rows_batch(out)

        for batch in pieces(batches, "text"):
            hashes, bounds = shingle_sets(*byte_view(batch.column("text")), hasher, width)
            held.append((batch.column("doc_id").to_numpy(), hashes, np.diff(bounds)))
            size += batch.column("text").nbytes
            if size >= FLUSH_BYTES:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return send


def _pairs(kind: int, hub, member, n_buckets: int):
    """Packed distinct pairs, dealt by a hash of both."""
    pairs = np.unique(np.stack([hub, member], axis=1), axis=0)
    hub, member = pairs[:, 0], pairs[:, 1]
    buckets = bucket_of(mixed(mixed(hub.astype(np.uint64)) + member.astype(np.uint64)), n_buckets)
    return [(kind, b, blob) for b, blob in by_bucket(buckets, [hub, member], PAIR_TYPES)]


PAIRS = "kind int, hub bigint, member bigint"


def _meet(table: pa.Table) -> pa.Table:
    """Each key's nodes tied to the first of them; pairs found in tasks are passed on."""
    kinds, blobs = table.column("kind").to_numpy(), table.column("packed").to_pylist()
    rows = unpack([b for k, b in zip(kinds, blobs) if k == KEY], KEY_TYPES)
    keys = rows["high"].astype(np.uint64) << np.uint64(8) | rows["low"]
    docs = rows["node"]
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    found = [(KEY, np.zeros((0, 2), np.int64))]
    if len(keys):
        begin = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        hub = np.repeat(docs[begin], np.diff(np.append(begin, len(keys))))
        found.append((KEY, np.stack([hub, docs], axis=1)[hub != docs]))
    for kind in (STAR, NODE):
        pairs = unpack([b for k, b in zip(kinds, blobs) if k == kind], PAIR_TYPES)
        found.append((kind, np.stack([pairs["hub"], pairs["member"]], axis=1)))
    found = [(kind, np.unique(pairs, axis=0)) for kind, pairs in found]
    pairs = np.concatenate([p for _, p in found])
    return pa.table(
        {
            "kind": pa.array(np.repeat([k for k, _ in found], [len(p) for _, p in found]), pa.int32()),
            "hub": pa.array(pairs[:, 0]),
            "member": pa.array(pairs[:, 1]),
        }
    )


def _id_buckets(n_buckets: int):
    def deal(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            buckets = pa.array(bucket_of_ids(ids.to_numpy(), n_buckets), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [buckets, ids, batch.column("node")], names=["bucket", "doc_id", "node"]
            )

    return deal


SIZED = "doc_id bigint, n_shingles bigint, node bigint, sketch binary, text binary"


def _size_function(width: int):
    """The set size of every document, and node, sketch and compressed text of those in a pair.

    A node's text is taken once, from the document that stands for it.
    """

    def measure(texts: pa.Table, wanted: pa.Table) -> pa.Table:
        wanted = set(zip(*(wanted.column(c).to_pylist() for c in ("doc_id", "node")), strict=True))
        names = {doc_id for doc_id, _ in wanted}
        hasher, codec = SpanHash(), pa.Codec("zstd", 1)
        out = []
        for ids, _, data, offsets in text_blocks(texts):
            hashes, bounds = shingle_sets(data, offsets, hasher, width)
            packed, sketches, nodes = ([None] * len(ids) for _ in range(3))
            sizes = np.diff(bounds)
            rows = [i for i, name in enumerate(ids.tolist()) if name in names and sizes[i]]
            for row, node in zip(rows, set_nodes(hashes, bounds, rows).tolist() if rows else (), strict=True):
                if (int(ids[row]), node) not in wanted:
                    continue
                wanted.remove((int(ids[row]), node))
                raw = data[offsets[row] : offsets[row + 1]].tobytes()
                packed[row] = len(raw).to_bytes(8, "little") + codec.compress(raw, asbytes=True)
                sketches[row] = parity_sketches([hashes[bounds[row] : bounds[row + 1]]]).tobytes()
                nodes[row] = node
            columns = [pa.array(ids), pa.array(sizes), pa.array(nodes, pa.int64())]
            columns += [pa.array(sketches, pa.binary()), pa.array(packed, pa.binary())]
            out.append(pa.table(columns, ["doc_id", "n_shingles", "node", "sketch", "text"]))
        empty = pa.schema(
            [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()),
             ("sketch", pa.binary()), ("text", pa.binary())]
        )
        return pa.concat_tables(out) if out else empty.empty_table()

    return measure


def _cells(nodes: np.ndarray) -> np.ndarray:
    return (mixed(nodes.view(np.uint64)) % np.uint64(FILTER_CELLS)).astype(np.int64)


def _cell_slices(batches):
    for batch in batches:
        cells = np.unique(_cells(batch.column("node").to_numpy()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells // FILTER_SLICE, pa.int32()), pa.array(cells % FILTER_SLICE, pa.int32())],
            names=["slice", "cell"],
        )


def _slice_bits(table: pa.Table) -> pa.Table:
    bits = np.zeros(FILTER_SLICE, np.uint8)
    bits[table.column("cell").to_numpy()] = 1
    bits = pa.array([np.packbits(bits).tobytes()], pa.binary())
    return pa.table([table.column("slice")[:1], bits], ["slice", "bits"])


def likely_among(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The ``rows`` whose node is one of ``nodes``, and a few others; nothing is shuffled but nodes.

    Tasks pass rows by a bitmap of hashed nodes, 8 MB whatever the size of the corpus, so that texts
    that no join wants are not moved to it.
    """
    slices = nodes.mapInArrow(_cell_slices, "slice int, cell int").distinct()
    slices = slices.groupBy("slice").applyInArrow(_slice_bits, "slice int, bits binary").collect()
    bits = np.zeros(FILTER_CELLS // 8, np.uint8)
    for row in slices:
        at = row["slice"] * (FILTER_SLICE // 8)
        bits[at : at + FILTER_SLICE // 8] = np.frombuffer(row["bits"], np.uint8)
    held = rows.sparkSession.sparkContext.broadcast(bits)

    def keep(batches):
        for batch in batches:
            cells = _cells(batch.column("node").to_numpy())
            found = held.value[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8) & 1
            yield batch.filter(pa.array(found.astype(bool)))

    return rows.mapInArrow(keep, rows.schema)


def sets_of(blobs: list[bytes], hasher: SpanHash, width: int):
    """The shingle hashes of compressed texts."""
    codec = pa.Codec("zstd", 1)
    raw = [
        codec.decompress(b[8:], int.from_bytes(b[:8], "little"), asbytes=True) for b in blobs
    ]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
    hashes, bounds = shingle_sets(np.frombuffer(b"".join(raw), np.uint8), offsets, hasher, width)
    return [hashes[bounds[i] : bounds[i + 1]] for i in range(len(blobs))]


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - both
    return both > 0 and 100 * both >= percent * union


def sketch_words(column) -> np.ndarray:
    """A column of sketches as rows of 64-bit words."""
    data, _ = byte_view(column)
    return data.view(np.uint64).reshape(len(column), -1)


def _near_function(percent: int):
    """Whether the sketches of a pair differ in so few bits that the sets can be linked."""

    def near(batches):
        for batch in batches:
            a, b = (sketch_words(batch.column(f"{end}_sketch")) for end in ("hub", "member"))
            n, m = (batch.column(f"{end}_n").to_numpy() for end in ("hub", "member"))
            differ = np.bitwise_count(a ^ b).sum(axis=1)
            found = differ <= largest_difference(n, m, percent)
            yield pa.RecordBatch.from_arrays(
                [batch.column(name) for name in ("kind", "hub", "member")]
                + [pa.array(found, pa.bool_())],
                names=["kind", "hub", "member", "near"],
            )

    return near


def _verify_function(width: int, percent: int):
    def verify(batches):
        hasher = SpanHash()
        last, held = None, None
        for batch in batches:
            hubs = batch.column("hub").to_pylist()
            out = []
            for row, hub in enumerate(hubs):
                blob = batch.column("hub_text")[row].as_py()
                if hub != last or held[0] != blob:
                    last, held = hub, (blob, sets_of([blob], hasher, width)[0])
                (other,) = sets_of([batch.column("member_text")[row].as_py()], hasher, width)
                out.append(linked(held[1], other, percent))
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in ("kind", "hub", "member")] + [pa.array(out, pa.bool_())],
                names=["kind", "hub", "member", "linked"],
            )

    return verify


def parity_sketches(sets: list[np.ndarray]) -> np.ndarray:
    """A bit per shingle hash, flipped by each shingle: rows of 64-bit words."""
    sizes = [len(s) for s in sets]
    bit = (mixed(np.concatenate(sets) + np.uint64(7)) % np.uint64(SKETCH_BITS)).astype(np.int64)
    bit += np.repeat(np.arange(len(sets)) * SKETCH_BITS, sizes)
    flipped = np.bincount(bit, minlength=len(sets) * SKETCH_BITS) & 1
    return np.packbits(flipped.astype(np.uint8)).view(np.uint64).reshape(len(sets), -1)


def _apart_function(percent: int):
    """The documents of two chunks that have a partner of another root with a near sketch."""

    def compare(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        roots, sizes = table.column("root").to_numpy(), table.column("n_shingles").to_numpy()
        sketches = sketch_words(table.column("sketch").combine_chunks())
        kept = np.zeros(len(side), bool)
        for i in np.flatnonzero(side == 0):
            j = np.flatnonzero((roots != roots[i]) & (side == 1 if (side == 1).any() else True))
            differ = np.bitwise_count(sketches[j] ^ sketches[i]).sum(axis=1)
            j = j[differ <= largest_difference(sizes[j], sizes[i], percent)]
            kept[j] = True
            kept[i] |= len(j) > 0
        names = ["gid", "lo", "hi", "side", "node", "root"]
        return table.select(names).filter(pa.array(kept))

    return compare


def _between_function(width: int, percent: int):
    """Links between the documents of two chunks that nothing connects yet.

    Pairs whose sketches differ in more bits than linked sets can are passed over; of the rest,
    the nearest are verified first, and a pair that is connected by then needs no look.
    """

    def compare(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_numpy()
        side = table.column("side").to_numpy()
        roots = np.unique(table.column("root").to_numpy(), return_inverse=True)[1]
        edges = []
        if len(np.unique(roots)) > 1:
            sets = sets_of(table.column("text").to_pylist(), SpanHash(), width)
            sizes = np.array([len(s) for s in sets])
            sketches = parity_sketches(sets)
            for i in np.flatnonzero(side == 0):
                other = (roots != roots[i]) & (side == 1 if (side == 1).any() else True)
                j = np.flatnonzero(other)
                differ = np.bitwise_count(sketches[j] ^ sketches[i]).sum(axis=1)
                near = differ <= largest_difference(sizes[j], sizes[i], percent)
                for k in j[near][np.argsort(differ[near], kind="stable")].tolist():
                    if roots[k] != roots[i] and linked(sets[i], sets[k], percent):
                        edges.append((int(nodes[i]), int(nodes[k])))
                        roots[roots == roots[k]] = roots[i]
        a, b = zip(*edges) if edges else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return compare


def _remaining_links(verified: DataFrame, ends: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between nodes that met at a hub, but are not both linked to it.

    A hub's nodes are those tied to it, and those tied inside tasks to one of these. Where
    all are linked nothing is left to do. Else they are compared with each other in chunks,
    except nodes of the same root: those already connected to the hub.
    """
    stars = verified.where(F.col("kind") == STAR).drop("kind")
    groups = verified.where(F.col("kind") == KEY).drop("kind")
    root = F.when(F.col("linked"), F.col("hub")).otherwise(F.col("member"))
    own = verified.select("hub").distinct()
    first = groups.select(F.col("hub").alias("gid"), F.col("member").alias("node"), root.alias("root"))
    first = first.unionByName(
        own.select(F.col("hub").alias("gid"), F.col("hub").alias("node"), F.col("hub").alias("root"))
    )
    second = first.join(stars, first["node"] == stars["hub"]).select(
        "gid",
        F.col("member").alias("node"),
        F.when(F.col("linked"), F.col("root")).otherwise(F.col("member")).alias("root"),
    )
    nodes = first.unionByName(second)
    best = F.min(F.struct((F.col("root") == F.col("node")).alias("alone"), F.col("root")))
    nodes = cut(
        nodes.groupBy("gid", "node")
        .agg(best["root"].alias("root"))
        .withColumn("root", F.when(F.col("node") == F.col("gid"), F.col("gid")).otherwise(F.col("root")))
    )
    open_ = (
        nodes.groupBy("gid")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max((F.col("root") != F.col("gid")).cast("int")).alias("apart"),
        )
        .where("apart = 1 AND n > 2")
        .withColumn("chunks", F.ceil(F.col("n") / CHUNK_NODES).cast("int"))
    )
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    tiles = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda x: F.struct(
            F.least(x, F.col("chunk")).alias("lo"),
            F.greatest(x, F.col("chunk")).alias("hi"),
            (F.col("chunk") > x).cast("int").alias("side"),
        ),
    )
    tiled = (
        nodes.join(open_, "gid")
        .withColumn("chunk", chunk)
        .select("gid", "node", "root", F.explode(tiles).alias("tile"))
        .select("gid", "node", "root", "tile.*")
    )
    schema = "gid bigint, lo int, hi int, side int, node bigint, root bigint"
    near = cut(
        tiled.join(ends.drop("text"), "node")
        .groupBy("gid", "lo", "hi")
        .applyInArrow(_apart_function(percent), schema)
        .distinct()
    )
    return (
        near.join(likely_among(ends.select("node", "text"), near.select("node")), "node")
        .groupBy("gid", "lo", "hi")
        .applyInArrow(_between_function(width, percent), "a bigint, b bigint")
    )


def link_documents(
    docs: DataFrame, width: int = SHINGLE_WORDS, percent: int = PERCENT
) -> tuple[DataFrame, DataFrame]:
    """(sizes, links) of all documents: (doc_id, n_shingles) and (a, b).

    The links connect the same documents as all pairs of sets with 100 * intersection >=
    percent * union would; of a group of copies they are a few per copy, not all pairs.

    1. Parity sketches give each set keys, of which similar sets share at least one; keys are
       ordered by how rare their shingles are in the whole corpus.
    2. A key's documents are tied to the smallest of them, the hub; a key that is hot inside a
       task is tied there first. Pairs are verified on the texts.
    3. Documents that met at a hub without both being linked to it are compared directly.
    """
    if not 0 < percent <= 100 or width < 1:
        raise ValueError("percent must be in 1 to 100, width positive")
    spark = docs.sparkSession
    rows = keyed(docs)
    n_texts = bucket_count(docs)
    n_keys = bucket_count(docs, BUCKET_BYTES)
    named = rows.where(F.col("doc_id") != NO_ID)
    levels = spark.sparkContext.broadcast(shingle_levels(named, width))
    sent = named.mapInArrow(_key_function(levels, width, percent, n_keys), ROWS)
    found = cut(sent.groupBy("bucket").applyInArrow(_meet, PAIRS).distinct())
    members = found.where(F.col("kind") == NODE).select(
        F.col("hub").alias("node"), F.col("member").alias("doc_id")
    )
    nodes = cut(members.groupBy("node").agg(F.min("doc_id").alias("rep")))
    pairs = found.where(F.col("kind") != NODE)
    met_nodes = pairs.select("hub").unionAll(pairs.select("member")).distinct().toDF("node")
    reps = nodes.join(met_nodes, "node", "left_semi")
    wanted = reps.select(F.col("rep").alias("doc_id"), "node")
    wanted = wanted.mapInArrow(_id_buckets(n_texts), "bucket int, doc_id bigint, node bigint")
    sized = cut(
        texts_by_bucket(rows, n_texts).groupBy("bucket")
        .cogroup(wanted.groupBy("bucket"))
        .applyInArrow(_size_function(width), SIZED)
    )
    ends = sized.where("text IS NOT NULL").select("node", "n_shingles", "sketch", "text")

    def of(end: str, rows: DataFrame = ends, **columns: str) -> DataFrame:
        names = {"node": end} | {c: f"{end}_{short}" for short, c in columns.items()}
        return rows.select(*[F.col(c).alias(name) for c, name in names.items()])

    met = cut(
        pairs.join(of("member", n="n_shingles", sketch="sketch"), "member")
        .join(of("hub", n="n_shingles", sketch="sketch"), "hub")
        .mapInArrow(_near_function(percent), PAIRS + ", near boolean")
        .groupBy("kind", "hub", "member")
        .agg(F.max("near").alias("near"))
    )
    near = met.where("near")
    near_nodes = near.select("hub").unionAll(near.select("member")).toDF("node")
    texts = likely_among(ends.select("node", "text"), near_nodes)
    checked = (
        near.join(of("member", texts, text="text"), "member")
        .join(of("hub", texts, text="text"), "hub")
        .mapInArrow(_verify_function(width, percent), PAIRS + ", linked boolean")
        .groupBy("kind", "hub", "member")
        .agg(F.max("linked").alias("linked"))
    )
    far = met.where(~F.col("near")).select("kind", "hub", "member", F.lit(False).alias("linked"))
    verified = cut(checked.unionByName(far))
    more = _remaining_links(verified, ends, width, percent)
    of_nodes = verified.where("linked").select("hub", "member").toDF("a", "b").unionByName(more)
    for end in ("a", "b"):
        rep = nodes.select(F.col("node").alias(end), F.col("rep").alias("_rep"))
        of_nodes = of_nodes.join(rep, end).withColumn(end, F.col("_rep")).drop("_rep")
    copies = salted_join(members, nodes, ["node"], "doc_id").where("rep <> doc_id")
    links = copies.select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    links = links.unionByName(of_nodes.select("a", "b"))
    sizes = sized.select(
        F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "n_shingles"
    )
    return sizes, cut(links)


def similar_components(
    docs: DataFrame, width: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    ``component_id`` is the smallest doc_id that links reach. Null and empty texts and texts
    without words have no shingles and no links. Rows that share a doc_id are one document, which
    is linked where any of them is. Rows without doc_id have a size and no component. No rows
    give no rows.
    """
    sizes, links = link_documents(docs, width, percent)
    ends = links.select("a").unionAll(links.select("b")).distinct().toDF("id")
    found = connected_components(ends, links)
    return sizes.join(found, sizes["doc_id"] == found["id"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )
