"""Shingle sets of documents and exact Jaccard similarity between them.

Pairs are reported in a form that copies cannot inflate: documents with the same shingle set
form a class, similar pairs are listed between class representatives (the smallest id), and
every other member has one row that ties it to its representative with similarity 1. Every
similar pair of documents follows from these rows.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import md5
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coterie.functions.hashing import md5_int
from coterie.functions.text import character_windows, tokens, word_windows
from coterie.operators.heavy_join import heavy_join
from coterie.operators.indexing import dense_index
from coterie.operators.lineage import cut
from coterie.operators.skew import salted_join
from coterie.operators.spectrum import pairs_above, spectrum
from coterie.operators.universe import LOW_BITS, numbered_shingles

SHINGLE_SIZE = 5
# shingles that leave a task together
BATCH_SHINGLES = 1 << 18
# cells in which the shingles of all sets are counted, and the rows that a task's counts make
CELL_BITS, CELL_PARTS = 20, 64
# shingles that more sets show are joined over several tasks
HOT_POSTS = 512
STEP_PAIRS = 1 << 20
# from this similarity on, sets meet by sums of several shingles; a sketch's parts for each shown
HIGH_THRESHOLD, PARTS_PER_WORD = 0.75, 1.1
PARITY_BITS, PARITY_SETS = 1024, 512
MOST_BLOCK_SHINGLES = 1 << 22
# bits of the bitmap of posts that share their set, and its parts, of Spark's size
SLICE_BITS, MARK_SLICES = 1 << 15, 1 << 11
# below this similarity pairs are found by block products instead of prefixes
LOW_THRESHOLD = 0.2


def sample_fraction(rows: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """Each row with probability ``fraction``, decided by a hash of its key: repeatable."""
    ticket = md5_int(F.concat_ws(":", F.lit(str(seed)), F.col(key)))
    return rows.where(ticket < F.lit(fraction * 2**32))


def sample_fixed(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows in random but repeatable order, all rows if there are fewer.

    Rows are drawn by the hash of their key, so few rows more than ``n`` can be told by their hash
    alone; only these are put in order, over all tasks.
    """
    ticket = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key)))
    drawn = rows.withColumn("_ticket", ticket)
    n_rows = rows.count()
    if n_rows <= n:
        return rows
    wanted = n + 6 * sqrt(n) + 100
    number = F.conv(F.substring("_ticket", 1, 8), 16, 10).cast("bigint")
    likely = drawn.where(number < F.lit(int(min(1.0, wanted / n_rows) * 2**32)))
    chosen = likely if likely.count() >= n else drawn
    placed = dense_index(chosen, ["_ticket", key], "_place")
    return placed.where(F.col("_place") < n).select(*rows.columns)


def min_tokens(posts: DataFrame, n: int = SHINGLE_SIZE) -> DataFrame:
    """Posts of at least ``n`` tokens."""
    return posts.where(F.size(tokens(F.col("body"))) >= n)


def min_characters(posts: DataFrame, n: int = SHINGLE_SIZE) -> DataFrame:
    """Posts of at least ``n`` characters."""
    return posts.where(F.length("body") >= n)


def word_shingles(posts: DataFrame, size: int = SHINGLE_SIZE) -> DataFrame:
    """(post_id, position, shingle): every run of ``size`` tokens."""
    runs = word_windows(F.col("body"), size)
    return min_tokens(posts, size).select(
        "post_id", F.posexplode_outer(runs).alias("position", "shingle")
    )


def character_shingles(posts: DataFrame, size: int = SHINGLE_SIZE) -> DataFrame:
    """(post_id, position, shingle): every run of ``size`` characters."""
    runs = character_windows(F.col("body"), size)
    return min_characters(posts, size).select(
        "post_id", F.posexplode_outer(runs).alias("position", "shingle")
    )


def _hash_sets(posts: DataFrame, size: int, separator: bytes) -> DataFrame:
    id_type = posts.schema["post_id"].dataType.simpleString()
    return posts.select("post_id", "body").mapInArrow(
        _sets_function(size, separator), f"post_id {id_type}, shingles array<bigint>"
    )


def _sets_function(size: int, separator: bytes):
    """The distinct first 32 bits of the MD5 of each text's runs, rising; no row without a run.

    Units are tokens between separators, or characters. Few texts at a time leave the task.
    """

    def runs(text: str) -> list[bytes]:
        if not separator:
            found = {text[i : i + size] for i in range(len(text) - size + 1)}
            return [run.encode() for run in found]
        raw = text.encode()
        places = np.flatnonzero(np.frombuffer(raw, np.uint8) == separator[0])
        ends = [*places.tolist(), len(raw)][size - 1 :]
        starts = [0, *(places + 1).tolist()]
        return [raw[start:end] for start, end in zip(starts, ends)]

    def packed(ids: list, sets: list, id_type) -> pa.RecordBatch:
        offsets = np.cumsum([0, *map(len, sets)], dtype=np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets)))
        return pa.RecordBatch.from_arrays([pa.array(ids, id_type), lists], names=["post_id", "shingles"])

    def hashed(batches):
        for batch in batches:
            ids, sets, held = [], [], 0
            for post, text in zip(batch.column("post_id"), batch.column("body")):
                found = runs(text.as_py()) if text.is_valid else []
                if not found:
                    continue
                digests = b"".join([md5(run, usedforsecurity=False).digest() for run in found])
                ids.append(post.as_py())
                sets.append(np.unique(np.frombuffer(digests, ">u4")[::4]).astype(np.int64))
                held += len(sets[-1])
                if held >= BATCH_SHINGLES:
                    yield packed(ids, sets, batch.schema.field("post_id").type)
                    ids, sets, held = [], [], 0
            if ids:
                yield packed(ids, sets, batch.schema.field("post_id").type)

    return hashed


def word_shingle_sets(posts: DataFrame, size: int = SHINGLE_SIZE) -> DataFrame:
    """(post_id, shingles): the distinct 32-bit shingle hashes of each post, without a shuffle.

    Posts too short for one shingle are left out.
    """
    return _hash_sets(posts, size, b" ")


def character_shingle_sets(posts: DataFrame, size: int = SHINGLE_SIZE) -> DataFrame:
    """The same over runs of characters."""
    return _hash_sets(posts, size, b"")


def hashed_shingles(sets: DataFrame) -> DataFrame:
    """(post_id, shingle): one row per distinct hash of a post.

    Sets are never empty; the outer form only keeps Catalyst from filtering on their size, which
    would compute every set twice.
    """
    return sets.select("post_id", F.explode_outer("shingles").alias("shingle"))


def shingle_universe(sets: DataFrame) -> DataFrame:
    """One row: posts, (post, shingle) rows and distinct shingles."""
    per_shingle = hashed_shingles(sets).groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    counts = per_shingle.agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"), F.lit(0).alias("n_posts")
    )
    posts = sets.agg(
        F.lit(0).cast("bigint").alias("n_rows"),
        F.lit(0).cast("bigint").alias("n_distinct"),
        F.count(F.lit(1)).alias("n_posts"),
    )
    return counts.unionByName(posts).agg(
        F.sum("n_posts").alias("n_posts"),
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_distinct").alias("n_distinct"),
    )


def characteristic_matrix(sets: DataFrame) -> DataFrame:
    """Coordinates (shingle_idx, post_id) of the ones, shingles numbered in hash order."""
    return numbered_shingles(cut(sets))


@dataclass
class SimilarPairs:
    """``pairs`` between representatives and ``copies`` (post_id, representative, n_members)."""

    pairs: DataFrame
    copies: DataFrame

    def rows(self) -> DataFrame:
        """Both as (post_a, post_b, jaccard, copies_a, copies_b)."""
        ties = self.copies.select(
            F.col("representative").alias("post_a"),
            F.col("post_id").alias("post_b"),
            F.lit(1.0).alias("jaccard"),
            F.col("n_members").alias("copies_a"),
            F.col("n_members").alias("copies_b"),
        )
        return self.pairs.select(ties.columns).unionByName(ties)


def _cell(post: str) -> Column:
    return F.pmod(F.xxhash64(post), F.lit(MARK_SLICES * SLICE_BITS))


def _slice(post: str) -> Column:
    return F.floor(_cell(post) / SLICE_BITS)


def _marks(posts: DataFrame) -> DataFrame:
    """(slice, bits): a bitmap of the posts' hashes, 8 MB whatever their number."""
    place = _cell("post_id") % SLICE_BITS
    return posts.groupBy(_slice("post_id").alias("slice")).agg(F.bitmap_construct_agg(place).alias("bits"))


def _is_marked(post: str) -> Column:
    """Whether the bit of a post is set in the ``bits`` of its slice; few others share it."""
    place = _cell(post) % SLICE_BITS
    byte = F.substring("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.coalesce(F.floor(value / F.pow(F.lit(2), place % 8)) % 2 == 1, F.lit(False))


def _classes(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Representatives with their class size, and the other members of each class."""
    identity = ["n", "digest_a", "digest_b"]
    ordered = F.array_sort("shingles")
    tagged = sets.select(
        "post_id",
        "shingles",
        F.size("shingles").alias("n"),
        F.xxhash64(ordered).alias("digest_a"),
        F.xxhash64(F.lit("second"), ordered).alias("digest_b"),
    )
    members = cut(tagged.select("post_id", *identity))
    classes = cut(
        members.groupBy(*identity).agg(
            F.min("post_id").alias("representative"), F.count(F.lit(1)).alias("n_members")
        )
    )
    # only sets that are or may be of a repeated class, or of a repeated post, move to be joined
    several = members.join(classes.where("n_members > 1"), identity, "left_semi").select("post_id")
    several = several.unionAll(members.groupBy("post_id").count().where("count > 1").select("post_id"))
    marks = cut(_marks(several))
    own = sets.select("post_id", "shingles", F.size("shingles").alias("n"))
    marked = own.join(F.broadcast(marks), _slice("post_id") == F.col("slice"), "left")
    single = marked.where(~_is_marked("post_id")).where("post_id IS NOT NULL")
    joined = marked.where(_is_marked("post_id")).select(*own.columns).join(
        classes.select(F.col("representative").alias("post_id"), "n_members"), "post_id"
    )
    representatives = single.select(*own.columns, F.lit(1).cast("bigint").alias("copies")).unionAll(
        cut(joined.select(*own.columns, F.col("n_members").alias("copies")), "zstd")
    )
    repeated = classes.where(F.col("n_members") > 1)
    copies = (
        salted_join(members, repeated, identity, "post_id")
        .where(F.col("post_id") != F.col("representative"))
        .select("post_id", "representative", "n_members")
    )
    return representatives, copies


def _count_function():
    """How often the shingles of a task fall into each cell of a fixed number of cells."""

    def count(batches):
        counts = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            counts += np.bincount(_cells(batch.column("shingles").flatten().to_numpy()), minlength=len(counts))
        parts = counts.reshape(CELL_PARTS, -1)
        columns = [pa.array(range(CELL_PARTS), pa.int32()), pa.array([c.tobytes() for c in parts], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "counts"])

    return count


def _cells(shingles: np.ndarray) -> np.ndarray:
    mixed = shingles.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _cell_counts(sets: DataFrame) -> np.ndarray:
    """The sum over all tasks: one array of fixed size, whatever the number of sets."""

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c.as_py(), np.int64) for c in rows.column("counts"))
        return pa.table([rows.column("part")[:1], pa.array([total.tobytes()])], ["part", "counts"])

    schema = "part int, counts binary"
    counted = sets.select("shingles").mapInArrow(_count_function(), schema)
    found = {row["part"]: row["counts"] for row in counted.groupBy("part").applyInArrow(add, schema).collect()}
    none = bytes(8 << CELL_BITS - CELL_PARTS.bit_length() + 1)
    return np.frombuffer(b"".join(found.get(part, none) for part in range(CELL_PARTS)), np.int64)


def _most_apart(a, b, threshold: float):
    """The most shingles that one but not both of two sets of these sizes hold."""
    return np.floor((a + b) * (1 - threshold) / (1 + threshold) + 1e-6).astype(np.int64)


def _mix(values: np.ndarray) -> np.ndarray:
    x = values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _sketch_function(threshold: float):
    """Words of each set, of which sets that reach the threshold share one of the first ``shown``.

    Sets are in bands by size, a band as wide as the sizes that can be partners. The sketch of a
    band deals the hashes of the shingles to parts and adds up each part, also an empty one, to a
    word, so ``d`` shingles apart are at most ``d`` words apart, and in any order of all words the
    first ``d + 1`` of both sets share one. A set is sketched for its band and for the one below.
    """

    def sketched(batches):
        for whole in batches:
            places = whole.column("shingles").offsets.to_numpy()
            first = 0
            while first < whole.num_rows:
                last = np.searchsorted(places, places[first] + BATCH_SHINGLES, side="right") - 1
                batch = whole.slice(first, max(1, int(last) - first))
                first += batch.num_rows
                yield words(batch)

    def words(batch):
        lists = batch.column("shingles")
        offsets = lists.offsets.to_numpy()
        shingles = lists.values.to_numpy()[offsets[0] : offsets[-1]]
        sizes = np.diff(offsets).astype(np.int64)
        step = np.log(1 / min(threshold, 0.99))  # for equal sets a band has some width too
        band = np.floor(np.log(sizes) / step + 1e-9).astype(np.int64)
        row = np.tile(np.arange(len(sizes)), 2)
        band = np.concatenate((band, band - 1))
        # partners of a set of the band or the one above hold at most 1 / threshold**2 of this
        top = np.ceil(np.exp((band + 2) * step)).astype(np.int64)
        shown = _most_apart(sizes[row], np.minimum(np.ceil(sizes[row] / threshold), top), threshold) + 1
        parts = np.ceil(PARTS_PER_WORD * (_most_apart(top, top, threshold) + 1)).astype(np.int64)
        begin = np.concatenate(([0], np.cumsum(parts)))
        index = np.concatenate((np.arange(len(shingles)), np.arange(len(shingles))))
        sketch = np.repeat(np.arange(len(row)), sizes[row])
        mixed = _mix(shingles + 1)[index]
        part = ((mixed >> np.uint64(40)) % parts[sketch].astype(np.uint64)).astype(np.int64)
        sums = np.zeros(begin[-1], np.uint64)
        np.add.at(sums, begin[sketch] + part, _mix(mixed))
        owner = np.repeat(np.arange(len(row)), parts)
        name = np.arange(begin[-1]) - begin[owner] + (band[owner] << 32)
        found = (_mix(_mix(name) + sums) >> np.uint64(32)).astype(np.int64)
        bounds = pa.array(begin.astype(np.int32))
        columns = [batch.column("post_id").take(pa.array(row)), pa.ListArray.from_arrays(bounds, pa.array(found))]
        columns += [pa.array(sizes[row].astype(np.int32)), pa.array(shown.astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, names=_names(SKETCHED))

    return sketched


SKETCHED = "post_id bigint, shingles array<bigint>, n int, shown int"
DEALT = "range bigint, low array<int>, posts array<bigint>, sizes array<int>, rests array<int>"


def _prefix_function(counts, threshold: float):
    """The first shingles of each set, rare ones before common ones, dealt to ranges as lists.

    A row has the set's size and how many of its shingles are left from this one on.
    """

    def deal(batches):
        for whole in batches:
            places = whole.column("shingles").offsets.to_numpy()
            first = 0
            while first < whole.num_rows:
                last = np.searchsorted(places, places[first] + BATCH_SHINGLES, side="right") - 1
                batch = whole.slice(first, max(1, int(last) - first))
                first += batch.num_rows
                yield dealt(batch)

    def dealt(batch):
        sets = batch.column("shingles")
        offsets = sets.offsets.to_numpy()
        shingles = sets.values.to_numpy()[offsets[0] : offsets[-1]]
        sizes = np.diff(offsets)
        holder = np.repeat(np.arange(len(sizes)), sizes)
        count = counts.value[_cells(shingles)]
        order = np.lexsort((shingles, count, holder))
        shingles, count = shingles[order], count[order]
        rest = np.repeat(offsets[1:] - offsets[0], sizes) - np.arange(len(shingles))
        if "shown" in batch.schema.names:  # words of sketches, which say nothing of what is left
            shown = sizes[holder] - rest < batch.column("shown").to_numpy()[holder]
            sizes = batch.column("n").to_numpy()
            rest = sizes[holder]
        else:
            # how many of its rarest shingles a set must show so that no partner is missed
            shown = rest >= np.ceil(sizes * threshold - 1e-9)[holder]
        kept = np.flatnonzero(shown & (count > 1))
        kept = kept[np.argsort(shingles[kept], kind="stable")]
        shingles, holder = shingles[kept], holder[kept]
        ranges = shingles >> LOW_BITS
        starts = np.flatnonzero(np.concatenate(([len(ranges) > 0], ranges[1:] != ranges[:-1])))
        bounds = pa.array(np.append(starts, len(ranges)).astype(np.int32))
        posts = batch.column("post_id").to_numpy()[holder]
        values = [pa.array(shingles & ((1 << LOW_BITS) - 1), pa.int64()).cast(pa.int32()), pa.array(posts, pa.int64())]
        values += [pa.array(v.astype(np.int32)) for v in (sizes[holder], rest[kept])]
        lists = [pa.ListArray.from_arrays(bounds, v) for v in values]
        return pa.RecordBatch.from_arrays([pa.array(ranges[starts], pa.int64()), *lists], names=_names(DEALT))

    return deal


MET = "shingle bigint, post_a bigint, n_a int, rest_a int, post_b bigint"


def _meet_function(threshold: float):
    """The close pairs of each shingle of a range, or the rows of a shingle that is hot."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        low, posts, sizes, rests = (
            rows.column(name).combine_chunks().flatten().to_numpy() for name in ("low", "posts", "sizes", "rests")
        )
        order = np.lexsort((posts, low))
        low, posts, sizes, rests = low[order], posts[order], sizes[order], rests[order]
        starts = np.flatnonzero(np.concatenate(([len(low) > 0], low[1:] != low[:-1])))
        counts = np.diff(np.append(starts, len(low)))
        hot = np.flatnonzero(np.repeat(counts > HOT_POSTS, counts))
        shingles = (rows.column("range")[0].as_py() << LOW_BITS) + low[hot].astype(np.int64)
        none = pa.nulls(len(hot), pa.int64())
        yield batch(shingles, posts[hot], sizes[hot], rests[hot], none)
        following = np.where(np.repeat(counts > HOT_POSTS, counts), 0, np.repeat(starts + counts, counts) - np.arange(len(low)) - 1)
        total = np.cumsum(following)
        start = 0
        while start < len(low):
            done = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, done + STEP_PAIRS, side="right")))
            n = following[start:end]
            a = np.repeat(np.arange(start, end), n)
            b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
            # if this is the first common shingle, there are no more in common than either has left
            most = np.minimum(rests[a], rests[b])
            near = (posts[a] < posts[b]) & (most * (1 + threshold) >= threshold * (sizes[a] + sizes[b]) - 1e-6)
            pairs = np.unique(np.stack([posts[a[near]], posts[b[near]]]), axis=1)
            nothing = pa.nulls(pairs.shape[1], pa.int64())
            yield batch(nothing, pairs[0], nothing, nothing, pairs[1])
            start = end

    def batch(shingle, post_a, n_a, rest_a, post_b):
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
        columns = [pa.array(c).cast(t) for c, t in zip((shingle, post_a, n_a, rest_a, post_b), types)]
        return pa.RecordBatch.from_arrays(columns, names=_names(MET))

    return meet


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _candidates(representatives: DataFrame, threshold: float) -> DataFrame:
    """Pairs (post_a, post_b) that can reach the threshold, by prefix, length and place filters.

    With shingles ordered from rare to common, two sets of similarity ``t`` share one among the
    first ``n - ceil(t n) + 1`` of each; common shingles are joined on only where ``t`` is low. Any
    fixed order is exact, so frequencies are counted in a fixed number of cells, which go out to
    all tasks, and only prefixes move, packed as lists. From a high threshold on, the words of
    sketches, which are sums of several shingles, take the place of shingles that may all be common.
    """
    context = representatives.sparkSession.sparkContext
    sets = representatives.select(F.col("post_id").cast("bigint").alias("post_id"), "shingles")
    if threshold >= HIGH_THRESHOLD:
        sets = sets.mapInArrow(_sketch_function(threshold), SKETCHED)
    counts = context.broadcast(_cell_counts(sets))
    dealt = sets.mapInArrow(_prefix_function(counts, threshold), DEALT)
    met = cut(dealt.groupBy("range").applyInArrow(_meet_function(threshold), MET).distinct())
    a = met.where(F.col("post_b").isNull()).drop("post_b")
    b = a.toDF("shingle", "post_b", "n_b", "rest_b")
    most = F.least("rest_a", "rest_b")
    near = most * F.lit(1 + threshold) >= F.lit(threshold) * (F.col("n_a") + F.col("n_b")) - F.lit(1e-6)
    hot = heavy_join(a, b, ["shingle"], "post_a", "post_b").where(near & (F.col("post_a") < F.col("post_b")))
    cold = met.where(F.col("post_b").isNotNull()).select("post_a", "post_b")
    return cold.unionByName(hot.select("post_a", "post_b")).distinct()


PARITIES = "post_id bigint, n int, parity binary"


def _parity_function():
    """A bit for each of a fixed number of parts of a set: whether the part's size is odd."""

    def flip(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, PARITY_SETS):
                yield flipped(batch.slice(first, PARITY_SETS))

    def flipped(batch):
        lists = batch.column("shingles")
        sizes = np.diff(lists.offsets.to_numpy())
        bit = (_mix(lists.flatten().to_numpy() + 7) >> np.uint64(40)).astype(np.int64) % PARITY_BITS
        bit += np.repeat(np.arange(len(sizes)) * PARITY_BITS, sizes)
        odd = np.bincount(bit, minlength=len(sizes) * PARITY_BITS) & 1
        rows = np.packbits(odd.astype(np.uint8)).reshape(len(sizes), -1)
        columns = [batch.column("post_id"), pa.array(sizes.astype(np.int32)), pa.array([r.tobytes() for r in rows], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=_names(PARITIES))

    return flip


def _near(candidates: DataFrame, representatives: DataFrame, threshold: float) -> DataFrame:
    """The candidates whose parities differ in no more bits than sets above the threshold can."""

    def near(batches):
        for batch in batches:
            a, b = (
                np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint64).reshape(batch.num_rows, -1)
                for name in ("parity_a", "parity_b")
            )
            n_a, n_b = (batch.column(name).to_numpy().astype(np.int64) for name in ("n_a", "n_b"))
            kept = np.bitwise_count(a ^ b).sum(axis=1) <= _most_apart(n_a, n_b, threshold)
            yield batch.select(["post_a", "post_b"]).filter(pa.array(kept))

    sets = representatives.select(F.col("post_id").cast("bigint").alias("post_id"), "shingles")
    parities = cut(sets.mapInArrow(_parity_function(), PARITIES))
    return (
        candidates.join(parities.toDF("post_a", "n_a", "parity_a"), "post_a")
        .join(parities.toDF("post_b", "n_b", "parity_b"), "post_b")
        .mapInArrow(near, "post_a bigint, post_b bigint")
        .distinct()
    )


MEASURED = (
    "post_a bigint, post_b bigint, n_common bigint, n_union bigint, jaccard double, "
    "copies_a bigint, copies_b bigint"
)


def _measure(rows: pa.Table, pairs: pa.Table) -> pa.Table:
    """The candidates of a tile, measured on its sets; a post in several rows is measured in each."""
    sets = [x.values.to_numpy() for x in rows.column("shingles")]
    copies = rows.column("copies").to_pylist()
    places: dict[int, list[int]] = {}
    for place, post in enumerate(rows.column("post_id").to_pylist()):
        places.setdefault(post, []).append(place)
    found = []
    for post_a, post_b in zip(pairs.column("post_a").to_pylist(), pairs.column("post_b").to_pylist()):
        for a in places[post_a]:
            for b in places[post_b]:
                common = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                union = len(sets[a]) + len(sets[b]) - common
                found.append((post_a, post_b, common, union, common / union, copies[a], copies[b]))
    columns = zip(*found) if found else [()] * 7
    types = [pa.float64() if name == "jaccard" else pa.int64() for name in _names(MEASURED)]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], _names(MEASURED))


def _measured(candidates: DataFrame, representatives: DataFrame) -> DataFrame:
    """Candidates with their similarity. Posts are dealt to blocks, and a set goes once to each tile
    of two blocks in which it has a candidate, not once to each candidate."""
    tasks = int(representatives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ends = candidates.select(F.col("post_a").alias("post_id")).unionAll(candidates.select("post_b")).distinct()
    total = representatives.join(ends, "post_id", "left_semi").agg(F.sum("n")).first()[0] or 0
    n_blocks = max(ceil(total / MOST_BLOCK_SHINGLES), ceil(sqrt(2 * tasks)))

    def block(post: str) -> Column:
        return F.pmod(F.xxhash64(F.col(post).cast("bigint")), F.lit(n_blocks)).cast("int")

    tiled = candidates.select(
        F.least(block("post_a"), block("post_b")).alias("low"),
        F.greatest(block("post_a"), block("post_b")).alias("high"),
        "post_a",
        "post_b",
    )
    both = F.explode(F.array("post_a", "post_b")).alias("post_id")
    sets = tiled.select("low", "high", both).distinct().toDF("low", "high", "post_id").join(
        representatives.select("post_id", "shingles", "copies"), "post_id"
    )
    measured = sets.groupBy("low", "high").cogroup(tiled.groupBy("low", "high")).applyInArrow(_measure, MEASURED)
    id_type = representatives.schema["post_id"].dataType
    return measured.withColumns({end: F.col(end).cast(id_type) for end in ("post_a", "post_b")})


def similar_pairs(sets: DataFrame, threshold: float, strict: bool = False) -> SimilarPairs:
    """Exact Jaccard similarity join: all pairs at or (``strict``) above the threshold.

    Where the threshold is low, nearly all shingles of a set are in its prefix, and block products
    take less than joining them.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    representatives, copies = _classes(cut(sets, "zstd"))
    if threshold < LOW_THRESHOLD:
        return SimilarPairs(pairs_above(representatives, threshold, strict), copies)
    candidates = cut(_near(_candidates(representatives, threshold), representatives, threshold))
    pairs = _measured(candidates, representatives)
    passes = F.col("jaccard") > threshold if strict else F.col("jaccard") >= threshold
    pairs = pairs.where(passes)
    return SimilarPairs(pairs, copies)


def similarity_spectrum(sets: DataFrame) -> DataFrame:
    """(jaccard, n_pairs): how many pairs of documents have each similarity above zero.

    Pairs are counted inside block products and never leave a task one by one.
    """
    representatives, copies = _classes(cut(sets, "zstd"))
    between = spectrum(representatives)
    # each class of m members has m - 1 copy rows, which together stand for m (m - 1) / 2 pairs
    classes = copies.groupBy("representative").agg(F.max("n_members").alias("m"))
    within = classes.select(
        F.lit(1.0).alias("jaccard"), F.expr("m * (m - 1) div 2").alias("n_pairs")
    )
    return between.unionByName(within).groupBy("jaccard").agg(F.sum("n_pairs").alias("n_pairs"))


def similarity_histogram(similarities: DataFrame, bins: int = 50) -> DataFrame:
    """Equal bins from the lowest to the highest similarity, the last one closed on the right."""
    low, high = similarities.agg(F.min("jaccard"), F.max("jaccard")).first()
    if low is None or low == high:
        index = F.lit(0)
    else:
        scaled = F.floor((F.col("jaccard") - low) / F.lit(high - low) * bins)
        index = F.least(scaled, F.lit(bins - 1))
    return (
        similarities.select(index.cast("int").alias("bin"), "n_pairs")
        .groupBy("bin")
        .agg(F.sum("n_pairs").alias("n_pairs"))
    )
