"""Finding benchmark passages in documents by multi-pattern search with shift tables."""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from coterie.llm.buffers import (
    LOWER_WORD,
    TO_LOWER,
    SpanHash,
    byte_view,
    lists,
    mixed,
    pieces,
    ranges,
    words,
)
from coterie.operators.lineage import cut

WINDOW_WORDS = 13
BLOCK_BYTES = 2 << 20
SHIFT_BLOCK = 2
LANE_WORDS = 256
COMPARED_AT_ONCE = 1 << 18


FOUND = ("n_words", "hit_bounds", "items")


class WindowTable:
    """The windows of one length: shift table, and buckets by the hash of the last words.

    ``shifts[h]`` tells how far a window may move on when its last ``block`` words hash to ``h``:
    as far as the nearest place of these words in any pattern, or past them if there is none.
    """

    def __init__(self, length: int, hashes: np.ndarray, texts: list[bytes], items: list[list]):
        self.length, self.block = length, min(SHIFT_BLOCK, length)
        bits = max(12, int(hashes.size * 8).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        farthest = length - self.block + 1
        self.shifts = np.full(1 << bits, min(farthest, 255), np.uint8)
        for last in range(self.block - 1, length):
            found = self.block_hash(hashes, last) & self.mask
            np.minimum.at(self.shifts, found, min(length - 1 - last, 255))
        suffixes = self.block_hash(hashes, length - 1)
        order = np.argsort(suffixes, kind="stable")
        self.suffixes, self.prefixes = suffixes[order], hashes[order, 0]
        self.texts = [texts[i] for i in order]
        self.items = [items[i] for i in order]

    def block_hash(self, hashes: np.ndarray, last: int) -> np.ndarray:
        """The hash of the block that ends in word ``last`` of each row of word hashes."""
        total = hashes[:, last].copy()
        for back in range(1, self.block):
            total = total * np.uint64(0xD6E8FEB86659FD93) + hashes[:, last - back]
        return mixed(total)

    def text_hash(self, hashes: np.ndarray, last: np.ndarray) -> np.ndarray:
        total = hashes[last]
        for back in range(1, self.block):
            total = total * np.uint64(0xD6E8FEB86659FD93) + hashes[last - back]
        return mixed(total)

    def candidates(self, hashes: np.ndarray, bounds: np.ndarray):
        """(last word, place in the buckets) of windows whose suffix and first word agree.

        Texts are cut into lanes, which all move on by their own shifts at the same time.
        """
        ends = np.diff(bounds) - self.length + 1  # places where a window may end
        rows = np.flatnonzero(ends > 0)
        lanes = -(-ends[rows] // LANE_WORDS)
        begin = np.repeat(bounds[rows] + self.length - 1, lanes) + LANE_WORDS * ranges(
            np.zeros(len(rows), np.int64), lanes
        )
        stop = np.minimum(begin + LANE_WORDS, np.repeat(bounds[rows + 1], lanes))
        halted = []
        while len(begin):
            shift = self.shifts[self.text_hash(hashes, begin) & self.mask]
            halted.append(begin[shift == 0])
            begin = begin + np.maximum(shift, 1)
            going = begin < stop
            begin, stop = begin[going], stop[going]
        last = np.sort(np.concatenate(halted)) if halted else np.zeros(0, np.int64)
        suffix = self.text_hash(hashes, last)
        low = np.searchsorted(self.suffixes, suffix, "left")
        size = np.searchsorted(self.suffixes, suffix, "right") - low
        last, low, size = last[size > 0], low[size > 0], size[size > 0]
        until = np.cumsum(size)
        done = 0
        while done < len(last):  # so many at once that a large bucket does not fill the memory
            limit = (until[done - 1] if done else 0) + COMPARED_AT_ONCE
            to = max(done + 1, int(np.searchsorted(until, limit, "right")))
            place = ranges(low[done:to], size[done:to])
            at = np.repeat(last[done:to], size[done:to])
            same = self.prefixes[place] == hashes[at - self.length + 1]
            yield from zip(at[same].tolist(), place[same].tolist())
            done = to


def window_tables(items: list[tuple], window: int = WINDOW_WORDS) -> list[WindowTable]:
    """Tables for the windows of (id, text) items, one for each length of window."""
    column = pa.array([text for _, text in items], pa.large_string())
    data, offsets = byte_view(column)
    data = TO_LOWER[data]
    starts, ends, bounds = words(data, offsets, LOWER_WORD)
    hasher = SpanHash()
    hasher.load(data)
    hashes = hasher(starts, ends)
    plain = data.tobytes()
    found: dict[int, dict[bytes, tuple[int, set]]] = {}
    for row, (item, _) in enumerate(items):
        first, after = int(bounds[row]), int(bounds[row + 1])
        length = min(window, after - first)
        for at in range(first, after - length + 1 if length else first):
            text = b" ".join(plain[starts[i] : ends[i]] for i in range(at, at + length))
            found.setdefault(length, {}).setdefault(text, (at, set()))[1].add(item)
    tables = []
    for length, windows in sorted(found.items()):
        at = np.array([place for place, _ in windows.values()], np.int64)
        held = [sorted(ids) for _, ids in windows.values()]
        rows = hashes[at[:, None] + np.arange(length)]
        tables.append(WindowTable(length, rows, list(windows), held))
    return tables


def _scan_function(tables, every_row: bool, kept: list[str]):
    """Batches with a text to the hit words and items of each row, beside the ``kept`` columns."""

    def scan(batches):
        hasher = SpanHash()
        for batch in pieces(batches, "text"):
            data, offsets = byte_view(batch.column("text"))
            data = TO_LOWER[data]
            starts, ends, bounds = words(data, offsets, LOWER_WORD)
            hasher.load(data)
            hashes = hasher(starts, ends)
            plain = data.tobytes()
            change = np.zeros(len(starts) + 1, np.int64)
            items: dict[int, set] = {}
            for table in tables.value:
                for last, place in table.candidates(hashes, bounds):
                    first = last - table.length + 1
                    here = b" ".join(plain[starts[i] : ends[i]] for i in range(first, last + 1))
                    if here == table.texts[place]:
                        change[first] += 1
                        change[last + 1] -= 1
                        row = int(np.searchsorted(bounds, first, "right")) - 1
                        items.setdefault(row, set()).update(table.items[place])
            hit = np.flatnonzero(np.cumsum(change[:-1]) > 0)
            row_of = np.searchsorted(bounds, hit, "right") - 1
            # a run of hit words ends where the next one is not the next word of the same row
            breaks = (np.diff(hit) > 1) | (np.diff(row_of) > 0)
            opens = np.concatenate(([True], breaks)) if len(hit) else np.zeros(0, bool)
            closes = np.concatenate((breaks, [True])) if len(hit) else np.zeros(0, bool)
            rows = row_of[opens]
            spans = np.stack([hit[opens] - bounds[rows], hit[closes] + 1 - bounds[rows]], axis=1)
            counts = 2 * np.bincount(rows, minlength=batch.num_rows)
            named = [sorted(items.get(row, ())) for row in range(batch.num_rows)]
            out = pa.RecordBatch.from_arrays(
                [
                    *[batch.column(name) for name in kept],
                    pa.array(np.diff(bounds), pa.int64()),
                    lists(spans.ravel(), counts, pa.int64()),
                    pa.array(named, pa.list_(pa.string())),
                ],
                names=[*kept, *FOUND],
            )
            yield out if every_row else out.filter(pa.array(counts > 0))

    return scan


def _blocks(benchmark: DataFrame, most_bytes: int) -> Iterator[list[tuple]]:
    """(id, text) rows in blocks of at most ``most_bytes`` of text (or one longer item)."""
    rows = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text"
    ).where("text IS NOT NULL")
    block, size = [], 0
    for item, text in rows.toLocalIterator():
        length = len(text.encode())
        if block and size + length > most_bytes:
            yield block
            block, size = [], 0
        block.append((item, text))
        size += length
    yield block


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW_WORDS,
    block_bytes: int = BLOCK_BYTES,
    kept: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """The ``kept`` columns, n_words, hit_bounds and items for every row of ``docs``.

    ``hit_bounds`` lists first word and word after the last of each run of words inside an
    occurrence of a window of an item; ``items`` the ids of these items as text, sorted. Items
    are searched in blocks of bounded size, each sent to all tasks, one pass over the documents
    for each block; documents are not shuffled unless there are several blocks.

    A null or empty document has no words; an item without words has no window; an item without
    id is named by the empty text. Repeated rows each get a result. Without documents there are
    no rows, without items no hits. Kept columns named as one of the three are left out.
    """
    spark = docs.sparkSession
    kept = [name for name in kept if name not in FOUND]
    found = StructType(
        [
            StructField("n_words", LongType()),
            StructField("hit_bounds", ArrayType(LongType())),
            StructField("items", ArrayType(StringType())),
        ]
    )
    own = [F.col("doc_id").alias("_own"), F.xxhash64("text").alias("_key")]
    identity = [StructField("_own", docs.schema["doc_id"].dataType), StructField("_key", LongType())]
    result, more = None, []
    for block in _blocks(benchmark, block_bytes):
        tables = spark.sparkContext.broadcast(window_tables(block, window))
        if result is None:
            schema = StructType([*[docs.schema[name] for name in kept], *identity, *found])
            rows = docs.select(*dict.fromkeys([*kept, "text"]), *own)
            scan = _scan_function(tables, True, [*kept, "_own", "_key"])
            result = rows.mapInArrow(scan, schema)
        else:
            scan = _scan_function(tables, False, ["_own", "_key"])
            rows = docs.select(*own, "text")
            more.append(cut(rows.mapInArrow(scan, StructType([*identity, *found]))))
    if not more:
        return result.drop("_own", "_key")
    others = more[0]
    for frame in more[1:]:
        others = others.unionByName(frame)
    others = others.distinct().groupBy(F.col("_own").alias("_id"), F.col("_key").alias("_text")).agg(
        F.flatten(F.collect_list("hit_bounds")).alias("_bounds"),
        F.flatten(F.collect_list("items")).alias("_items"),
    )
    same = result["_own"].eqNullSafe(others["_id"]) & (result["_key"] == others["_text"])
    both = result.join(others, same, "left")
    no_bounds, no_items = F.array().cast("array<bigint>"), F.array().cast("array<string>")
    return both.select(
        *kept,
        "n_words",
        F.concat("hit_bounds", F.coalesce("_bounds", no_bounds)).alias("hit_bounds"),
        F.array_sort(
            F.array_distinct(F.concat("items", F.coalesce("_items", no_items)))
        ).alias("items"),
    )


def hit_words(hit_bounds: Column) -> Column:
    """The number of words inside the runs, also where runs of several passes overlap."""
    runs = F.transform(
        F.sequence(F.lit(0), F.floor(F.size(hit_bounds) / 2).cast("int") - 1),
        lambda i: F.sequence(
            F.get(hit_bounds, (i * 2)), F.get(hit_bounds, (i * 2 + 1)) - 1
        ),
    )
    n = F.size(F.array_distinct(F.flatten(runs))).cast("bigint")
    return F.when(F.size(hit_bounds) > 0, n).otherwise(F.lit(0).cast("bigint"))


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``find_contamination`` with n_hit words and ``contaminated``: a twentieth or more is hit."""
    found = find_contamination(docs, benchmark, **options)
    found = found.withColumn("n_hit", hit_words(F.col("hit_bounds")))
    much = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return found.drop("hit_bounds").withColumn("contaminated", much)
