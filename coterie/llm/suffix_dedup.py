"""Removing bytes of strings that start earlier in the corpus, by column-wise sorted suffixes."""

import tempfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coterie.llm.buffers import PIECE_BYTES, SpanHash, byte_view, mixed, pieces, ranges
from coterie.llm.exchange import (
    FLUSH_BYTES,
    NO_ID,
    ROWS,
    bucket_count,
    bucket_of,
    bucket_of_ids,
    by_bucket,
    keyed,
    rows_batch,
    text_blocks,
    texts_by_bucket,
    unpack,
)
from coterie.operators.lineage import cut

LENGTH = 100
ANCHOR = 24
TILE = 16
TILE_ROWS = 1 << 14

# kinds of packed rows, and what they hold
STRETCH, REPEAT, OPEN, PIECE = 0, 1, 2, 3
STRETCH_TYPES = [
    ("anchor", "u8"), ("content", "u8"), ("doc_id", "i8"), ("version", "u4"), ("start", "u4"),
    ("more", "u2"), ("ahead", "u2"),
]
REPEAT_TYPES = [("doc_id", "i8"), ("version", "u4"), ("first", "u4"), ("last", "u4")]
OPEN_TYPES = [
    ("anchor", "u8"), ("doc_id", "i8"), ("version", "u4"), ("start", "u4"), ("more", "u2"),
    ("ahead", "u2"),
]


def stretches(data, offsets, hasher: SpanHash, length: int, anchor: int):
    """(anchor hash, content hash, row, start, more, ahead) of each stretch of starts.

    Every string of ``length`` bytes is anchored at its smallest ``anchor``-gram by hash, the
    leftmost of equal ones; equal strings have equal anchors at equal places. Consecutive starts
    in a text with the same anchor are a stretch: ``more`` further starts after ``start``, the
    anchor ``ahead`` bytes after it. Stretches of equal content hash hold the same strings.
    """
    n = len(data)
    places = n - anchor + 1
    window = length - anchor + 1
    if n < length:
        return tuple(np.zeros(0, t) for t in ("u8", "u8", "i8", "i8", "i8", "i8"))
    at = np.arange(places)
    grams = hasher(at, at + anchor)
    place_bits = np.uint64((1 << max(28, n.bit_length())) - 1)
    order = (grams & ~place_bits) | at.astype(np.uint64)
    blocks = np.full(-(-places // window) * window, np.iinfo(np.uint64).max, np.uint64)
    blocks[:places] = order
    blocks = blocks.reshape(-1, window)
    to_here = np.minimum.accumulate(blocks, axis=1).ravel()
    from_here = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - length + 1
    least = np.minimum(from_here[:count], to_here[window - 1 : window - 1 + count])
    starts = np.flatnonzero(
        np.arange(count) + length <= np.repeat(offsets[1:], np.diff(offsets))[:count]
    )
    anchors = (least & place_bits).astype(np.int64)[starts]
    opens = np.ones(len(starts), bool)
    opens[1:] = (np.diff(anchors) != 0) | (np.diff(starts) != 1)
    first = np.flatnonzero(opens)
    more = np.diff(np.append(first, len(starts))) - 1
    start, anchors = starts[first], anchors[first]
    ahead = anchors - start
    content = hasher(start, start + more + length)
    content = mixed(content + ahead.astype(np.uint64) + (more.astype(np.uint64) << np.uint64(32)))
    row = np.searchsorted(offsets, start, "right") - 1
    return grams[anchors], content, row, start - offsets[row], more, ahead


def merged(doc_id, version, first, last):
    """Ranges of starts, sorted and joined where they touch or overlap in a document."""
    order = np.lexsort((first, version, doc_id))
    doc_id, version, first, last = doc_id[order], version[order], first[order], last[order]
    if not len(order):
        return doc_id, version, first, last
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(doc_id) != 0) | (np.diff(version.astype(np.int64)) != 0)
    group = np.cumsum(new) - 1
    # the farthest end so far, kept apart between documents by a base that grows with each
    base = group * (1 << 33)
    reach = np.maximum.accumulate(last.astype(np.int64) + base)
    new[1:] |= first[1:].astype(np.int64) + base[1:] > reach[:-1] + 1
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(order)) - 1
    return doc_id[begin], version[begin], first[begin], (reach - base)[end]


def repeats(rows: dict, order: np.ndarray, keys: list[str]):
    """(indices of each key's first row, indices of the rows after it), by doc_id and start.

    ``order`` sorts the rows by key, doc_id and start. A row at the first one's own doc_id and
    start is neither: it is the same place.
    """
    if not len(order):
        return order, order
    new = np.zeros(len(order), bool)
    new[0] = True
    for key in keys:
        values = rows[key][order]
        new[1:] |= values[1:] != values[:-1]
    begin = np.flatnonzero(new)
    first = np.repeat(order[begin], np.diff(np.append(begin, len(order))))
    later = (rows["doc_id"][order] != rows["doc_id"][first]) | (
        rows["start"][order] != rows["start"][first]
    )
    return order[begin], order[later]


def repeat_rows(doc_id, version, first, last, n_buckets: int):
    """Packed rows of ranges of starts that occur earlier, for the buckets of their documents."""
    columns = list(merged(doc_id, version, first, last))
    buckets = bucket_of_ids(columns[0], n_buckets)
    return [(REPEAT, b, blob) for b, blob in by_bucket(buckets, columns, REPEAT_TYPES)]


def long_text_parts(data: np.ndarray, offsets: np.ndarray, length: int):
    """(bytes before, bytes, offsets): several texts as they are, a long one in parts.

    Parts overlap by ``length - 1`` bytes, so every string starts in exactly one of them. A
    stretch that is cut here may differ from its equals elsewhere; their tiles still meet.
    """
    if len(offsets) != 2 or len(data) <= 2 * PIECE_BYTES:
        yield 0, data, offsets
        return
    for begin in range(0, len(data) - length + 1, PIECE_BYTES):
        part = data[begin : begin + PIECE_BYTES + length - 1]
        yield begin, part, np.array([0, len(part)])


def _stretch_function(n_buckets: int, length: int, anchor: int):
    def send(batches):
        hasher, held, size = SpanHash(), [], 0

        def flush():
            names = [name for name, _ in STRETCH_TYPES]
            rows = {n: np.concatenate([h[i] for h in held]) for i, n in enumerate(names)}
            # what repeats inside this task's texts is known here; only firsts are sent
            order = np.lexsort((rows["start"], rows["doc_id"], rows["content"], rows["anchor"]))
            first, later = repeats(rows, order, ["anchor", "content"])
            ends = rows["start"] + rows["more"]
            out = repeat_rows(
                rows["doc_id"][later], rows["version"][later], rows["start"][later], ends[later],
                n_buckets,
            )
            first = np.sort(first)
            buckets = bucket_of(rows["anchor"][first], n_buckets)
            packed = by_bucket(buckets, [rows[n][first] for n in names], STRETCH_TYPES)
            return rows_batch(out + [(STRETCH, b, blob) for b, blob in packed])

        for batch in pieces(batches, "text"):
            data, offsets = byte_view(batch.column("text"))
            ids = batch.column("doc_id").to_numpy()
            versions = batch.column("version").to_numpy()
            for skipped, part, bounds in long_text_parts(data, offsets, length):
                hasher.load(part)
                grams, content, row, start, more, ahead = stretches(
                    part, bounds, hasher, length, anchor
                )
                start += skipped
                held.append((grams, content, ids[row], versions[row], start, more, ahead))
                size += len(part)
                if size >= FLUSH_BYTES:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return send


def _compare_function(n_buckets: int):
    """Of the stretches with one anchor: which repeat whole, and which must be looked into."""

    def compare(table: pa.Table) -> pa.Table:
        kinds, blobs = table.column("kind").to_numpy(), table.column("packed").to_pylist()
        rows = unpack([b for k, b in zip(kinds, blobs) if k == STRETCH], STRETCH_TYPES)
        order = np.lexsort((rows["start"], rows["doc_id"], rows["content"], rows["anchor"]))
        first, later = repeats(rows, order, ["anchor", "content"])
        done = unpack([b for k, b in zip(kinds, blobs) if k == REPEAT], REPEAT_TYPES)
        ends = rows["start"].astype(np.int64) + rows["more"]
        out = repeat_rows(
            np.concatenate((done["doc_id"], rows["doc_id"][later])),
            np.concatenate((done["version"], rows["version"][later])),
            np.concatenate((done["first"], rows["start"][later])),
            np.concatenate((done["last"], ends[later])),
            n_buckets,
        )
        anchors = rows["anchor"][first]
        alone = np.ones(len(first), bool)
        alone[1:] &= anchors[1:] != anchors[:-1]
        alone[:-1] &= anchors[:-1] != anchors[1:]
        first = first[~alone]
        buckets = bucket_of_ids(rows["doc_id"][first], n_buckets)
        columns = [rows[name][first] for name, _ in OPEN_TYPES]
        out += [(OPEN, b, blob) for b, blob in by_bucket(buckets, columns, OPEN_TYPES)]
        return pa.Table.from_batches([rows_batch(out)])

    return compare


def _piece_types(length: int, tile: int):
    return [
        ("key", "u8"), ("content", "u8"), ("doc_id", "i8"), ("version", "u4"), ("start", "u4"),
        ("skipped", "u1"), ("strings", "u1"), ("bytes", f"V{length + tile - 1}"),
    ]


def tile_bytes(data, places, first, last, width: int) -> np.ndarray:
    """``width`` bytes from each of ``places`` on, with zeros outside of ``first`` to ``last``."""
    padded = np.pad(data, width)
    windows = np.lib.stride_tricks.sliding_window_view(padded, width)
    block = np.ascontiguousarray(windows[places + width])
    column = np.arange(width, dtype=np.int16)
    for row in range(0, len(block), TILE_ROWS):
        rows = slice(row, row + TILE_ROWS)
        outside = (column < first[rows, None]) | (column >= last[rows, None])
        block[rows][outside] = 0
    return block


def _piece_function(n_buckets: int, length: int, tile: int):
    """Cut the open stretches into tiles of starts and send each tile's bytes by its core.

    All strings of a tile contain its core, so equal strings are in tiles of equal core.
    """
    width = length + tile - 1
    types = _piece_types(length, tile)

    def send(texts: pa.Table, opened: pa.Table) -> pa.Table:
        rows = unpack(opened.column("packed").to_pylist(), OPEN_TYPES)
        by_id: dict[tuple, int] = {}
        order = np.lexsort((rows["version"], rows["doc_id"]))
        rows = {name: values[order] for name, values in rows.items()}
        out, hasher, held = [], SpanHash(1), []
        if len(order):
            names = np.stack([rows["doc_id"], rows["version"].astype(np.int64)], axis=1)
            found, begin = np.unique(names, axis=0, return_index=True)
            limits = np.append(begin, len(order))
            # np.unique orders by id and version, as the rows are
            by_id = {tuple(k): i for i, k in enumerate(found.tolist())}
        for ids, versions, data, offsets in text_blocks(texts) if by_id else ():
            here = [
                (row, by_id[key])
                for row, key in enumerate(zip(ids.tolist(), versions.tolist()))
                if key in by_id
            ]
            if not here:
                continue
            text_rows = np.array([row for row, _ in here])
            groups = np.array([group for _, group in here])
            counts = limits[groups + 1] - limits[groups]
            index = ranges(limits[groups], counts)
            base = np.repeat(offsets[text_rows], counts)
            start = rows["start"][index].astype(np.int64)
            more = rows["more"][index].astype(np.int64)
            ahead = rows["ahead"][index].astype(np.int64)
            # starts relative to the anchor, cut at multiples of the tile
            low, high = -ahead, more - ahead
            tiles = high // tile - low // tile + 1
            each = np.repeat(np.arange(len(index)), tiles)
            number = ranges(low // tile, tiles)
            anchor = start[each] + ahead[each]
            begin = np.maximum(low[each], number * tile)
            end = np.minimum(high[each], number * tile + tile - 1)
            hasher.load(data)
            at = base[each] + anchor
            core = hasher(at + number * tile + tile - 1, at + number * tile + length)
            key = mixed(core + number.astype(np.uint64))
            content = hasher(at + begin, at + end + length)
            skipped = begin - number * tile
            content = mixed(content + skipped.astype(np.uint64))
            block = tile_bytes(data, at + number * tile, skipped, end - number * tile + length, width)
            pieces_ = {
                "key": key, "content": content, "doc_id": rows["doc_id"][index][each],
                "version": rows["version"][index][each], "start": anchor + begin,
                "skipped": skipped, "strings": end - begin + 1,
                "bytes": block.view(f"V{width}").ravel(),
            }
            held.append(pieces_)
        if held:
            gathered = {name: np.concatenate([h.pop(name) for h in held]) for name, _ in types}
            sort = np.lexsort(tuple(gathered[k] for k in ("start", "doc_id", "content", "key")))
            first, later = repeats(gathered, sort, ["key", "content"])
            out += repeat_rows(
                gathered["doc_id"][later], gathered["version"][later], gathered["start"][later],
                (gathered["start"] + gathered["strings"] - 1)[later], n_buckets,
            )
            columns = [gathered[name][first] for name, _ in types]
            packed = by_bucket(bucket_of(gathered["key"][first], n_buckets), columns, types)
            out += [(PIECE, b, blob) for b, blob in packed]
        return pa.Table.from_batches([rows_batch(out)])

    return send


def column_sorted(columns, groups: np.ndarray, length: int, tile: int):
    """For each start in a tile: the rows in suffix order and their common prefixes.

    ``columns(j)`` gives the symbols of all rows at place ``j`` of their tiles. Beginning with
    the last column, each round puts one symbol in front of every row's suffix: the order is
    sorted again by the new symbol alone, inside the groups of equal cores, and the prefix that
    neighbours share is one longer than the least one between their former places, or nothing if
    the symbols differ. This is the collection's Burrows-Wheeler transform at equal depths.
    """
    n = len(groups)
    order = np.argsort(groups, kind="stable")
    edge = np.ones(n, bool)
    edge[1:] = np.diff(groups[order]) != 0
    common = np.zeros(n, np.int32)
    group = np.cumsum(edge).astype(np.int64)
    for place in range(length + tile - 2, -1, -1):
        symbols = columns(place)[order]
        sort = np.argsort(group * 256 + symbols, kind="stable")
        # the least common prefix after the former place of the neighbour up to the own
        low, high = sort[:-1] + 1, sort[1:] + 1
        between = np.zeros(n, np.int32)
        same = np.zeros(n, bool)
        same[1:] = (group[sort][1:] == group[sort][:-1]) & (
            symbols[sort][1:] == symbols[sort][:-1]
        )
        if same.any():
            pairs = np.stack([low, high], axis=1)[same[1:]].ravel()
            padded = np.append(common, np.int32(0))
            between[same] = np.minimum.reduceat(padded, pairs)[::2]
        # at the very end of the tile suffixes are empty and share nothing yet
        depth = length + tile - 2 - place
        common = np.where(same, np.minimum(between if depth else 0, depth) + 1, 0).astype(np.int32)
        order = order[sort]
        if place < tile:
            yield place, order, common


def _collection_function(n_buckets: int, length: int, tile: int):
    """Of the pieces with one core: the strings that occur earlier."""
    types = _piece_types(length, tile)
    width = length + tile - 1

    def compare(table: pa.Table) -> pa.Table:
        kinds, blobs = table.column("kind").to_numpy(), table.column("packed").to_pylist()
        done = unpack([b for k, b in zip(kinds, blobs) if k == REPEAT], REPEAT_TYPES)
        rows = unpack([b for k, b in zip(kinds, blobs) if k == PIECE], types)
        order = np.lexsort((rows["start"], rows["doc_id"], rows["content"], rows["key"]))
        first, later = repeats(rows, order, ["key", "content"])
        start = rows["start"].astype(np.int64)
        found = [
            (done["doc_id"], done["version"], done["first"], done["last"]),
            (rows["doc_id"][later], rows["version"][later], start[later],
             start[later] + rows["strings"][later] - 1),
        ]
        keys = rows["key"][first]
        alone = np.ones(len(first), bool)
        alone[1:] &= keys[1:] != keys[:-1]
        alone[:-1] &= keys[:-1] != keys[1:]
        first = first[~alone]
        block = rows.pop("bytes").view(np.uint8).reshape(-1, width)
        rows = {name: values[first] for name, values in rows.items()}
        groups = np.unique(rows["key"], return_inverse=True)[1]
        if len(first):
            with tempfile.TemporaryDirectory() as folder:  # this task's own, gone with it
                file = Path(folder, "columns")
                with file.open("wb") as out:  # symbols column by column, read back in sequence
                    for place in range(width):
                        out.write(block[first, place].tobytes())
                del block

                def column(place):
                    return np.fromfile(file, np.uint8, len(groups), offset=place * len(groups))

                found += earlier_strings(rows, groups, column, length, tile)
        out = repeat_rows(*[np.concatenate(x) for x in zip(*found)], n_buckets)
        return pa.Table.from_batches([rows_batch(out)])

    return compare


def earlier_strings(rows, groups, column, length, tile):
    """Ranges (doc_id, version, first, last) of strings that an earlier row's piece holds."""
    found = []
    start = rows["start"].astype(np.int64)
    skipped, strings = rows["skipped"].astype(np.int64), rows["strings"].astype(np.int64)
    for place, order, common in column_sorted(column, groups, length, tile):
        has = (skipped[order] <= place) & (place < skipped[order] + strings[order])
        run = np.cumsum(common < length)
        order, run = order[has], run[has]
        at = start[order] + place - skipped[order]
        sort = np.lexsort((at, rows["doc_id"][order], run))
        order, run, at = order[sort], run[sort], at[sort]
        doc_id = rows["doc_id"][order]
        if not len(order):
            continue
        begin = np.flatnonzero(np.concatenate(([True], np.diff(run) != 0)))
        lead = np.repeat(begin, np.diff(np.append(begin, len(run))))
        later = (doc_id != doc_id[lead]) | (at != at[lead])
        found.append((doc_id[later], rows["version"][order][later], at[later], at[later]))
    return found


REMOVED = "doc_id bigint, n_bytes bigint, starts array<bigint>, ends array<bigint>, kept binary"


def _remove_function(length: int):
    """Texts and the starts of repeated strings to the bytes removed and kept."""

    def remove(texts: pa.Table, found: pa.Table) -> pa.Table:
        rows = unpack(found.column("packed").to_pylist(), REPEAT_TYPES)
        doc_id, version, first, last = merged(*[rows[name] for name, _ in REPEAT_TYPES])
        runs: dict[tuple, list] = {}
        names = zip(doc_id.tolist(), version.tolist())
        for name, a, b in zip(names, first.tolist(), last.tolist()):
            spans = runs.setdefault(name, [])
            if spans and a <= spans[-1][1]:
                spans[-1][1] = b + length
            else:
                spans.append([a, b + length])
        batches = []
        for ids, versions, data, offsets in text_blocks(texts):
            out = []
            for row, name in enumerate(zip(ids.tolist(), versions.tolist())):
                text = data[offsets[row] : offsets[row + 1]].tobytes()
                spans = runs.get(name, [])
                kept, at = [], 0
                for a, b in spans:
                    kept.append(text[at:a])
                    at = b
                kept.append(text[at:])
                out.append(
                    (None if name[0] == NO_ID else name[0], len(text), [a for a, _ in spans],
                     [b for _, b in spans], b"".join(kept))
                )
            columns = list(zip(*out))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            batches.append(
                pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["doc_id", "n_bytes", "starts", "ends", "kept"],
                )
            )
        return pa.Table.from_batches(batches) if batches else pa.table(
            {"doc_id": pa.array([], pa.int64()), "n_bytes": pa.array([], pa.int64()),
             "starts": pa.array([], pa.list_(pa.int64())),
             "ends": pa.array([], pa.list_(pa.int64())), "kept": pa.array([], pa.binary())}
        )

    return remove


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, tile: int = TILE
) -> DataFrame:
    """(doc_id, n_bytes, starts, ends, kept) for every row of ``docs``.

    ``starts`` and ``ends`` are the maximal runs of bytes covered by a string of ``length`` bytes
    that also starts earlier: in a smaller doc_id, or before in the same document. ``kept`` is
    what remains, as bytes, since a run may begin inside a character. Strings are judged on the
    input.

    1. Starts are grouped into stretches with a common anchor, and stretches with equal content
       are resolved by their first occurrence, inside tasks and then by anchor. Most of the text
       never moves.
    2. Stretches that share an anchor and not their content are cut into tiles, whose pieces of
       text meet by a core that all strings of the tile contain.
    3. The pieces of a bucket are a collection of documents, whose suffixes are sorted column by
       column; neighbours with a common prefix of ``length`` hold equal strings.

    A null text is empty. Rows without doc_id come after all others, as one document; rows that
    share doc_id and place do not repeat each other. No rows give no rows.
    """
    if not 0 < tile <= length - 8 or not 8 <= anchor < length:
        raise ValueError("tile and anchor must leave some bytes of the length")
    rows = keyed(docs)
    n = bucket_count(docs)
    sent = rows.mapInArrow(_stretch_function(n, length, anchor), ROWS)
    compared = cut(sent.groupBy("bucket").applyInArrow(_compare_function(n), ROWS))
    opened = compared.where(F.col("kind") == OPEN)
    pieces_ = (
        texts_by_bucket(rows, n).groupBy("bucket")
        .cogroup(opened.groupBy("bucket"))
        .applyInArrow(_piece_function(n, length, tile), ROWS)
    )
    inside = cut(pieces_.groupBy("bucket").applyInArrow(_collection_function(n, length, tile), ROWS))
    found = compared.where(F.col("kind") == REPEAT).unionByName(inside)
    return (
        texts_by_bucket(rows, n).groupBy("bucket")
        .cogroup(found.groupBy("bucket"))
        .applyInArrow(_remove_function(length), REMOVED)
    )
