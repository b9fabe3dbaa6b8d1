"""Moving packed arrays and texts between tasks: few wide rows instead of one row per value.

Values go to a bucket by their hash. The number of buckets follows the size of the input, so a
bucket holds about the same amount at any size; Spark shuffles and groups the buckets.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coterie.llm.buffers import byte_view, mixed

BUCKET_BYTES = 8 << 20
FLUSH_BYTES = 8 << 20
NO_ID = (1 << 63) - 1

Types = list[tuple[str, str]]


def bucket_count(docs: DataFrame, bytes_each: int = BUCKET_BYTES) -> int:
    """The number of buckets for a table of documents, from the bytes of all its texts."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-total // bytes_each))


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, version, text): ids as numbers, rows without one after all others.

    ``version`` tells apart rows that share an id but not their text.
    """
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc_id"),
        F.crc32(text).alias("version"),
        text.alias("text"),
    )


def pack(arrays: list[np.ndarray], types: Types) -> bytes:
    """Columns of equal length as one compressed value."""
    raw = b"".join(
        np.ascontiguousarray(a, dtype=t).tobytes() for a, (_, t) in zip(arrays, types, strict=True)
    )
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def unpack(blobs, types: Types) -> dict[str, np.ndarray]:
    """The columns of any number of packed values, one after the other."""
    width = sum(np.dtype(t).itemsize for _, t in types)
    sizes = [int.from_bytes(blob[:8], "little") for blob in blobs]
    columns = {name: np.empty(sum(sizes) // width, t) for name, t in types}
    row = 0
    for blob, size in zip(blobs, sizes, strict=True):  # one value is open at a time
        raw = pa.Codec("zstd", 1).decompress(blob[8:], size, asbytes=True)
        n, at = size // width, 0
        for name, t in types:
            columns[name][row : row + n] = np.frombuffer(raw, t, n, at)
            at += n * np.dtype(t).itemsize
        row += n
    return columns


def by_bucket(buckets: np.ndarray, arrays: list[np.ndarray], types: Types):
    """(bucket, packed arrays) for each bucket that occurs."""
    if not len(buckets):
        return
    order = np.argsort(buckets, kind="stable")
    found, first = np.unique(buckets[order], return_index=True)
    arrays = [a[order] for a in arrays]
    for bucket, start, end in zip(found, first, [*first[1:], len(order)], strict=True):
        yield int(bucket), pack([a[start:end] for a in arrays], types)


def bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """A bucket for each 64-bit hash, stirred first: the least hash of a window is a low number."""
    return ((mixed(hashes) >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int32)


def bucket_of_ids(ids: np.ndarray, n: int) -> np.ndarray:
    return bucket_of(ids.astype(np.uint64), n)


def rows_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    """(kind, bucket, packed) rows as a batch."""
    kinds, buckets, blobs = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(kinds, pa.int32()), pa.array(buckets, pa.int32()), pa.array(blobs, pa.binary())],
        names=["kind", "bucket", "packed"],
    )


ROWS = "kind int, bucket int, packed binary"


TEXT_ROWS = "bucket int, ids binary, texts binary"
TEXT_TYPES = [("doc_id", "i8"), ("version", "u4"), ("length", "i8")]


def texts_by_bucket(docs: DataFrame, n_buckets: int) -> DataFrame:
    """Texts of ``keyed`` documents in compressed blocks, dealt to buckets by doc_id."""

    def send(batches):
        held, size = [], 0

        def flush():
            table = pa.Table.from_batches(held).combine_chunks()
            ids = table.column("doc_id").to_numpy()
            buckets = bucket_of_ids(ids, n_buckets)
            order = np.argsort(buckets, kind="stable")
            table = table.take(pa.array(order))
            buckets = buckets[order]
            data, offsets = byte_view(table.column("text").combine_chunks())
            found, first = np.unique(buckets, return_index=True)
            columns = [table.column("doc_id").to_numpy(), table.column("version").to_numpy()]
            columns.append(np.diff(offsets))
            ids, texts = [], []
            for start, end in zip(first, [*first[1:], len(buckets)], strict=True):
                ids.append(pack([c[start:end] for c in columns], TEXT_TYPES))
                raw = data[offsets[start] : offsets[end]]
                texts.append(pa.Codec("zstd", 1).compress(raw.tobytes(), asbytes=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int32()), pa.array(ids, pa.binary()),
                 pa.array(texts, pa.large_binary()).cast(pa.binary())],
                names=["bucket", "ids", "texts"],
            )

        for batch in batches:
            held.append(batch)
            size += batch.column("text").nbytes
            if size >= FLUSH_BYTES:
                yield flush()
                held, size = [], 0
        if held and sum(b.num_rows for b in held):
            yield flush()

    return docs.mapInArrow(send, TEXT_ROWS)


def text_blocks(table: pa.Table):
    """(doc_ids, versions, bytes, offsets) of each compressed block of a bucket."""
    for row in range(table.num_rows):
        ids = unpack([table.column("ids")[row].as_py()], TEXT_TYPES)
        offsets = np.concatenate(([0], np.cumsum(ids["length"])))
        blob = table.column("texts")[row].as_py()
        raw = pa.Codec("zstd", 1).decompress(blob, int(offsets[-1]), asbytes=True)
        yield ids["doc_id"], ids["version"], np.frombuffer(raw, np.uint8), offsets
