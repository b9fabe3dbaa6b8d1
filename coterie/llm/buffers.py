"""Words and hashes of whole texts, as numpy arrays over the bytes of an Arrow column."""

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 18
WORD_64 = (1 << 64) - 1


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; row ``i`` is bytes[offsets[i]:offsets[i + 1]].

    Nulls are empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches, column: str, most_bytes: int = PIECE_BYTES):
    """The batches cut into slices of at most ``most_bytes`` of text, or one longer text."""
    for batch in batches:
        lengths = np.diff(byte_view(batch.column(column))[1])
        first, size = 0, 0
        for row, length in enumerate(lengths):
            if size and size + length > most_bytes:
                yield batch.slice(first, row - first)
                first, size = row, 0
            size += length
        if first < batch.num_rows:
            yield batch.slice(first)


def byte_table(wanted) -> np.ndarray:
    """A table of the 256 bytes: whether ``wanted(byte)``."""
    return np.array([wanted(byte) for byte in range(256)])


NOT_SPACE = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
LOWER_WORD = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
TO_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def words(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray):
    """(starts, ends, bounds): the words of each row, row ``i`` has words bounds[i]:bounds[i+1].

    Words are maximal runs of ``word_bytes`` and never cross rows.
    """
    inside = word_bytes[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit values stirred, so that any bits of the result can be used."""
    values = values ^ (values >> np.uint64(30))
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


class SpanHash:
    """64-bit hashes of any spans of a byte array, from the prefix sums of a polynomial."""

    def __init__(self, seed: int = 0):
        base = 0x9E3779B97F4A7C15 + 16 * seed
        self.base, self.back = base, pow(base, -1, 1 << 64)
        self.values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(2 * seed + 1))
        self.up = self.down = np.ones(1, np.uint64)

    def load(self, data: np.ndarray) -> None:
        """Take the bytes that the next calls are about."""
        if len(self.up) <= len(data):
            n = len(data) + 1 + len(data) // 4
            self.up = np.full(n, self.base, np.uint64)
            self.down = np.full(n, self.back, np.uint64)
            self.up[0] = self.down[0] = 1
            np.cumprod(self.up, out=self.up)
            np.cumprod(self.down, out=self.down)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[: len(data)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        spans = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mixed(spans + (ends - starts).astype(np.uint64))


def window_hash(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of each ``width`` consecutive hashes."""
    n = max(len(hashes) - width + 1, 0)
    total = np.zeros(n, np.uint64)
    factor = 1
    for i in range(width):
        factor = factor * 0xD6E8FEB86659FD93 & WORD_64
        total += hashes[i : i + n] * np.uint64(factor)
    return mixed(total)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... (lengths[0] numbers), then the same for the next."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    first = np.repeat(np.asarray(starts, np.int64) - (np.cumsum(lengths) - lengths), lengths)
    return first + np.arange(total, dtype=np.int64)


def lists(values, counts: np.ndarray, type_) -> pa.ListArray:
    """An Arrow list column from flat values and the number of values in each row."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type_))
