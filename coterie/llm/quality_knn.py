"""Quality of documents by the votes of their nearest labelled neighbours in a latent space."""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from coterie.llm.buffers import (
    NOT_SPACE,
    TO_LOWER,
    SpanHash,
    byte_view,
    mixed,
    pieces,
    words,
)
from coterie.llm.exchange import pack, unpack
from coterie.operators.lineage import cut

SAMPLE_PER_LABEL = 1536
DIMENSIONS = 64
NEIGHBOURS = 25
SHARPNESS = 4
THRESHOLD = 0.7
BLOCK_ROWS = 256
SEED = 7

# Terms: trigrams of character classes, words, the share of distinct words, the length.
SHAPES, WORDS, SHARES, LENGTHS = 2048, 4096, 21, 32
TERMS = SHAPES + WORDS + SHARES + LENGTHS
BLOCKS = ((0, SHAPES, 1.0), (SHAPES, SHAPES + WORDS, 0.4), (SHAPES + WORDS, TERMS, 0.5))
PARTS_SUMMED = 1000
COUNT_TYPES = [("count", "i4")]
TOTAL_TYPES = [("count", "i8")]


def _classes() -> np.ndarray:
    """Bytes with letters, capitals, digits, and letters beyond ASCII each made alike."""
    table = np.arange(256, dtype=np.uint64)
    table[ord("a") : ord("z") + 1] = ord("a")
    table[ord("A") : ord("Z") + 1] = ord("A")
    table[ord("0") : ord("9") + 1] = ord("0")
    table[0x80:] = 0x80
    return table


CLASSES = _classes()


def term_counts(data, offsets, hasher: SpanHash) -> np.ndarray:
    """Counts of the terms, a row for each text."""
    n = len(offsets) - 1
    counts = np.zeros(n * TERMS, np.int32)
    row = np.repeat(np.arange(n), np.diff(offsets))
    if len(data) >= 3:
        shape = mixed(
            (CLASSES[data[:-2]] << np.uint64(16))
            + (CLASSES[data[1:-1]] << np.uint64(8))
            + CLASSES[data[2:]]
        )
        inside = row[:-2] == row[2:]
        at = row[:-2][inside] * TERMS + (shape[inside] % np.uint64(SHAPES)).astype(np.int64)
        counts += np.bincount(at, minlength=len(counts)).astype(np.int32)
    lower = TO_LOWER[data]
    starts, ends, bounds = words(lower, offsets, NOT_SPACE)
    hasher.load(lower)
    hashes = hasher(starts, ends)
    n_words = np.diff(bounds)
    word_row = np.repeat(np.arange(n), n_words)
    at = word_row * TERMS + SHAPES + (hashes % np.uint64(WORDS)).astype(np.int64)
    counts += np.bincount(at, minlength=len(counts)).astype(np.int32)
    counts = counts.reshape(n, TERMS)
    order = np.lexsort((hashes, word_row))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(word_row) != 0) | (hashes[order][1:] != hashes[order][:-1])
    distinct = np.bincount(word_row[new], minlength=n)
    full = np.flatnonzero(n_words)
    share = (distinct[full] * (SHARES - 1)) // n_words[full]
    counts[full, SHAPES + WORDS + share] = 1
    size = np.minimum(np.log2(n_words[full]).astype(np.int64), LENGTHS - 1)
    counts[full, SHAPES + WORDS + SHARES + size] = 1
    return counts


def weighted(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Term weights of unit length in each block of terms."""
    rows = np.log1p(counts.astype(np.float32)) * rarity
    for first, after, weight in BLOCKS:
        length = np.linalg.norm(rows[:, first:after], axis=1, keepdims=True)
        rows[:, first:after] *= weight / np.maximum(length, 1e-9)
    return rows


class Model(NamedTuple):
    """What a task needs to score a text; its size is fixed by the parameters."""

    rarity: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    votes: np.ndarray
    prior: float


def _frequency_function():
    def count(batches):
        hasher, total = SpanHash(), np.zeros(TERMS + 1, np.int64)
        for batch in pieces(batches, "text"):
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(first, BLOCK_ROWS)
                held = term_counts(*byte_view(part.column("text")), hasher) > 0
                total[:-1] += held.sum(axis=0)
                total[-1] += len(held)
        part = TaskContext.get().partitionId() // PARTS_SUMMED
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([pack([total], TOTAL_TYPES)], pa.binary())],
            names=["part", "counts"],
        )

    return count


def _add(table: pa.Table) -> pa.Table:
    total = sum(unpack([b.as_py()], TOTAL_TYPES)["count"] for b in table.column("counts"))
    packed = pa.array([pack([total], TOTAL_TYPES)], pa.binary())
    return pa.table([table.column("part")[:1], packed], ["part", "counts"])


def term_rarity(docs: DataFrame) -> np.ndarray:
    """The logarithm of how rare each term is among all documents."""
    schema = "part int, counts binary"
    parts = docs.mapInArrow(_frequency_function(), schema).groupBy("part").applyInArrow(_add, schema)
    everything = parts.withColumn("part", F.lit(0)).groupBy("part").applyInArrow(_add, schema)
    row = everything.first()
    total = np.zeros(TERMS + 1, np.int64)
    if row is not None:
        total = unpack([row["counts"]], TOTAL_TYPES)["count"]
    return np.log((1.0 + total[-1]) / (1.0 + total[:-1])).astype(np.float32) + np.float32(0.1)


def _example_function():
    def features(batches):
        hasher = SpanHash()
        for batch in pieces(batches, "text"):
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(first, BLOCK_ROWS)
                counts = term_counts(*byte_view(part.column("text")), hasher)
                packed = [pack([row], COUNT_TYPES) for row in counts]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("label"), pa.array(packed, pa.binary())],
                    names=["doc_id", "label", "counts"],
                )

    return features


def example_rows(packed: list[bytes], rarity: np.ndarray) -> np.ndarray:
    """The weighted terms of packed counts; besides the result only one block of rows is open."""
    rows = np.empty((len(packed), TERMS), np.float32)
    for first in range(0, len(packed), BLOCK_ROWS):
        block = packed[first : first + BLOCK_ROWS]
        counts = unpack(block, COUNT_TYPES)["count"].reshape(len(block), TERMS)
        rows[first : first + BLOCK_ROWS] = weighted(counts, rarity)
    return rows


def latent_axes(rows: np.ndarray, dimensions: int) -> np.ndarray:
    """The strongest right singular vectors of ``rows``, by a randomised projection."""
    dimensions = min(dimensions, *rows.shape)
    start = np.random.default_rng(SEED).normal(size=(rows.shape[1], min(dimensions + 16, rows.shape[0])))
    basis = np.linalg.qr(rows @ start.astype(np.float32))[0]
    for _ in range(3):
        basis = np.linalg.qr(rows @ (rows.T @ basis))[0]
    return np.linalg.svd(basis.T @ rows, full_matrices=False)[2][:dimensions].T.astype(np.float32)


def unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.where(length > 0, rows / np.maximum(length, 1e-12), 0).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_PER_LABEL) -> Model:
    """Fit the model. ``docs`` (doc_id, text), ``labels`` (doc_id, label) of the training rows.

    At most ``sample`` documents of each label are used, those with the smallest hashes of their
    ids; a vote counts for as many documents as its label has per chosen one. Term rarities come
    from all of ``docs``. Only the sample's counts reach the driver.
    """
    rarity = term_rarity(docs.select("text"))
    totals = {row["label"]: row["n"] for row in labels.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals:
        empty = np.zeros((0, 1), np.float32)
        return Model(rarity, np.zeros((TERMS, 1), np.float32), empty, np.zeros(0), np.zeros(0), 0.5)
    chosen = None
    for label in totals:
        part = labels.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id")
        part = part.limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = cut(chosen)  # at most twice ``sample`` ids
    examples = (
        docs.join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "label", "text")
        .mapInArrow(_example_function(), "doc_id bigint, label int, counts binary")
        .dropDuplicates(["doc_id"])
        .collect()
    )
    examples.sort(key=lambda row: row["doc_id"])
    prior = totals.get(1, 0) / sum(totals.values())
    if not examples:
        empty = np.zeros((0, 1), np.float32)
        return Model(rarity, np.zeros((TERMS, 1), np.float32), empty, np.zeros(0), np.zeros(0), prior)
    label = np.array([row["label"] for row in examples])
    rows = example_rows([row["counts"] for row in examples], rarity)
    axes = latent_axes(rows, DIMENSIONS)
    votes = np.array([totals[l] / max(1, (label == l).sum()) for l in label])
    votes = (votes / votes.mean()).astype(np.float32)
    return Model(rarity, axes, unit(rows @ axes), label.astype(np.float32), votes, prior)


def scores(counts: np.ndarray, model: Model, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """The similarity-weighted share of label 1 among the nearest labelled documents."""
    k = min(neighbours, len(model.labels))
    if k == 0:
        return np.full(len(counts), model.prior)
    near = unit(weighted(counts, model.rarity) @ model.axes) @ model.vectors.T
    best = np.argpartition(-near, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(near, best, axis=1), 0) ** SHARPNESS * model.votes[best]
    total = weight.sum(axis=1)
    found = (weight * model.labels[best]).sum(axis=1) / np.maximum(total, 1e-12)
    return np.clip(np.where(total > 1e-12, found, model.prior), 0.0, 1.0)


def _score_function(model):
    def score(batches):
        hasher = SpanHash()
        for batch in pieces(batches, "text"):
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(first, BLOCK_ROWS)
                counts = term_counts(*byte_view(part.column("text")), hasher)
                found = pa.array(scores(counts, model.value).astype(np.float64))
                columns = {name: part.column(name) for name in part.schema.names}
                yield pa.RecordBatch.from_pydict(columns | {"score": found})

    return score


def is_held_out(doc_id: Column) -> Column:
    """Rows that training must not see: crc32 of the id as text has remainder 2 by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, label) of the labelled documents that are not held out; the most frequent label
    where an id has several, 0 where they are even."""
    return (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .where(~is_held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg((F.avg("quality") > 0.5).cast("int").alias("label"))
    )


def score_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_PER_LABEL) -> DataFrame:
    """Add ``score`` (0 to 1, higher: quality 1 likelier) to every row of ``docs``.

    A text's terms are weighted by their rarity in all documents and projected on the strongest
    directions of the labelled sample; the cosines with all labelled vectors are exact, and the
    ``NEIGHBOURS`` nearest vote with their similarity. Only the text is looked at. Null and empty
    texts have no neighbours and get the share of label 1; without usable labels this is 0.5.
    Repeated rows get equal scores; no rows give no rows. Columns of any name are kept; one named
    ``score`` is replaced.
    """
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    model = docs.sparkSession.sparkContext.broadcast(train(ids, training_labels(labels), sample))
    kept = docs.drop("score")
    schema = StructType([*kept.schema.fields, StructField("score", DoubleType())])
    return kept.mapInArrow(_score_function(model), schema)
