"""What the driver's Python holds at once while the first two stages of the pipeline are fitted."""

import tracemalloc

import numpy as np

from coterie.llm import jaccard_join, quality_knn
from coterie.llm.exchange import pack


def peak_mb(work):
    """(result, the most MB that Python held during ``work``)."""
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_examples_are_weighted_in_blocks(spark):
    n = 2 * quality_knn.SAMPLE_PER_LABEL
    docs = spark.range(n).selectExpr("id AS doc_id", "concat_ws(' ', sequence(id, id + id % 9)) AS text")
    labels = spark.range(n).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS label")
    model, peak = peak_mb(lambda: quality_knn.train(docs, labels))
    assert model.vectors.shape == (n, quality_knn.DIMENSIONS)
    assert peak < 1.5 * n * quality_knn.TERMS * 4 / 1e6  # the matrix itself, and less than half of it again


def test_blocks_give_the_rows_of_the_whole():
    rng = np.random.default_rng(3)
    counts = rng.poisson(0.2, (quality_knn.BLOCK_ROWS + 5, quality_knn.TERMS)).astype(np.int32)
    rarity = rng.random(quality_knn.TERMS).astype(np.float32)
    packed = [pack([row], quality_knn.COUNT_TYPES) for row in counts]
    found = quality_knn.example_rows(packed, rarity)
    assert found.dtype == np.float32 and (found == quality_knn.weighted(counts, rarity)).all()


def test_levels_are_taken_slice_by_slice(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "concat('one two three four five ', id % 7) AS text")
    levels, peak = peak_mb(lambda: jaccard_join.shingle_levels(docs, 5))
    counted = np.sort(levels[levels > 0])
    # five words in all texts, and the last five with each of seven numbers: 43 or 42 texts each
    assert len(levels) == 1 << jaccard_join.CELL_BITS
    assert counted.tolist() == [21] * 7 + [32]
    assert peak < 4 * len(levels) / 1e6  # not the eight bytes of each count
