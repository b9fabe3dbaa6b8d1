"""Whitening of embeddings by MLlib's distributed BlockMatrix.

Vectors are quantised to whole numbers, so that sums are exact, and each distinct one is fitted
once. Their centred rows are numbered into blocks of a BlockMatrix. Its transposed product with
itself is the scatter matrix, whose eigenvectors (found on the driver, the square of the dimension
in size) make the whitening matrix, and one more BlockMatrix product projects all rows.

The blocks are laid out twice. For the scatter they stand below each other, and the product splits
their common dimension over tasks of a few blocks. For the projection they form a square grid
against a block-diagonal whitening matrix, since MLlib deals a product to tasks along both of its
dimensions and a single column of blocks would get few of them. MLlib keeps one pair of numbers a
block on the driver.
"""

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coterie.operators.indexing import dense_index
from coterie.operators.lineage import cut
from coterie.operators.skew import salted_join

COMPONENTS = 4
SCALE = 256.0
LEAST_BLOCK_VALUES, MOST_BLOCK_VALUES = 1 << 16, 1 << 21
USUAL_BLOCKS = 4096
BLOCKS_PER_TASK = 8
# an eigenvalue below this share of the trace is rounding, not variance
NO_VARIANCE = 1e-12
LONG_MAX = (1 << 63) - 1
LOW_BITS = (1 << 31) - 1

WHITENED = "component int, n bigint, deviation bigint, whitened double, explained double"
WHITENED += ", identity_error double"


def quantised(rows: DataFrame, id_column: str, column: str) -> DataFrame:
    """(vec_id, x): each usable vector with its entries as floor(256 c), whole numbers.

    Vectors that are null or empty, or hold null or non-finite entries or any of 2^54 or more,
    take no part.
    """
    entries = F.col(column).cast("array<double>")
    whole = F.transform(entries, lambda c: F.floor(c * F.lit(SCALE)))
    usable = F.size(column) > 0
    usable &= F.forall(entries, lambda c: c.isNotNull() & (F.abs(c) < F.lit(2.0**54)))
    return rows.where(usable).select(F.col(id_column).alias("vec_id"), whole.alias("x"))


def _matrix(batch: pa.RecordBatch | pa.Table, size: int) -> np.ndarray:
    column = batch.column("x")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _sums(distinct: DataFrame, size: int) -> list[int]:
    """The exact sum of each dimension."""

    def add(batches):
        totals = [0] * size
        for batch in batches:
            x = _matrix(batch, size)
            # the halves of a batch's numbers cannot overflow; totals have any length
            high, low = (x >> 31).sum(axis=0).tolist(), (x & LOW_BITS).sum(axis=0).tolist()
            totals = [t + (h << 31) + part for t, h, part in zip(totals, high, low, strict=True)]
        yield pa.RecordBatch.from_pydict(
            {"place": pa.array(range(size), pa.int32()), "total": [str(t) for t in totals]}
        )

    parts = distinct.select("x").mapInArrow(add, "place int, total string")
    found = parts.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    sums = {row["place"]: int(row["total"]) for row in found.collect()}  # one row a dimension
    return [sums[place] for place in range(size)]


def _offsets(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exactly: 64-bit numbers if their squares' sums fit, else Python's."""
    most = float(np.abs(x).max(initial=0)) * n + max(abs(s) for s in sums)
    if most * most * len(sums) < 2.0**62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    total = (_offsets(x, n, sums) ** 2).sum(axis=1).tolist()
    return [t if t <= LONG_MAX else None for t in total]


def _centred_blocks(distinct: DataFrame, n: int, sums: list[int], height: int) -> DataFrame:
    """(block, centred): rows x - S / n of each block, filled up with zeros to ``height`` rows."""
    size = len(sums)

    def build(rows: pa.Table) -> pa.Table:
        places = rows.column("row").to_numpy()
        block = np.zeros((height, size))
        block[places % height] = (_offsets(_matrix(rows, size), n, sums) / n).astype(float)
        columns = [pa.array([places[0] // height]), pa.array([block.tobytes()], pa.binary())]
        return pa.table(columns, ["block", "centred"])

    placed = distinct.withColumn("block", F.floor(F.col("row") / height))
    return placed.groupBy("block").applyInArrow(build, "block bigint, centred binary")


def _block_matrix(blocks: DataFrame, height: int, size: int, rows: int, columns: int):
    """A BlockMatrix of blocks in a grid of ``columns``, numbered row by row."""

    def place(row):
        # the matrix is column-major unless marked as transposed
        values = np.frombuffer(row["centred"], np.float64)
        return divmod(row["block"], columns), DenseMatrix(height, size, values, True)

    return BlockMatrix(blocks.rdd.map(place), height, size, rows * height, columns * size)


def _product(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """left times right, its common dimension split over ``splits`` tasks a block.

    Python's ``multiply`` lacks the splits of the JVM's.
    """
    wrapper = left._java_matrix_wrapper
    found = wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(found, left.rowsPerBlock, right.colsPerBlock)


def scatter_matrix(blocks: DataFrame, height: int, size: int, n_blocks: int) -> np.ndarray:
    """The sum of the outer products of all rows of the blocks."""
    tall = _block_matrix(blocks, height, size, n_blocks, 1)
    tall = tall.persist(StorageLevel.DISK_ONLY)
    total = _product(tall.transpose(), tall, -(-n_blocks // BLOCKS_PER_TASK)).toLocalMatrix()
    tall._java_matrix_wrapper._java_model.blocks().unpersist(False)
    return total.toArray()


def projected(blocks: DataFrame, height: int, weights: np.ndarray, n_blocks: int) -> DataFrame:
    """(row, whitened): the rows of all blocks times ``weights``."""
    spark, (size, width) = blocks.sparkSession, weights.shape
    columns = isqrt(n_blocks - 1) + 1
    grid = _block_matrix(blocks, height, size, -(-n_blocks // columns), columns)
    local = DenseMatrix(size, width, np.ascontiguousarray(weights).ravel(), True)
    diagonal = spark.sparkContext.parallelize(range(columns)).map(lambda j: ((j, j), local))
    spread = BlockMatrix(diagonal, size, width, columns * size, columns * width)

    def flat(block):
        (i, j), values = block
        return i * columns + j, bytearray(np.ascontiguousarray(values.toArray()).tobytes())

    found = spark.createDataFrame(
        _product(grid, spread, 1).blocks.map(flat), "block bigint, values binary"
    )

    def rows(batches):
        for batch in batches:
            for block, values in zip(*batch.to_pydict().values(), strict=True):
                flat_values = pa.array(np.frombuffer(values, np.float64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block * height + np.arange(height)),
                     pa.ListArray.from_arrays(
                         pa.array(np.arange(height + 1, dtype=np.int32) * width), flat_values)],
                    names=["row", "whitened"],
                )

    return found.mapInArrow(rows, "row bigint, whitened array<double>")


def _identity_error(whitened: DataFrame, width: int) -> float:
    """The largest entry by which the covariance of the whitened rows misses the identity."""
    pairs = [(i, j) for i in range(width) for j in range(i + 1)]
    measured = whitened.agg(
        *[F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]).alias(f"c{i}_{j}") for i, j in pairs]
    ).first()
    return max(abs(measured[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def _whiten_size(rows: DataFrame, size: int, components: int) -> DataFrame:
    distinct = cut(dense_index(rows.select("x").distinct(), ["x"], "row"))
    n = distinct.count()
    sums = _sums(distinct, size)
    values = min(max(LEAST_BLOCK_VALUES, n * size // USUAL_BLOCKS), MOST_BLOCK_VALUES)
    height = max(1, values // size)
    n_blocks = -(-n // height)
    blocks = cut(_centred_blocks(distinct, n, sums, height))
    covariance = scatter_matrix(blocks, height, size, n_blocks) / n
    # eigh numbers eigenvalues from the smallest
    eigenvalues, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    width = min(components, size)
    eigenvalues, vectors = eigenvalues[::-1][:width], vectors[:, ::-1][:, :width]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(width)])
    trace = float(np.trace(covariance))
    kept = int((eigenvalues > NO_VARIANCE * trace).sum()) if trace > 0 else 0
    explained = [float(max(e, 0.0) / trace) if trace > 0 else 0.0 for e in eigenvalues]

    def deviate(batches):
        for batch in batches:
            found = pa.array(_deviations(_matrix(batch, size), n, sums), pa.int64())
            yield batch.append_column("deviation", found)

    fitted = distinct.mapInArrow(deviate, "x array<bigint>, row bigint, deviation bigint")
    error = None
    if kept:
        weights = vectors[:, :kept] / np.sqrt(eigenvalues[:kept])
        whitened = cut(projected(blocks, height, weights, n_blocks).where(F.col("row") < n))
        error = _identity_error(whitened, kept)
        fitted = fitted.join(whitened, "row")
    else:
        fitted = fitted.withColumn("whitened", F.lit(None).cast("array<double>"))
    parts = [
        F.struct(
            F.lit(k + 1).alias("component"),
            (F.col("whitened")[k] if k < kept else F.lit(None).cast("double")).alias("whitened"),
            F.lit(explained[k]).alias("explained"),
        )
        for k in range(width)
    ]
    named = salted_join(rows, fitted.select("x", "deviation", "whitened"), ["x"], "vec_id")
    return named.select(
        "vec_id", "deviation", F.inline(F.array(*parts))
    ).select(
        "vec_id",
        "component",
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        "explained",
        F.lit(error).cast("double").alias("identity_error"),
    )


def whiten(
    rows: DataFrame,
    id_column: str = "vec_id",
    column: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error).

    One row for each usable row of ``rows`` and each component, up to ``components`` and the
    vectors' length. Unusable vectors (see ``quantised``) are left out. Equal vectors, under one
    id or many, are fitted once and each row is returned. Vectors of different lengths are fitted
    apart, one after the other. A component without variance, as all are for a single vector, has
    whitened null, and identity_error is null where no component varies; deviation is null beyond
    the range of a long. Further columns of ``rows`` are left out. No usable rows give no rows.
    """
    usable = cut(quantised(rows, id_column, column))
    # one row for each length that occurs
    sizes = sorted(r[0] for r in usable.select(F.size("x")).distinct().collect())
    if not sizes:
        kind = usable.schema["vec_id"].dataType.simpleString()
        return rows.sparkSession.createDataFrame([], f"vec_id {kind}, {WHITENED}")
    result = None
    for size in sizes:
        part = _whiten_size(usable.where(F.size("x") == size), size, components)
        result = part if result is None else result.unionAll(part)
    return result
