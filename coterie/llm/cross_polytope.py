"""Approximate nearest neighbours by cross-polytope hashing and exact reranking."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coterie.operators.lineage import cut

TABLES = 8
PROBES = 16
SEED = 20_011
CHUNK_ROWS = 8192
CHUNK_QUERIES = 1024
BLOCK_VALUES = 1 << 19
SALTS = 16


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row; the width is a power of two."""
    n, width = rows.shape
    step = 1
    while step < width:
        pairs = rows.reshape(n, -1, 2, step)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
        rows = rows.reshape(n, width)
        step *= 2
    return rows / np.sqrt(width)


def rotated(vectors: np.ndarray, table: int, seed: int = SEED) -> np.ndarray:
    """Pseudo-rotation of a table: three rounds of random signs and a Hadamard transform."""
    n, size = vectors.shape
    width = 1 << max(0, size - 1).bit_length()
    signs = np.random.default_rng([seed, table, size]).choice([-1.0, 1.0], (3, width))
    rows = np.zeros((n, width))
    rows[:, :size] = vectors
    for sign in signs:
        rows = hadamard(rows * sign)
    return rows


def signed_axes(vectors: np.ndarray, table: int, probes: int) -> np.ndarray:
    """The ``probes`` nearest signed axes of each rotated unit vector, nearest first.

    Axis ``a`` has number 2 a where its coordinate is positive and 2 a + 1 where negative.
    """
    rows = rotated(vectors / np.linalg.norm(vectors, axis=1, keepdims=True), table)
    near = np.stack([rows, -rows], axis=2).reshape(len(rows), -1)
    return np.argsort(-near, axis=1, kind="stable")[:, :probes]


def _hash_function(tables: int, probes: int):
    def send(batches):
        for batch in batches:
            lists = batch.column("vector").to_pylist()
            sizes = np.array([len(x) for x in lists])
            rows, tables_, axes = [], [], []
            for size in np.unique(sizes):
                here = np.flatnonzero(sizes == size)
                vectors = np.array([lists[i] for i in here], np.float64)
                # long vectors must not overflow when they are squared
                vectors /= np.abs(vectors).max(axis=1, keepdims=True)
                for table in range(tables):
                    found = signed_axes(vectors, table, probes)
                    rows.append(np.repeat(here, found.shape[1]))
                    tables_.append(np.full(found.size, table))
                    axes.append(found.ravel())
            rows = np.concatenate(rows) if rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rep").take(pa.array(rows)),
                    pa.array(sizes[rows] if len(rows) else [], pa.int32()),
                    pa.array(np.concatenate(tables_) if tables_ else [], pa.int32()),
                    pa.array(np.concatenate(axes) if axes else [], pa.int32()),
                    batch.column("vector").take(pa.array(rows)),
                    batch.column("least_id").take(pa.array(rows)),
                ],
                names=["rep", "size", "table", "axis", "vector", "least_id"],
            )

    return send


def distances(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """The Euclidean distance of each row to the query.

    Where squares would leave the range of a double, they are taken in parts of the largest
    difference. A distance beyond that range is infinite.
    """
    with np.errstate(over="ignore"):
        apart = rows - query
        found = np.sqrt((apart**2).sum(axis=1))
        odd = np.flatnonzero(~((found > 1e-140) & (found < 1e150)))
        if len(odd):
            most = np.abs(apart[odd]).max(axis=1)
            odd, most = odd[most > 0], most[most > 0]
            found[odd] = most * np.sqrt(((apart[odd] / most[:, None]) ** 2).sum(axis=1))
    return found


def _rerank_function(most: int):
    """The ``most`` nearest rows of a chunk for each query that probes it, by exact distance.

    Of equally far rows those with the smaller ids are taken.
    """

    def rerank(queries: pa.Table, rows: pa.Table) -> pa.Table:
        query, rep, distance = [], [], []
        if queries.num_rows and rows.num_rows:
            q = np.array(queries.column("vector").to_pylist(), np.float64)
            x = np.array(rows.column("vector").to_pylist(), np.float64)
            query_ids, row_ids = queries.column("rep").to_numpy(), rows.column("rep").to_numpy()
            least_ids = rows.column("least_id").to_numpy()
            step = max(1, BLOCK_VALUES // x.shape[1])
            blocks = [x[at : at + step] for at in range(0, len(x), step)]
            take = min(len(x), most)
            for i in range(len(q)):
                exact = np.concatenate([distances(part, q[i]) for part in blocks])
                chosen = np.flatnonzero(exact <= np.partition(exact, take - 1)[take - 1])
                order = chosen[np.lexsort((row_ids[chosen], least_ids[chosen], exact[chosen]))[:take]]
                query += [query_ids[i]] * len(order)
                rep += row_ids[order].tolist()
                distance += exact[order].tolist()
        columns = [pa.array(query, pa.int64()), pa.array(rep, pa.int64())]
        columns.append(pa.array(distance, pa.float64()))
        return pa.table(columns, ["query_rep", "rep", "score"])

    return rerank


def _met_rows(index: DataFrame, probing: DataFrame, most: int) -> DataFrame:
    """(query_rep, rep, score): the nearest rows of each chunk of the buckets that queries probe."""
    bucket = ["size", "table", "axis"]
    # as many rows as there are buckets, which the dimension and the tables fix
    chunks = index.groupBy(*bucket).agg(
        F.ceil(F.count(F.lit(1)) / CHUNK_ROWS).cast("int").alias("chunks")
    )
    blocks = probing.groupBy(*bucket).agg(
        F.ceil(F.count(F.lit(1)) / CHUNK_QUERIES).cast("int").alias("blocks")
    )
    met = F.broadcast(chunks.join(blocks, bucket))

    def dealt(frame, own, own_name, other, other_name):
        one = F.pmod(F.xxhash64("rep"), F.col(own)).cast("int").alias(own_name)
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other_name)
        return frame.join(met, bucket).select("rep", *bucket, "vector", "least_id", one, every)

    place = [*bucket, "chunk", "block"]
    sent_rows = dealt(index, "chunks", "chunk", "blocks", "block")
    sent_queries = dealt(probing, "blocks", "block", "chunks", "chunk")
    return (
        sent_queries.groupBy(*place)
        .cogroup(sent_rows.groupBy(*place))
        .applyInArrow(_rerank_function(most), "query_rep bigint, rep bigint, score double")
    )


def usable(vectors: DataFrame, id_name: str, vector_name: str) -> DataFrame:
    """(vec_id, vector) of the rows with an id and a finite vector that is not zero."""
    vector = F.col(vector_name).cast("array<double>")
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return vectors.select(F.col(id_name).cast("bigint").alias("vec_id"), vector.alias("vector")).where(
        F.col("vec_id").isNotNull()
        & F.col("vector").isNotNull()
        & F.coalesce(finite, F.lit(False))
        & F.exists("vector", lambda x: x != 0)
    )


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    tables: int = TABLES,
    probes: int = PROBES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found rows of each query.

    ``vectors`` and ``queries`` have ``vec_id`` and ``vector`` as ``usable`` gives them; a query
    never finds a row of its own id. The score is the Euclidean distance of the vectors as they
    are; ties go to the smaller vec_id.

    1. Equal vectors are one, with their ``k + 1`` smallest ids: no others can be among the
       nearest. So a group of copies of any size is one row of the index.
    2. Each vector is in one bucket of every table, its nearest signed axis after a
       pseudo-rotation; a query looks into its ``probes`` nearest ones.
    3. Buckets are cut into chunks of about ``CHUNK_ROWS`` rows, and the queries of a bucket into
       blocks. Each block takes the exact nearest rows of each chunk, so what a query gets is
       bounded by the number of chunks it meets.
    4. Queries that got fewer than ``k`` rows are compared with all rows of their length. So a
       result is shorter only where there are no more candidates.

    Vectors only meet vectors of their own length. Rows that share an id are told apart by their
    vectors; repeated rows are one. Without rows or queries the result is empty.
    """
    key = F.xxhash64("vector")
    ranked = Window.partitionBy("key", "vector", "salt").orderBy("vec_id")
    over_salts = Window.partitionBy("key", "vector").orderBy("vec_id")
    members = (
        vectors.distinct()
        .withColumn("key", key)
        .withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
        .withColumn("_place", F.row_number().over(ranked))
        .where(F.col("_place") <= k + 1)
        .withColumn("_place", F.row_number().over(over_salts))
        .where(F.col("_place") <= k + 1)
        .withColumn("rep", F.first("vec_id").over(over_salts))
        .select("key", "vector", "rep", "vec_id")
    )
    members = cut(members)
    # a representative may stand for several vectors if ids repeat: it is named by both
    name = F.xxhash64("rep", "key")
    distinct = members.where(F.col("vec_id") == F.col("rep")).select(
        name.alias("rep"), "vector", F.col("rep").alias("least_id")
    )
    ids = members.select(name.alias("rep"), "vec_id")
    asked = cut(
        queries.distinct()
        .withColumn("key", key)
        .join(
            members.where(F.col("vec_id") == F.col("rep"))
            .select("key", F.col("vector").alias("_same"), "rep"),
            "key",
            "left",
        )
        .where(F.col("_same").isNull() | (F.col("_same") == F.col("vector")))
        .select(
            F.coalesce(F.xxhash64("rep", "key"), F.xxhash64("vec_id", "key")).alias("rep"),
            F.col("vec_id").alias("query_id"),
            "vector",
        )
    )
    hashed = "rep bigint, size int, table int, axis int, vector array<double>, least_id bigint"
    index = cut(distinct.mapInArrow(_hash_function(tables, 1), hashed))
    queried = asked.groupBy("rep").agg(
        F.first("vector").alias("vector"), F.min("query_id").alias("least_id")
    )
    probing = queried.mapInArrow(_hash_function(tables, probes), hashed)
    near = cut(_met_rows(index, probing, k + 1).distinct())
    by_rep = asked.select(F.col("rep").alias("query_rep"), "query_id").distinct()
    of_query = Window.partitionBy("query_id").orderBy("score", "vec_id")

    def ranked(near):
        by_score = Window.partitionBy("query_rep").orderBy("score")
        near = near.withColumn("_place", F.dense_rank().over(by_score))
        return (
            near.where(F.col("_place") <= k + 1)
            .drop("_place")
            .join(ids, "rep")
            .join(by_rep, "query_rep")
            .where(F.col("vec_id") != F.col("query_id"))
            .groupBy("query_id", "vec_id")
            .agg(F.min("score").alias("score"))
            .withColumn("rank", F.row_number().over(of_query))
            .where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score")
        )

    found = cut(ranked(near))
    whole = found.where(F.col("rank") == k).select("query_id")
    short = cut(asked.join(whole, "query_id", "left_anti").select("rep", "query_id").distinct())
    everywhere = [F.size("vector").alias("size"), F.lit(0).alias("table"), F.lit(0).alias("axis")]
    fields = ["rep", *everywhere, "vector", "least_id"]
    wanted = queried.join(short.select("rep").distinct(), "rep", "left_semi").select(*fields)
    added = ranked(_met_rows(distinct.select(*fields), wanted, k + 1).distinct())
    added = added.join(short.select("query_id").distinct(), "query_id", "left_semi")
    return found.join(short.select("query_id").distinct(), "query_id", "left_anti").unionByName(added)
