"""TF-IDF features of texts and k-means over features and vectors."""

import hashlib
from collections import Counter
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coterie.functions.hashing import md5_int
from coterie.operators.lineage import cut

SEED = 459392
ROUNDS = 5
# additions in another order may round once to a place that the centres had left
MOST_RETURNS = 3


def _terms(body: Column) -> Column:
    """Lower-case runs of at least two word characters."""
    return F.regexp_extract_all(F.lower(body), F.lit(r"([\p{L}\p{N}_]{2,})"), 1)


def vocabulary(
    posts: DataFrame, stop_words: list[str], max_df: int, min_df: int, max_features: int
) -> DataFrame:
    """(term, total, df): the most frequent terms among those in min_df to max_df posts.

    Terms are sorted inside each row so that a post's first occurrence of a term can be marked
    there; the only shuffle is the count per term, which combines map-side.
    """
    kept = F.filter(_terms(F.col("body")), lambda term: ~term.isin(stop_words))
    ordered = posts.select(F.sort_array(kept).alias("terms"))
    previous = F.concat(
        F.array(F.lit(None).cast("string")),
        F.slice("terms", F.lit(1), F.greatest(F.size("terms") - 1, F.lit(0))),
    )
    marked = F.zip_with(
        "terms",
        previous,
        lambda term, before: F.struct(
            term.alias("term"), (~term.eqNullSafe(before)).cast("int").alias("first")
        ),
    )
    occurrences = ordered.select(F.inline_outer(marked)).where(F.col("term").isNotNull())
    return (
        occurrences.groupBy("term")
        .agg(F.count(F.lit(1)).alias("total"), F.sum("first").alias("df"))
        .where(F.col("df").between(min_df, max_df))
        .orderBy(F.desc("total"), "term")
        .limit(max_features)
    )


def tfidf(
    posts: DataFrame,
    stop_words: list[str],
    max_df: int = 15,
    min_df: int = 1,
    max_features: int = 10,
) -> DataFrame:
    """(post_id, term, tfidf): smoothed inverse frequency, rows scaled to length 1."""
    n_posts = posts.count()
    terms = vocabulary(posts, stop_words, max_df, min_df, max_features)
    weighted = cut(
        terms.select("term", (F.log((1 + F.lit(n_posts)) / (1 + F.col("df"))) + 1).alias("idf"))
    )
    names = [row["term"] for row in weighted.select("term").collect()]  # max_features at most
    listed = F.filter(_terms(F.col("body")), lambda term: term.isin(names))
    raw = (
        posts.select("post_id", F.explode(listed).alias("term"))
        .join(F.broadcast(weighted), "term")  # max_features rows at most
        .groupBy("post_id", "term")
        .agg((F.count(F.lit(1)) * F.max("idf")).alias("raw"))
    )
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("post_id")))
    return raw.select("post_id", "term", (F.col("raw") / length).alias("tfidf"))


def tfidf_vectors(posts: DataFrame, weights: DataFrame) -> DataFrame:
    """(post_id, features): the weights of all listed terms in term order, zero where absent."""
    terms = [row["term"] for row in weights.select("term").distinct().orderBy("term").collect()]
    # at most one entry per listed term
    listed = F.collect_list(F.when(F.col("term").isNotNull(), F.struct("term", "tfidf")))
    order = F.array(*[F.lit(term) for term in terms]).cast("array<string>")
    rows = posts.select("post_id").join(weights, "post_id", "left")
    return (
        rows.groupBy("post_id")
        .agg(F.map_from_entries(listed).alias("listed"))
        .select(
            "post_id",
            F.transform(
                order, lambda term: F.coalesce(F.try_element_at("listed", term), F.lit(0.0))
            ).alias("features"),
        )
    )


def kmeans(
    points: DataFrame, k: int, key: str, max_steps: int | None = None, seed: int = SEED
) -> DataFrame:
    """``points`` with the k-means ``cluster`` of their ``features``, arrays of equal length.

    Starts from ``start_centres``, assigns every point to the nearest centre (ties to the lowest number) and moves the centres to the means until
    none moves, which takes the more steps the more points there are. Raises if that takes more than
    ``max_steps``, where given, or if rounding leads the centres round in a circle. A centre without points stays.
    Distances and centres are rounded to nine digits, so the order of additions does not matter.
    A step is one pass in Arrow batches: each task adds up its points to one row a cluster, and the
    driver only sees the ``k`` sums.
    """
    points = cut(points)
    centres = start_centres(points, k, key, seed)
    if not len(centres):
        return points.withColumn("cluster", F.lit(None).cast("int"))
    met = Counter()
    for _ in count() if max_steps is None else range(max_steps):
        sums = (
            points.select("features")
            .mapInArrow(_summing(centres), SUMS)
            .select("cluster", F.posexplode("sums").alias("at", "value"))
            .groupBy("cluster", "at")
            .agg(F.sum("value").alias("value"))
        )
        totals = np.zeros((len(centres), centres.shape[1] + 1))
        for cluster, at, value in sums.collect():  # k times the dimension, and the counts
            totals[cluster, at] = value
        held = totals[:, -1] > 0
        moved = centres.copy()
        moved[held] = np.round(totals[held, :-1] / totals[held, -1:], DIGITS)
        if np.array_equal(moved, centres):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in points.schema)
            return points.mapInArrow(_assigning(centres), f"{columns}, cluster int")
        met[moved.tobytes()] += 1
        if met[moved.tobytes()] > MOST_RETURNS:
            raise RuntimeError("centres move in a circle")
        centres = moved
    raise RuntimeError(f"centres still move after {max_steps} steps")


def start_centres(
    points: DataFrame, k: int, key: str, seed: int = SEED, rounds: int = ROUNDS
) -> np.ndarray:
    """``k`` different vectors far apart, one a row (all vectors, if there are fewer).

    Candidates begin with ``k`` vectors drawn evenly. Each round draws ``2 * k`` more, with chances
    that go by a vector's points times its squared distance to the nearest candidate so far. Then
    every candidate weighs the points that are nearest to it, and ``k`` of them are drawn one by
    one, with chances by weight times squared distance to those drawn before. All draws compare
    hashes of the vectors' smallest keys: of numbers -log(u) / chance the least ones win, so a
    round is one pass and a top of ``2 * k`` rows, and a rerun draws the same. The driver holds
    at most ``k * (1 + 2 * rounds)`` candidates.
    """
    ticket = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    vectors = points.groupBy("features").agg(
        F.min(ticket).alias("ticket"), F.count(F.lit(1)).alias("weight")
    )
    vectors = vectors.withColumn("away", F.lit(float("inf")))
    drawn = vectors.orderBy("ticket").limit(k).select("features", "ticket").collect()
    if not drawn:
        return np.zeros((0, 0))
    candidates = list(drawn)
    for number in range(1, rounds + 1):
        if not drawn:
            break
        vectors = cut(vectors.mapInArrow(_nearing(_matrix(drawn)), vectors.schema))
        even = (md5_int(F.concat_ws(":", F.lit(f"{seed}:{number}"), "ticket")) + 0.5) / 2.0**32
        wait = -F.log(even) / (F.col("weight") * F.col("away"))
        drawn = (
            vectors.where("away > 0").orderBy(wait, "ticket").limit(2 * k)
            .select("features", "ticket").collect()
        )
        candidates += drawn
    candidates.sort(key=lambda row: row["ticket"])
    held = (
        points.select("features")
        .mapInArrow(_summing(_matrix(candidates)), SUMS)
        .groupBy("cluster")
        .agg(F.sum(F.element_at("sums", -1)).alias("n"))
    )
    weights = np.zeros(len(candidates))
    for cluster, n in held.collect():  # one row a candidate
        weights[cluster] = n
    return _drawn(_matrix(candidates), weights, [row["ticket"] for row in candidates], k, seed)


def _drawn(
    candidates: np.ndarray, weights: np.ndarray, tickets: list[str], k: int, seed: int
) -> np.ndarray:
    """``k`` of the candidates, each drawn by its weight and its distance to those before it."""
    away, chosen = np.ones(len(candidates)), []
    for number in range(1, k + 1):
        texts = [f"{seed}:pick:{number}:{ticket}" for ticket in tickets]
        heads = [int(hashlib.md5(text.encode()).hexdigest()[:8], 16) for text in texts]
        even = (np.array(heads) + 0.5) / 2.0**32
        open_ = np.flatnonzero(weights * away > 0)
        if not len(open_):
            break
        wait = -np.log(even[open_]) / (weights * away)[open_]
        chosen.append(open_[wait.argmin()])
        squares = ((candidates - candidates[chosen[-1]]) ** 2).sum(axis=1)
        away = squares if number == 1 else np.minimum(away, squares)
    return candidates[chosen]


def _matrix(rows: list) -> np.ndarray:
    return np.array([row["features"] for row in rows], np.float64).reshape(len(rows), -1)


def _nearing(candidates: np.ndarray):
    """Lowers ``away`` to the squared distance to the nearest of the candidates."""

    def lower(batches):
        for batch in batches:
            away = batch.column("away").to_numpy().copy()
            if batch.num_rows:
                vectors = _vectors(batch)
                for candidate in candidates:
                    np.minimum(away, ((vectors - candidate) ** 2).sum(axis=1), out=away)
            at = batch.schema.get_field_index("away")
            yield batch.set_column(at, "away", pa.array(away))

    return lower


DIGITS = 9
STEP_VALUES = 1 << 20
SUMS = "cluster int, sums array<double>"


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    values = batch.column("features").flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.float64).reshape(batch.num_rows, -1)


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The number of each vector's nearest centre, in steps of bounded memory."""
    found = np.zeros(len(vectors), np.int32)
    step = max(1, STEP_VALUES // max(1, centres.shape[1]))
    for at in range(0, len(vectors), step):
        part = vectors[at : at + step]
        squares = np.stack([((part - centre) ** 2).sum(axis=1) for centre in centres], axis=1)
        found[at : at + step] = np.round(np.sqrt(squares), DIGITS).argmin(axis=1)
    return found


def _summing(centres: np.ndarray):
    """For each cluster that has points in a task the sum of them, and their number as last value."""

    def add(batches):
        sums = np.zeros((len(centres), centres.shape[1] + 1))
        for batch in batches:
            if batch.num_rows:
                vectors = _vectors(batch)
                cluster = _nearest(vectors, centres)
                sums[:, -1] += np.bincount(cluster, minlength=len(centres))
                for number in np.unique(cluster):
                    sums[number, :-1] += vectors[cluster == number].sum(axis=0)
        held = np.flatnonzero(sums[:, -1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array(sums[held].tolist(), pa.list_(pa.float64()))],
            names=["cluster", "sums"],
        )

    return add


def _assigning(centres: np.ndarray):
    def assign(batches):
        for batch in batches:
            cluster = _nearest(_vectors(batch), centres) if batch.num_rows else np.zeros(0, np.int32)
            yield batch.append_column("cluster", pa.array(cluster))

    return assign


def cluster_top_terms(clusters: DataFrame, weights: DataFrame, n: int = 10) -> DataFrame:
    """(cluster, rank, term, weight): the heaviest terms of each cluster's centroid."""
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    sums = (
        weights.join(clusters.select("post_id", "cluster"), "post_id")
        .groupBy("cluster", "term")
        .agg(F.sum("tfidf").alias("total"))
    )
    order = Window.partitionBy("cluster").orderBy(F.desc("weight"), "term")
    return (
        sums.join(sizes, "cluster")
        .select("cluster", "term", F.round(F.col("total") / F.col("size"), 9).alias("weight"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= n)
    )
