"""Clustering of titles around member titles (clustroids), for many groups at once.

A group is a period, a number of clusters or any other set of columns. Points are distinct
titles with a ``weight`` (how often the title occurs), so copies cost nothing: they cannot
change a maximum distance, and enter means through the weight. ``distance`` may be any metric.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coterie.functions.distance import levenshtein
from coterie.operators.lineage import cut
from coterie.operators.skew import spread

SEED = 459392

# Clustroids are broadcast, so their number is checked. All numbers are given by the caller.
MAX_CLUSTROIDS = 100_000
MAX_BROADCAST_TITLES = 500_000
CANDIDATES_PER_ROUND = 64

# A clustering that still moves after so many steps is an error, never a result.
MAX_STEPS = 200

Distance = Callable[[Column, Column], Column]


def year_bounds(titles: DataFrame, by: list[str]) -> DataFrame:
    """First and last year, per period or overall."""
    return titles.groupBy(*by).agg(
        F.min("year").alias("min_year"), F.max("year").alias("max_year")
    )


def in_period(titles: DataFrame, first: int, last: int) -> DataFrame:
    """Titles of the years ``first`` to ``last``, both included."""
    return titles.where(F.col("year").between(first, last))


def sliding_periods(titles: DataFrame, length: int = 10, step: int = 5) -> DataFrame:
    """Each title once per period it falls in: years start to start + length, both included.

    Periods start at the first year and every ``step`` years up to the last. The starts of a row
    follow from its year, so there is no join.
    """
    first_year = titles.agg(F.min("year")).first()[0]
    if first_year is None:
        first_year = 0
    first = F.greatest(F.lit(0), F.ceil((F.col("year") - length - first_year) / step))
    last = F.floor((F.col("year") - first_year) / step)
    starts = F.when(first <= last, F.sequence(first, last))
    return titles.select("*", F.explode(starts).alias("_period")).select(
        (F.lit(first_year) + F.col("_period") * step).cast("int").alias("period_start"),
        (F.lit(first_year) + F.col("_period") * step + length).cast("int").alias("period_end"),
        *titles.columns,
    )


def weighted_titles(titles: DataFrame, by: list[str]) -> DataFrame:
    """Distinct titles per group with their number of occurrences."""
    return titles.groupBy(*by, "title").agg(F.count(F.lit(1)).alias("weight"))


def cluster_counts(
    spark: SparkSession, by: list[str], counts: list[tuple]
) -> tuple[DataFrame, int, int]:
    """The wanted number of clusters per group, with the largest and the total number."""
    total = sum(row[-1] for row in counts)
    if total > MAX_CLUSTROIDS:
        raise ValueError(f"{total} clustroids exceed the {MAX_CLUSTROIDS} that may be broadcast")
    schema = ", ".join(f"{column} int" for column in [*by, "wanted"])
    largest = max((row[-1] for row in counts), default=0)
    return spark.createDataFrame(counts, schema), largest, total


def initial_clustroids(
    points: DataFrame, by: list[str], counts: list[tuple], seed: int = SEED
) -> DataFrame:
    """(group, cluster, title): each group's wanted number of titles in a seeded random order."""
    wanted, largest, _ = cluster_counts(points.sparkSession, by, counts)
    ticket = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("title")))
    order = Window.partitionBy(*by).orderBy("_ticket", "title")
    return (
        points.select(*by, "title", ticket.alias("_ticket"))
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= largest)  # a literal bound, applied before the shuffle
        .join(F.broadcast(wanted), by)
        .where(F.col("_rank") <= F.col("wanted"))
        .select(*by, (F.col("_rank") - 1).alias("cluster"), "title")
    )


def nearest_clustroid(
    points: DataFrame, clustroids: DataFrame, by: list[str], distance: Distance = levenshtein
) -> DataFrame:
    """Points with the cluster, clustroid and distance of the nearest clustroid of their group.

    Ties go to the lowest cluster number. The clustroids, whose number the caller has checked,
    are broadcast as one list per group; points are neither shuffled nor multiplied.
    """
    lists = clustroids.groupBy(*by).agg(
        F.collect_list(F.struct("cluster", "title")).alias("_clustroids")
    )
    options = F.transform(
        "_clustroids",
        lambda c: F.struct(
            distance(F.col("title"), c["title"]).alias("distance"),
            c["cluster"].alias("cluster"),
            c["title"].alias("clustroid"),
        ),
    )
    kept = [column for column in points.columns if column not in ("cluster", "clustroid", "distance")]
    return (
        spread(points)
        .join(F.broadcast(lists), by)
        .withColumn("_best", F.array_min(options))
        .select(*kept, "_best.cluster", "_best.clustroid", "_best.distance")
    )


def _measure(members: DataFrame, chosen: DataFrame, key: list[str], distance: Distance):
    """(key, candidate, reach): the largest distance from each chosen candidate to a member."""
    lists = chosen.groupBy(*key).agg(F.collect_list("title").alias("_candidates"))
    measured = F.transform(
        "_candidates",
        lambda c: F.struct(
            c.alias("candidate"), distance(F.col("title"), c).alias("distance")
        ),
    )
    return (
        spread(members)
        .join(F.broadcast(lists), key)
        .select(*key, F.inline(measured))
        .groupBy(*key, "candidate")
        .agg(F.max("distance").alias("reach"))
    )


def update_clustroids(
    assigned: DataFrame,
    by: list[str],
    distance: Distance = levenshtein,
    total: int = MAX_CLUSTROIDS,
    largest: int | None = None,
) -> DataFrame:
    """(group, cluster, title): per cluster the member with the smallest maximum distance.

    Ties go to the first title; emptied clusters disappear and the others move up. Members are
    not paired with each other. A bounded number of candidates per cluster is measured against
    all members in one pass; the triangle inequality then gives every other member a lower bound
    of its maximum distance, and only those that can still win are candidates of the next round.
    The result is exact, and clusters up to the candidate number need one round.
    """
    key = [*by, "cluster"]
    batch = max(1, min(CANDIDATES_PER_ROUND, MAX_BROADCAST_TITLES // max(total, 1)))
    members = assigned.select(*key, "title")
    if largest is None:
        largest = members.groupBy(*key).count().agg(F.max("count")).first()[0] or 0
    if largest <= batch:
        reach = _measure(members, members, key, distance)
        best = reach.groupBy(*key).agg(F.min(F.struct("reach", "candidate")).alias("best"))
    else:
        best = _search_clustroids(members, key, distance, batch)
    renumber = Window.partitionBy(*by).orderBy("cluster")  # one row per cluster
    return best.select(
        *by,
        (F.row_number().over(renumber) - 1).alias("cluster"),
        F.col("best.candidate").alias("title"),
    )


def _search_clustroids(
    members: DataFrame, key: list[str], distance: Distance, batch: int
) -> DataFrame:
    """The clusters' best (reach, candidate), in rounds of ``batch`` candidates per cluster."""
    open_titles = members.withColumn("lower", F.lit(0))
    order = Window.partitionBy(*key).orderBy("lower", "title")
    best = None
    while True:
        chosen = open_titles.withColumn("_rank", F.row_number().over(order))
        chosen = cut(chosen.where(F.col("_rank") <= batch).select(*key, "title"))
        reach = cut(_measure(members, chosen, key, distance))
        winners = reach.groupBy(*key).agg(F.min(F.struct("reach", "candidate")).alias("best"))
        if best is not None:
            winners = best.unionByName(winners).groupBy(*key).agg(F.min("best").alias("best"))
        best = cut(winners)
        known = reach.groupBy(*key).agg(
            F.collect_list(F.struct("candidate", "reach")).alias("_known")
        )
        bounds = F.transform(
            "_known",
            lambda k: F.greatest(
                distance(F.col("title"), k["candidate"]),
                k["reach"] - distance(F.col("title"), k["candidate"]),
            ),
        )
        can_win = (F.col("lower") < F.col("best.reach")) | (
            (F.col("lower") == F.col("best.reach")) & (F.col("title") < F.col("best.candidate"))
        )
        open_titles = cut(
            open_titles.join(F.broadcast(known), key)
            .where(~F.exists("_known", lambda k: k["candidate"] == F.col("title")))
            .withColumn("lower", F.greatest("lower", F.array_max(bounds)))
            .join(F.broadcast(best), key)
            .where(can_win)
            .select(*key, "title", "lower")
        )
        if open_titles.isEmpty():
            return best


def settle(
    points: DataFrame,
    by: list[str],
    counts: list[tuple],
    max_steps: int = MAX_STEPS,
    distance: Distance = levenshtein,
    seed: int = SEED,
) -> tuple[DataFrame, int]:
    """Points with cluster, clustroid and distance after clustering every group, and the steps.

    Repeats nearest clustroid and clustroid update until no point moves, and raises if that takes
    more than ``max_steps`` assignments. ``points`` is (group, title, weight); ``counts`` is
    (group, clusters wanted).
    """
    total = cluster_counts(points.sparkSession, by, counts)[2]
    points = cut(points.withColumn("previous", F.lit(-1)))
    clustroids = cut(initial_clustroids(points, by, counts, seed))
    for step in range(1, max_steps + 1):
        assigned = cut(nearest_clustroid(points, clustroids, by, distance))
        sizes = assigned.groupBy(*by, "cluster").agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("cluster") != F.col("previous")).alias("moved"),
        )
        moved, largest = sizes.agg(F.sum("moved"), F.max("n")).first()
        if not moved:
            return assigned.drop("previous"), step
        clustroids = cut(update_clustroids(assigned, by, distance, total, largest))
        points = assigned.select(*by, "title", "weight", F.col("cluster").alias("previous"))
    raise RuntimeError(f"titles still change clusters after {max_steps} steps")


def cluster_titles(points: DataFrame, by: list[str], counts: list[tuple], **options) -> DataFrame:
    """Points with cluster, clustroid and distance; the options are those of ``settle``."""
    return settle(points, by, counts, **options)[0]


def cluster_cost(assigned: DataFrame, by: list[str]) -> DataFrame:
    """Mean over a group's clusters of the mean distance of their titles to the clustroid."""
    per_cluster = assigned.groupBy(*by, "cluster").agg(
        (F.sum(F.col("distance") * F.col("weight")) / F.sum("weight")).alias("mean_distance")
    )
    return per_cluster.groupBy(*by).agg(F.avg("mean_distance").alias("cost"))


def elbow_sweep(titles: DataFrame, ks: list[int], max_steps: int = MAX_STEPS) -> DataFrame:
    """(k, cost) for every number of clusters, all clustered in one run with k as the group."""
    each_k = F.explode(F.array(*[F.lit(k) for k in ks])).alias("k")
    points = weighted_titles(titles, []).select(each_k, "title", "weight")
    assigned = cluster_titles(points, ["k"], [(k, k) for k in ks], max_steps=max_steps)
    return cluster_cost(assigned, ["k"])


def cluster_members(assigned: DataFrame, by: list[str]) -> DataFrame:
    """(group, cluster, clustroid, n_members, title): one row per member, counting occurrences."""
    key = [*by, "cluster", "clustroid"]
    sizes = assigned.groupBy(*key).agg(F.sum("weight").alias("n_members"))
    # one row per cluster: bounded by the number of clustroids
    return assigned.join(F.broadcast(sizes), key).select(*key, "n_members", "title", "weight")
