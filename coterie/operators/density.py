"""Density clustering, single linkage and affinity propagation over edit distances."""

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coterie.functions.hashing import md5_int
from coterie.operators.edit_join import both_ways, edit_distance_join
from coterie.operators.graph import connected_components
from coterie.operators.indexing import dense_index
from coterie.operators.lineage import cut
from coterie.operators.metric_join import Measure, metric_pairs
from coterie.operators.skew import salted_join

SEED = 459392  # of the hash that breaks ties between symmetric titles


def titles_within(
    titles: DataFrame, eps: int, measure: Measure | None, apart: str | None = None
) -> DataFrame:
    """Pairs within ``eps``: by the edit-distance join, or under any metric ``measure``."""
    if measure is None:
        return edit_distance_join(titles, eps, apart=apart)
    return metric_pairs(titles, eps, measure, apart=apart)


def dbscan(
    titles: DataFrame, eps: int, min_samples: int, measure: Measure | None = None
) -> DataFrame:
    """(title, n_neighbours, is_core, cluster); noise has cluster -1.

    The distance is Levenshtein's, or the metric ``measure`` of two columns.

    ``titles`` is (title, weight); a title's neighbours are all occurrences within ``eps``, its
    own included. Core titles within ``eps`` share a cluster, a border title joins the lowest
    cluster among its core neighbours. Clusters are numbered by their smallest core title.
    """
    points = cut(titles.select("title", "weight"))
    near = cut(both_ways(titles_within(points, eps, measure)).select("title", "neighbour"))
    weights = points.select(F.col("title").alias("neighbour"), "weight")
    around = salted_join(near, weights, ["neighbour"], "title")
    around = around.groupBy("title").agg(F.sum("weight").alias("around"))
    degree = points.join(around, "title", "left").select(
        "title", (F.col("weight") + F.coalesce("around", F.lit(0))).alias("n_neighbours")
    )
    degree = cut(degree.withColumn("is_core", F.col("n_neighbours") >= min_samples))
    core = degree.where("is_core").select(F.col("title").alias("id"))
    core_title = core.select(F.col("id").alias("title"))
    core_neighbour = core.select(F.col("id").alias("neighbour"))
    to_core = cut(near.join(core_neighbour, "neighbour", "left_semi"))
    links = to_core.join(core_title, "title", "left_semi").select(
        F.col("title").alias("a"), F.col("neighbour").alias("b")
    )
    components = cut(connected_components(core, links))
    numbers = dense_index(components.select("component").distinct(), ["component"], "cluster")
    core_clusters = cut(
        components.join(numbers, "component").select(F.col("id").alias("title"), "cluster")
    )
    border_clusters = (
        salted_join(
            to_core.join(core_title, "title", "left_anti"),
            core_clusters.withColumnRenamed("title", "neighbour"),
            ["neighbour"],
            "title",
        )
        .groupBy("title")
        .agg(F.min("cluster").alias("cluster"))
    )
    clusters = core_clusters.unionByName(border_clusters)
    return degree.join(clusters, "title", "left").select(
        "title", "n_neighbours", "is_core", F.coalesce("cluster", F.lit(-1)).alias("cluster")
    )


def dbscan_labels(
    titles: DataFrame, eps: int, min_samples: int, measure: Measure | None = None
) -> DataFrame:
    """(title, is_core, cluster) as ``dbscan`` gives them, without the pairs of dense places.

    Titles within half of ``eps`` of a common centre are within ``eps`` of one another; if they
    are ``min_samples``, counted with their weights, all of them are core and in one cluster. Such
    balls are found first, see ``full_balls``, and those whose centres are within ``eps`` are one
    block. The range join then leaves out pairs inside a block where they meet: neighbours are
    listed and counted for titles outside of balls only, and between blocks that may still touch.
    """
    points = cut(titles.select("title", "weight"))
    balls = cut(full_balls(points, eps, min_samples, measure))
    centres = cut(balls.select(F.col("ball").alias("title")).distinct())
    touching = titles_within(centres, eps, measure).select(
        F.col("title_a").alias("a"), F.col("title_b").alias("b")
    )
    joined = connected_components(centres.select(F.col("title").alias("id")), touching).select(
        F.col("id").alias("ball"), F.col("component").alias("joined")
    )
    inside = salted_join(balls, joined, ["ball"], "title").select("title", "joined")
    # a title outside is its own block; blocks of balls are named by a centre, which is inside
    blocks = cut(
        points.join(inside, "title", "left").select(
            "title",
            "weight",
            F.col("joined").isNotNull().alias("dense"),
            F.coalesce("joined", "title").alias("block"),
        )
    )
    near = titles_within(blocks, eps, measure, apart="block")
    near = cut(both_ways(near).select("title", "neighbour"))
    outside = blocks.where("NOT dense")
    around = (
        salted_join(
            near.join(outside.select("title"), "title", "left_semi"),
            points.select(F.col("title").alias("neighbour"), "weight"),
            ["neighbour"],
            "title",
        )
        .groupBy("title")
        .agg(F.sum("weight").alias("around"))
    )
    crowded = F.col("weight") + F.coalesce("around", F.lit(0)) >= min_samples
    core_outside = outside.join(around, "title", "left").where(crowded)
    core = cut(
        blocks.where("dense").select("title", "block").unionByName(core_outside.select("title", "block"))
    )
    to_core = cut(
        salted_join(
            near,
            core.select(F.col("title").alias("neighbour"), F.col("block").alias("b")),
            ["neighbour"],
            "title",
        )
    )
    of_title = core.select("title", F.col("block").alias("a"))
    links = salted_join(to_core, of_title, ["title"], "neighbour").select("a", "b").distinct()
    components = connected_components(core.select(F.col("block").alias("id")).distinct(), links)
    components = components.select(F.col("id").alias("block"), "component")
    clustered = cut(salted_join(core, components, ["block"], "title"))
    first = clustered.groupBy("component").agg(F.min("title").alias("first"))
    numbers = dense_index(first, ["first"], "cluster").select("component", "cluster")
    core_clusters = cut(
        salted_join(clustered, numbers, ["component"], "title").select("title", "cluster")
    )
    border_clusters = (
        salted_join(
            to_core.join(core.select("title"), "title", "left_anti"),
            core_clusters.withColumnRenamed("title", "neighbour"),
            ["neighbour"],
            "title",
        )
        .groupBy("title")
        .agg(F.min("cluster").alias("cluster"))
    )
    every = core_clusters.select("title", F.lit(True).alias("is_core"), "cluster").unionByName(
        border_clusters.select("title", F.lit(False).alias("is_core"), "cluster")
    )
    return points.join(every, "title", "left").select(
        "title",
        F.coalesce("is_core", F.lit(False)).alias("is_core"),
        F.coalesce("cluster", F.lit(-1)).alias("cluster"),
    )


def full_balls(
    points: DataFrame, eps: int, min_samples: int, measure: Measure | None = None
) -> DataFrame:
    """(title, ball): titles at most ``eps // 2`` from ``ball``, a centre that reaches ``min_samples``.

    Of ``n`` titles about the square root of ``n`` are centres, drawn by a hash; balls may overlap,
    and a title is listed under its nearest full one (ties to the smallest). So a place of ``m``
    titles costs ``m`` times its centres, and one with no centre has few more titles than that root.
    """
    n_titles = points.count()
    ticket = md5_int(F.concat(F.lit("ball:"), "title")) / F.lit(2.0**32)
    drawn = ticket * F.lit(float(n_titles) ** 0.5) < 1
    marked = cut(points.select("title", "weight", drawn.alias("drawn")))
    centres = marked.where("drawn").select("title")
    if measure is None:
        pairs = edit_distance_join(marked, eps // 2, of=centres)
    else:
        pairs = metric_pairs(marked, eps // 2, measure, apart="drawn")
    own = centres.select("title", F.lit(0).alias("distance"), F.col("title").alias("ball"))
    reach = salted_join(
        both_ways(pairs), centres.withColumnRenamed("title", "neighbour"), ["neighbour"], "title"
    ).select("title", "distance", F.col("neighbour").alias("ball"))
    reach = cut(salted_join(reach.unionByName(own), points, ["title"], "ball"))
    full = (
        reach.groupBy("ball")
        .agg(F.sum("weight").alias("held"))
        .where(F.col("held") >= min_samples)
        .select("ball")
    )
    return (
        salted_join(reach, full, ["ball"], "title")
        .groupBy("title")
        .agg(F.min(F.struct("distance", "ball")).alias("best"))
        .select("title", F.col("best.ball").alias("ball"))
    )


def single_linkage_cut(
    titles: DataFrame, height: int, measure: Measure | None = None
) -> DataFrame:
    """(title, cluster): single linkage stopped at a distance; named by the smallest title."""
    vertices = titles.select(F.col("title").alias("id")).distinct()
    links = titles_within(titles, height, measure).select(
        F.col("title_a").alias("a"), F.col("title_b").alias("b")
    )
    return connected_components(vertices, links).select(
        F.col("id").alias("title"), F.col("component").alias("cluster")
    )


def single_linkage_merges(
    titles: DataFrame, first_radius: int = 4, measure: Measure | None = None
) -> DataFrame:
    """(pass, cluster, nearest, distance, merged_into), until one cluster is left.

    In each pass every cluster finds its nearest other cluster (ties to the smallest name) and
    all of them merge, so the passes are at most the logarithm of the titles. They run over the
    edges that any pass can need, see ``linkage_edges``.
    """
    edges = linkage_edges(titles, first_radius, measure)
    passes = []
    while True:
        swap = F.array(
            F.struct(F.col("a").alias("cluster"), F.col("b").alias("other")),
            F.struct(F.col("b").alias("cluster"), F.col("a").alias("other")),
        )
        outgoing = cut(
            edges.select("distance", F.inline(swap))
            .groupBy("cluster")
            .agg(F.min(F.struct("distance", "other")).alias("best"))
            .select("cluster", F.col("best.other").alias("nearest"), "best.distance")
        )
        if outgoing.isEmpty():
            break
        merged = _merged(outgoing)
        passes.append(
            outgoing.join(merged, "cluster").select(
                F.lit(len(passes) + 1).alias("pass"),
                "cluster", "nearest", "distance", "merged_into",
            )
        )
        of_a = merged.select(F.col("cluster").alias("a"), F.col("merged_into").alias("into_a"))
        of_b = merged.select(F.col("cluster").alias("b"), F.col("merged_into").alias("into_b"))
        joined = salted_join(salted_join(edges, of_a, ["a"], "b"), of_b, ["b"], "a")
        edges = cut(
            joined.where("into_a <> into_b")
            .groupBy(F.least("into_a", "into_b").alias("a"), F.greatest("into_a", "into_b").alias("b"))
            .agg(F.min("distance").alias("distance"))
        )
    schema = "pass int, cluster string, nearest string, distance int, merged_into string"
    none = titles.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, passes, none)


def _merged(outgoing: DataFrame) -> DataFrame:
    """(cluster, merged_into): the smallest name among the clusters that nearest pointers tie.

    Pointers of equal distances lead to ever smaller names, so their only cycles are two clusters
    that name each other; following them, twice as far each round, ends at such a pair.
    """
    mutual = outgoing.select(F.col("nearest").alias("cluster"), F.col("cluster").alias("nearest"))
    ends = outgoing.join(mutual, ["cluster", "nearest"], "left_semi").select(
        "cluster", F.least("cluster", "nearest").alias("target")
    )
    others = outgoing.join(mutual, ["cluster", "nearest"], "left_anti")
    pointers = cut(
        ends.withColumn("ended", F.lit(True)).unionByName(
            others.select("cluster", F.col("nearest").alias("target"), F.lit(False).alias("ended"))
        )
    )
    while not pointers.where("NOT ended").isEmpty():
        onward = pointers.select(
            F.col("cluster").alias("target"),
            F.col("target").alias("further"),
            F.col("ended").alias("further_ended"),
        )
        moved = salted_join(pointers.where("NOT ended"), onward, ["target"], "cluster").select(
            "cluster", F.col("further").alias("target"), F.col("further_ended").alias("ended")
        )
        pointers = cut(pointers.where("ended").unionByName(moved))
    names = pointers.groupBy("target").agg(F.min("cluster").alias("merged_into"))
    return cut(salted_join(pointers, names, ["target"], "cluster").select("cluster", "merged_into"))


def linkage_edges(
    titles: DataFrame, first_radius: int = 4, measure: Measure | None = None
) -> DataFrame:
    """(a, b, distance): the pairs of titles that some pass of single linkage can need.

    A pair that shorter ones connect is never needed. The radius doubles until all titles are
    connected; a wider search leaves out pairs that are connected already where they meet, and of
    those it finds every task keeps a forest, with the pairs that tie in it.
    """
    points = cut(titles.select("title", F.col("title").alias("cluster")).distinct())
    n_clusters, radius = points.count(), first_radius
    edges = titles.sparkSession.createDataFrame([], "a string, b string, distance int")
    while n_clusters > 1:
        near = titles_within(points, radius, measure, apart="cluster")
        near = near.select(F.col("title_a").alias("a"), F.col("title_b").alias("b"), "distance")
        found = cut(near.mapInArrow(_forest, "a string, b string, distance int"))
        edges = edges.unionByName(found)
        of_a = points.select(F.col("title").alias("a"), F.col("cluster").alias("cluster_a"))
        of_b = points.select(F.col("title").alias("b"), F.col("cluster").alias("cluster_b"))
        links = salted_join(salted_join(found, of_a, ["a"], "b"), of_b, ["b"], "a").select(
            F.col("cluster_a").alias("a"), F.col("cluster_b").alias("b")
        )
        names = points.select(F.col("cluster").alias("id")).distinct()
        merged = connected_components(names, links.distinct()).select(
            F.col("id").alias("cluster"), "component"
        )
        points = cut(
            salted_join(points, merged, ["cluster"], "title").select(
                "title", F.col("component").alias("cluster")
            )
        )
        n_clusters = points.select("cluster").distinct().count()
        radius *= 2
    return cut(edges)


FOREST_ROWS = 1 << 19


def _forest(batches):
    """The edges of a task that no shorter edges connect, without repeats that tie.

    Of the edges of one length that lead from one connected part to one title, one is enough.
    """
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= FOREST_ROWS:
            held = [_forest_of(pa.Table.from_batches(held))]
            rows = held[0].num_rows
    if rows:
        yield _forest_of(pa.Table.from_batches(held))


def _forest_of(edges: pa.Table) -> pa.RecordBatch:
    both = pa.chunked_array([*edges.column("a").chunks, *edges.column("b").chunks])
    ends = both.combine_chunks().dictionary_encode()
    a, b = ends.indices.to_numpy().astype(np.int64).reshape(2, -1)
    distance = edges.column("distance").to_numpy()
    n = len(ends.dictionary)
    label, kept = np.arange(n), []
    for length in np.unique(distance):
        at = np.flatnonzero(distance == length)
        at = at[label[a[at]] != label[b[at]]]
        from_a = np.unique(label[a[at]] * n + b[at], return_index=True)[1]
        from_b = np.unique(label[b[at]] * n + a[at], return_index=True)[1]
        kept.append(at[np.union1d(from_a, from_b)])
        low = label
        while True:
            lower = low.copy()
            least = np.minimum(low[a[at]], low[b[at]])
            np.minimum.at(lower, low[a[at]], least)
            np.minimum.at(lower, low[b[at]], least)
            lower = lower[lower]
            if np.array_equal(lower, low):
                break
            low = lower
        label = low[label]
    return edges.take(pa.array(np.concatenate(kept))).combine_chunks().to_batches()[0]


def mutual_similarities(nearest: DataFrame) -> DataFrame:
    """(title, neighbour, similarity) in both directions of the rows of a nearest-neighbour join."""
    both = F.array(
        F.struct("title", "neighbour"),
        F.struct(F.col("neighbour").alias("title"), F.col("title").alias("neighbour")),
    )
    return (
        nearest.select(F.inline(both), (-F.col("distance")).cast("double").alias("similarity"))
        .distinct()
    )


def affinity_propagation(
    titles: DataFrame,
    similarities: DataFrame,
    preference: float | None = None,
    damping: float = 0.5,
    max_steps: int = 200,
    stable_steps: int = 15,
    tie_break: float = 0.01,
) -> DataFrame:
    """(title, exemplar) for every distinct title, by message passing over listed similarities.

    ``similarities`` is (title, neighbour, similarity) in both directions; pairs not listed
    cannot choose each other. The preference defaults to the median of the similarities. Titles
    in symmetric positions would alternate for ever, so each title's preference is lowered by a
    share of ``tie_break`` that a hash of the title gives. Ends when the exemplars have not changed
    for ``stable_steps`` steps and raises if ``max_steps`` pass before. Exemplars are their own;
    another title takes the most similar listed exemplar (ties to the smallest), and one that
    lists none is its own, as all are where no exemplar arises. Each step needs minima and maxima
    per title and a sum per neighbour, all of which merge map-side.
    """
    titles = titles.select("title").distinct()
    if similarities.isEmpty():
        return titles.select("title", F.col("title").alias("exemplar"))
    if preference is None:
        preference = similarities.agg(F.median("similarity")).first()[0]
    share = md5_int(F.concat_ws(":", F.lit(str(SEED)), "title")) / F.lit(2.0**32)
    own = similarities.select("title").distinct().select(
        "title",
        F.col("title").alias("neighbour"),
        (F.lit(float(preference)) - F.lit(tie_break) * share).alias("similarity"),
    )
    messages = cut(
        similarities.select("title", "neighbour", F.col("similarity").cast("double"))
        .unionByName(own)
        .withColumn("r", F.lit(0.0))
        .withColumn("a", F.lit(0.0))
    )
    stable, before = 0, None
    for _ in range(max_steps):
        messages = cut(_pass_messages(messages, damping))
        exemplars = messages.where(
            (F.col("title") == F.col("neighbour")) & (F.col("r") + F.col("a") > 0)
        )
        now = tuple(
            exemplars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("title"))).first()
        )
        stable = stable + 1 if now == before else 0
        before = now
        if stable >= stable_steps:
            break
    else:
        raise RuntimeError(f"exemplars still change after {max_steps} steps")
    order = F.struct(
        (F.col("title") != F.col("neighbour")).alias("other"),
        (-F.col("similarity")).alias("away"),
        "neighbour",
    )
    best = (
        salted_join(messages, exemplars.select("neighbour"), ["neighbour"], "title")
        .groupBy("title")
        .agg(F.min(order).alias("best"))
    )
    return titles.join(best, "title", "left").select(
        "title", F.coalesce("best.neighbour", "title").alias("exemplar")
    )


def _pass_messages(messages: DataFrame, damping: float) -> DataFrame:
    """One damped update of all responsibilities and then of all availabilities."""
    scored = messages.withColumn("score", F.col("a") + F.col("similarity"))
    top = scored.groupBy("title").agg(
        F.min(F.struct((-F.col("score")).alias("score"), "neighbour")).alias("top")
    )
    # salted, since one title may be listed with most others
    scored = salted_join(scored, top, ["title"], "neighbour")
    is_top = F.col("neighbour") == F.col("top.neighbour")
    second = scored.where(~is_top).groupBy("title").agg(F.max("score").alias("second"))
    rival = F.when(is_top, F.col("second")).otherwise(-F.col("top.score"))
    # a title without any listed neighbour has no rival and keeps its preference
    response = F.col("similarity") - F.coalesce(rival, F.lit(0.0))
    responded = scored.join(second, "title", "left").select(
        "title", "neighbour", "similarity", "a",
        (damping * F.col("r") + (1 - damping) * response).alias("r"),
    )
    is_own = F.col("title") == F.col("neighbour")
    support = responded.groupBy("neighbour").agg(
        F.sum(F.when(~is_own, F.greatest("r", F.lit(0.0))).otherwise(0.0)).alias("support"),
        F.max(F.when(is_own, F.col("r"))).alias("own_r"),
    )
    others = F.col("support") - F.greatest("r", F.lit(0.0))
    available = F.when(is_own, F.col("support")).otherwise(
        F.least(F.lit(0.0), F.col("own_r") + others)
    )
    return salted_join(responded, support, ["neighbour"], "title").select(
        "title", "neighbour", "similarity", "r",
        (damping * F.col("a") + (1 - damping) * available).alias("a"),
    )
