"""Pairs of strings within an edit distance, found by an equi join."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coterie.operators.heavy_join import heavy_join
from coterie.operators.lineage import cut


def _segment(length: Column, part: Column, n_parts: int) -> tuple[Column, Column]:
    """Start (from 0) and length of an even split's part; the last parts take the remainder."""
    base = F.floor(length / n_parts).cast("int")
    plain_parts = n_parts - length % n_parts
    start = part * base + F.greatest(F.lit(0), part - plain_parts)
    return start.cast("int"), (base + (part >= plain_parts).cast("int")).cast("int")


def _indexed(distinct: DataFrame, eps: int) -> DataFrame:
    """(short, short_side, size, part, segment): the eps + 1 segments of each title."""
    start, length = _segment(F.col("size"), F.col("part"), eps + 1)
    parts = F.explode(F.sequence(F.lit(0), F.lit(eps))).alias("part")
    return distinct.select("title", "size", "side", parts).select(
        F.col("title").alias("short"),
        F.col("side").alias("short_side"),
        "size",
        "part",
        F.substring(F.col("title"), start + 1, length).alias("segment"),
    )


def _probes(distinct: DataFrame, eps: int) -> DataFrame:
    """(long, long_side, size, part, segment): the substrings of each title that a segment of a title of
    length ``size`` can have become, given how far ``eps`` edits can shift it."""
    start, length = _segment(F.col("size"), F.col("part"), eps + 1)
    shift = F.col("long_size") - F.col("size")
    left = eps - F.col("part")
    low = F.greatest(F.lit(0), start - F.col("part"), start + shift - left)
    high = F.least(F.col("long_size") - length, start + F.col("part"), start + shift + left)
    sizes = F.explode(F.sequence(F.greatest(F.lit(0), F.col("size") - eps), F.col("size")))
    parts = F.explode(F.sequence(F.lit(0), F.lit(eps))).alias("part")
    return (
        distinct.select(
            F.col("title").alias("long"),
            F.col("side").alias("long_side"),
            F.col("size").alias("long_size"),
            sizes.alias("size"),
        )
        .select("*", parts)
        .select("*", length.alias("length"), low.alias("low"), high.alias("high"))
        .select(
            "long", "long_side", "size", "part", "length",
            F.explode(F.when(F.col("low") <= F.col("high"), F.sequence("low", "high"))).alias("at"),
        )
        .select(
            "long", "long_side", "size", "part",
            F.substring(F.col("long"), F.col("at") + 1, F.col("length")).alias("segment"),
        )
    )


def edit_distance_join(
    titles: DataFrame, eps: int, of: DataFrame | None = None, apart: str | None = None
) -> DataFrame:
    """All pairs of different titles within Levenshtein distance ``eps``.

    Returns (title_a, title_b, distance) with title_a < title_b; with ``of``, only the pairs
    that have a title of that subset; with ``apart``, only the pairs that differ in that column,
    which the titles then determine and which others never leave the join. Of two strings within ``eps`` edits, the longer one holds
    at least one of the shorter one's ``eps + 1`` segments unchanged, at a position that the
    other edits can explain; joining on (length, segment number, segment text) therefore misses
    no pair and compares no pair without such a match. A segment that many titles hold is cut into
    tiles on both sides. Candidates are verified where they meet, and only true pairs are shuffled
    once more to drop repeats.
    """
    key = ["size", "part", "segment"]
    # both sides of the join read the titles, so they are computed once
    side = (F.lit(None).cast("string") if apart is None else F.col(apart)).alias("side")
    every = titles.select("title", side).distinct().withColumn("size", F.length("title"))
    every = cut(every)
    if of is None:
        met = heavy_join(_indexed(every, eps), _probes(every, eps), key, "short", "long")
    else:
        some = every.join(of.select("title"), "title", "left_semi")
        some = cut(some)
        met = heavy_join(_indexed(every, eps), _probes(some, eps), key, "short", "long").unionByName(
            heavy_join(_indexed(some, eps), _probes(every, eps), key, "short", "long")
        )
    once = (F.length("long") > F.col("size")) | (F.col("short") < F.col("long"))
    if of is not None:
        once = F.lit(True)
    if apart is not None:
        once = once & ~F.col("short_side").eqNullSafe(F.col("long_side"))
    return (
        met.where(once & (F.col("short") != F.col("long")))
        .select(
            F.least("short", "long").alias("title_a"),
            F.greatest("short", "long").alias("title_b"),
            F.levenshtein("short", "long", eps).alias("distance"),
        )
        .where(F.col("distance") >= 0)
        .distinct()
    )


def both_ways(pairs: DataFrame) -> DataFrame:
    """(title, neighbour, distance) in both directions."""
    swap = F.array(
        F.struct(F.col("title_a").alias("title"), F.col("title_b").alias("neighbour")),
        F.struct(F.col("title_b").alias("title"), F.col("title_a").alias("neighbour")),
    )
    return pairs.select(F.inline(swap), "distance")
