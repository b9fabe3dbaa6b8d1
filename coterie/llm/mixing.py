"""Mixing sources to target weights by distributed prefix sums over hash-random keys."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coterie.functions.hashing import md5_int
from coterie.operators.lineage import cut
from coterie.operators.skew import salted_join

WORD = r"[^\x20\x09-\x0D]+"
KEY_DIGITS = 15
KEY_RANGE = 1 << (4 * KEY_DIGITS)
BUCKET_ROWS = 50_000


def source_targets(
    totals: DataFrame, weights: Sequence[float], share: float, epochs: float
) -> DataFrame:
    """Add ``target`` to (source, source_size, ...): weighted shares of ``share`` x all sizes.

    Sources in code point order, null last, take the weights in turn. A target stops at
    ``epochs`` times its source's size and the excess goes to the others by weight until none is
    above: with sources ordered by (limit / weight), the first k are at their limit, where k is
    the first number for which the rest, sharing what is left, stay below theirs.
    One row per source: the windows run over source totals, never over documents.
    """
    ranked = totals.withColumn(
        "_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    )
    turn = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") - 1) % len(weights) + 1
    )
    everything = Window.partitionBy()
    by_limit = Window.orderBy("_ratio", "_rank")
    earlier = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    limited = (
        ranked.withColumn("_weight", turn)
        .withColumn("_limit", F.col("source_size") * F.lit(float(epochs)))
        .withColumn("_ratio", F.col("_limit") / F.col("_weight"))
        .withColumn("_budget", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("_full", F.coalesce(F.sum("_limit").over(earlier), F.lit(0.0)))
        .withColumn(
            "_open",
            F.sum("_weight").over(by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
        )
        .withColumn("_level", (F.col("_budget") - F.col("_full")) / F.col("_open"))
    )
    level = F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_level")))
    return (
        limited.withColumn("_at", level.over(everything)["_level"])
        .withColumn(
            "target",
            F.when(F.col("_at").isNull(), F.col("_limit")).otherwise(
                F.least(F.col("_limit"), F.col("_at") * F.col("_weight"))
            ),
        )
        .select(*totals.columns, "target")
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    epochs: float = 2.0,
    kept: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, ``kept`` columns, size, source_size, target, taken) for every row of ``docs``:
    ``taken`` is the words the mix takes of it.

    Each row has a hash-random key. A source's keys are cut into ranges of about ``BUCKET_ROWS``
    rows; rows are sorted within a range and the ranges' sums give each row the words before it
    in its source, so a source of any size spreads over many tasks. The source gives all its
    words as often as they fit its target, and in the last pass the rows up to the exact budget
    (the target without its fraction); the row on the cut gives what is left.

    Size counts words; a null or empty text has none and gives none. Null is a source of its own.
    Repeated rows count each. Rows that share a doc_id are ordered by size. No rows give no rows.
    """
    sized = cut(
        docs.select(
            "doc_id",
            "source",
            *[F.col(name).alias(f"_kept_{i}") for i, name in enumerate(kept)],
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
            md5_int(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), KEY_DIGITS)
            .alias("key"),
            # without nulls, so that it can be joined on
            F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")).alias("source_key"),
        )
    )
    totals = (
        sized.groupBy("source_key", "source")
        .agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    )
    targets = cut(source_targets(totals, weights, share, epochs)).drop("source")
    ranges = F.ceil(F.col("n_rows") / BUCKET_ROWS)
    placed = salted_join(sized, targets, ["source_key"], "doc_id").withColumn(
        "bucket", F.floor(F.col("key") / F.lit(float(KEY_RANGE)) * ranges)
    )
    sums = placed.groupBy("source_key", "bucket").agg(F.sum("size").alias("_words"))
    before = Window.partitionBy("source_key").orderBy("bucket")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        "source_key", "bucket", F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_offset")
    )
    within = Window.partitionBy("source_key", "bucket").orderBy("key", "doc_id", "size")
    within = within.rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("_within", F.coalesce(F.sum("size").over(within), F.lit(0)))
    budget = F.floor("target")
    passes = F.coalesce(F.floor(F.try_divide(budget, F.col("source_size"))), F.lit(0))
    rest = budget - passes * F.col("source_size") - F.col("_offset") - F.col("_within")
    taken = passes * F.col("size") + F.greatest(F.lit(0), F.least(rest, F.col("size")))
    return summed.join(sums, ["source_key", "bucket"]).select(
        "doc_id",
        *[F.col(f"_kept_{i}").alias(name) for i, name in enumerate(kept)],
        "size",
        "source_size",
        "target",
        taken.cast("bigint").alias("taken"),
    )
