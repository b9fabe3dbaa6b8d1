"""Assigning records to weighted shards by rendezvous hashing."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coterie.functions.hashing import md5_int
from coterie.operators.indexing import ROW_BITS
from coterie.operators.lineage import cut

HASH_DIGITS = 15
HASH_RANGE = float(1 << (4 * HASH_DIGITS))


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0, 1, ...) of a key: the one with the smallest -ln(u) / weight.

    ``u`` in (0, 1) is a hash of key and shard, so every shard wins its share of the weights, and
    adding a shard only moves the keys that the new shard wins. A null key counts as the text
    ``null``. Shards of weight 0 take nothing; at least one weight must be positive.
    """
    if not any(weight > 0 for weight in weights) or any(weight < 0 for weight in weights):
        raise ValueError("weights must not be negative, and one must be positive")
    name = F.coalesce(key.cast("string"), F.lit("null"))
    scores = []
    for shard, weight in enumerate(weights):
        if weight > 0:
            u = (md5_int(F.concat(name, F.lit(f"#{shard}")), HASH_DIGITS) + 0.5) / HASH_RANGE
            scores.append(
                F.struct((-F.log(u) / F.lit(float(weight))).alias("s"), F.lit(shard).alias("n"))
            )
    return (scores[0] if len(scores) == 1 else F.least(*scores))["n"]


def numbered_in_shards(df: DataFrame, shard: str, order_by: list, name: str) -> DataFrame:
    """Add ``name`` = 0, 1, 2, ... inside each shard, in the order of ``order_by``.

    The rows are range-sorted by shard and order, so a shard of any size spreads over many tasks.
    What is summed up over the parts is one row for each shard in each part: at most the number
    of parts plus the number of shards.
    """
    placed = cut(
        df.repartitionByRange(shard, *order_by)
        .sortWithinPartitions(shard, *order_by)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", ROW_BITS))
    )
    runs = placed.groupBy("_part", shard).agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    before = Window.partitionBy(shard).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "_part", shard, (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first"))
        .alias("_shift"),
    )
    return (
        placed.join(F.broadcast(runs), ["_part", shard])
        .withColumn(name, F.col("_place") + F.col("_shift"))
        .drop("_place", "_part", "_shift")
    )


def shard_documents(
    docs: DataFrame, weights: Sequence[float], more_weights: Sequence[float]
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs``.

    The key is ``doc_id`` alone; ``grown_shard`` is the shard under ``more_weights``, the weights
    with shards added at the end. ``slot`` numbers a shard's rows without gaps by doc_id, then
    size and checksum. A null text counts as no bytes; rows without doc_id share one key and come
    first in their shard; repeated rows get slots of their own; an empty table gives no rows.
    """
    if list(more_weights[: len(weights)]) != list(weights):
        raise ValueError("the grown weights must begin with the present ones")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous_shard(F.col("doc_id"), weights).alias("shard"),
        rendezvous_shard(F.col("doc_id"), more_weights).alias("grown_shard"),
    )
    order = [F.col("doc_id"), F.col("size"), F.col("text_crc32")]
    return numbered_in_shards(rows, "shard", order, "slot")
