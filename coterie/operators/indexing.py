"""Consecutive numbering without sending a whole table or a hot group to one task."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coterie.operators.lineage import cut

# monotonically_increasing_id keeps the row number inside a partition in its low 33 bits.
ROW_BITS = 33


def dense_index(df: DataFrame, order_by: list, name: str) -> DataFrame:
    """Add ``name`` = 0, 1, 2, ... in the order of ``order_by`` (which must be unique per row).

    Range partitioning sorts the table across all tasks; only one row per partition (its row
    count) is summed up to turn positions inside a partition into global ones.
    """
    placed = cut(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", ROW_BITS))
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    row = F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    # one row per partition of ``placed``: bounded by the partition count
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + row)
        .drop("_place", "_part", "_offset")
    )


def index_within(df: DataFrame, group_by: list[str], order_by: list, name: str) -> DataFrame:
    """Add ``name`` = 0, 1, 2, ... inside each group, also when one group holds most rows.

    A window function would sort a group in a single task. Here the table is numbered as a
    whole and the group's first number is subtracted.
    """
    numbered = cut(dense_index(df, [*group_by, *order_by], "_global"))
    first = numbered.groupBy(*group_by).agg(F.min("_global").alias("_first"))
    return (
        numbered.join(first, group_by)
        .withColumn(name, F.col("_global") - F.col("_first"))
        .drop("_global", "_first")
    )
