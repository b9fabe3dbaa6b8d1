"""Joins that stay balanced when one key holds a large share of the rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16


def salted_join(
    large: DataFrame, unique: DataFrame, keys: list[str], spread_by: str, salts: int = SALTS
) -> DataFrame:
    """Inner join to a side that is unique on ``keys``; each key is spread over ``salts`` tasks.

    The rows of ``large`` are split by a hash of ``spread_by``, which is deterministic, so a
    recomputed task sends its rows to the same place. The unique side is repeated per salt. Spark's
    estimates leave the repeats out, so it would broadcast many times what the session allows; only
    a side that stays below the threshold with its repeats is broadcast, and then once.
    """
    if _estimated_bytes(unique) * salts <= _most_broadcast(unique):
        return large.join(F.broadcast(unique), keys)
    left = large.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt")
    right = unique.select("*", every_salt).hint("merge")
    return left.join(right, [*keys, "_salt"]).drop("_salt")


def _estimated_bytes(df: DataFrame) -> int:
    """Spark's estimate of a table's size, which for files is the size of the files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _most_broadcast(df: DataFrame) -> int:
    return df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def spread(df: DataFrame) -> DataFrame:
    """Repartition a scan that has fewer partitions than the session has cores.

    Small single-file inputs would otherwise run on one core; a large scan is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)
