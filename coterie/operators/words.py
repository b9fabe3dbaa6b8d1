"""Word counts of clusters."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coterie.functions.text import title_words

TOP_WORDS = 1000
HUE_CLUSTERS = 80


def cluster_word_counts(assigned: DataFrame, by: list[str]) -> DataFrame:
    """(group, cluster, word, cnt) over the titles of each cluster, occurrences counted."""
    words = assigned.select(
        *by, "cluster", "weight", F.explode(title_words(F.col("title"))).alias("word")
    )
    return words.groupBy(*by, "cluster", "word").agg(F.sum("weight").alias("cnt"))


def top_words(counts: DataFrame, by: list[str], n: int = TOP_WORDS) -> DataFrame:
    """The ``n`` most frequent words of each group with their rank and the cluster's hue."""
    order = Window.partitionBy(*by).orderBy(F.desc("cnt"), "word", "cluster")
    return (
        counts.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= n)
        .withColumn("hue", F.col("cluster") * F.lit(360.0) / F.lit(HUE_CLUSTERS))
    )


def merged_counts(counts: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The maps of all groups merged into one, in rising ``order``: the last entry of a key wins.

    ``counts`` has one ``cnt`` for each key and order. Returns the keys, ``cnt`` and the order it
    comes from. Entries are merged map-side, so a key of any number of groups is one row a task.
    """
    last = F.max(F.struct(order, "cnt")).alias("last")
    return counts.groupBy(*keys).agg(last).select(*keys, "last.cnt", f"last.{order}")
