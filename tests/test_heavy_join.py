"""The join of keys that are hot on both sides."""

from statistics import median

import pytest
from pyspark.sql import functions as F

from coterie.operators import heavy_join
from coterie.operators.edit_join import edit_distance_join


def sides(spark, n=6000, hot_share=0.9):
    """Two tables in which key ``hot`` has ``hot_share`` of all rows."""
    key = F.when(F.col("id") < n * hot_share, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 97))
    left = spark.range(n).select(key.alias("k"), F.lit(1).alias("part"), F.col("id").alias("a"))
    right = left.withColumnRenamed("a", "b")
    return left, right


def test_hot_key_spreads_over_tasks(spark):
    left, right = sides(spark)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = heavy_join.heavy_join(left, right, ["k", "part"], "a", "b")
        tasks = joined.groupBy(F.spark_partition_id()).count().collect()
        plain = left.join(right, ["k", "part"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sizes = [row["count"] for row in tasks]
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(sizes) <= 2 * median(sizes)
    assert max(row["count"] for row in plain) > 0.9 * sum(sizes)
    assert sum(sizes) == sum(row["count"] for row in plain)


@pytest.mark.parametrize("hot_share", [0.0, 0.5, 1.0])
def test_same_rows_as_a_plain_join(spark, hot_share):
    left, right = sides(spark, 1500, hot_share)
    left = left.unionByName(spark.createDataFrame([(None, 1, -1), ("only left", 1, -2)], left.schema))
    right = right.where("b % 3 = 0").unionByName(spark.createDataFrame([(None, 1, -1)], right.schema))
    digest = [F.count(F.lit(1)), F.bit_xor(F.xxhash64("k", "part", "a", "b"))]
    got = heavy_join.heavy_join(left, right, ["k", "part"], "a", "b")
    assert got.columns == left.join(right, ["k", "part"]).columns
    assert got.agg(*digest).first() == left.join(right, ["k", "part"]).agg(*digest).first()
    empty = heavy_join.heavy_join(left, right.limit(0), ["k", "part"], "a", "b")
    assert empty.count() == 0


def test_sketch_names_every_frequent_key(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 4 == 0, F.lit(1)).when(F.col("id") % 10 == 1, F.lit(2)).otherwise(F.col("id")).alias("k")
    )
    found, none = heavy_join.frequent_keys([rows, rows.limit(0)], ["k"], 16)
    counts = {r["h"]: r["n"] for r in rows.groupBy(F.xxhash64("k").alias("h")).agg(F.count("*").alias("n")).where("n > 1").collect()}
    assert found.n_rows == 30_000 and found.counts == counts and len(counts) == 2
    assert (none.n_rows, none.counts) == (0, {})


def test_edit_distance_join_of_one_hot_segment(spark):
    """Titles that all begin alike: one segment is in every title."""
    titles = sorted({f"common begin {i % 40:02d}{chr(97 + i % 26)}" for i in range(1200)})
    frame = spark.createDataFrame([(t,) for t in titles], "title string")
    got = {tuple(r) for r in edit_distance_join(frame, 2).collect()}

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            diagonal, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (x != y))
        return row[-1]

    sample = titles[::7]
    want = {(a, b, d) for a in sample for b in titles if a < b and (d := distance(a, b)) <= 2}
    assert {g for g in got if g[0] in set(sample)} == want
