"""Queries that once did a part of their job, on tables of the tests' own."""

from pyspark.sql import functions as F

from coterie.plans.catalog import ALL_QUERIES


def test_sample_of_ten_thousand(spark, tmp_path):
    ids = spark.range(12_000).withColumnRenamed("id", "doc_id")
    ids.write.parquet(str(tmp_path / "documents.parquet"))
    drawn = ALL_QUERIES["sample_fixed"].run(spark, str(tmp_path))
    order = ids.orderBy(F.md5(F.concat_ws(":", F.lit("459392"), "doc_id")), "doc_id")
    assert {r[0] for r in drawn.collect()} == {r[0] for r in order.limit(10_000).collect()}
    assert drawn.count() == 10_000


def test_histogram_of_every_support(spark, tmp_path):
    """Sets in one basket count too: a and b together, and c alone."""
    lines = [(1, 1), (1, 2), (2, 1), (3, 3)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint").write.parquet(str(tmp_path / "lineitem.parquet"))
    parts = [(1, "a"), (2, "b"), (3, "c")]
    spark.createDataFrame(parts, "p_partkey bigint, p_brand string").write.parquet(str(tmp_path / "part.parquet"))
    found = ALL_QUERIES["support_histogram"].run(spark, str(tmp_path)).collect()
    assert [tuple(row) for row in found] == [(1, 1, 2), (1, 2, 1), (2, 1, 1)]
