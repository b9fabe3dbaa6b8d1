"""The fixture tables in the shapes the operators take."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coterie.operators.skew import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baskets: the distinct brands of each order, as (basket_id, item)."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return (
        lines.join(parts, lines.l_partkey == parts.p_partkey)
        .select(F.col("l_orderkey").alias("basket_id"), F.col("p_brand").alias("item"))
        .distinct()
    )


def order_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baskets with repeats: every (order, part) line as (basket_id, item)."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("basket_id"), F.col("l_partkey").alias("item")
    )


def product_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated titles: the distinct (part name and type, year of shipping)."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return (
        lines.join(parts, lines.l_partkey == parts.p_partkey)
        .select(
            F.concat_ws(" ", "p_name", "p_type").alias("title"),
            F.year("l_shipdate").alias("year"),
        )
        .distinct()
    )


def part_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct titles of all parts."""
    parts = table(spark, sf_dir, "part")
    return parts.select(F.concat_ws(" ", "p_name", "p_type").alias("title")).distinct()


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as (post_id, body)."""
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return documents.select(F.col("doc_id").alias("post_id"), F.col("text").alias("body"))


# The same shapes as SQL common table expressions.
ORDER_BRANDS_SQL = """baskets AS (
  SELECT DISTINCT l_orderkey AS basket_id, p_brand AS item
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

PRODUCT_TITLES_SQL = """titles AS (
  SELECT DISTINCT p_name || ' ' || p_type AS title, CAST(year(l_shipdate) AS INTEGER) AS year
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

PART_TITLES_SQL = """part_titles AS (
  SELECT DISTINCT p_name || ' ' || p_type AS title FROM part)"""
