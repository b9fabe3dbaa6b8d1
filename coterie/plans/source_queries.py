"""Round trips through the file layouts: tables written in a layout and read back."""

from pyspark.sql import functions as F

from coterie.functions.text import ENGLISH_STOP_WORDS, content_words
from coterie.operators.lineage import scratch_path
from coterie.plans.clustering_queries import CLUSTERED, PRODUCT_TITLES_SQL, cleaned_sql
from coterie.plans.clustering_queries import settled_titles
from coterie.plans.registry import Registry
from coterie.plans.tables import ORDER_BRANDS_SQL, order_brands, posts, product_titles, table
from coterie.sources import lines, xml

QUERIES = Registry()

URL_MARKS = ["/en", "/fr", "/de", "/es"]

# Baskets lose their id in a line format, so they are compared as counted item lists.
BASKET_LISTS = (
    "WITH "
    + ORDER_BRANDS_SQL
    + """, lists AS (
  SELECT basket_id, string_agg(item, ',' ORDER BY item) AS items FROM baskets GROUP BY basket_id)
SELECT items, count(*) AS n_baskets FROM lists GROUP BY items"""
)


def counted_lists(baskets):
    """Number of baskets per item list."""
    items = F.array_join(F.sort_array(F.collect_list("item")), ",").alias("items")
    per_basket = baskets.groupBy("basket_id").agg(items)
    return per_basket.groupBy("items").agg(F.count(F.lit(1)).alias("n_baskets"))


@QUERIES.add("io_basket_text_roundtrip", BASKET_LISTS.replace("p_brand", "replace(p_brand, '#', ' ')"))
def io_basket_text_roundtrip(spark, sf_dir):
    """Brands hold the format's delimiter, which the writer refuses, so it is replaced."""
    path = scratch_path(spark, "baskets")
    baskets = order_brands(spark, sf_dir).withColumn("item", F.translate("item", "#", " "))
    lines.write_baskets(baskets, path)
    return counted_lists(lines.read_baskets(spark, path))


@QUERIES.add(
    "io_title_year_roundtrip", "WITH " + PRODUCT_TITLES_SQL + " SELECT title, year FROM titles"
)
def io_title_year_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "titles")
    lines.write_titles(product_titles(spark, sf_dir), path)
    return lines.read_titles(spark, path)


@QUERIES.add(
    "io_post_text_roundtrip",
    f"""SELECT CAST(doc_id AS VARCHAR) AS post_id, '1' AS post_type, {cleaned_sql("text")} AS body
FROM documents""",
)
def io_post_text_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "posts")
    cleaned = F.array_join(content_words(F.col("body"), ENGLISH_STOP_WORDS), " ")
    written = posts(spark, sf_dir).select(
        F.col("post_id").cast("string").alias("post_id"),
        F.lit("1").alias("post_type"),
        cleaned.alias("body"),
    )
    lines.write_posts(written, path)
    return lines.read_posts(spark, path)


@QUERIES.add(
    "io_cluster_report_roundtrip",
    CLUSTERED
    + """ SELECT period_start, cluster, clustroid, title, weight AS n_listed FROM assigned""",
)
def io_cluster_report_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "reports")
    assigned, steps = settled_titles(spark, sf_dir)
    assigned = assigned.withColumn("period_end", F.col("period_start") + 10)
    lines.write_cluster_reports(assigned, path, steps)
    listed = lines.read_cluster_reports(spark, path)
    return listed.groupBy(*listed.columns).agg(F.count(F.lit(1)).alias("n_listed"))


@QUERIES.add("src_xml_baskets", BASKET_LISTS)
def src_xml_baskets(spark, sf_dir):
    """Order baskets as bibliography records of two types, read back by type."""
    path = scratch_path(spark, "records")
    baskets = order_brands(spark, sf_dir)
    records = baskets.groupBy("basket_id").agg(F.collect_list("item").alias("author"))
    records = records.select(F.col("basket_id").cast("string").alias("_key"), "author")
    for remainder, tag in enumerate(["article", "inproceedings"]):
        chosen = records.where(F.pmod(F.col("_key").cast("bigint"), F.lit(2)) == remainder)
        xml.write_records(chosen, f"{path}/{tag}", tag)
    read = xml.read_records(spark, f"{path}/*", ["article", "inproceedings"])
    return counted_lists(xml.record_baskets(read))


@QUERIES.add(
    "src_xml_titles",
    "WITH " + PRODUCT_TITLES_SQL + " SELECT title, year FROM titles WHERE year % 2 = 0",
)
def src_xml_titles(spark, sf_dir):
    """Titles as records that cite a wanted venue in the even years."""
    path = scratch_path(spark, "records")
    venue = F.when(F.col("year") % 2 == 0, F.lit("db/conf/vldb")).otherwise(F.lit("db/conf/other"))
    records = product_titles(spark, sf_dir).select(
        F.concat_ws("/", "title", "year").alias("_key"),
        "title",
        F.col("year").cast("string").alias("year"),
        venue.alias("cite"),
    )
    xml.write_records(records, path, "article")
    return xml.record_titles(xml.read_records(spark, path, ["article"]))


@QUERIES.add(
    "src_xml_posts",
    "SELECT CAST(doc_id AS VARCHAR) AS post_id, '1' AS post_type, text AS body FROM documents",
)
def src_xml_posts(spark, sf_dir):
    path = scratch_path(spark, "posts")
    written = posts(spark, sf_dir).withColumn("post_type", F.lit("1"))
    xml.write_xml_posts(written, path)
    return xml.read_xml_posts(spark, path)


@QUERIES.add(
    "filter_venue",
    "SELECT page_id, url FROM pages WHERE "
    + " OR ".join(f"contains(url, '{mark}')" for mark in URL_MARKS),
)
def filter_venue(spark, sf_dir):
    """Pages whose address holds one of the marks."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.where(xml.mentions(F.col("url"), URL_MARKS))
