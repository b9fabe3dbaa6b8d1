"""Line formats: ``a#b#c`` baskets, ``title#year``, ``id#type#body`` posts and cluster reports.

None of the formats escapes its delimiter, so writers refuse values that contain it.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIELD = "#"
REPORT_FIELD = "§"
POST_END = "§§§"
TITLES_PER_LINE = 1000
# One basket is one line, so it must fit a row; larger baskets belong in Parquet.
MAX_LINE_ITEMS = 1_000_000


def _free_of(value: Column, *delimiters: str) -> Column:
    found = F.lit(False)
    for delimiter in (*delimiters, "\n"):
        found = found | F.contains(value, F.lit(delimiter))
    message = F.concat(F.lit("value contains a delimiter: "), value)
    return F.when(found, F.raise_error(message).cast("string")).otherwise(value)


def write_baskets(baskets: DataFrame, path: str) -> None:
    """(basket_id, item) rows as one ``#``-joined line per basket; baskets have no empty line."""
    sizes = baskets.groupBy("basket_id").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.agg(F.max("n")).first()[0]
    if largest is not None and largest > MAX_LINE_ITEMS:
        raise ValueError(f"a basket of {largest} items is too large for a line")
    items = F.sort_array(F.collect_list(_free_of(F.col("item"), FIELD)))
    lines = baskets.groupBy("basket_id").agg(F.array_join(items, FIELD).alias("value"))
    lines.select("value").where("value <> ''").write.text(path)


def read_baskets(spark: SparkSession, path: str) -> DataFrame:
    """(basket_id, item): items as they stand on the line, repeats included."""
    lines = spark.read.text(path).where("value <> ''")
    # numbered before the items are exploded, or each item would get a number of its own
    numbered = lines.select(F.monotonically_increasing_id().alias("basket_id"), "value")
    return numbered.select("basket_id", F.explode(F.split("value", FIELD)).alias("item"))


def write_titles(titles: DataFrame, path: str) -> None:
    """``title#year`` lines; titles without a year are left out."""
    dated = titles.where(F.col("year").isNotNull())
    title = _free_of(F.coalesce("title", F.lit("")))
    dated.select(F.concat_ws(FIELD, title, F.col("year").cast("string")).alias("value")).write.text(
        path
    )


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    """(title, year), split at the last ``#``; lines without a year are left out."""
    shape = r"^(.*)#(\d+)$"
    return (
        spark.read.text(path)
        .where(F.col("value").rlike(shape))
        .select(
            F.regexp_extract("value", shape, 1).alias("title"),
            F.regexp_extract("value", shape, 2).try_cast("int").alias("year"),
        )
        .where("year IS NOT NULL")
    )


def write_posts(posts: DataFrame, path: str) -> None:
    """(post_id, post_type, body) as ``id#type#body§§§`` lines."""
    # a NULL field is an empty one: left out, it would shift the fields after it
    fields = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("post_id", "post_type")]
    body = _free_of(F.coalesce("body", F.lit("")), FIELD, REPORT_FIELD)
    line = F.concat(F.concat_ws(FIELD, *fields, body), F.lit(POST_END))
    posts.select(line.alias("value")).write.text(path)


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    """(post_id, post_type, body) of ``id#type#body§§§`` lines."""
    fields = F.split(F.rtrim(F.col("value"), F.lit(REPORT_FIELD)), FIELD)
    return (
        spark.read.text(path)
        .where("value <> ''")
        .select(
            fields[0].alias("post_id"),
            F.get(fields, F.lit(1)).alias("post_type"),
            F.coalesce(F.get(fields, F.lit(2)), F.lit("")).alias("body"),
        )
    )


def write_cluster_reports(assigned: DataFrame, path: str, steps: int | None = None) -> None:
    """A folder per period: ``#`` header lines, then ``cluster§clustroid§title§title...``.

    ``assigned`` is (period_start, period_end, cluster, clustroid, title, weight). A cluster
    takes as many lines as it needs for about ``TITLES_PER_LINE`` titles each, so a line stays
    small whatever the cluster's size. A title is listed once per occurrence. ``steps`` is the
    number of steps the clustering took, for the header.
    """
    key = ["period_start", "cluster", "clustroid"]
    sizes = assigned.groupBy(*key).agg(
        F.ceil(F.sum("weight") / TITLES_PER_LINE).alias("n_lines")
    )
    # a frequent title is listed in parts, which may go to different lines
    last_part = F.floor((F.col("weight") - 1) / TITLES_PER_LINE).cast("int")
    parts = assigned.where("weight > 0").select(
        *key, "title", "weight", F.explode(F.sequence(F.lit(0), last_part)).alias("part")
    )
    left = F.col("weight") - F.col("part") * TITLES_PER_LINE
    # one row per cluster: bounded by the number of clustroids
    listed = parts.join(F.broadcast(sizes), key).select(
        *key,
        "title",
        F.least(left, F.lit(TITLES_PER_LINE)).cast("int").alias("times"),
        F.pmod(F.xxhash64("title", "part"), "n_lines").alias("line"),
    )
    title = _free_of(F.col("title"), REPORT_FIELD)
    members = listed.groupBy(*key, "line").agg(
        F.flatten(F.collect_list(F.array_repeat(title, F.col("times")))).alias("t")
    )
    lines = members.select(
        "period_start",
        F.concat_ws(REPORT_FIELD, F.col("cluster").cast("string"), "clustroid", "t").alias("value"),
    )
    headers = assigned.groupBy("period_start", "period_end").agg(
        F.max("cluster").alias("last"), F.sum("weight").alias("titles")
    )
    headers = headers.select(
        "period_start",
        F.inline(
            F.array(
                F.struct(F.concat(F.lit("# clusters: "), F.col("last") + 1).alias("value")),
                F.struct(
                    F.concat(
                        F.lit("# period: "), "period_start", F.lit("-"), "period_end"
                    ).alias("value")
                ),
                F.struct(F.concat(F.lit("# titles: "), "titles").alias("value")),
                *([] if steps is None else [F.struct(F.lit(f"# steps: {steps}").alias("value"))]),
            )
        ),
    )
    headers.unionByName(lines).write.partitionBy("period_start").text(path)


def read_cluster_reports(spark: SparkSession, path: str) -> DataFrame:
    """(period_start, cluster, clustroid, title) of all reports, a row per listed title."""
    parts = F.split("value", REPORT_FIELD)
    return (
        spark.read.text(path)
        .where("value <> '' AND NOT startswith(value, '#')")
        .select(
            "period_start",
            parts[0].cast("int").alias("cluster"),
            parts[1].alias("clustroid"),
            F.explode(F.slice(parts, 3, F.greatest(F.size(parts) - 2, F.lit(0)))).alias("title"),
        )
    )


def write_group_contents(contents: DataFrame, path: str, folders: int = 256) -> None:
    """The numbered bodies of candidate groups, group after group, in ``folders`` folders.

    ``contents`` is (band, bucket, body_no, body); a group's folder is a hash of its band and
    bucket. Rows are range-partitioned by group and number, so a group of any size is written by
    as many tasks as it needs.
    """
    order = ["folder", "band", "bucket", "body_no"]
    heading = F.format_string("Group %d/%d, Body %d:\n", "band", "bucket", "body_no")
    block = F.concat(heading, F.coalesce("body", F.lit("")), F.lit("\n"))
    folder = F.pmod(F.xxhash64("band", "bucket"), F.lit(folders)).cast("int")
    (
        contents.withColumn("folder", folder)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("folder", block.alias("value"))
        .write.partitionBy("folder")
        .text(path)
    )


GROUP_BLOCK = r"(?s)^\n*Group (\d+)/(\d+), Body (\d+):(?:\n(.*))?$"


def read_group_contents(spark: SparkSession, path: str) -> DataFrame:
    """(band, bucket, body_no, body) of all groups that ``write_group_contents`` has written."""
    blocks = spark.read.option("lineSep", "\n\n").text(path).where(F.col("value").rlike(GROUP_BLOCK))

    def part(number: int):
        return F.regexp_extract("value", GROUP_BLOCK, number)

    return blocks.select(
        part(1).cast("int").alias("band"),
        part(2).cast("bigint").alias("bucket"),
        part(3).cast("bigint").alias("body_no"),
        part(4).alias("body"),
    )
