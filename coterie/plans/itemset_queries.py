"""Which brands are ordered together: the itemset operators over order baskets."""

from pyspark.sql import functions as F

from coterie.functions.hashing import md5_int
from coterie.operators import itemsets as ops
from coterie.plans.registry import Registry
from coterie.plans.tables import ORDER_BRANDS_SQL, order_brands, order_parts

QUERIES = Registry()

PAIR_SUPPORT = 300
SET_SUPPORT = 50
BUCKETS = 1_500_000
BASKET_SIZES = [1, 2, 4, 8]
HEAD_ROWS = 35
START_THRESHOLD = 400

BASKETS = "WITH " + ORDER_BRANDS_SQL

# Supports of all itemsets as (k, itemset, support).
SUPPORTS = (
    "WITH RECURSIVE "
    + ORDER_BRANDS_SQL
    + """,
subsets AS (
  SELECT basket_id, item AS last, 1 AS k, item AS itemset FROM baskets
  UNION ALL
  SELECT s.basket_id, b.item, s.k + 1, s.itemset || ',' || b.item
  FROM subsets s JOIN baskets b ON s.basket_id = b.basket_id AND s.last < b.item),
supports AS (SELECT k, itemset, count(*) AS support FROM subsets GROUP BY k, itemset)"""
)


def kept_baskets(spark, sf_dir):
    """The baskets written once in compact form, since mining passes over them repeatedly."""
    return ops.cut(order_brands(spark, sf_dir))


def shown(itemsets):
    """Itemsets as comma-joined text."""
    return itemsets.withColumn("itemset", F.array_join("itemset", ","))


@QUERIES.add(
    "item_support", BASKETS + " SELECT item, count(*) AS support FROM baskets GROUP BY item"
)
def item_support(spark, sf_dir):
    return ops.item_support(order_brands(spark, sf_dir))


@QUERIES.add(
    "basket_pairs",
    BASKETS
    + """ SELECT a.basket_id, a.item AS item_a, b.item AS item_b
FROM baskets a JOIN baskets b ON a.basket_id = b.basket_id AND a.item < b.item""",
)
def basket_pairs(spark, sf_dir):
    return ops.basket_pairs(order_brands(spark, sf_dir))


@QUERIES.add(
    "basket_stats",
    """SELECT max(n) AS largest_basket, count(*) AS n_baskets, sum(n) AS n_items, """
    + ", ".join(f"count(*) FILTER (n > {size}) AS above_{size}" for size in BASKET_SIZES)
    + " FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey)",
)
def basket_stats(spark, sf_dir):
    return ops.basket_stats(order_parts(spark, sf_dir), BASKET_SIZES)


@QUERIES.add(
    "dedupe_baskets",
    """SELECT l_orderkey AS basket_id, l_partkey AS item, count(*) AS n_copies
FROM lineitem GROUP BY ALL""",
)
def dedupe_baskets(spark, sf_dir):
    return ops.dedupe_baskets(order_parts(spark, sf_dir))


@QUERIES.add(
    "head_baskets",
    BASKETS
    + f""" SELECT basket_id, item, count(*) OVER (PARTITION BY basket_id) AS n_items FROM baskets
WHERE basket_id IN (SELECT DISTINCT basket_id FROM baskets ORDER BY 1 LIMIT {HEAD_ROWS})""",
)
def head_baskets(spark, sf_dir):
    return ops.head_baskets(order_brands(spark, sf_dir), HEAD_ROWS)


@QUERIES.add(
    "pcy_bucket_counts",
    BASKETS
    + f""" SELECT CAST('0x' || substr(md5(a.item || ',' || b.item), 1, 8) AS BIGINT) % {BUCKETS}
  AS bucket, count(*) AS cnt
FROM baskets a JOIN baskets b ON a.basket_id = b.basket_id AND a.item < b.item
GROUP BY ALL""",
)
def pcy_bucket_counts(spark, sf_dir):
    return ops.bucket_counts(ops.basket_pairs(order_brands(spark, sf_dir)), portable_bucket())


def portable_bucket():
    return F.pmod(md5_int(F.concat_ws(",", "item_a", "item_b")), F.lit(BUCKETS))


@QUERIES.add(
    "pcy_pruning_stats",
    BASKETS
    + f""", pairs AS (
  SELECT a.item AS item_a, b.item AS item_b, count(*) AS support,
    CAST('0x' || substr(md5(a.item || ',' || b.item), 1, 8) AS BIGINT) % {BUCKETS} AS bucket
  FROM baskets a JOIN baskets b ON a.basket_id = b.basket_id AND a.item < b.item GROUP BY ALL),
buckets AS (SELECT bucket, sum(support) AS cnt FROM pairs GROUP BY bucket),
frequent AS (SELECT item FROM baskets GROUP BY item HAVING count(*) >= {PAIR_SUPPORT})
SELECT (SELECT count(*) * (count(*) - 1) // 2 FROM frequent) AS candidates_before,
  count(*) AS candidates_after, count(*) FILTER (support >= {PAIR_SUPPORT}) AS frequent_pairs
FROM pairs WHERE item_a IN (FROM frequent) AND item_b IN (FROM frequent)
  AND bucket IN (SELECT bucket FROM buckets WHERE cnt >= {PAIR_SUPPORT})""",
)
def pcy_pruning_stats(spark, sf_dir):
    baskets = kept_baskets(spark, sf_dir)
    return ops.pcy_candidate_counts(baskets, PAIR_SUPPORT, portable_bucket())


@QUERIES.add(
    "apriori_itemsets",
    SUPPORTS + f" SELECT k, itemset, support FROM supports WHERE support >= {SET_SUPPORT}",
)
def apriori_itemsets(spark, sf_dir):
    return shown(ops.frequent_itemsets(kept_baskets(spark, sf_dir), SET_SUPPORT))


@QUERIES.add(
    "pcy_pairs",
    SUPPORTS
    + f" SELECT k, itemset, support FROM supports WHERE k = 2 AND support >= {PAIR_SUPPORT}",
)
def pcy_pairs(spark, sf_dir):
    found = ops.frequent_itemsets(
        kept_baskets(spark, sf_dir), PAIR_SUPPORT, max_k=2, pruning=ops.BucketPruning(BUCKETS)
    )
    return shown(found.where("k = 2"))


@QUERIES.add(
    "pcy_multilevel_triples",
    SUPPORTS
    + f" SELECT k, itemset, support FROM supports WHERE k = 3 AND support >= {SET_SUPPORT}",
)
def pcy_multilevel_triples(spark, sf_dir):
    pruning = ops.BucketPruning(5_000_000_000, levels=(2, 3))
    found = ops.frequent_itemsets(
        kept_baskets(spark, sf_dir), SET_SUPPORT, max_k=3, pruning=pruning
    )
    return shown(found.where("k = 3"))


@QUERIES.add(
    "adaptive_threshold_trace",
    SUPPORTS
    + f""", thresholds AS (
  SELECT * FROM (WITH RECURSIVE t(round, threshold) AS (
    SELECT 1, {START_THRESHOLD}
    UNION ALL
    SELECT round + 1, CAST(floor(threshold - threshold / 4) AS INTEGER) FROM t
    WHERE threshold > 1) SELECT * FROM t)),
stop AS (
  SELECT coalesce(min(round), (SELECT max(round) FROM thresholds)) AS round FROM thresholds
  WHERE threshold <= (SELECT max(support) FROM supports WHERE k = 3))
SELECT round, threshold, k, count(*) AS n_sets
FROM thresholds JOIN supports ON support >= threshold AND k <= 3
WHERE round <= (SELECT round FROM stop) GROUP BY ALL""",
)
def adaptive_threshold_trace(spark, sf_dir):
    baskets = kept_baskets(spark, sf_dir)
    trace = ops.adaptive_threshold(baskets, START_THRESHOLD, target_k=3)[1]
    return spark.createDataFrame(trace, "round int, threshold int, k int, n_sets bigint")


@QUERIES.add(
    "support_histogram",
    SUPPORTS
    + """ SELECT k, support, count(*) AS n_itemsets FROM supports
WHERE support >= 1 GROUP BY ALL""",
)
def support_histogram(spark, sf_dir):
    """Every set of items that some basket holds."""
    found = ops.frequent_itemsets(kept_baskets(spark, sf_dir), 1)
    return ops.support_histogram(found).orderBy("k", "support")


@QUERIES.add(
    "max_frequency_sets",
    SUPPORTS
    + f""" SELECT k, itemset, support FROM supports WHERE support >= {SET_SUPPORT}
QUALIFY rank() OVER (PARTITION BY k ORDER BY support DESC) = 1""",
)
def max_frequency_sets(spark, sf_dir):
    found = ops.frequent_itemsets(kept_baskets(spark, sf_dir), SET_SUPPORT)
    return shown(ops.max_frequency_sets(found))


@QUERIES.add(
    "best_itemset_per_k",
    SUPPORTS
    + f""" SELECT k, itemset, support FROM supports WHERE support >= {SET_SUPPORT}
QUALIFY row_number() OVER (PARTITION BY k ORDER BY support DESC, string_split(itemset, ',')) = 1""",
)
def best_itemset_per_k(spark, sf_dir):
    found = ops.frequent_itemsets(kept_baskets(spark, sf_dir), SET_SUPPORT)
    return shown(ops.best_itemset_per_size(found))


@QUERIES.add(
    "maximal_itemsets",
    SUPPORTS
    + f""", frequent AS (
  SELECT k, itemset, support, string_split(itemset, ',') AS items FROM supports
  WHERE support >= {SET_SUPPORT})
SELECT k, itemset, support FROM frequent f WHERE NOT EXISTS (
  SELECT 1 FROM frequent g WHERE g.k = f.k + 1 AND list_has_all(g.items, f.items))""",
)
def maximal_itemsets(spark, sf_dir):
    return shown(ops.maximal_itemsets(kept_baskets(spark, sf_dir), SET_SUPPORT))


@QUERIES.add(
    "fpgrowth_itemsets",
    SUPPORTS + f" SELECT k, itemset, support FROM supports WHERE support > {SET_SUPPORT}",
)
def fpgrowth_itemsets(spark, sf_dir):
    return shown(ops.fpgrowth_itemsets(kept_baskets(spark, sf_dir), SET_SUPPORT, strict=True))


@QUERIES.add(
    "verify_itemset_counts",
    SUPPORTS
    + f""" SELECT k, itemset, support, support AS counted FROM supports WHERE support >= {SET_SUPPORT}
QUALIFY row_number() OVER (PARTITION BY k ORDER BY support DESC, string_split(itemset, ',')) = 1""",
)
def verify_itemset_counts(spark, sf_dir):
    baskets = kept_baskets(spark, sf_dir)
    chosen = ops.best_itemset_per_size(ops.fpgrowth_itemsets(baskets, SET_SUPPORT))
    counted = ops.containment_counts(baskets, chosen).withColumnRenamed("support", "counted")
    return shown(chosen.join(counted, "itemset").select("k", "itemset", "support", "counted"))


@QUERIES.add(
    "itemset_containment_count",
    SUPPORTS
    + f""", links AS MATERIALIZED (
  SELECT string_split(itemset, ',')[1] AS a, string_split(itemset, ',')[2] AS b
  FROM supports WHERE k = 2 AND support >= {PAIR_SUPPORT}),
triples AS (
  SELECT ab.a || ',' || ab.b || ',' || ac.b AS itemset
  FROM links ab JOIN links ac ON ab.a = ac.a AND ab.b < ac.b
  JOIN links bc ON bc.a = ab.b AND bc.b = ac.b)
SELECT itemset, coalesce(support, 0) AS support
FROM triples LEFT JOIN (SELECT itemset, support FROM supports WHERE k = 3) USING (itemset)""",
)
def itemset_containment_count(spark, sf_dir):
    """Triples all of whose pairs are frequent, counted against the baskets, zero included."""
    baskets = kept_baskets(spark, sf_dir)
    pairs = ops.frequent_itemsets(baskets, PAIR_SUPPORT, max_k=2).where("k = 2")
    links = pairs.select(F.col("itemset")[0].alias("a"), F.col("itemset")[1].alias("b"))
    ab = links
    ac = links.select("a", F.col("b").alias("c"))
    bc = links.select(F.col("a").alias("b"), F.col("b").alias("c"))
    triples = ab.join(ac, "a").where("b < c").join(bc, ["b", "c"])
    counted = ops.containment_counts(baskets, triples.select(F.array("a", "b", "c").alias("itemset")))
    return shown(counted)


@QUERIES.add(
    "frequency_ordered_baskets",
    BASKETS
    + f""", frequent AS (
  SELECT item, count(*) AS support FROM baskets GROUP BY item HAVING count(*) > {PAIR_SUPPORT})
SELECT basket_id, item, support,
  row_number() OVER (PARTITION BY basket_id ORDER BY support DESC, item) - 1 AS position
FROM baskets JOIN frequent USING (item)""",
)
def frequency_ordered_baskets(spark, sf_dir):
    baskets = kept_baskets(spark, sf_dir)
    return ops.frequency_ordered_baskets(baskets, PAIR_SUPPORT, strict=True)
