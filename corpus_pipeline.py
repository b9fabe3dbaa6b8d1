"""A corpus from documents to shards: five stages, each written and read again by the next."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coterie.llm import decontamination, jaccard_join, mixing, quality_knn, sharding
from coterie.operators.lineage import cut
from coterie.plans.registry import Registry
from coterie.plans.tables import table

SHARDS = 16


def free_name(name: str, docs: DataFrame) -> str:
    """The name, behind as many underscores as no column of the documents has."""
    taken = {column.lower() for column in docs.columns}
    while name in taken:
        name = "_" + name
    return name


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier does not reject.

    Each row is judged by its text, null and empty ones too; repeated rows are judged alike and
    all stay or go. No rows give no rows.
    """
    own = free_name("_score", docs)
    scored = quality_knn.score_documents(
        docs.withColumnRenamed("score", own), table(spark, sf_dir, "labels")
    )
    kept = scored.where(F.col("score") >= quality_knn.THRESHOLD).drop("score")
    return kept.withColumnRenamed(own, "score").select(*docs.columns)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest doc_id.

    Rows that share a doc_id are one document, of which the smallest row stays; rows without
    doc_id are in no group and all stay.
    """
    grouped = jaccard_join.similar_components(docs)
    first = grouped.where(F.col("component_id") == F.col("doc_id")).select("doc_id").distinct()
    chosen = (
        docs.join(first, "doc_id", "left_semi")
        .groupBy("doc_id")
        .agg(F.min(F.struct(*docs.columns)).alias("_row"))
        .select("_row.*")
    )
    return chosen.unionByName(docs.where("doc_id IS NULL"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of which less than a twentieth is benchmark passages.

    Null and empty texts and texts of any length are judged whole; repeated rows are judged
    alike. No rows give no rows.
    """
    names = {name: f"_doc_{i}" for i, name in enumerate(docs.columns)}
    own = docs.select("doc_id", "text", *[F.col(n).alias(new) for n, new in names.items()])
    found = decontamination.contamination(
        own, table(spark, sf_dir, "benchmark"), kept=list(names.values())
    )
    return found.where(~F.col("contaminated")).select(
        *[F.col(new).alias(n) for n, new in names.items()]
    )


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources begins to take it; the rest goes.

    Rows that agree in id, source and text share what is taken of them. Rows without words add
    nothing to the mix and go. No rows give no rows.
    """
    key = F.xxhash64("text")
    names = ("_id", "_source", "_text", "_times", "_copy")
    own_id, own_source, own_text, times, copy = (free_name(name, docs) for name in names)
    taken = mixing.mix_sources(
        docs.select("doc_id", "source", "text", key.alias("_key")), kept=["source", "_key"]
    )
    share = taken.groupBy(
        F.col("doc_id").alias(own_id), F.col("source").alias(own_source), F.col("_key").alias(own_text)
    ).agg(F.ceil(F.try_divide(F.sum("taken"), F.sum("size"))).cast("int").alias(times))
    same = (
        F.col("doc_id").eqNullSafe(F.col(own_id))
        & F.col("source").eqNullSafe(F.col(own_source))
        & (key == F.col(own_text))
    )
    return (
        docs.join(share.where(F.col(times) > 0), same)
        .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times))))
        .select(*docs.columns)
    )


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard; copies of a document are in one shard, a null id counts as one.

    A column ``shard`` of the documents is replaced. No rows give no rows.
    """
    return docs.withColumn("shard", sharding.rendezvous_shard(F.col("doc_id"), [1.0] * SHARDS))


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram jaccard join", keep_one_of_similar),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources", mix),
    ("sharding", assign_shards),
]

# the classifier is trained; SQL cannot express it
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = Registry()
QUERIES.add("pipeline", ORACLE_SQL)(run)
