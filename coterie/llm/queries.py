"""One query per operator, over whole tables, and its SQL where SQL can express it."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coterie.llm import (
    collinear,
    cross_polytope,
    decontamination,
    jaccard_join,
    line_dedup,
    mixing,
    quality_knn,
    secret_scan,
    sharding,
    simhash,
    spelling,
    suffix_dedup,
    whitening,
)
from coterie.llm.sql import (
    DECONTAMINATION_SQL,
    JACCARD_JOIN_SQL,
    LINE_DEDUP_SQL,
    MIXING_SQL,
    SHARDING_SQL,
    SPELLING_SQL,
)
from coterie.plans.registry import Registry
from coterie.plans.tables import table

QUERIES = Registry()

SHARDS = 16


@QUERIES.add("op1_collinear_passages")
def op1_collinear_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of fifty words and more that an earlier document holds, exactly or nearly."""
    return collinear.repeated_passages(table(spark, sf_dir, "documents"))


@QUERIES.add("op2_decontamination", DECONTAMINATION_SQL)
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words inside passages of the benchmark."""
    documents = table(spark, sf_dir, "documents")
    found = decontamination.contamination(documents, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@QUERIES.add("op3_mix_sources", MIXING_SQL)
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of every document that a mix of weights 3, 1, 2 takes, at most two epochs."""
    return mixing.mix_sources(table(spark, sf_dir, "documents"), (3, 1, 2), 1.5, 2.0)


@QUERIES.add("op4_nearest_neighbours")
def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest found rows of every embedding whose id is divisible by 100."""
    vectors = cross_polytope.usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return cross_polytope.nearest(vectors, vectors.where("vec_id % 100 = 0"))


@QUERIES.add("op5_quality_classifier")
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality, learned from the labels that are not held out."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_knn.score_documents(documents, table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id",
        quality_knn.is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality_knn.THRESHOLD).cast("int").alias("predicted"),
    )


@QUERIES.add("op6_line_dedup", LINE_DEDUP_SQL)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier document holds."""
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@QUERIES.add("op7_sharding", SHARDING_SQL)
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of 16 equal ones, and where a 17th would move it."""
    documents = table(spark, sf_dir, "documents")
    return sharding.shard_documents(documents, [1.0] * SHARDS, [1.0] * (SHARDS + 1))


@QUERIES.add("op8_ngram_jaccard_join", JACCARD_JOIN_SQL)
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component under links of three quarters common shingles of five words."""
    return jaccard_join.similar_components(table(spark, sf_dir, "documents"))


@QUERIES.add("op9_suffix_dedup")
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 100-byte strings that start earlier."""
    removed = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    n_kept = F.octet_length("kept")
    return removed.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - n_kept).cast("bigint").alias("n_removed"),
        F.size("starts").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@QUERIES.add("op10_secret_scan")
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets: the patterns' findings, and those the network adds."""
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "learned")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


@QUERIES.add("op11_spelling_variants", SPELLING_SQL)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the corpus with the near word that is at least five times as frequent."""
    words = spelling.word_counts(table(spark, sf_dir, "documents"))
    return spelling.spelling_variants(words).select(
        "word", "form", "root", "n", "n_near", "form_n"
    )


@QUERIES.add("op12_simhash_near_dedup")
def op12_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's SimHash and the smallest document that links of three bits reach."""
    found = simhash.near_copies(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


@QUERIES.add("op13_embedding_whitening")
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding's first four whitened components."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
