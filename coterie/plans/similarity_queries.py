"""Similar documents: the shingle, Jaccard, MinHash and banding operators over all documents."""

from pyspark.sql import functions as F

from coterie.operators import minhash, similarity
from coterie.operators.lineage import scratch_path
from coterie.plans.registry import Registry
from coterie.plans.tables import posts, table
from coterie.sources import lines

QUERIES = Registry()

PRINT_CUT = 0.02  # similarity above which the brute-force comparison lists a pair
CHARACTER_CUT = 0.8
GROUP_FOLDERS = 16


def md5_sql(value: str, digits: int = 8) -> str:
    return f"CAST('0x' || substr(md5({value}), 1, {digits}) AS BIGINT)"


def runs_sql(separator: str) -> str:
    """Every run of five tokens (or characters) of each document: (post_id, position, shingle)."""
    following = "".join(
        f" || '{separator}' || lead(unit, {i}) OVER in_order" for i in range(1, 5)
    )
    return f"""WITH units AS (
  SELECT doc_id AS post_id, unnest(string_split(text, '{separator}')) AS unit,
    generate_subscripts(string_split(text, '{separator}'), 1) AS i FROM documents),
runs AS MATERIALIZED (
  SELECT post_id, i - 1 AS position, shingle FROM (
    SELECT post_id, i, unit{following} AS shingle FROM units
    WINDOW in_order AS (PARTITION BY post_id ORDER BY i)) WHERE shingle IS NOT NULL)"""


# Distinct shingle hashes of each document, as a list.
SETS = f""",
sets AS MATERIALIZED (
  SELECT post_id, list(DISTINCT {md5_sql("shingle")}) AS shingles FROM runs GROUP BY post_id)"""
WORD_SETS = runs_sql(" ") + SETS
CHARACTER_SETS = runs_sql("") + SETS

# Classes of equal sets, and the similarity of all representatives that share a shingle.
PAIRS = """,
classes AS MATERIALIZED (
  SELECT min(post_id) AS rep, count(*) AS copies, list(post_id) AS members,
    any_value(shingles) AS shingles, any_value(len(shingles)) AS n
  FROM sets GROUP BY list_sort(shingles)),
tokens AS (SELECT rep, unnest(shingles) AS shingle FROM classes),
shared AS MATERIALIZED (
  SELECT a.rep AS post_a, b.rep AS post_b, count(*) AS n_common
  FROM tokens a JOIN tokens b ON a.shingle = b.shingle AND a.rep < b.rep GROUP BY ALL),
measured AS MATERIALIZED (
  SELECT post_a, post_b, n_common, a.n + b.n - n_common AS n_union,
    CAST(n_common AS DOUBLE) / (a.n + b.n - n_common) AS jaccard,
    a.copies AS copies_a, b.copies AS copies_b
  FROM shared JOIN classes a ON post_a = a.rep JOIN classes b ON post_b = b.rep),
ties AS (
  SELECT rep AS post_a, member AS post_b, 1.0::DOUBLE AS jaccard,
    copies AS copies_a, copies AS copies_b
  FROM (SELECT rep, copies, unnest(members) AS member FROM classes) WHERE member <> rep)"""

PAIR_COLUMNS = "post_a, post_b, round(jaccard, 9) AS jaccard, copies_a, copies_b"

WEIGHTED = (
    WORD_SETS
    + PAIRS
    + """,
weighted AS (
  SELECT jaccard, copies_a * copies_b AS n_pairs FROM measured
  UNION ALL SELECT 1.0, copies * (copies - 1) // 2 FROM classes WHERE copies > 1)"""
)

SIGNATURES = (
    WORD_SETS
    + f""",
tokens AS MATERIALIZED (SELECT post_id, unnest(shingles) AS shingle FROM sets),
universe AS MATERIALIZED (SELECT count(DISTINCT shingle) AS n FROM tokens),
hashed AS MATERIALIZED (
  SELECT post_id, ({minhash.FIRST_HASH[0]} * shingle + {minhash.FIRST_HASH[1]}) % n AS h1,
    ({minhash.SECOND_HASH[0]} * shingle + {minhash.SECOND_HASH[1]}) % n AS h2, n
  FROM tokens, universe),
signatures AS MATERIALIZED (
  SELECT post_id, CAST(i AS INTEGER) AS hash_no, min((h1 + i * h2) % n) AS minhash
  FROM hashed, range({minhash.HASH_FUNCTIONS}) t(i) GROUP BY ALL)"""
)


def banded_sql(n_buckets: int | None) -> str:
    reduced = "" if n_buckets is None else f" % {n_buckets}"
    values = "string_agg(CAST(minhash AS VARCHAR), ',' ORDER BY hash_no)"
    return (
        SIGNATURES
        + f""",
members AS MATERIALIZED (
  SELECT post_id, band, {md5_sql(values, 15)}{reduced} AS bucket
  FROM (SELECT *, CAST(CASE WHEN hash_no < 28 THEN hash_no // 7
                       ELSE 4 + (hash_no - 28) // 6 END AS INTEGER) AS band FROM signatures)
  GROUP BY post_id, band)"""
    )


def groups_sql(n_buckets: int | None) -> str:
    return (
        banded_sql(n_buckets)
        + f""",
buckets AS (
  SELECT band, bucket, count(*) AS n_members, list(post_id ORDER BY post_id) AS posts
  FROM members GROUP BY band, bucket HAVING count(*) > 1),
groups AS MATERIALIZED (
  SELECT min({{'band': band, 'bucket': bucket}}) AS first, count(*) AS n_bands,
    any_value(n_members) AS n_members, posts
  FROM buckets GROUP BY posts HAVING count(*) / {minhash.BANDS} >= {minhash.THRESHOLD}),
candidates AS MATERIALIZED (
  SELECT first.band AS band, first.bucket AS bucket, n_bands, n_members,
    unnest(posts) AS post_id FROM groups)"""
    )


def long_posts(spark, sf_dir):
    return similarity.min_tokens(posts(spark, sf_dir))


def word_sets(spark, sf_dir):
    return similarity.word_shingle_sets(posts(spark, sf_dir))


def kept_sets(spark, sf_dir):
    """The shingle sets written once, for queries that pass over them more than once."""
    return minhash.cut(word_sets(spark, sf_dir))


def rounded(pairs):
    return pairs.withColumn("jaccard", F.round("jaccard", 9))


@QUERIES.add(
    "filter_min_tokens",
    """SELECT doc_id AS post_id, len(string_split(text, ' ')) AS n_tokens
FROM documents WHERE len(string_split(text, ' ')) >= 5""",
)
def filter_min_tokens(spark, sf_dir):
    return long_posts(spark, sf_dir).select(
        "post_id", F.size(F.split("body", " ")).alias("n_tokens")
    )


@QUERIES.add("word_shingles", runs_sql(" ") + " SELECT post_id, position, shingle FROM runs")
def word_shingles(spark, sf_dir):
    return similarity.word_shingles(posts(spark, sf_dir))


@QUERIES.add("char_shingles", runs_sql("") + " SELECT post_id, position, shingle FROM runs")
def char_shingles(spark, sf_dir):
    return similarity.character_shingles(posts(spark, sf_dir))


@QUERIES.add("hashed_shingles", WORD_SETS + " SELECT post_id, unnest(shingles) AS shingle FROM sets")
def hashed_shingles(spark, sf_dir):
    return similarity.hashed_shingles(word_sets(spark, sf_dir))


@QUERIES.add(
    "shingle_universe",
    WORD_SETS
    + """, tokens AS (SELECT post_id, unnest(shingles) AS shingle FROM sets)
SELECT (SELECT count(*) FROM sets) AS n_posts, count(*) AS n_rows,
  count(DISTINCT shingle) AS n_distinct FROM tokens""",
)
def shingle_universe(spark, sf_dir):
    return similarity.shingle_universe(word_sets(spark, sf_dir))


@QUERIES.add(
    "characteristic_matrix",
    WORD_SETS
    + """, tokens AS (SELECT post_id, unnest(shingles) AS shingle FROM sets)
SELECT post_id, dense_rank() OVER (ORDER BY shingle) - 1 AS shingle_idx FROM tokens""",
)
def characteristic_matrix(spark, sf_dir):
    return similarity.characteristic_matrix(word_sets(spark, sf_dir))


@QUERIES.add(
    "jaccard_similar_pairs",
    WORD_SETS
    + PAIRS
    + f""" SELECT {PAIR_COLUMNS} FROM measured WHERE jaccard > {PRINT_CUT}
UNION ALL SELECT {PAIR_COLUMNS} FROM ties""",
)
def jaccard_similar_pairs(spark, sf_dir):
    found = similarity.similar_pairs(word_sets(spark, sf_dir), PRINT_CUT, strict=True)
    return rounded(found.rows())


@QUERIES.add(
    "set_overlap",
    WORD_SETS
    + PAIRS
    + f""" SELECT post_a, post_b, n_common, n_union FROM measured
WHERE jaccard >= {minhash.THRESHOLD}""",
)
def set_overlap(spark, sf_dir):
    found = similarity.similar_pairs(word_sets(spark, sf_dir), minhash.THRESHOLD)
    return found.pairs.select("post_a", "post_b", "n_common", "n_union")


@QUERIES.add(
    "jaccard_allpairs_ordered",
    CHARACTER_SETS
    + PAIRS
    + f""", listed AS (
  SELECT * FROM (SELECT post_a, post_b, jaccard FROM measured WHERE jaccard >= {CHARACTER_CUT})
  UNION ALL SELECT post_a, post_b, jaccard FROM ties)
SELECT post_a, post_b, round(jaccard, 9) AS jaccard FROM listed
UNION ALL SELECT post_b, post_a, round(jaccard, 9) FROM listed""",
)
def jaccard_allpairs_ordered(spark, sf_dir):
    """Character shingles, each pair in both directions."""
    sets = similarity.character_shingle_sets(posts(spark, sf_dir))
    found = rounded(similarity.similar_pairs(sets, CHARACTER_CUT).rows())
    both = F.array(
        F.struct(F.col("post_a"), F.col("post_b")),
        F.struct(F.col("post_b").alias("post_a"), F.col("post_a").alias("post_b")),
    )
    return found.select("jaccard", F.inline(both))


@QUERIES.add(
    "similarity_histogram",
    WEIGHTED
    + """, ends AS (SELECT min(jaccard) AS low, max(jaccard) AS high FROM weighted)
SELECT CAST(least(floor((jaccard - low) / (high - low) * 50), 49) AS INTEGER) AS bin,
  sum(n_pairs) AS n_pairs
FROM weighted, ends GROUP BY ALL""",
)
def similarity_histogram(spark, sf_dir):
    """Every pair of documents that share a shingle, in 50 bins of similarity."""
    found = minhash.cut(similarity.similarity_spectrum(word_sets(spark, sf_dir)))
    return similarity.similarity_histogram(found)


@QUERIES.add("minhash_signatures", SIGNATURES + " SELECT post_id, hash_no, minhash FROM signatures")
def minhash_signatures(spark, sf_dir):
    return minhash.signature_rows(minhash.minhash_signatures(kept_sets(spark, sf_dir)))


@QUERIES.add(
    "lsh_band_buckets",
    banded_sql(minhash.BUCKETS) + " SELECT post_id, band, bucket FROM members",
)
def lsh_band_buckets(spark, sf_dir):
    signatures = minhash.minhash_signatures(kept_sets(spark, sf_dir))
    return minhash.band_buckets(signatures, n_buckets=minhash.BUCKETS)


@QUERIES.add(
    "lsh_bucket_groups",
    banded_sql(minhash.BUCKETS)
    + """ SELECT band, bucket, count(*) OVER (PARTITION BY band, bucket) AS n_members, post_id
FROM members QUALIFY n_members > 1""",
)
def lsh_bucket_groups(spark, sf_dir):
    signatures = minhash.minhash_signatures(kept_sets(spark, sf_dir))
    members = minhash.band_buckets(signatures, n_buckets=minhash.BUCKETS)
    return minhash.bucket_groups(minhash.cut(members))


@QUERIES.add(
    "lsh_candidate_groups",
    groups_sql(minhash.BUCKETS)
    + " SELECT band, bucket, n_bands, n_members, post_id FROM candidates",
)
def lsh_candidate_groups(spark, sf_dir):
    return minhash.near_duplicate_groups(kept_sets(spark, sf_dir), n_buckets=minhash.BUCKETS)


@QUERIES.add(
    "near_duplicate_documents",
    groups_sql(None) + " SELECT band, bucket, n_bands, n_members, post_id FROM candidates",
)
def near_duplicate_documents(spark, sf_dir):
    """The whole chain with unreduced band hashes, so that only equal bands meet."""
    return minhash.near_duplicate_groups(kept_sets(spark, sf_dir))


@QUERIES.add(
    "lsh_candidate_pairs",
    banded_sql(minhash.BUCKETS)
    + f""",
classes AS MATERIALIZED (
  SELECT min(post_id) AS rep, count(*) AS copies, list(post_id) AS posts FROM (
    SELECT post_id, list(bucket ORDER BY band) AS buckets FROM members GROUP BY post_id)
  GROUP BY buckets),
placed AS (SELECT rep, copies, band, bucket FROM classes JOIN members ON post_id = rep)
SELECT a.rep AS post_a, b.rep AS post_b, CAST(count(*) AS INTEGER) AS n_bands,
  any_value(a.copies) AS copies_a, any_value(b.copies) AS copies_b
FROM placed a JOIN placed b ON a.band = b.band AND a.bucket = b.bucket AND a.rep < b.rep
GROUP BY a.rep, b.rep HAVING count(*) / {minhash.BANDS} >= {minhash.THRESHOLD}
UNION ALL
SELECT rep, post_id, {minhash.BANDS}, copies, copies
FROM (SELECT rep, copies, unnest(posts) AS post_id FROM classes) WHERE post_id <> rep""",
)
def lsh_candidate_pairs(spark, sf_dir):
    """Pairs that share enough bands, between classes of equal bands, and who is in each class."""
    signatures = minhash.minhash_signatures(kept_sets(spark, sf_dir))
    members = minhash.band_buckets(signatures, n_buckets=minhash.BUCKETS)
    return minhash.candidate_pairs(members).rows()


@QUERIES.add(
    "lsh_verified_pairs",
    groups_sql(None).replace("tokens AS", "post_tokens AS").replace("FROM tokens", "FROM post_tokens")
    + PAIRS.replace("FROM sets GROUP", "FROM sets SEMI JOIN candidates USING (post_id) GROUP")
    + f""" SELECT {PAIR_COLUMNS} FROM measured WHERE jaccard >= {minhash.THRESHOLD}
  AND EXISTS (SELECT 1 FROM candidates a JOIN candidates b USING (band, bucket)
              WHERE a.post_id = post_a AND b.post_id = post_b)
UNION ALL SELECT {PAIR_COLUMNS} FROM ties""",
)
def lsh_verified_pairs(spark, sf_dir):
    sets = kept_sets(spark, sf_dir)
    found = minhash.verified_pairs(sets, minhash.near_duplicate_groups(sets))
    return rounded(found.rows())


@QUERIES.add(
    "lsh_candidate_contents",
    groups_sql(None)
    + """ SELECT band, bucket, post_id, replace(text, chr(10), ' ') AS body,
  row_number() OVER (PARTITION BY band, bucket ORDER BY post_id) - 1 AS body_no
FROM candidates JOIN documents ON doc_id = post_id""",
)
def lsh_candidate_contents(spark, sf_dir):
    groups = minhash.near_duplicate_groups(kept_sets(spark, sf_dir))
    return minhash.group_contents(posts(spark, sf_dir), groups)


@QUERIES.add(
    "io_group_bodies_roundtrip",
    groups_sql(None)
    + """ SELECT band, bucket, replace(text, chr(10), ' ') AS body,
  row_number() OVER (PARTITION BY band, bucket ORDER BY post_id) - 1 AS body_no
FROM candidates JOIN documents ON doc_id = post_id""",
)
def io_group_bodies_roundtrip(spark, sf_dir):
    """Candidate bodies written to a folder for each group's hash and read again."""
    path = scratch_path(spark, "groups")
    groups = minhash.near_duplicate_groups(kept_sets(spark, sf_dir))
    contents = minhash.group_contents(posts(spark, sf_dir), groups)
    lines.write_group_contents(contents, path, GROUP_FOLDERS)
    return lines.read_group_contents(spark, path).select("band", "bucket", "body_no", "body")


@QUERIES.add(
    "lsh_band_plan",
    WEIGHTED
    + f""", steps AS (
  SELECT round(jaccard, 4) AS s, sum(n_pairs) AS n_pairs FROM weighted GROUP BY ALL),
settings AS (SELECT b, r FROM range(1, 101) x(b), range(1, 101) y(r) WHERE b * r <= 100),
each AS (SELECT b, r, s, n_pairs, n_pairs * (1 - pow(1 - pow(s, r), b)) AS found
  FROM steps, settings)
SELECT CAST(b AS INTEGER) AS b, CAST(r AS INTEGER) AS r,
  round(pow(1 / b, 1 / r), 6) AS curve_threshold,
  abs(pow(1 / b, 1 / r) - {minhash.THRESHOLD}) <= {minhash.PLAN_TOLERANCE} AS fits,
  round(sum(found) FILTER (s >= {minhash.THRESHOLD}) /
    sum(n_pairs) FILTER (s >= {minhash.THRESHOLD}), 6) AS expected_recall,
  round(sum(found) / sum(n_pairs), 6) AS expected_found
FROM each GROUP BY b, r""",
)
def lsh_band_plan(spark, sf_dir):
    return minhash.band_plan(similarity.similarity_spectrum(word_sets(spark, sf_dir)))


@QUERIES.add(
    "sample_fraction",
    f"""SELECT doc_id AS post_id FROM documents
WHERE {md5_sql("'459392:' || doc_id")} < 0.2 * 4294967296""",
)
def sample_fraction(spark, sf_dir):
    ids = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("post_id"))
    return similarity.sample_fraction(ids, "post_id", 0.2, seed=459392)


@QUERIES.add(
    "sample_fixed",
    """SELECT doc_id AS post_id FROM documents
ORDER BY md5('459392:' || doc_id), doc_id LIMIT 10000""",
)
def sample_fixed(spark, sf_dir):
    ids = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("post_id"))
    return similarity.sample_fixed(ids, "post_id", 10_000, seed=459392)
