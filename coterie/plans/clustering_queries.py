"""Titles and vectors: distances, clustering by period, word counts and text features."""

from pyspark.sql import functions as F

from coterie.functions.distance import insert_delete_distance, levenshtein
from coterie.functions.text import (
    ENGLISH_STOP_WORDS,
    STRIPPED_CHARACTERS,
    TITLE_STOP_WORDS,
    content_words,
    strip_markup,
)
from coterie.operators import clustroids, density, features, metric_join, words
from coterie.operators.edit_join import both_ways, edit_distance_join
from coterie.operators.graph import connected_components
from coterie.plans.registry import Registry
from coterie.plans.tables import (
    PART_TITLES_SQL,
    PRODUCT_TITLES_SQL,
    part_titles,
    posts,
    product_titles,
    table,
)

QUERIES = Registry()


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


ENGLISH = ", ".join(quoted(word) for word in ENGLISH_STOP_WORDS)


# Clusters wanted in the successive periods; later periods take the last one.
PERIOD_CLUSTERS = [50, 75, 50, 60, 30, 65, 50, 55, 65, 80, 80]
SWEEP = list(range(10, 200, 10))
SWEEP_YEARS = (1994, 2004)
# steps written out in SQL; the clusterings end when nothing moves, after 7 steps on the fixtures
SQL_STEPS = 10
EPS = 5
NEAREST = 10
MIN_SAMPLES = 3
CUT_HEIGHT = 3
# steps written out in SQL; exemplars come to rest earlier on the fixtures
SQL_MESSAGE_STEPS = 45
TIE_BREAK = 0.01
LINKAGE_PASSES = 6
TEXT_CLUSTERS = 20
# steps written out in SQL; the centres come to rest earlier on the fixtures
SQL_MEAN_STEPS = 80

TITLES = "WITH RECURSIVE " + PRODUCT_TITLES_SQL
PERIODS = (
    TITLES
    + """,
bounds AS (SELECT min(year) AS first_year, max(year) AS last_year FROM titles),
periods AS (
  SELECT CAST(start AS INTEGER) AS period_start, CAST(start + 10 AS INTEGER) AS period_end,
    row_number() OVER (ORDER BY start) AS i
  FROM (SELECT unnest(range(first_year, last_year + 1, 5)) AS start FROM bounds)),
counts AS (
  SELECT period_start, list_extract("""
    + f"{PERIOD_CLUSTERS}, CAST(least(i, {len(PERIOD_CLUSTERS)}) AS INTEGER)"
    + """) AS wanted FROM periods),
points AS MATERIALIZED (
  SELECT period_start, title, count(*) AS weight
  FROM titles JOIN periods ON year BETWEEN period_start AND period_end
  GROUP BY period_start, title)"""
)
SWEEP_POINTS = (
    TITLES
    + f""",
counts AS (SELECT unnest({SWEEP}) AS k, k AS wanted),
points AS MATERIALIZED (
  SELECT k, title, count(*) AS weight FROM titles, counts
  WHERE year BETWEEN {SWEEP_YEARS[0]} AND {SWEEP_YEARS[1]} GROUP BY k, title)"""
)


def clustering_sql(group: str, steps: int) -> str:
    """The clustering of ``points`` with its iterations written out; ``assigned`` is the last."""
    text = f""",
clustroids_1 AS MATERIALIZED (
  SELECT {group}, title, row_number() OVER w - 1 AS cluster FROM points JOIN counts USING ({group})
  WINDOW w AS (PARTITION BY {group} ORDER BY md5('{clustroids.SEED}:' || title), title)
  QUALIFY row_number() OVER w <= wanted)"""
    for step in range(1, steps + 1):
        text += f""",
assigned_{step} AS MATERIALIZED (
  SELECT p.{group}, p.title, p.weight, c.cluster, c.title AS clustroid,
    levenshtein(p.title, c.title) AS distance
  FROM points p JOIN clustroids_{step} c USING ({group})
  QUALIFY row_number() OVER (PARTITION BY p.{group}, p.title ORDER BY distance, c.cluster) = 1),
reach_{step} AS (
  SELECT a.{group}, a.cluster, a.title, max(levenshtein(a.title, b.title)) AS reach
  FROM assigned_{step} a JOIN assigned_{step} b USING ({group}, cluster) GROUP BY ALL),
clustroids_{step + 1} AS MATERIALIZED (
  SELECT {group}, title, row_number() OVER (PARTITION BY {group} ORDER BY cluster) - 1 AS cluster
  FROM (SELECT * FROM reach_{step} QUALIFY row_number() OVER (
    PARTITION BY {group}, cluster ORDER BY reach, title) = 1))"""
    return text + f", assigned AS (SELECT * FROM assigned_{steps})"


CLUSTERED = PERIODS + clustering_sql("period_start", SQL_STEPS)
WORD_COUNTS = (
    CLUSTERED
    + f""",
word_counts AS (
  SELECT period_start, cluster, word, sum(weight) AS cnt FROM (
    SELECT period_start, cluster, weight,
      lower(trim(unnest(string_split(title, ' ')), {quoted(STRIPPED_CHARACTERS)})) AS word
    FROM assigned)
  WHERE word <> '' AND NOT regexp_matches(word, '[0-9]')
    AND word NOT IN ({", ".join(quoted(word) for word in TITLE_STOP_WORDS)}) GROUP BY ALL)"""
)

# Part titles, their pairs within EPS and the transitive closure of a neighbour relation.
NEAR = (
    "WITH RECURSIVE "
    + PART_TITLES_SQL
    + """,
distances AS MATERIALIZED (
  SELECT a.title AS title, b.title AS neighbour, levenshtein(a.title, b.title) AS distance
  FROM part_titles a JOIN part_titles b ON a.title <> b.title)"""
)


def closure_sql(name: str, vertices: str, links: str) -> str:
    """``name``: (id, component), the smallest id reachable over the links (a, b)."""
    return f""",
{name}_reach AS (
  SELECT id, id AS reached FROM {vertices}
  UNION
  SELECT r.id, l.b FROM {name}_reach r JOIN {links} l ON r.reached = l.a),
{name} AS MATERIALIZED (SELECT id, min(reached) AS component FROM {name}_reach GROUP BY id)"""


def linkage_sql(passes: int) -> str:
    """Single linkage with its passes written out; passes after the last merge are empty."""
    text = NEAR + ", clusters_1 AS (SELECT title, title AS cluster FROM part_titles)"
    for i in range(1, passes + 1):
        text += f""",
outgoing_{i} AS MATERIALIZED (
  SELECT a.cluster, b.cluster AS nearest, distance
  FROM distances d JOIN clusters_{i} a ON d.title = a.title
  JOIN clusters_{i} b ON d.neighbour = b.title WHERE a.cluster <> b.cluster
  QUALIFY row_number() OVER (PARTITION BY a.cluster ORDER BY distance, b.cluster) = 1),
names_{i} AS (SELECT DISTINCT cluster AS id FROM clusters_{i}),
links_{i} AS (
  SELECT cluster AS a, nearest AS b FROM outgoing_{i}
  UNION SELECT nearest, cluster FROM outgoing_{i})"""
        text += closure_sql(f"merged_{i}", f"names_{i}", f"links_{i}")
        text += f""",
clusters_{i + 1} AS MATERIALIZED (
  SELECT title, component AS cluster FROM clusters_{i} JOIN merged_{i} ON cluster = id)"""
    return text + " UNION ALL ".join(
        f""" SELECT {i} AS pass, cluster, nearest, distance, component AS merged_into
FROM outgoing_{i} JOIN merged_{i} ON cluster = id"""
        for i in range(1, passes + 1)
    )


LISTED_WITHIN = f"""
listed AS (SELECT title, neighbour, CAST(-distance AS DOUBLE) AS s FROM distances
  WHERE distance <= {EPS})"""
LISTED_NEAREST = f"""
chosen AS MATERIALIZED (SELECT title, neighbour, distance FROM distances
  QUALIFY row_number() OVER (PARTITION BY title ORDER BY distance, neighbour) <= {NEAREST}),
listed AS MATERIALIZED (SELECT title, neighbour, CAST(-distance AS DOUBLE) AS s FROM (
  SELECT title, neighbour, distance FROM chosen
  UNION SELECT neighbour, title, distance FROM chosen))"""


def messages_sql(listed: str, steps: int) -> str:
    """Affinity propagation over the ``listed`` pairs with its steps written out."""
    text = (
        NEAR
        + f""",{listed},
messages_0 AS MATERIALIZED (
  SELECT title, neighbour, s, 0.0::DOUBLE AS r, 0.0::DOUBLE AS a FROM listed
  UNION ALL
  SELECT title, title, (SELECT median(s) FROM listed) - {TIE_BREAK} *
    CAST('0x' || substr(md5('{density.SEED}:' || title), 1, 8) AS BIGINT) / 4294967296.0, 0.0, 0.0
  FROM listed GROUP BY title)"""
    )
    for i in range(1, steps + 1):
        text += f""",
ranked_{i} AS (
  SELECT *, row_number() OVER (PARTITION BY title ORDER BY a + s DESC, neighbour) AS place
  FROM messages_{i - 1}),
rivals_{i} AS (
  SELECT title, max(a + s) FILTER (place = 1) AS top, max(a + s) FILTER (place > 1) AS second
  FROM ranked_{i} GROUP BY title),
responded_{i} AS MATERIALIZED (
  SELECT title, neighbour, s, a,
    0.5 * r + 0.5 * (s - CASE WHEN place = 1 THEN second ELSE top END) AS r
  FROM ranked_{i} JOIN rivals_{i} USING (title)),
support_{i} AS (
  SELECT neighbour, sum(CASE WHEN title <> neighbour THEN greatest(r, 0) ELSE 0 END) AS support,
    max(r) FILTER (title = neighbour) AS own FROM responded_{i} GROUP BY neighbour),
messages_{i} AS MATERIALIZED (
  SELECT title, neighbour, s, r, 0.5 * a + 0.5 * CASE WHEN title = neighbour THEN support
    ELSE least(0, own + support - greatest(r, 0)) END AS a
  FROM responded_{i} JOIN support_{i} USING (neighbour))"""
    return (
        text
        + f""",
exemplars AS (
  SELECT neighbour FROM messages_{steps} WHERE title = neighbour AND a + r > 0),
best AS (
  SELECT title, neighbour FROM messages_{steps} JOIN exemplars USING (neighbour)
  QUALIFY row_number() OVER (
    PARTITION BY title ORDER BY title <> neighbour, s DESC, neighbour) = 1)
SELECT title, coalesce(neighbour, title) AS exemplar
FROM part_titles LEFT JOIN best USING (title)"""
    )


def period_points(spark, sf_dir):
    periods = clustroids.sliding_periods(product_titles(spark, sf_dir))
    return clustroids.weighted_titles(periods, ["period_start"])


def period_counts(titles):
    """(period_start, clusters wanted) for all periods of the titles."""
    low, high = titles.agg(F.min("year"), F.max("year")).first()
    starts = range(low, high + 1, 5) if low is not None else []
    return [
        (start, PERIOD_CLUSTERS[min(i, len(PERIOD_CLUSTERS) - 1)]) for i, start in enumerate(starts)
    ]


def settled_titles(spark, sf_dir):
    """The clustered titles of all periods and the number of steps."""
    counts = period_counts(product_titles(spark, sf_dir))
    return clustroids.settle(period_points(spark, sf_dir), ["period_start"], counts)


def clustered_titles(spark, sf_dir):
    return settled_titles(spark, sf_dir)[0]


def first_assignment(spark, sf_dir):
    titles = product_titles(spark, sf_dir)
    points = clustroids.cut(period_points(spark, sf_dir))
    first = clustroids.initial_clustroids(points, ["period_start"], period_counts(titles))
    return clustroids.nearest_clustroid(points, first, ["period_start"])


@QUERIES.add(
    "filter_record_type",
    """SELECT p_partkey, p_type FROM part WHERE p_type IN ('ECONOMY', 'PROMO', 'STANDARD')""",
)
def filter_record_type(spark, sf_dir):
    """A whitelist on the type column of a record table."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return parts.where(F.col("p_type").isin("ECONOMY", "PROMO", "STANDARD"))


@QUERIES.add(
    "filter_period", TITLES + " SELECT title, year FROM titles WHERE year BETWEEN 1996 AND 1999"
)
def filter_period(spark, sf_dir):
    return clustroids.in_period(product_titles(spark, sf_dir), 1996, 1999)


@QUERIES.add(
    "year_bounds",
    PERIODS
    + """ SELECT period_start, min(year) AS min_year, max(year) AS max_year
FROM titles JOIN periods ON year BETWEEN period_start AND period_end GROUP BY period_start""",
)
def year_bounds(spark, sf_dir):
    periods = clustroids.sliding_periods(product_titles(spark, sf_dir))
    return clustroids.year_bounds(periods, ["period_start"])


@QUERIES.add(
    "sliding_periods",
    PERIODS
    + """ SELECT period_start, period_end, title, year
FROM titles JOIN periods ON year BETWEEN period_start AND period_end""",
)
def sliding_periods(spark, sf_dir):
    return clustroids.sliding_periods(product_titles(spark, sf_dir))


@QUERIES.add(
    "clustroid_init",
    PERIODS + clustering_sql("period_start", 1) + " SELECT period_start, cluster, title FROM clustroids_1",
)
def clustroid_init(spark, sf_dir):
    counts = period_counts(product_titles(spark, sf_dir))
    return clustroids.initial_clustroids(period_points(spark, sf_dir), ["period_start"], counts)


@QUERIES.add(
    "nearest_clustroid",
    PERIODS
    + clustering_sql("period_start", 1)
    + " SELECT period_start, title, weight, cluster, clustroid, distance FROM assigned_1",
)
def nearest_clustroid(spark, sf_dir):
    return first_assignment(spark, sf_dir)


@QUERIES.add(
    "clustroid_update",
    PERIODS
    + clustering_sql("period_start", 1)
    + " SELECT period_start, cluster, title FROM clustroids_2",
)
def clustroid_update(spark, sf_dir):
    assigned = clustroids.cut(first_assignment(spark, sf_dir))
    total = sum(wanted for _, wanted in period_counts(product_titles(spark, sf_dir)))
    return clustroids.update_clustroids(assigned, ["period_start"], total=total)


@QUERIES.add(
    "kclustroid_titles",
    CLUSTERED + " SELECT period_start, title, weight, cluster, clustroid, distance FROM assigned",
)
def kclustroid_titles(spark, sf_dir):
    return clustered_titles(spark, sf_dir)


@QUERIES.add(
    "cluster_members",
    CLUSTERED
    + """ SELECT period_start, cluster, clustroid, title, weight,
  sum(weight) OVER (PARTITION BY period_start, cluster) AS n_members FROM assigned""",
)
def cluster_members(spark, sf_dir):
    return clustroids.cluster_members(clustered_titles(spark, sf_dir), ["period_start"])


COST = """ SELECT {0}, round(avg(mean_distance), 6) AS cost FROM (
  SELECT {0}, sum(distance * weight) / sum(weight) AS mean_distance FROM assigned
  GROUP BY {0}, cluster) GROUP BY {0}"""


@QUERIES.add("cluster_cost", CLUSTERED + COST.format("period_start"))
def cluster_cost(spark, sf_dir):
    cost = clustroids.cluster_cost(clustered_titles(spark, sf_dir), ["period_start"])
    return cost.withColumn("cost", F.round("cost", 6))


@QUERIES.add("elbow_sweep", SWEEP_POINTS + clustering_sql("k", SQL_STEPS) + COST.format("k"))
def elbow_sweep(spark, sf_dir):
    titles = clustroids.in_period(product_titles(spark, sf_dir), *SWEEP_YEARS)
    return clustroids.elbow_sweep(titles, SWEEP).withColumn("cost", F.round("cost", 6))


@QUERIES.add(
    "cluster_word_counts", WORD_COUNTS + " SELECT period_start, cluster, word, cnt FROM word_counts"
)
def cluster_word_counts(spark, sf_dir):
    return words.cluster_word_counts(clustered_titles(spark, sf_dir), ["period_start"])


@QUERIES.add(
    "cluster_top_words",
    WORD_COUNTS
    + f""" SELECT period_start, cluster, word, cnt, cluster * 360.0 / 80 AS hue,
  row_number() OVER w AS rank FROM word_counts
WINDOW w AS (PARTITION BY period_start ORDER BY cnt DESC, word, cluster)
QUALIFY row_number() OVER w <= {words.TOP_WORDS}""",
)
def cluster_top_words(spark, sf_dir):
    counts = words.cluster_word_counts(clustered_titles(spark, sf_dir), ["period_start"])
    return words.top_words(counts, ["period_start"])


@QUERIES.add(
    "merged_word_counts",
    WORD_COUNTS
    + """ SELECT cluster, word, cnt, period_start FROM word_counts
QUALIFY row_number() OVER (PARTITION BY cluster, word ORDER BY period_start DESC) = 1""",
)
def merged_word_counts(spark, sf_dir):
    """The word counts of all periods as one map, where later periods replace earlier ones."""
    counts = words.cluster_word_counts(clustered_titles(spark, sf_dir), ["period_start"])
    return words.merged_counts(counts, ["cluster", "word"], "period_start")


TEXT_PAIRS = """ SELECT DISTINCT p_name || ' ' || p_type AS a, p_type || ' ' || p_brand AS b FROM part"""


def text_pairs(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    pairs = parts.select(
        F.concat_ws(" ", "p_name", "p_type").alias("a"),
        F.concat_ws(" ", "p_type", "p_brand").alias("b"),
    )
    return pairs.distinct()


@QUERIES.add(
    "levenshtein_pairs", f"SELECT a, b, levenshtein(a, b) AS distance FROM ({TEXT_PAIRS})"
)
def levenshtein_pairs(spark, sf_dir):
    return text_pairs(spark, sf_dir).select(
        "a", "b", levenshtein(F.col("a"), F.col("b")).alias("distance")
    )


@QUERIES.add(
    "lcs_distance_pairs",
    f"""WITH RECURSIVE pairs AS ({TEXT_PAIRS}),
cells AS (
  SELECT a, b, 0 AS i, list_transform(range(length(b) + 1), lambda j: 0) AS row FROM pairs
  UNION ALL
  SELECT a, b, i + 1, list_reduce(
    list_prepend([0], list_transform(range(1, length(b) + 1), lambda j: [j])),
    lambda built, j: list_append(built, CASE WHEN substr(b, j[1], 1) = substr(a, i + 1, 1)
      THEN row[j[1]] + 1 ELSE greatest(row[j[1] + 1], built[len(built)]) END))
  FROM cells WHERE i < length(a))
SELECT a, b, length(a) + length(b) - 2 * row[length(b) + 1] AS distance
FROM cells WHERE i = length(a)""",
)
def lcs_distance_pairs(spark, sf_dir):
    return text_pairs(spark, sf_dir).select(
        "a", "b", insert_delete_distance(F.col("a"), F.col("b")).alias("distance")
    )


@QUERIES.add(
    "levenshtein_eps_join",
    NEAR
    + f""" SELECT title AS title_a, neighbour AS title_b, distance FROM distances
WHERE title < neighbour AND distance <= {EPS}""",
)
def levenshtein_eps_join(spark, sf_dir):
    return edit_distance_join(part_titles(spark, sf_dir), EPS)


@QUERIES.add(
    "connected_components",
    NEAR
    + f""", vertices AS (SELECT title AS id FROM part_titles),
links AS (SELECT title AS a, neighbour AS b FROM distances WHERE distance <= {CUT_HEIGHT - 1})"""
    + closure_sql("components", "vertices", "links")
    + " SELECT id, component FROM components",
)
def components(spark, sf_dir):
    titles = part_titles(spark, sf_dir)
    pairs = edit_distance_join(titles, CUT_HEIGHT - 1)
    return connected_components(
        titles.select(F.col("title").alias("id")),
        pairs.select(F.col("title_a").alias("a"), F.col("title_b").alias("b")),
    )


DENSITY = (
    NEAR
    + f""", degrees AS MATERIALIZED (
  SELECT t.title, 1 + count(d.neighbour) AS n_neighbours
  FROM part_titles t LEFT JOIN distances d ON t.title = d.title AND d.distance <= {EPS}
  GROUP BY t.title),
core AS (SELECT title AS id FROM degrees WHERE n_neighbours >= {MIN_SAMPLES}),
links AS (
  SELECT title AS a, neighbour AS b FROM distances WHERE distance <= {EPS}
    AND title IN (FROM core) AND neighbour IN (FROM core))"""
    + closure_sql("components", "core", "links")
    + f""",
numbered AS (SELECT id, dense_rank() OVER (ORDER BY component) - 1 AS cluster FROM components),
labels AS (
  SELECT id AS title, cluster FROM numbered
  UNION ALL
  SELECT d.title, min(cluster) FROM distances d JOIN numbered n ON d.neighbour = n.id
  WHERE distance <= {EPS} AND d.title NOT IN (FROM core) GROUP BY d.title)
"""
)


@QUERIES.add(
    "dbscan_titles",
    DENSITY
    + f"""SELECT title, n_neighbours, n_neighbours >= {MIN_SAMPLES} AS is_core,
  coalesce(cluster, -1) AS cluster
FROM degrees LEFT JOIN labels USING (title)""",
)
def dbscan_titles(spark, sf_dir):
    points = part_titles(spark, sf_dir).withColumn("weight", F.lit(1))
    return density.dbscan(points, EPS, MIN_SAMPLES)


@QUERIES.add(
    "dbscan_labels",
    DENSITY
    + f"""SELECT title, n_neighbours >= {MIN_SAMPLES} AS is_core, coalesce(cluster, -1) AS cluster
FROM degrees LEFT JOIN labels USING (title)""",
)
def dbscan_labels(spark, sf_dir):
    """Labels only, by balls of dense places."""
    points = part_titles(spark, sf_dir).withColumn("weight", F.lit(1))
    return density.dbscan_labels(points, EPS, MIN_SAMPLES)


@QUERIES.add("single_linkage_merges", linkage_sql(LINKAGE_PASSES))
def single_linkage_merges(spark, sf_dir):
    return density.single_linkage_merges(part_titles(spark, sf_dir))


@QUERIES.add(
    "single_linkage_cut",
    NEAR
    + f""", vertices AS (SELECT title AS id FROM part_titles),
links AS (SELECT title AS a, neighbour AS b FROM distances WHERE distance <= {CUT_HEIGHT})"""
    + closure_sql("components", "vertices", "links")
    + " SELECT id AS title, component AS cluster FROM components",
)
def single_linkage_cut(spark, sf_dir):
    return density.single_linkage_cut(part_titles(spark, sf_dir), CUT_HEIGHT)


@QUERIES.add(
    "nearest_titles",
    NEAR
    + f""" SELECT title, neighbour, distance, row_number() OVER w AS rank FROM distances
WINDOW w AS (PARTITION BY title ORDER BY distance, neighbour)
QUALIFY row_number() OVER w <= {NEAREST}""",
)
def nearest_titles(spark, sf_dir):
    return metric_join.nearest_titles(part_titles(spark, sf_dir), NEAREST, levenshtein)


@QUERIES.add(
    "metric_range_pairs",
    NEAR
    + f""" SELECT title AS title_a, neighbour AS title_b, distance FROM distances
WHERE distance <= {EPS} AND title < neighbour""",
)
def metric_range_pairs(spark, sf_dir):
    """The pairs of ``levenshtein_eps_join`` by pivots, which serve any metric."""
    return metric_join.metric_pairs(part_titles(spark, sf_dir), EPS, levenshtein)


@QUERIES.add("affinity_propagation", messages_sql(LISTED_WITHIN, SQL_MESSAGE_STEPS))
def affinity_propagation(spark, sf_dir):
    titles = part_titles(spark, sf_dir)
    pairs = both_ways(edit_distance_join(titles, EPS))
    listed = pairs.select("title", "neighbour", (-F.col("distance")).alias("similarity"))
    return density.affinity_propagation(titles, density.cut(listed), tie_break=TIE_BREAK)


@QUERIES.add("affinity_propagation_nearest", messages_sql(LISTED_NEAREST, SQL_MESSAGE_STEPS))
def affinity_propagation_nearest(spark, sf_dir):
    """Every title lists its nearest titles, however far they are, and those that list it."""
    titles = part_titles(spark, sf_dir)
    nearest = metric_join.nearest_titles(titles, NEAREST, levenshtein)
    listed = density.cut(density.mutual_similarities(nearest))
    return density.affinity_propagation(titles, listed, tie_break=TIE_BREAK)


TFIDF = f"""WITH terms AS (
  SELECT doc_id AS post_id, term, count(*) AS tf FROM (
    SELECT doc_id, unnest(regexp_extract_all(lower(text), '([\\p{{L}}\\p{{N}}_]{{2,}})', 1)) AS term
    FROM documents)
  WHERE term NOT IN ({ENGLISH}) GROUP BY ALL),
listed AS (
  SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf FROM terms
  GROUP BY term HAVING count(*) <= 15 ORDER BY sum(tf) DESC, term LIMIT 10),
raw AS (SELECT post_id, term, tf * idf AS raw FROM terms JOIN listed USING (term))
SELECT post_id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY post_id)), 6) AS tfidf
FROM raw"""


def document_tfidf(spark, sf_dir):
    return features.tfidf(posts(spark, sf_dir), ENGLISH_STOP_WORDS)


@QUERIES.add("tfidf_features", TFIDF)
def tfidf_features(spark, sf_dir):
    return document_tfidf(spark, sf_dir).withColumn("tfidf", F.round("tfidf", 6))


def even_sql(text: str) -> str:
    """A number between 0 and 1 that the first 32 bits of a text's MD5 give."""
    return f"((CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) + 0.5) / 4294967296)"


def start_sql(k: int) -> str:
    """The starting centres of ``points`` (id, features), as ``centres_1`` (centre, cluster)."""
    nearing = """
  SELECT v.features, v.ticket, any_value(v.weight) AS weight,
    least(any_value(v.away), min(pow(list_distance(v.features, d.features), 2))) AS away
  FROM {} v LEFT JOIN {} d ON true GROUP BY v.features, v.ticket"""
    text = f""",
vectors AS MATERIALIZED (
  SELECT features, min(md5('{features.SEED}:' || id)) AS ticket, count(*) AS weight,
    CAST('inf' AS DOUBLE) AS away FROM points GROUP BY features),
drawn_0 AS MATERIALIZED (SELECT features, ticket FROM vectors ORDER BY ticket LIMIT {k}),
away_0 AS MATERIALIZED ({nearing.format("vectors", "drawn_0")})"""
    for number in range(1, features.ROUNDS + 1):
        even = even_sql(f"'{features.SEED}:{number}:' || ticket")
        text += f""",
drawn_{number} AS MATERIALIZED (
  SELECT features, ticket FROM away_{number - 1} WHERE away > 0
  ORDER BY -ln({even}) / (weight * away), ticket LIMIT {2 * k}),
away_{number} AS MATERIALIZED ({nearing.format(f"away_{number - 1}", f"drawn_{number}")})"""
    every = " UNION ALL ".join(f"FROM drawn_{number}" for number in range(features.ROUNDS + 1))
    text += f""",
candidates AS MATERIALIZED ({every}),
left_0 AS MATERIALIZED (
  SELECT features, ticket, count(*) AS weight, 1.0::DOUBLE AS away FROM (
    SELECT c.features, c.ticket FROM points p, candidates c QUALIFY row_number() OVER (
      PARTITION BY id ORDER BY round(list_distance(p.features, c.features), 9), ticket) = 1)
  GROUP BY features, ticket)"""
    for number in range(1, k + 1):
        even = even_sql(f"'{features.SEED}:pick:{number}:' || ticket")
        nearest = "pow(list_distance(l.features, p.features), 2)"
        away = nearest if number == 1 else f"least(away, {nearest})"
        text += f""",
pick_{number} AS MATERIALIZED (
  SELECT features FROM left_{number - 1} WHERE away > 0
  ORDER BY -ln({even}) / (weight * away), ticket LIMIT 1),
left_{number} AS MATERIALIZED (
  SELECT l.features, ticket, weight, {away} AS away FROM left_{number - 1} l, pick_{number} p)"""
    picks = " UNION ALL ".join(
        f"SELECT features AS centre, {number - 1} AS cluster FROM pick_{number}"
        for number in range(1, k + 1)
    )
    return text + f", centres_1 AS MATERIALIZED ({picks})"


def kmeans_sql(k: int, steps: int) -> str:
    """k-means of ``points`` (id, features) written out; ``assigned`` is the last assignment."""
    text = start_sql(k)
    for step in range(1, steps + 1):
        text += f""",
assigned_{step} AS MATERIALIZED (
  SELECT id, features, cluster FROM points, centres_{step}
  QUALIFY row_number() OVER (PARTITION BY id
    ORDER BY round(list_distance(features, centre), 9), cluster) = 1),
means_{step} AS (
  SELECT cluster, list(value ORDER BY place) AS mean FROM (
    SELECT cluster, place, round(avg(value), 9) AS value FROM (
      SELECT cluster, unnest(features) AS value, generate_subscripts(features, 1) AS place
      FROM assigned_{step}) GROUP BY cluster, place) GROUP BY cluster),
centres_{step + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(mean, centre) AS centre
  FROM centres_{step} LEFT JOIN means_{step} USING (cluster))"""
    return text + f", assigned AS (SELECT id, cluster FROM assigned_{steps})"


TFIDF_CLUSTERS = (
    "WITH weights AS MATERIALIZED ("
    + TFIDF
    + """),
listed AS (SELECT DISTINCT term FROM weights),
points AS MATERIALIZED (
  SELECT doc_id AS id, list(coalesce(tfidf, 0.0::DOUBLE) ORDER BY l.term) AS features
  FROM documents, listed l LEFT JOIN weights w ON w.post_id = doc_id AND w.term = l.term
  GROUP BY doc_id)"""
    + kmeans_sql(TEXT_CLUSTERS, SQL_MEAN_STEPS)
)


def tfidf_clusters(spark, sf_dir):
    weights = document_tfidf(spark, sf_dir).withColumn("tfidf", F.round("tfidf", 6))
    weights = features.cut(weights)
    vectors = features.tfidf_vectors(posts(spark, sf_dir), weights)
    return features.kmeans(vectors, TEXT_CLUSTERS, "post_id"), weights


@QUERIES.add("kmeans_tfidf", TFIDF_CLUSTERS + " SELECT id AS post_id, cluster FROM assigned")
def kmeans_tfidf(spark, sf_dir):
    return tfidf_clusters(spark, sf_dir)[0].select("post_id", "cluster")


@QUERIES.add(
    "cluster_top_terms",
    TFIDF_CLUSTERS
    + """, sizes AS (SELECT cluster, count(*) AS size FROM assigned GROUP BY cluster),
heavy AS (
  SELECT cluster, term, round(sum(tfidf) / any_value(size), 9) AS weight
  FROM weights JOIN assigned ON id = post_id JOIN sizes USING (cluster) GROUP BY cluster, term)
SELECT cluster, term, weight,
  row_number() OVER (PARTITION BY cluster ORDER BY weight DESC, term) AS rank
FROM heavy QUALIFY rank <= 10""",
)
def cluster_top_terms(spark, sf_dir):
    return features.cluster_top_terms(*tfidf_clusters(spark, sf_dir))


@QUERIES.add(
    "kmeans_vectors",
    """WITH points AS MATERIALIZED (
  SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS features FROM embeddings
  WHERE embedding IS NOT NULL)"""
    + kmeans_sql(2, SQL_MEAN_STEPS)
    + " SELECT id AS vec_id, cluster FROM assigned",
)
def kmeans_vectors(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").where("embedding IS NOT NULL")
    vectors = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("features"))
    return features.kmeans(vectors, 2, "vec_id").select("vec_id", "cluster")


def cleaned_sql(text: str) -> str:
    return f"""array_to_string(list_filter(
  list_transform(regexp_extract_all({text}, '(\\p{{L}}+)', 1), lambda w: lower(w)),
  lambda w: length(w) >= 3 AND w NOT IN ({ENGLISH})), ' ')"""


HTML_TEXT = "regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g')"
for entity, character in (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"),
):
    HTML_TEXT = f"replace({HTML_TEXT}, {quoted(entity)}, {quoted(character)})"


@QUERIES.add("clean_html_body", f"SELECT page_id, {cleaned_sql(HTML_TEXT)} AS body FROM pages")
def clean_html_body(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    cleaned = content_words(strip_markup(F.col("html")), ENGLISH_STOP_WORDS)
    return pages.select("page_id", F.array_join(cleaned, " ").alias("body"))


@QUERIES.add(
    "clean_text_tokens", f"SELECT doc_id AS post_id, {cleaned_sql('text')} AS body FROM documents"
)
def clean_text_tokens(spark, sf_dir):
    cleaned = content_words(F.col("body"), ENGLISH_STOP_WORDS)
    return posts(spark, sf_dir).select("post_id", F.array_join(cleaned, " ").alias("body"))
