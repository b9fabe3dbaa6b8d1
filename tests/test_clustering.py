"""Clustering operators against brute force and small known cases."""

import hashlib
import random
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from coterie.functions.distance import insert_delete_distance, levenshtein
from coterie.operators import clustroids, density, features, metric_join
from coterie.operators.edit_join import both_ways, edit_distance_join
from coterie.operators.graph import connected_components


@cache
def distance(a, b):
    if not a or not b:
        return len(a) + len(b)
    return min(
        distance(a[1:], b) + 1, distance(a, b[1:]) + 1, distance(a[1:], b[1:]) + (a[0] != b[0])
    )


@pytest.fixture(scope="module")
def words():
    chance = random.Random(11)
    made = {"".join(chance.choice("abc") for _ in range(chance.randint(0, 9))) for _ in range(60)}
    return sorted(made)


def titles(spark, words):
    return spark.createDataFrame([(word,) for word in words], "title string")


@pytest.mark.parametrize("eps", [1, 2, 4])
def test_edit_distance_join_finds_all_pairs(spark, words, eps):
    found = edit_distance_join(titles(spark, words), eps).collect()
    expected = {(a, b, distance(a, b)) for a in words for b in words if a < b}
    assert {tuple(row) for row in found} == {pair for pair in expected if pair[2] <= eps}
    assert len(found) == len({tuple(row) for row in found})


def test_edit_distance_join_of_a_subset(spark, words):
    some = set(words[::7])
    found = edit_distance_join(titles(spark, words), 3, of=titles(spark, sorted(some))).collect()
    assert {tuple(row) for row in found} == {
        (a, b, distance(a, b))
        for a in words
        for b in words
        if a < b and distance(a, b) <= 3 and (a in some or b in some)
    }


@pytest.mark.parametrize("candidates", [2, 5, 64])
def test_clustroid_search_is_exact(spark, words, monkeypatch, candidates):
    monkeypatch.setattr(clustroids, "CANDIDATES_PER_ROUND", candidates)
    assigned = [(0, i % 2, word) for i, word in enumerate(words)]
    frame = spark.createDataFrame(assigned, "g int, cluster int, title string")
    found = clustroids.update_clustroids(frame, ["g"]).collect()
    for cluster in (0, 1):
        members = [word for _, c, word in assigned if c == cluster]
        best = min((max(distance(a, b) for b in members), a) for a in members)[1]
        assert [r["title"] for r in found if r["cluster"] == cluster] == [best]


def test_emptied_clusters_are_renumbered(spark):
    frame = spark.createDataFrame([(0, 3, "aa"), (0, 7, "bb")], "g int, cluster int, title string")
    found = clustroids.update_clustroids(frame, ["g"]).collect()
    assert sorted((r["cluster"], r["title"]) for r in found) == [(0, "aa"), (1, "bb")]


def test_periods_reach_the_last_year_over_a_gap(spark):
    rows = spark.createDataFrame([("a", 1990), ("b", 2007)], "title string, year int")
    found = clustroids.sliding_periods(rows).collect()
    assert sorted((r["period_start"], r["title"]) for r in found) == [
        (1990, "a"), (2000, "b"), (2005, "b"),
    ]


def test_too_many_clustroids_are_refused(spark):
    with pytest.raises(ValueError):
        clustroids.cluster_counts(spark, ["g"], [(0, clustroids.MAX_CLUSTROIDS + 1)])


def test_insert_delete_distance(spark):
    rows = [("The man sits in the park", "The woman sits in the park"), ("", "abc"), ("abc", "")]
    frame = spark.createDataFrame(rows, "a string, b string")
    got = frame.select(insert_delete_distance(F.col("a"), F.col("b"))).collect()
    assert [row[0] for row in got] == [2, 3, 3]


def test_insert_delete_distance_of_long_strings(spark):
    chance = random.Random(6)

    def table(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            before, row = row, [0]
            for j, y in enumerate(b):
                row.append(before[j] + 1 if x == y else max(before[j + 1], row[-1]))
        return len(a) + len(b) - 2 * row[-1]

    texts = ["".join(chance.choices("abcdé", k=chance.choice([0, 1, 63, 64, 65, 130, 1000]))) for _ in range(24)]
    pairs = list(zip(texts[::2], texts[1::2])) + [(None, "a"), ("a", None)]
    frame = spark.createDataFrame(pairs, "a string, b string")
    got = frame.select("a", "b", insert_delete_distance(F.col("a"), F.col("b")).alias("d")).collect()
    for a, b, d in got:
        assert d == (None if a is None or b is None else table(a, b))


@pytest.mark.parametrize("min_samples, expected", [(3, [-1, -1, -1]), (2, [0, 0, -1])])
def test_dbscan_small_case(spark, min_samples, expected):
    strings = ["ACCTACTAGAAGTT", "ACCTCCTAGAAG", "GAATATTAGGCCGA"]
    points = titles(spark, strings).withColumn("weight", F.lit(1))
    found = density.dbscan(points, 5, min_samples).orderBy("title").collect()
    assert [row["cluster"] for row in found] == expected


def test_single_linkage_passes(spark, words):
    found = density.single_linkage_merges(titles(spark, words)).collect()
    clusters = {word: [word] for word in words}
    step = 0
    while len(clusters) > 1:
        step += 1
        nearest = {
            name: min(
                (distance(a, b), other)
                for other in clusters if other != name
                for a in members for b in clusters[other]
            )
            for name, members in clusters.items()
        }
        rows = {r["cluster"]: r for r in found if r["pass"] == step}
        assert {c: (r["distance"], r["nearest"]) for c, r in rows.items()} == nearest
        merged = {}
        for name, members in clusters.items():
            merged.setdefault(rows[name]["merged_into"], []).extend(members)
        clusters = merged
    assert max(row["pass"] for row in found) == step


def test_far_clusters_are_found_without_pairs_inside_them(spark, monkeypatch):
    near = ["a" * i + "b" + "a" * (13 - i) for i in range(14)]
    far = ["z" * i + "y" + "z" * (13 - i) for i in range(14)]
    searches = []

    def counted(points, eps, **options):
        found = density.cut(edit_distance_join(points, eps, **options))
        searches.append((eps, found.select("title_a", "title_b").collect()))
        return found

    monkeypatch.setattr(density, "edit_distance_join", counted)
    found = density.single_linkage_merges(titles(spark, near + far)).collect()
    assert max(row["distance"] for row in found) == 14
    eps, pairs = searches[-1]
    assert eps >= 14 and all(a < "y" <= b for a, b in pairs)


def test_clustering_that_still_moves_is_an_error(spark, words):
    points = titles(spark, words).select(F.lit(0).alias("g"), "title", F.lit(1).alias("weight"))
    with pytest.raises(RuntimeError, match="still change"):
        clustroids.cluster_titles(points, ["g"], [(0, 2)], max_steps=1)


def test_components_of_a_long_path(spark):
    n = 40
    vertices = spark.range(n + 1)
    edges = spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    edges = edges.where("a <> 25")
    found = connected_components(vertices, edges).collect()
    assert all(row["component"] == (0 if row["id"] <= 25 else 26) for row in found)


def test_affinity_propagation_finds_the_centres(spark):
    centres = {"aaaaaaaa": "b", "zzzzzzzz": "y"}
    expected = {centre: centre for centre in centres}
    for centre, other in centres.items():
        for i in range(4):
            expected[centre[:i] + other + centre[i + 1 :]] = centre
    alone = "0123456789abcdefghij"
    expected[alone] = alone
    points = titles(spark, sorted(expected))
    pairs = both_ways(edit_distance_join(points, 7))
    listed = pairs.select("title", "neighbour", (-F.col("distance")).alias("similarity"))
    found = density.affinity_propagation(points, density.cut(listed), stable_steps=4).collect()
    assert {row["title"]: row["exemplar"] for row in found} == expected


def test_affinity_propagation_over_nearest_titles(spark):
    """Members of a group are further apart than any small radius; each still lists its nearest."""
    groups = {"a" * 40: "b", "z" * 40: "y"}
    expected = {}
    for centre, other in groups.items():
        expected[centre] = centre
        for i in range(4):
            expected[centre[: 10 * i] + other * 10 + centre[10 * i + 10 :]] = centre
    points = titles(spark, sorted(expected))
    nearest = metric_join.nearest_titles(points, 4, levenshtein)
    listed = density.cut(density.mutual_similarities(nearest))
    pairs = {(r.title, r.neighbour) for r in listed.collect()}
    assert len(pairs) == listed.count() and pairs == {(b, a) for a, b in pairs}
    found = density.affinity_propagation(points, listed, stable_steps=4).collect()
    assert {row["title"]: row["exemplar"] for row in found} == expected


def test_affinity_propagation_settles_between_symmetric_titles(spark):
    listed = spark.createDataFrame(
        [(a, b, -1.0) for a in "xy" for b in "xy" if a != b], "title string, neighbour string, similarity double"
    )
    found = density.affinity_propagation(titles(spark, ["x", "y"]), listed, preference=-1.5)
    assert len({row["exemplar"] for row in found.collect()}) == 1


def test_kmeans_on_six_points(spark):
    points = [(1, 2), (1, 4), (1, 0), (10, 2), (10, 4), (10, 0)]
    frame = spark.createDataFrame([(list(map(float, p)),) for p in points], "p array<double>")
    found = features.kmeans(frame.select("p", F.col("p").alias("features")), 2, "p").collect()
    left = {row["cluster"] for row in found if row["p"][0] == 1}
    right = {row["cluster"] for row in found if row["p"][0] == 10}
    assert len(left) == len(right) == 1 and left != right


def test_kmeans_follows_lloyd_steps(spark):
    """Against the same steps in numpy, with a centre that loses all points and a repeated vector."""
    chance = np.random.default_rng(5)
    vectors = np.round(chance.normal(size=(200, 5)) + chance.integers(0, 4, (200, 1)), 3)
    vectors[50:90] = vectors[3]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(vectors.tolist())], "id int, features array<double>")
    found = {r["id"]: r["cluster"] for r in features.kmeans(frame, 6, "id").collect()}
    centres = features.start_centres(frame, 6, "id")
    for _ in range(200):
        distance = np.round(np.sqrt(((vectors[:, None] - centres) ** 2).sum(axis=2)), 9)
        cluster = distance.argmin(axis=1)
        moved = [np.round(vectors[cluster == c].mean(axis=0), 9) if (cluster == c).any() else centres[c] for c in range(6)]
        if np.array_equal(moved, centres):
            break
        centres = np.array(moved)
    assert found == dict(enumerate(cluster.tolist()))


def test_kmeans_goes_on_until_nothing_moves(spark, monkeypatch):
    """Two heavy places and a row of points between them, of which each step moves one."""
    n, left, right = 205, np.zeros(600), np.full(6000, 1000.0)
    between = np.full(n, 500.0)
    for _ in range(30):
        means = [
            (np.append(left, between[:k]).mean() + np.append(right, between[k:]).mean()) / 2 for k in range(n)
        ]
        between = np.array([2 * means[0] - means[1], *means])
        between = (between[1:] + between[:-1]) / 2
    values = np.concatenate((left, between, right))
    frame = spark.createDataFrame([(i, [v]) for i, v in enumerate(values.tolist())], "id int, features array<double>")
    first = np.array([[0.0], [2 * (2 * means[0] - means[1])]])
    monkeypatch.setattr(features, "start_centres", lambda *_: first)
    steps, kept = [], features._summing
    monkeypatch.setattr(features, "_summing", lambda centres: steps.append(1) or kept(centres))
    found = {row["id"]: row["cluster"] for row in features.kmeans(frame, 2, "id").collect()}
    assert len(steps) > 200 and list(found.values()).count(1) == 6000


def even(text):
    return (int(hashlib.md5(text.encode()).hexdigest()[:8], 16) + 0.5) / 2**32


def test_start_centres_are_drawn_by_distance(spark):
    """Against the same draws one by one, with one vector that holds a third of the rows."""
    chance = np.random.default_rng(6)
    vectors = np.round(chance.normal(size=(150, 3)), 3)
    vectors[:50] = vectors[0]
    rows = [tuple(v) for v in vectors.tolist()]
    frame = spark.createDataFrame(list(enumerate(map(list, rows))), "id int, features array<double>")
    k, seed = 4, features.SEED
    ticket, weight = {}, {}
    for i, v in enumerate(rows):
        name = hashlib.md5(f"{seed}:{i}".encode()).hexdigest()
        ticket[v] = min(name, ticket.get(v, name))
        weight[v] = weight.get(v, 0) + 1

    def away(v, others):
        return min(sum((x - y) ** 2 for x, y in zip(v, other)) for other in others)

    found = sorted(ticket, key=ticket.get)[:k]
    for number in range(1, features.ROUNDS + 1):
        wait = {
            v: -np.log(even(f"{seed}:{number}:{ticket[v]}")) / (weight[v] * away(v, found))
            for v in ticket
            if away(v, found) > 0
        }
        found = found + sorted(wait, key=wait.get)[: 2 * k]
    held = dict.fromkeys(found, 0)
    for v in rows:
        held[min(found, key=lambda c: (round(away(v, [c]) ** 0.5, 9), ticket[c]))] += 1
    picked = []
    for number in range(1, k + 1):
        mass = {c: held[c] * (away(c, picked) if picked else 1) for c in found}
        wait = {
            c: -np.log(even(f"{seed}:pick:{number}:{ticket[c]}")) / mass[c] for c in found if mass[c]
        }
        picked.append(min(wait, key=wait.get))
    assert [tuple(c) for c in features.start_centres(frame, k, "id").tolist()] == picked


def test_start_centres_reach_small_far_groups(spark):
    sizes = {0.0: 300, 1000.0: 6, 2000.0: 4, 3000.0: 3}
    values = [[place + i % 7 / 10] for place, n in sizes.items() for i in range(n)]
    frame = spark.createDataFrame(list(enumerate(values)), "id int, features array<double>")
    assert {round(c[0], -3) for c in features.start_centres(frame, 4, "id").tolist()} == set(sizes)


def test_kmeans_of_few_vectors_and_of_none(spark):
    frame = spark.createDataFrame([(i, [float(i % 2)]) for i in range(6)], "id int, features array<double>")
    found = features.kmeans(frame, 5, "id").collect()
    assert {(r.features[0], r.cluster) for r in found} in ({(0, 0), (1, 1)}, {(0, 1), (1, 0)})
    assert features.kmeans(frame.limit(0), 5, "id").count() == 0
