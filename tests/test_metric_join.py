"""Range and nearest-neighbour joins under two metrics, and the clusterings that use them."""

import random

import pytest
from pyspark.sql import functions as F

from coterie.functions.distance import insert_delete_distance, levenshtein, subsequence_length
from coterie.operators import density, metric_join


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (x != y))
    return row[-1]


def inserts(a, b):
    return len(a) + len(b) - 2 * subsequence_length(a, b)


METRICS = {"levenshtein": (levenshtein, edits), "insert_delete": (insert_delete_distance, inserts)}


def some_titles():
    chance = random.Random(11)
    words = {"".join(chance.choices("abc", k=chance.randint(0, 7))) for _ in range(90)}
    # a dense place, all of whose members have one nearest pivot
    return sorted(words | {"zzzzzzzzzz"[:9] + c for c in "abcdefghijklmnopqrstuv"})


TITLES = some_titles()


def frame(spark, titles):
    return spark.createDataFrame([(t,) for t in titles], "title string")


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("eps", [0, 1, 2, 5])
def test_range_join(spark, metric, eps):
    measure, distance = METRICS[metric]
    titles = frame(spark, [*TITLES, *TITLES[:5], None])
    got = sorted(tuple(r) for r in metric_join.metric_pairs(titles, eps, measure, n_pivots=7).collect())
    want = [(a, b, d) for a in TITLES for b in TITLES if a < b and (d := distance(a, b)) <= eps]
    assert got == want


def test_range_join_of_titles_apart(spark):
    titles = frame(spark, TITLES).withColumn("side", F.length("title") % 2)
    got = metric_join.metric_pairs(titles, 2, levenshtein, apart="side").collect()
    want = {(a, b) for a in TITLES for b in TITLES if a < b and edits(a, b) <= 2 and (len(a) - len(b)) % 2}
    assert {(r.title_a, r.title_b) for r in got} == want


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("k", [1, 4])
def test_nearest(spark, metric, k):
    measure, distance = METRICS[metric]
    got = metric_join.nearest_titles(frame(spark, TITLES), k, measure, n_pivots=7).collect()
    want = {
        (a, rank, b, d)
        for a in TITLES
        for rank, (d, b) in enumerate(sorted((distance(a, b), b) for b in TITLES if b != a)[:k], 1)
    }
    assert {tuple(r) for r in got} == want


def test_few_titles_and_none(spark):
    few = frame(spark, ["a", "abc", "b"])
    assert metric_join.nearest_titles(few, 10, levenshtein).count() == 6
    assert metric_join.metric_pairs(few.limit(0), 3, levenshtein).count() == 0
    assert metric_join.nearest_titles(few.limit(0), 3, levenshtein).count() == 0


def test_dbscan_under_another_metric(spark):
    points = frame(spark, TITLES).withColumn("weight", F.lit(1))
    found = {r.title: r for r in density.dbscan(points, 2, 6, insert_delete_distance).collect()}
    near = {a: [b for b in TITLES if inserts(a, b) <= 2] for a in TITLES}
    core = {a for a in TITLES if len(near[a]) >= 6}
    assert {t for t, r in found.items() if r.is_core} == core
    assert all(found[t].n_neighbours == len(near[t]) for t in TITLES)
    for a in TITLES:
        if a in core:
            assert all(found[b].cluster == found[a].cluster for b in near[a] if b in core)
        else:
            clusters = {found[b].cluster for b in near[a] if b in core}
            assert found[a].cluster == min(clusters, default=-1)


@pytest.mark.parametrize("metric", [None, *METRICS])
@pytest.mark.parametrize(("eps", "min_samples"), [(2, 6), (3, 4)])
def test_dbscan_labels_by_balls(spark, metric, eps, min_samples):
    """Against neighbours counted one by one, with a weight that makes a lone title core."""
    measure, distance = METRICS[metric or "levenshtein"]
    titles = [*TITLES, "far away from all others"]
    weights = {t: min_samples if t == titles[-1] else 1 for t in titles}
    points = spark.createDataFrame(list(weights.items()), "title string, weight bigint")
    found = density.dbscan_labels(points, eps, min_samples, measure if metric else None)
    found = {r.title: r for r in found.collect()}
    near = {a: [b for b in titles if distance(a, b) <= eps] for a in titles}
    core = {a for a in titles if sum(weights[b] for b in near[a]) >= min_samples}
    assert {t for t, r in found.items() if r.is_core} == core
    label, numbers = {}, 0
    for seed in sorted(core):
        if seed not in label:
            open_ = [seed]
            while open_:
                title = open_.pop()
                if title not in label:
                    label[title] = numbers
                    open_ += [b for b in near[title] if b in core]
            numbers += 1
    for title in titles:
        joins = [label[b] for b in near[title] if b in core]
        assert found[title].cluster == label.get(title, min(joins, default=-1))


def test_dense_places_make_few_pairs(spark, monkeypatch):
    """Two places of 900 titles, each within four edits of all in its place, and some titles between."""
    letters = "abcdefghijklmnopqrstuvwxyzABCD"
    places = [f"{stem}{x}{y}" for stem in ("first place ", "some other spot ") for x in letters for y in letters]
    titles = [*places, "first placeXYZ", "alone", "some other spt ab"]
    seen = []

    def counted(join):
        def run(*args, **options):
            found = join(*args, **options)
            seen.append(found.count())
            return found

        return run

    monkeypatch.setattr(density, "edit_distance_join", counted(density.edit_distance_join))
    points = frame(spark, titles).withColumn("weight", F.lit(1))
    found = {r.title: r for r in density.dbscan_labels(points, 4, 20).collect()}
    assert {found[t].cluster for t in places[:900]} == {0}
    assert {found[t].cluster for t in places[900:]} == {1}
    assert (found["alone"].cluster, found["alone"].is_core) == (-1, False)
    assert found["some other spt ab"].cluster == 1
    # all pairs would be 2 * 900 * 899 / 2 = 809,100
    assert sum(seen) < 60_000


def test_dbscan_labels_of_none(spark):
    none = frame(spark, ["a"]).withColumn("weight", F.lit(1)).limit(0)
    assert density.dbscan_labels(none, 3, 2).count() == 0


def test_linkage_under_another_metric(spark):
    titles = TITLES[::4]
    found = density.single_linkage_merges(frame(spark, titles), 2, insert_delete_distance).collect()
    clusters, step = {t: [t] for t in titles}, 0
    while len(clusters) > 1:
        step += 1
        nearest = {
            name: min((inserts(a, b), other) for other in clusters if other != name
                      for a in members for b in clusters[other])
            for name, members in clusters.items()
        }
        rows = {r.cluster: r for r in found if r["pass"] == step}
        assert {c: (r.distance, r.nearest) for c, r in rows.items()} == nearest
        merged = {}
        for name, members in clusters.items():
            merged.setdefault(rows[name].merged_into, []).extend(members)
        clusters = merged
    assert max(r["pass"] for r in found) == step
