"""The similarity join, MinHash and grouping against brute force."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from coterie.operators import indexing, minhash, similarity, skew, spectrum, universe


@pytest.fixture(scope="module")
def shingles():
    chance = random.Random(3)
    base = {i: set(chance.sample(range(60), chance.randint(3, 12))) for i in range(40)}
    near = {100 + i: base[i] ^ {chance.randrange(60)} for i in range(20)}
    copies = {200 + i: set(base[0]) for i in range(6)}
    return {key: values for key, values in (base | near | copies).items() if values}


def frame(spark, shingles):
    rows = [(key, sorted(values)) for key, values in shingles.items()]
    return spark.createDataFrame(rows, "post_id bigint, shingles array<bigint>")


def expand(found):
    """All pairs of posts from the pairs of representatives and their copies."""
    members = {}
    for row in found.copies.collect():
        members.setdefault(row["representative"], [row["representative"]]).append(row["post_id"])
    pairs = {}
    for row in found.pairs.collect():
        for a in members.get(row["post_a"], [row["post_a"]]):
            for b in members.get(row["post_b"], [row["post_b"]]):
                pairs[tuple(sorted((a, b)))] = round(row["jaccard"], 9)
    for same in members.values():
        for a in same:
            for b in same:
                if a < b:
                    pairs[a, b] = 1.0
    return pairs


def brute_force(shingles, threshold, strict=False):
    pairs = {}
    for a in shingles:
        for b in shingles:
            if a < b:
                value = len(shingles[a] & shingles[b]) / len(shingles[a] | shingles[b])
                if value > threshold or (value == threshold and not strict):
                    pairs[a, b] = round(value, 9)
    return pairs


@pytest.mark.parametrize("threshold", [0.02, 0.4, 0.5, 0.8, 1.0])
@pytest.mark.parametrize("strict", [False, True])
def test_similar_pairs(spark, shingles, threshold, strict):
    found = similarity.similar_pairs(frame(spark, shingles), threshold, strict)
    expected = brute_force(shingles, threshold, strict)
    got = expand(found)
    if strict and threshold == 1.0:
        got = {}  # copies are always tied to their representative
    assert got == expected


@pytest.mark.parametrize("height,dense", [(2048, 1 / 64), (7, 1e-9), (7, 2.0)])
def test_spectrum_counts_every_pair(spark, shingles, monkeypatch, height, dense):
    """One block, and many, with all members multiplied as dense or as sparse columns."""
    monkeypatch.setattr(spectrum, "MOST_BLOCK_SETS", height)
    monkeypatch.setattr(spectrum, "DENSE_SHARE", dense)
    monkeypatch.setattr(spectrum, "STEP_PAIRS", 50)
    monkeypatch.setattr(spectrum, "MOST_BLOCK_MEMBERS", height * 4)
    found = similarity.similarity_spectrum(frame(spark, shingles))
    want = Counter(brute_force(shingles, 0.0, strict=True).values())
    assert {round(r.jaccard, 9): r.n_pairs for r in found.collect()} == want
    total = similarity.similarity_histogram(found).agg(F.sum("n_pairs")).first()[0]
    assert total == sum(want.values())


@pytest.mark.parametrize("bits", [4, 1 << 15])
def test_only_sets_of_several_posts_move_for_classes(spark, shingles, monkeypatch, bits):
    """Also where a bitmap of few cells marks posts that share nothing."""
    monkeypatch.setattr(similarity, "SLICE_BITS", bits)
    monkeypatch.setattr(similarity, "MARK_SLICES", 1)
    representatives, copies = similarity._classes(similarity.cut(frame(spark, shingles)))
    classes = {}
    for post, held in shingles.items():
        classes.setdefault(frozenset(held), []).append(post)
    want = {min(posts): (len(held), len(posts)) for held, posts in classes.items() if held}
    assert {r["post_id"]: (r["n"], r["copies"]) for r in representatives.collect()} == want
    assert representatives.count() == len(want) and copies.count() == sum(map(len, classes.values())) - len(classes)
    assert "hashpartitioning" not in representatives._jdf.queryExecution().executedPlan().toString()


def test_spectrum_of_nothing(spark, shingles):
    assert similarity.similarity_spectrum(frame(spark, shingles).limit(0)).count() == 0
    assert similarity.similarity_spectrum(frame(spark, {1: {2}, 3: {4}})).count() == 0


def test_signatures(spark, shingles):
    universe = len(set().union(*shingles.values()))
    rows = minhash.minhash_signatures(frame(spark, shingles), 10).collect()
    for row in rows:
        expected = [
            min(
                ((3491 * x + 5003) % universe + i * ((1999 * x + 1409) % universe)) % universe
                for x in shingles[row["post_id"]]
            )
            for i in range(10)
        ]
        assert row["signature"] == expected


def test_band_ranges():
    ranges = minhash.band_ranges(100, 16)
    assert [size for _, size in ranges] == [7] * 4 + [6] * 12
    assert ranges[4] == (28, 6) and sum(ranges[-1]) == 100


def test_candidate_groups_need_the_same_members(spark):
    rows = [(band, 1, post) for band in range(4) for post in "ab"] + [(3, 1, "c"), (0, 2, "d")]
    members = spark.createDataFrame(rows, "band int, bucket bigint, post_id string")
    found = minhash.candidate_groups(members, n_bands=4, share=0.75).collect()
    assert sorted((r["band"], r["bucket"], r["n_bands"], r["post_id"]) for r in found) == [
        (0, 1, 3, "a"),
        (0, 1, 3, "b"),
    ]
    assert minhash.candidate_groups(members, n_bands=4, share=1.0).isEmpty()


def test_band_plan_marks_the_known_setting(spark):
    measured = spark.createDataFrame([(0.5, 10)], "jaccard double, n_pairs bigint")
    row = minhash.band_plan(measured).where("b = 16 AND r = 3").first()
    assert row["fits"] and abs(row["curve_threshold"] - 0.39685) < 1e-5
    assert abs(row["expected_recall"] - (1 - (1 - 0.5**3) ** 16)) < 1e-6


def test_short_posts_have_no_shingles(spark):
    posts = spark.createDataFrame(
        [(1, "a b c d"), (2, "a b c d e"), (3, "")], "post_id bigint, body string"
    )
    assert [r["post_id"] for r in similarity.word_shingle_sets(posts).collect()] == [2]
    shingles = similarity.character_shingles(posts.where("post_id = 2")).collect()
    assert [r["shingle"] for r in shingles] == ["a b c", " b c ", "b c d", " c d ", "c d e"]


def test_numbering_of_a_group_that_holds_most_rows(spark):
    rows = [("hot", i) for i in range(500)] + [("cold", i) for i in range(5)]
    frame = spark.createDataFrame(rows, "g string, v int").repartition(7)
    numbered = indexing.index_within(frame, ["g"], ["v"], "n").collect()
    assert len(numbered) == 505 and all(row["n"] == row["v"] for row in numbered)
    dense = indexing.dense_index(frame, ["g", "v"], "n").orderBy("n").collect()
    assert [row["n"] for row in dense] == list(range(505))


def test_salted_join_equals_a_join(spark):
    large = spark.range(300).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    unique = spark.createDataFrame([(0, "x"), (1, "y")], "k bigint, w string")
    salted = skew.salted_join(large, unique, ["k"], "v")
    assert sorted(salted.collect()) == sorted(large.join(unique, "k").select(salted.columns).collect())


def test_salted_join_broadcasts_no_repeats(spark, tmp_path):
    """Files below the threshold can hold many rows, of which every salt has a copy."""
    ids = spark.range(200_000).select(F.col("id").alias("k"))
    ids.write.parquet(str(tmp_path / "large"))
    ids.withColumn("w", F.lit(1)).write.parquet(str(tmp_path / "unique"))
    large, unique = (spark.read.parquet(str(tmp_path / name)) for name in ("large", "unique"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        wide = skew.salted_join(large.withColumn("v", F.col("k")), unique, ["k"], "v")
        narrow = skew.salted_join(large.withColumn("v", F.col("k")), unique.where("k < 3").limit(3), ["k"], "v")
        assert "BroadcastHashJoin" not in wide._jdf.queryExecution().executedPlan().toString()
        assert wide.count() == 200_000 and narrow.count() == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_candidate_pairs_count_shared_bands(spark):
    chance = random.Random(8)
    vectors = {post: [chance.randrange(3) for _ in range(8)] for post in range(60)}
    # one bucket of the first band holds everybody, one class has twenty copies
    vectors |= {100 + i: [0, *vectors[i][1:]] for i in range(40)}
    vectors |= {200 + i: list(vectors[0]) for i in range(20)}
    rows = [(post, band, bucket) for post, v in vectors.items() for band, bucket in enumerate(v)]
    members = spark.createDataFrame(rows, "post_id bigint, band int, bucket bigint")
    found = minhash.candidate_pairs(members, n_bands=8, share=0.5)

    classes = {}
    for post in sorted(vectors):
        classes.setdefault(tuple(vectors[post]), []).append(post)
    first = {posts[0]: (vector, len(posts)) for vector, posts in classes.items()}
    expected = set()
    for a, (of_a, copies_a) in first.items():
        for b, (of_b, copies_b) in first.items():
            shared = sum(x == y for x, y in zip(of_a, of_b))
            if a < b and shared >= 4:
                expected.add((a, b, shared, copies_a, copies_b))
    pairs = [tuple(row) for row in found.pairs.collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == expected
    assert {(r.post_id, r.representative, r.n_bands, r.n_members) for r in found.copies.collect()} == {
        (post, posts[0], 8, len(posts)) for posts in classes.values() for post in posts[1:]
    }


def test_candidate_pairs_of_one_hot_bucket(spark, monkeypatch):
    monkeypatch.setattr("coterie.operators.heavy_join.LEAST_TILE", 8)
    rows = [(post, band, 0 if band < 2 else post * 10 + band) for post in range(120) for band in range(4)]
    members = spark.createDataFrame(rows, "post_id bigint, band int, bucket bigint")
    assert minhash.candidate_pairs(members, n_bands=4, share=0.5).pairs.count() == 120 * 119 // 2
    assert minhash.candidate_pairs(members, n_bands=4, share=0.75).pairs.count() == 0
    assert minhash.candidate_pairs(members.limit(0), n_bands=4).rows().count() == 0


ODD_TEXTS = [" a  b c d e f ", "a b c d e", "     ", "é\n𝄞 x y z  q", "a b c d", "", None, "one two three four\nfive six seven"]


def test_windows_of_odd_texts(spark):
    posts = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "post_id int, body string")
    want = {(i, at, text[at : at + 5]) for i, text in enumerate(ODD_TEXTS) for at in range(len(text or "") - 4)}
    found = similarity.character_shingles(posts)
    assert {tuple(row) for row in found.collect()} == want
    # one pass over the text, no array of its characters
    assert "array_join" not in found._jdf.queryExecution().toString()


def test_numbers_of_shingles_over_several_ranges(spark, monkeypatch):
    monkeypatch.setattr(universe, "STEP_SHINGLES", 4)
    chance = random.Random(5)
    sets = {post: chance.sample([*range(6), *(x << 18 for x in range(1, 40))], 5) for post in range(30)}
    place = {x: i for i, x in enumerate(sorted(set().union(*sets.values())))}
    found = similarity.characteristic_matrix(frame(spark, sets)).collect()
    assert sorted((r.shingle_idx, r.post_id) for r in found) == sorted(
        (place[x], post) for post, values in sets.items() for x in values
    )
    assert universe.distinct_shingles(frame(spark, sets)) == len(place)
    assert universe.distinct_shingles(frame(spark, sets).limit(0)) == 0


def test_sets_and_signatures_leave_in_bounded_steps(monkeypatch):
    """A batch of long posts is taken a few posts at a time."""
    monkeypatch.setattr(minhash, "BATCH_SHINGLES", 10)
    monkeypatch.setattr(similarity, "BATCH_SHINGLES", 10)
    posts = pa.RecordBatch.from_pylist([{"post_id": i, "body": f"a b c d e f {i}"} for i in range(20)])
    sets = list(similarity._sets_function(5, b" ")([posts]))
    assert max(batch.num_rows for batch in sets) == 4
    whole = pa.Table.from_batches(sets).combine_chunks().to_batches()
    signatures = list(minhash._signature_function(97, 3)(whole))
    assert max(batch.num_rows for batch in signatures) <= 4
    assert sum(batch.num_rows for batch in signatures) == 20


def test_members_of_the_same_sets_go_as_one(spark):
    """A line that many posts hold is one weighed member; shingles of one post do not move."""
    line = list(range(100, 150))
    sets = {post: {*line, *range(1000 * post, 1000 * post + 200)} for post in range(1, 31)}
    sets[31], sets[32] = {100, 7}, {7, 8}
    found = universe.shared_members(frame(spark, sets)).collect()
    assert sorted(tuple(r) for r in found) == sorted(
        [(101, 49, post) for post in range(1, 31)] + [(100, 1, post) for post in range(1, 32)] + [(7, 1, 31), (7, 1, 32)]
    )
    assert expand(similarity.similar_pairs(frame(spark, sets), 0.02)) == brute_force(sets, 0.02)


def test_pairs_leave_a_tile_in_strips(spark, shingles, monkeypatch):
    """However many pairs a tile has, a batch holds those of a strip."""
    monkeypatch.setattr(spectrum, "STRIP_CELLS", 40)
    held, kept = [], spectrum._Block.strips
    monkeypatch.setattr(spectrum._Block, "strips", lambda self, height: held.append(height) or kept(self, height))
    row = {"ids": np.arange(90), "sizes": np.full(90, 3), "copies": np.ones(90, int), "member": np.repeat([1, 2, 3], 90)}
    row |= {"weight": np.ones(270, int), "holder": np.tile(np.arange(90, dtype=np.int32), 3)}
    block = spectrum._Block({name: values.tobytes() for name, values in row.items()})
    parts = [spectrum.common_members(side, block.whole()) for side in block.strips(7)]
    assert held == [7] and [len(part) for part in parts] == [7] * 12 + [6]
    assert (np.concatenate(parts) == 3).all()
    found = similarity.similar_pairs(frame(spark, shingles), 0.02)
    assert expand(found) == brute_force(shingles, 0.02)


def test_blocks_travel_compressed():
    """A (member, set) row took 20 bytes of a block wherever it moved."""
    chance = np.random.default_rng(3)
    number, member = np.divmod(np.unique(chance.integers(0, 1 << 32, 60_000) % (400 << 20)), 1 << 20)
    rows = pa.table({"block": np.zeros(len(number), np.int32), "number": number, "member": member, "weight": member % 5 + 1})
    facts = pa.table({"number": np.arange(400), "post_id": np.arange(400) * 9 - 70, "n": np.arange(400) + 500, "copies": np.ones(400, int)})
    packed = spectrum._pack(rows, facts)
    assert packed.num_rows == 1 and packed.nbytes < 10 * len(number)
    block = spectrum._Block.opened({name: packed.column(name)[0] for name in packed.column_names})
    held = sorted(zip(block.rows[2].tolist(), block.rows[0].tolist(), block.rows[1].tolist()))
    assert held == list(zip(number.tolist(), member.tolist(), (member % 5 + 1).tolist()))
    assert (block.ids == np.arange(400) * 9 - 70).all() and (block.sizes == np.arange(400) + 500).all()


def test_sets_of_common_shingles_meet_by_sums(spark):
    """Where every shingle is common, few pairs that are not similar become candidates."""
    chance = random.Random(6)
    sets = {post: set(chance.sample(range(400), 200)) for post in range(40)}
    sets |= {100 + post: sets[post] ^ set(chance.sample(range(400), 12)) for post in range(20)}
    want = brute_force(sets, 0.8)
    representatives, _ = similarity._classes(frame(spark, sets))
    near = similarity._near(similarity._candidates(representatives, 0.8), representatives, 0.8)
    assert len(want) == 20 and want.keys() <= {tuple(r) for r in near.collect()} and near.count() < 40
    assert expand(similarity.similar_pairs(frame(spark, sets), 0.8)) == want
