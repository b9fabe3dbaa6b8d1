"""The corpus operators against brute force, on documents with every odd case."""

import itertools
import math
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from coterie.llm import (
    collinear,
    cross_polytope,
    decontamination,
    exchange,
    jaccard_join,
    line_dedup,
    mixing,
    quality_knn,
    secret_scan,
    sharding,
    suffix_dedup,
)

SCHEMA = "doc_id bigint, text string, lang string, source string, score int, bucket string, kind int"
UPPER = {c: c + 32 for c in range(65, 91)}


def some_documents():
    random.seed(5)
    vocabulary = ["".join(random.choices("abcdeéñ", k=random.randint(2, 7))) for _ in range(300)]

    def prose(n):
        return " ".join(random.choices(vocabulary, k=n))

    passage, line = prose(60), "This Line   is common to many"
    base = prose(150)
    texts = [prose(random.randint(1, 120)) for _ in range(12)]
    texts += [prose(20) + "\n" + passage + "\n" + prose(30) for _ in range(4)]
    texts += [f"{prose(8)}\n {line.upper()} \n{prose(9)}\n{line}\n{line}" for _ in range(4)]
    for changes in (0, 0, 1, 2, 3, 4, 6, 8):
        changed = base.split()
        for at in random.sample(range(150), changes):
            changed[at] = random.choice(vocabulary)
        texts.append(" ".join(changed))
    texts += ["", " \t\n ", None, "one two", "One  TWO", prose(6000), "ab" * 300, prose(60) + "ñ" * 130]
    rows = [(i * 7 % 101, t, "en", [None, "b", "a", "é"][i % 4], 1, "x", 2) for i, t in enumerate(texts)]
    rows += [rows[3], rows[14], (None, base, None, None, None, None, None), (None, None, None, "b", 1, "", 0)]
    return rows, passage


ROWS, PASSAGE = some_documents()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def order(doc_id):
    return (1 << 63) - 1 if doc_id is None else doc_id


def lower(text):
    return (text or "").translate(UPPER)


def multiset(rows):
    return sorted(rows, key=repr)


def test_decontamination(spark, docs, nothing):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    items = [(1, PASSAGE), (10, ROWS[3][1]), (2, "One two"), (3, ""), (4, None), (None, ROWS[0][1]), (1, "x")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    windows = defaultdict(set)
    for item, text in items:
        w = word.findall(lower(text))
        m = min(13, len(w))
        for p in range(len(w) - m + 1 if m else 0):
            windows[tuple(w[p : p + m])].add("" if item is None else str(item))
    want = []
    for doc_id, text, *_ in ROWS:
        w, hit, held = word.findall(lower(text)), set(), set()
        for m in {len(x) for x in windows}:
            for p in range(len(w) - m + 1):
                if tuple(w[p : p + m]) in windows:
                    hit |= set(range(p, p + m))
                    held |= windows[tuple(w[p : p + m])]
        want.append((doc_id, len(w), len(hit), sorted(held)))
    for block in (1 << 20, 60):  # one pass, and several
        found = decontamination.contamination(docs, benchmark, block_bytes=block).collect()
        got = [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found]
        assert multiset(got) == multiset(want)
    assert all(r.contaminated == (r.n_hit > 0 and 20 * r.n_hit >= r.n_words) for r in found)
    assert decontamination.contamination(nothing, benchmark).count() == 0
    assert decontamination.contamination(docs, benchmark.limit(0)).where("n_hit > 0").count() == 0


def test_mixing(docs, nothing):
    found = mixing.mix_sources(docs, (3, 1, 2)).collect()
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t, *_ in ROWS if d is not None}
    assert len(found) == len(ROWS)
    assert all(r["size"] == size[r.doc_id] for r in found if r.doc_id is not None)
    taken, target = defaultdict(int), {}
    for r in found:
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.target] += r.taken
        target[r.target] = r.source_size
    assert all(taken[t] == math.floor(t) and t <= 2 * target[t] for t in target)
    total = sum(r["size"] for r in found)
    assert abs(sum(target) - 1.5 * total) < 1e-6
    again = mixing.mix_sources(docs.repartition(5), (3, 1, 2)).collect()
    assert multiset(again) == multiset(found)
    assert mixing.mix_sources(nothing).count() == 0


def test_line_dedup(docs, nothing):
    strip = " \t\n\x0b\x0c\r"
    first = defaultdict(lambda: 1 << 64)
    for doc_id, text, *_ in ROWS:
        for text_line in (text or "").split("\n"):
            key = text_line.strip(strip).translate(UPPER)
            first[key] = min(first[key], order(doc_id))
    want = []
    for doc_id, text, *_ in ROWS:
        lines = (text or "").split("\n")
        keys = [x.strip(strip).translate(UPPER) for x in lines]
        kept = [x for x, k in zip(lines, keys) if len(k) < 10 or order(doc_id) == first[k]]
        want.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    assert multiset(tuple(r) for r in line_dedup.dedup_lines(docs).collect()) == multiset(want)
    assert sum(row[2] for row in want) > 0
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_sharding(docs, nothing):
    found = sharding.shard_documents(docs, [1.0] * 4, [1.0] * 5).collect()
    assert len(found) == len(ROWS)
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 4)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {r["size"] for r in found} == {len((t or "").encode()) + 1 for _, t, *_ in ROWS}
    weighted = docs.sparkSession.range(8000).select(
        sharding.rendezvous_shard(F.col("id"), [1.0, 0.0, 3.0]).alias("s")
    )
    share = {r.s: r["count"] / 8000 for r in weighted.groupBy("s").count().collect()}
    assert set(share) == {0, 2} and abs(share[2] - 0.75) < 0.03
    assert sharding.shard_documents(nothing, [1.0], [1.0, 1.0]).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_documents(docs, [1.0, 2.0], [2.0, 1.0, 1.0])


def components(sets):
    parent = {d: d for d in sets}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_jaccard_join(docs, nothing):
    sets = {d: shingles(t) for d, t, *_ in ROWS if d is not None}
    group = components(sets)
    want = [(d, len(shingles(t)), group.get(d)) for d, t, *_ in ROWS]
    assert multiset(tuple(r) for r in jaccard_join.similar_components(docs).collect()) == multiset(want)
    assert len(set(group.values())) < len(group)
    assert jaccard_join.similar_components(nothing).count() == 0


def test_jaccard_family(spark, monkeypatch):
    """Near copies of which only some pairs are linked, above the size of a hot key."""
    monkeypatch.setattr(jaccard_join, "HOT_MEMBERS", 4)
    monkeypatch.setattr(jaccard_join, "CHUNK_NODES", 10)
    random.seed(8)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        changed = list(base)
        for at in random.sample(range(120), random.randint(0, 6)):
            changed[at] = f"x{random.randint(0, 9)}"
        rows.append((i, " ".join(changed)))
    sets = {d: shingles(t) for d, t in rows}
    family = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in jaccard_join.similar_components(family).collect()}
    assert got == components(sets)


@pytest.mark.parametrize("length, anchor, tile", [(100, 24, 16), (20, 8, 4)])
def test_suffix_dedup(docs, nothing, length, anchor, tile):
    first = {}
    for doc_id, text, *_ in ROWS:
        raw = (text or "").encode()
        for s in range(len(raw) - length + 1):
            place = (order(doc_id), s)
            first[raw[s : s + length]] = min(first.get(raw[s : s + length], place), place)
    want = []
    for doc_id, text, *_ in ROWS:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if first[raw[s : s + length]] < (order(doc_id), s):
                gone[s : s + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        want.append((doc_id, len(raw), [a for a, _ in spans], [b for _, b in spans], kept))
    found = suffix_dedup.remove_repeats(docs, length, anchor, tile).collect()
    got = [(r.doc_id, r.n_bytes, r.starts, r.ends, bytes(r.kept)) for r in found]
    assert multiset(got) == multiset(want)
    assert suffix_dedup.remove_repeats(nothing, length, anchor, tile).count() == 0


def test_suffix_dedup_of_long_texts(spark):
    random.seed(5)
    long = "".join(random.choice("abcdefgh ") for _ in range(1_200_000))
    part = long[262_000:262_900]  # over the place where a long text is cut
    rows = [(1, long), (2, "-" * 50 + part), (3, long[100:] + part[:150])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.starts, r.ends) for r in suffix_dedup.remove_repeats(frame).collect()}
    assert got == {1: ([], []), 2: ([50], [950]), 3: ([0], [1_200_050])}


def test_buckets_of_least_hashes_are_even():
    values = np.random.default_rng(1).integers(0, 1 << 63, (4_000, 50), dtype=np.uint64)
    filled = np.bincount(exchange.bucket_of(values.min(axis=1), 8), minlength=8)
    assert filled.min() > 300


def test_collinear(docs, nothing):
    found = collinear.repeated_passages(docs).collect()
    holders = {d for d, t, *_ in ROWS if t and d is not None and PASSAGE in t}
    assert holders - {r.doc_id for r in found} == {min(holders)}
    for r in found:
        assert r.other_id < r.doc_id and r.end_word - r.start_word >= 50
    words = {d: lower(t).split() for d, t, *_ in ROWS if d is not None}
    for r in found:
        length = max(r.end_word - r.start_word, r.other_end - r.other_start)
        same = sum(
            a == b
            for a, b in zip(
                words[r.doc_id][r.start_word : r.end_word], words[r.other_id][r.other_start : r.other_end]
            )
        )
        assert 100 * r.n_matched >= 75 * length and r.n_matched >= same - 5
    assert collinear.repeated_passages(nothing).count() == 0


def test_collinear_passage_of_stock_parts(spark):
    rng = random.Random(4)

    def new(n):
        return ["".join(rng.choices("abcdefghij", k=9)) for _ in range(n)]

    whole = new(145)
    # each part is first held by a document of its own, 45 words with 20 in common with the next
    rows = [(i, new(30) + whole[25 * i : 25 * i + 45] + new(30)) for i in range(5)]
    rows += [(10, new(40) + whole + new(7)), (11, new(5) + whole + new(60)), (12, new(90))]
    # the whole again beside one document that holds a part of it many times
    rows += [(13, [w for _ in range(70) for w in whole[30:60]]), (14, whole[20:90])]
    rows = [(i, " ".join(words)) for i, words in rows]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = collinear.repeated_passages(frame).collect()
    covered = defaultdict(set)
    for r in found:
        covered[r.doc_id] |= set(range(r.start_word, r.end_word))
    assert covered[11] >= set(range(5, 150)) and covered[14] >= set(range(70))
    assert not covered.keys() & {0, 1, 2, 3, 4, 10, 12}
    assert len(found) == len({(r.doc_id, r.other_id, r.start_word) for r in found})


def best_match(a, b):
    """Brute force: the most equal words of two stretches in step, of 50 words and three quarters."""
    best = 0
    for shift in range(-len(b) + 50, len(a) - 49):
        i, j = max(shift, 0), max(-shift, 0)
        n = min(len(a) - i, len(b) - j)
        same = [0, *itertools.accumulate(x == y for x, y in zip(a[i : i + n], b[j : j + n]))]
        for start in range(n - 49):
            for end in range(start + 50, n + 1):
                if 4 * (same[end] - same[start]) >= 3 * (end - start):
                    best = max(best, same[end] - same[start])
    return best


def test_collinear_recall_of_edited_passages(spark):
    rng = random.Random(8)

    def new(n):
        return ["".join(rng.choices("abcdefghij", k=9)) for _ in range(n)]

    rows, planted = [], {}
    for edits in (5, 10, 15, 20, 24):
        for length in (55, 60, 80, 120):
            for _ in range(12):
                passage = new(length)
                changed = list(passage)
                for at in rng.sample(range(length), edits * length // 100):
                    changed[at] = new(1)[0]
                first, doc = len(rows), len(rows) + 1
                rows.append((first, new(20) + passage + new(20)))
                rows.append((doc, new(15) + changed + new(25)))
                if best_match(rows[doc][1], rows[first][1]):
                    planted[doc] = (edits, first)
    assert len(planted) == len(rows) / 2
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id bigint, text string")
    found = {(r.doc_id, r.other_id) for r in collinear.repeated_passages(frame).collect()}
    assert found <= {(doc, first) for doc, (_, first) in planted.items()}
    for edits in (5, 10, 15, 20, 24):
        of_edits = [(doc, first) for doc, (e, first) in planted.items() if e == edits]
        assert sum(pair in found for pair in of_edits) >= 0.9 * len(of_edits)


def test_collinear_recall_of_edited_passages_of_stock_parts(spark):
    rng = random.Random(9)

    def new(n):
        return ["".join(rng.choices("abcdefghij", k=9)) for _ in range(n)]

    rows, planted = [], {}
    for edits in (5, 10, 15, 20, 24):
        for parts, length in ((2, 40), (3, 30), (4, 20)):
            for _ in range(16):
                pieces = [new(length) for _ in range(parts)]
                rows += [(len(rows) + i, new(20) + piece + new(20)) for i, piece in enumerate(pieces)]
                whole = [word for piece in pieces for word in piece]
                changed = list(whole)
                for at in rng.sample(range(len(whole)), edits * len(whole) // 100):
                    changed[at] = new(1)[0]
                holder, doc = len(rows), len(rows) + 1
                rows += [(holder, new(15) + whole + new(25)), (doc, new(20) + changed + new(9))]
                planted[doc] = (edits, holder)
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id bigint, text string")
    found = {(r.doc_id, r.other_id) for r in collinear.repeated_passages(frame).collect()}
    assert found <= {(doc, holder) for doc, (_, holder) in planted.items()}
    for edits in (5, 10, 15, 20, 24):
        of_edits = [(doc, holder) for doc, (e, holder) in planted.items() if e == edits]
        assert sum(pair in found for pair in of_edits) >= 0.9 * len(of_edits)


def test_a_failing_chain_is_cut_to_its_equal_parts():
    a, b = np.arange(1000, 1200), np.arange(2000, 2200)
    b[100:152] = a[100:152]
    b[20:26], b[170:176] = a[20:26], a[170:176]
    seeds = np.array([20, 21, *range(100, 147, 3), 170, 171])
    found = collinear.passages_of(a, b, np.stack([seeds, seeds], axis=1), 5, 50, 75)
    assert found == [(100, 152, 100, 152, 52)]


def test_chains_take_the_best():
    import numpy as np

    p, h = np.array([0, 5, 9, 10, 15]), np.array([100, 105, 3, 110, 115])
    assert [c.tolist() for c in collinear.chains(p, h)] == [[0, 1, 3, 4], [2]]
    assert collinear.common_words(np.array([1, 2, 3, 4]), np.array([2, 9, 4])) == 2


def test_secret_scan(spark, docs, nothing):
    random.seed(3)
    hexes = ["".join(random.choices("0123456789abcdef", k=40)) for _ in range(80)]
    rows = [(i, f"é the words token = \"{h}\" and Password: abc, api_key=Zz9/{h[:6]}") for i, h in enumerate(hexes)]
    rows += [(100 + i, "some longwordsofprosewithoutend here " * 3 + "x" * i) for i in range(60)]
    rows += [(500, "AKIA" + "A1" * 8 + " AKIA12"), (501, None), (502, ""), (502, "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = secret_scan.scan_secrets(frame, most=200).collect()
    assert len(found) == len(rows)
    kinds = {r.doc_id: [s.kind for s in r.spans] for r in found}
    assert kinds[0].count("assign") == 2 and kinds[0].count("hex") == 1
    assert kinds[500].count("access") == 1 and kinds[501] == [] and kinds[502] == []
    texts = dict(rows)
    for r in found:
        for s in r.spans:
            part = texts[r.doc_id][s.start : s.end]
            if s.kind == "hex":
                assert re.fullmatch("[0-9a-f]{32,}", part)
    clean = [r for r in found if 100 <= r.doc_id < 160]
    assert sum(bool(r.spans) for r in clean) <= 2
    assert secret_scan.scan_secrets(docs).count() == len(ROWS)
    assert secret_scan.scan_secrets(nothing).count() == 0


def test_secret_scan_looks_at_whole_tokens():
    key = "k3Jx9QmZ7vLp2RtY8wNc"
    text = "see https://hooks.example.com/services/T00000000/B00000000/" + key + " and\n"
    text += "/data/config/v1/AKIA" + "A1B2" * 5 + "-" + key + "tail/" + "z" * 200
    base = secret_scan.base_findings(text)
    found = secret_scan.candidates(text, base)
    assert [text[s:e] for s, e in found][1:] == ["/data/config/v1/", "-" + key + "tail/" + "z" * 200]
    seen = [(s, e, at) for s, e in found for at in secret_scan.windows(text, s, e)]
    for start, end in found:
        inside = {at + i for s, e, at in seen if s == start for i in range(min(secret_scan.TOKEN, e - at))}
        assert inside == set(range(start, end))
    assert text.index(key) in {at for _, _, at in seen}
    # one finding that reaches over two runs, and two findings in one run
    assert secret_scan.candidates("x" * 20 + " " + "y" * 40, [(18, 0, 25)]) == [(0, 18), (25, 61)]
    assert secret_scan.candidates("x" * 80, [(16, 0, 30), (20, 2, 50)]) == [(0, 16), (50, 80)]

    flat = secret_scan.Network(*[np.zeros(n) for n in [(256, 12), (60, 24), 24, 48, 1]], 1.0, 0.0, 0.5)
    asked = []

    def judged(rows, net):
        asked.extend(rows)
        # only a window that begins with the key is a secret
        mark = secret_scan.encoded(key, 0, len(key))[secret_scan.BEFORE :][: len(key)]
        return np.where((rows[:, secret_scan.BEFORE :][:, : len(key)] == mark).all(axis=1), 9.0, -9.0)

    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": [text]})
    original, secret_scan.logits = secret_scan.logits, judged
    try:
        scan = secret_scan._scan_function(type("Held", (), {"value": flat}))
        spans = next(scan([batch])).column("spans").to_pylist()[0]
    finally:
        secret_scan.logits = original
    assert sum(s["kind"] == "learned" for s in spans) == 2 and len(asked) == len(seen)


def test_secret_threshold_keeps_the_recall():
    rng = np.random.default_rng(5)
    # findings are rare and look like everything else, so that they score low
    rows = rng.integers(33, 120, (400, secret_scan.WIDTH)).astype(np.uint8)
    labels = (rng.random(400) < 0.2).astype(float)
    net = secret_scan.train_network(rows, labels)
    kept = np.random.default_rng(secret_scan.SEED).permutation(400)[:100]
    kept = kept[labels[kept] == 1]
    scores = secret_scan._sigmoid(net.scale * secret_scan.logits(rows[kept], net) + net.shift)
    assert (scores >= net.threshold).mean() >= secret_scan.LEAST_RECALL


def test_nearest_neighbours(spark):
    random.seed(2)
    centres = [[random.gauss(0, 1) for _ in range(16)] for _ in range(8)]
    rows = [(i, [c + random.gauss(0, 0.4) for c in centres[i % 8]]) for i in range(600)]
    rows += [(1000 + i, rows[0][1]) for i in range(30)] + [rows[5], (700, None), (800, [0.0] * 16)]
    rows += [(900, [float("nan")] * 16), (901, [None] * 16), (None, [1.0] * 16), (902, [1.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    vectors = cross_polytope.usable(frame, "vec_id", "embedding")
    held = {i: v for i, v in rows[:631] if v}
    assert vectors.distinct().count() == len(held) + 1
    found = defaultdict(list)
    asked = vectors.where("vec_id % 100 = 0 AND vec_id <> 900")
    for r in cross_polytope.nearest(vectors, asked).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.score, r.vec_id))
    recall = []
    for q in [i for i in held if i % 100 == 0]:
        exact = sorted((math.dist(held[q], v), i) for i, v in held.items() if i != q)[:10]
        assert [r for r in found[q]] == sorted(found[q]) and len(found[q]) == 10
        for score, i in found[q]:
            assert abs(score - math.dist(held[q], held[i])) < 1e-12
        recall.append(len({i for _, i in exact} & {i for _, i in found[q]}) / 10)
    assert sum(recall) / len(recall) >= 0.9
    assert [i for _, i in found[0]] == list(range(1000, 1010))
    assert cross_polytope.nearest(vectors.limit(0), asked).count() == 0


def test_nearest_neighbours_of_small_tables(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=64).tolist()) for i in range(5)]
    rows += [(10 + i, rng.normal(size=48).tolist()) for i in range(14)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    vectors = cross_polytope.usable(frame, "vec_id", "embedding")
    found = defaultdict(list)
    for r in cross_polytope.nearest(vectors, vectors).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.rank, r.vec_id))
    assert all(len(found[i]) == (4 if i < 10 else 10) for i, _ in rows)
    held = dict(rows)
    short = [(j, math.dist(held[0], held[j])) for j in range(1, 5)]
    assert [i for _, i in found[0]] == [j for j, _ in sorted(short, key=lambda x: x[1])]


def test_distances_of_very_large_and_small_vectors():
    rng = np.random.default_rng(3)
    for scale in (1e-300, 1e-170, 1.0, 1e155, 1e300):
        rows, query = rng.normal(size=(50, 8)), rng.normal(size=8)
        rows[7] = query
        want = np.array([math.dist(row, query) for row in rows])
        found = cross_polytope.distances(rows * scale, query * scale)
        assert found[7] == 0 and np.allclose(found / scale, want, rtol=1e-12)
        assert (np.argsort(found) == np.argsort(want)).all()


def test_nearest_neighbours_of_very_large_vectors(spark):
    rows = [(0, [1e200, 0.0]), (1, [3e200, 0.0]), (2, [2e200, 0.0]), (3, [1e-200, 1e-200]), (100, [1e-200, 2e-200])]
    vectors = cross_polytope.usable(
        spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), "vec_id", "embedding"
    )
    found = defaultdict(list)
    for r in cross_polytope.nearest(vectors, vectors).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    assert [i for i, _ in found[0]] == [2, 3, 100, 1]
    assert found[0][0][1] == 1e200 and found[3][0] == (100, 1e-200)


def nearest_in_a_chunk(x, ids, q, most):
    rng = np.random.default_rng(8)
    rows = {"rep": rng.permutation(len(x)), "vector": x.tolist(), "least_id": ids}
    asked = {"rep": [0], "vector": [q.tolist()]}
    out = cross_polytope._rerank_function(most)(pa.table(asked), pa.table(rows))
    by_rep = dict(zip(rows["rep"].tolist(), ids.tolist()))
    return [by_rep[rep] for rep in out.column("rep").to_pylist()]


def test_nearest_rows_of_a_chunk_with_ties():
    ids = np.random.default_rng(7).permutation(64)
    assert nearest_in_a_chunk(np.eye(64), ids, np.zeros(64), 11) == list(range(11))


def test_nearest_rows_of_a_chunk_with_an_offset():
    rng = np.random.default_rng(9)
    x = 1e9 + rng.normal(size=(500, 16))
    q = 1e9 + rng.normal(size=16)
    exact = sorted(range(500), key=lambda i: ((x[i] - q) ** 2).sum())[:11]
    assert nearest_in_a_chunk(x, np.arange(500), q, 11) == exact


def test_quality(spark, docs, nothing):
    random.seed(4)
    good = [" ".join(random.choices("abcdefgh", k=6)) + ". Plain words follow here, and end." for _ in range(150)]
    bad = [" ".join(w.upper() + "!!" for w in t.split()) for t in good]
    rows = list(enumerate(good + bad + [None, ""]))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = [(i, int(i < 150), 0) for i, t in rows if i < 300] + [(None, 1, 0), (3, None, 0), (9999, 1, 1)]
    labelled = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    scored = quality_knn.score_documents(frame, labelled)
    scored = scored.withColumn("held_out", quality_knn.is_held_out(scored.doc_id)).collect()
    held = [r for r in scored if r.held_out and r.doc_id < 300]
    assert len(scored) == len(rows) and held
    right = [(r.score >= quality_knn.THRESHOLD) == (r.doc_id < 150) for r in held]
    assert sum(right) >= 0.97 * len(right)
    empty = [r.score for r in scored if r.doc_id >= 300]
    assert all(0 <= s <= 1 for s in empty)
    flipped = labelled.withColumn(
        "quality", labelled.quality + quality_knn.is_held_out(labelled.doc_id).cast("int") * 5
    )
    again = {r.doc_id: r.score for r in quality_knn.score_documents(frame, flipped).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in scored)
    odd = quality_knn.score_documents(docs, labelled.limit(0))
    assert odd.columns == [c for c in docs.columns if c != "score"] + ["score"]
    assert {r.score for r in odd.collect()} == {0.5}
    assert quality_knn.score_documents(nothing, labelled).count() == 0


