"""The secret scan's patterns against plain ones, and what the network adds on planted secrets."""

import hashlib
import random
import re

import numpy as np

from coterie.llm import secret_scan
from coterie.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

NAMES = "password|passwd|secret|token|api_?key"


def plain_findings(text):
    """The contract's rules, letter by letter from its patterns."""
    found = []
    tail = re.compile(r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    at = 0
    while m := re.compile(NAMES, re.IGNORECASE | re.ASCII).search(text, at):
        value = tail.match(text, m.end())
        if value is None:
            at = m.start() + 1
            continue
        if len(value[1]) >= 8:
            found.append((m.start(), 0, value.end()))
        at = value.end()
    for kind, pattern, least in ((1, r"AKIA[A-Z0-9]+", 16), (2, r"[0-9a-f]+", 32)):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return sorted(found)


def digest(spans):
    listed = ",".join(f"{('assign', 'access', 'hex')[kind]}:{start}:{end}" for start, kind, end in spans)
    return hashlib.sha256(listed.encode()).hexdigest()


ODD = [
    None, "", "é token = 'abcdefgh' tokenpassword:12345678 apikey=1234567 API_KEY : \"Zz9/+_.=-\"",
    "secret==aaaaaaaa secret = = b" + "1" * 31 + " " + "0f" * 16 + "F", "AKIA" + "A1" * 6 + "x AKIAAKIA" + "B" * 12,
    "ſecret=12345678 toKen=12345678 paßword=1", "token=\ntoken  =  x1x1x1x1x", "a" * 300_000 + " passwd='" + "b" * 300_000,
]


def test_patterns(spark):
    for text in ODD:
        assert secret_scan.base_findings(text or "") == plain_findings(text or "")
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    texts = {r.doc_id: r.text or "" for r in rows}
    found = QUERIES["op10_secret_scan"].run(spark, SF_DIR).collect()
    assert len(found) == len(texts)
    for r in found:
        base = plain_findings(texts[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == kind for _, k, _ in base) for kind in range(3)]
        assert r.base_sha256 == digest(base)


def some_texts(chance, n):
    words = ["".join(chance.choices("abdeilnorstu", k=chance.randint(3, 11))) for _ in range(400)]
    noise = ["docs/readme-first.html", "2024-10-12T08:30:00", "snake_case_name_of_things", "v1.22.333-rc4", "x86_64", "10.1.2.30:8080"]

    def prose(k):
        return " ".join(chance.choices(words, k=k) + chance.choices(noise, k=3))

    return [prose(40) for _ in range(n)], prose


def test_planted_secrets_of_many_kinds(spark):
    """Documents the network is not trained on: recall over all kinds, and false alarms."""
    chance = random.Random(12)
    clean, prose = some_texts(chance, 250)
    shapes = [shape for shape in secret_scan.SHAPES for _ in range(12)]
    secrets = [p + "".join(chance.choices(a, k=chance.randint(least, most))) for _, p, a, least, most in shapes]
    texts = [prose(40) for _ in range(250)] + [f"{prose(9)} {value} {prose(9)}" for value in secrets]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    trained = spark.createDataFrame([(t,) for t in clean], "text string")
    rows = secret_scan.scan_secrets(frame, train_on=trained).collect()
    found = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in rows}
    hits = [
        any(s <= texts[250 + i].index(value) < e for s, e in found[250 + i]) for i, value in enumerate(secrets)
    ]
    assert np.mean(hits) >= 0.85
    assert sum(bool(found[i]) for i in range(250)) <= 8


def test_examples_are_tested_apart(spark):
    clean, _ = some_texts(random.Random(4), 120)
    frame = spark.createDataFrame([(t,) for t in clean] + [("token = " + "0a1b" * 10,)], "text string")
    held = secret_scan.examples(frame)
    assert {"finding", "finding, no name", "other", *[s[0] for s in secret_scan.SHAPES]} == set(held.kinds)
    # the name before a value is masked in the neutral copies
    neutral = held.rows[held.kinds == "finding, no name"]
    finding = held.rows[held.kinds == "finding"]
    token = slice(secret_scan.BEFORE, secret_scan.BEFORE + secret_scan.TOKEN)
    assert (neutral[:, token] == finding[:, token]).all() and not (neutral == finding).all()
    network, report = secret_scan.fit(held)
    assert network is not None and sum(n for n, _ in report.values()) < len(held.rows) / 3
    assert secret_scan.fit(None) == (None, {})


def test_short_candidates():
    text = "abcdefgh ab12cd34 12345678 abc1234 longlowercaseword x=y=z=12"
    found = [text[s:e] for s, e in secret_scan.candidates(text, [])]
    assert found == ["ab12cd34", "longlowercaseword", "x=y=z=12"]


def test_every_window_of_the_corpus_is_learned_from(spark):
    """Small parts: together they hold every different window once, and all of them are used."""
    chance = random.Random(5)
    texts, _ = some_texts(chance, 400)
    texts = [f"{t} {chance.randrange(10**9):09d}x" for t in texts]
    texts += [f"token = {chance.randrange(16**20):020x} {t[:30]}" for t in texts[:90]] + texts[:50] + [None]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").na.fill("")
    want = {0: set(), 1: set()}
    for text in set(texts) - {None}:
        base = secret_scan.base_findings(text)
        found = [(secret_scan.ASSIGN.match(text, s).start(2) if k == 0 else s, e) for s, k, e in base]
        for label, tokens in ((1, found), (0, secret_scan.candidates(text, base))):
            places = [(at, e) for s, e in tokens for at in secret_scan.windows(text, s, e)]
            want[label] |= {secret_scan.encoded(text, at, e).tobytes() for at, e in places}

    most, width = 128, secret_scan.WIDTH
    parts = secret_scan.window_parts(frame, most).collect()
    for label, name in ((0, "others"), (1, "findings")):
        blobs = [bytes(r[name]) for r in parts]
        rows = [blob[at : at + width] for blob in blobs for at in range(0, len(blob), width)]
        assert len(rows) == len(want[label]) and set(rows) == want[label]
    assert len(parts) > 6 and max(len(r.others + r.findings) for r in parts) < 2 * most * width

    held = [secret_scan._dealt_examples(r.asDict()) for r in parts]
    for examples, *uses in held:
        assert sorted(np.concatenate(uses).tolist()) == list(range(len(examples.rows)))
    net, report = secret_scan.learn(frame, most)
    tested = [kind for examples, chosen, _, _ in held for kind in examples.kinds[chosen]]
    assert {kind: n for kind, (n, _) in report.items()} == {kind: tested.count(kind) for kind in set(tested)}
    # the threshold keeps the recall over the kept-aside examples of all parts
    scores = []
    for examples, _, kept, _ in held:
        out = secret_scan.logits(examples.rows[kept][examples.labels[kept] == 1], net)
        scores += secret_scan._sigmoid(net.scale * out + net.shift).tolist()
    found = np.array(scores) >= net.threshold
    assert found.mean() >= secret_scan.LEAST_RECALL and np.array(scores).min() < net.threshold
    # neither the order of the rows nor the tasks that hold them matter
    again, _ = secret_scan.learn(frame.orderBy("text").repartition(3), most)
    assert all(np.array_equal(a, b) for a, b in zip(net, again, strict=True))
    assert report["other"][1] <= 0.05


def test_learning_without_other_candidates(spark):
    only = spark.createDataFrame([("token = " + "0a1b" * 10,), ("",)], "text string")
    assert secret_scan.learn(only) == (None, {})
    assert secret_scan.learn(only.where("false")) == (None, {})
    one = spark.createDataFrame([("abcdefgh12345 words",)], "text string")
    assert secret_scan.learn(one)[0] is not None
