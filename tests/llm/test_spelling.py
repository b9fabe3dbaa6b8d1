"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from test_operators import ROWS, SCHEMA, UPPER

from coterie.llm import spelling


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_counts(rows, least_length, least_count, every):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}


def brute_variants(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[word] = best if best and counts[best] >= 5 * counts[word] else None
    rows = []
    for word, n in counts.items():
        root = word
        while form[root]:
            root = form[root]
        rows.append((word, n, len(near[word]), form[word], counts.get(form[word]), root))
    return sorted(rows)


def some_counts():
    random.seed(4)
    counts = {}
    for _ in range(250):
        word = "".join(random.choices("abcé÷ß", k=random.randint(1, 9)))
        counts[word] = random.choice([1, 2, 10, 60, 300, 1500, 8000])
    # a chain of forms, and a hot first half
    for i, n in enumerate([5, 25, 125, 625, 3125, 15625]):
        counts["zzzzzz" + "y" * i] = n
    for i in range(300):
        counts["common" + "".join(random.choices("defgh", k=5)) + "xyz"[i % 3]] = i + 1
    counts["a" * 5000], counts["a" * 4999 + "b"] = 3, 40
    return counts


@pytest.mark.parametrize("tile,shard", [(4096, 1 << 15), (50, 200)])
def test_variants(spark, monkeypatch, tile, shard):
    monkeypatch.setattr(spelling, "TILE_WORDS", tile)
    monkeypatch.setattr(spelling, "SHARD_WORDS", shard)
    counts = some_counts()
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    found = spelling.spelling_variants(words)
    assert found.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    want = brute_variants(counts)
    assert sorted(tuple(r) for r in found.collect()) == want
    assert any(row[0] != row[5] != row[3] for row in want)


def test_index():
    words = ["ab", "abc", "b", "ba", "cab"]
    index = spelling.FmIndex(*spelling._letters(words))
    codes, lengths = spelling._letters(["ab", "xx", "c"])
    query, word = spelling.one_error_matches(index, codes, np.cumsum(lengths), lengths, np.array([1, 1, 0]))
    # the last letter of "ab" stays; "c" may change
    assert [(q, words[w]) for q, w in zip(query.tolist(), word.tolist())] == [(0, "b"), (0, "cab"), (2, "b")]


def test_odd_documents(spark):
    rows = [row[:2] for row in ROWS] + [
        (900, "Ünïcode ÀÉÎ naïve×seven, Seven sEven " * 40),
        (901, "abcdefg" * 200_000),
        (902, "letters " * 100_000 + "lettrs lettes"),
        (902, "letters letterz"),
    ]
    odd = [(d, t, None, None, None, None, None) for d, t in rows]
    docs = spark.createDataFrame(odd, SCHEMA).repartition(3)
    for every in (199, 3):
        counts = brute_counts(rows, 3, 1, every)
        found = spelling.word_counts(docs, 3, 1, every)
        assert dict(tuple(r) for r in found.collect()) == counts
    found = spelling.spelling_variants(spelling.word_counts(docs))
    want = brute_variants(brute_counts(rows, 6, 5, 199))
    assert sorted(tuple(r) for r in found.collect()) == want
    empty = spelling.spelling_variants(spelling.word_counts(spark.createDataFrame([], SCHEMA)))
    assert empty.count() == 0
