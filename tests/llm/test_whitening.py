"""Whitened embeddings against numpy."""

import math
import random

import numpy as np
import pytest

from coterie.llm import whitening
from coterie.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, x string, row int, whitened int, n string"


def want_rows(rows, size):
    """vec_id to (n, deviation, whitened by component or None, explained)."""
    kept = [
        (i, [math.floor(256 * float(np.float32(c))) for c in v])
        for i, v in rows
        if v is not None and len(v) == size and all(c is not None and math.isfinite(c) for c in v)
    ]
    fit = [list(x) for x in sorted({tuple(x) for _, x in kept})]
    n = len(fit)
    sums = [sum(column) for column in zip(*fit)]
    centred = np.array([[(n * v - s) / n for v, s in zip(x, sums)] for x in fit])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    want = []
    for i, x in kept:
        deviation = sum((n * v - s) ** 2 for v, s in zip(x, sums))
        row = np.array([(n * v - s) / n for v, s in zip(x, sums)])
        for k, e in enumerate(values):
            flat = e <= 1e-12 * np.trace(covariance)
            w = None if flat else float(row @ vectors[:, k] / np.sqrt(e))
            want.append((i, k + 1, n, deviation, w, float(e / np.trace(covariance)) if n > 1 else 0.0))
    return want


def compare(found, want):
    found = sorted(found, key=lambda r: (r.component, r.deviation, r.vec_id is None, r.vec_id))
    want = sorted(want, key=lambda r: (r[1], r[3], r[0] is None, r[0]))
    assert [tuple(r)[:4] for r in found] == [w[:4] for w in want]
    signs = {}
    for r, (_, component, _, _, w, explained) in zip(found, want):
        assert r.explained == pytest.approx(explained, rel=1e-9, abs=1e-12)
        assert (r.whitened is None) == (w is None)
        if w is not None and abs(w) > 1e-6:
            sign = signs.setdefault(component, np.sign(w * r.whitened))
            assert r.whitened == pytest.approx(sign * w, rel=1e-7, abs=1e-9)
            assert 0 <= r.identity_error < 1e-9


def test_odd_vectors(spark, monkeypatch):
    """Many blocks of few rows; the query's test has one."""
    monkeypatch.setattr(whitening, "LEAST_BLOCK_VALUES", 40)
    random.seed(8)
    rows = [(i, [random.gauss(0.1, s) for s in (1, 0.5, 0.2, 0.1, 0.05)]) for i in range(150)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]  # a hot vector
    rows += [(7, rows[3][1]), (7, rows[4][1]), (None, rows[5][1]), (None, None), (900, None)]
    rows += [(901, [1.0, None, 0.0, 0.0, 0.0]), (902, [math.nan] + [0.0] * 4), (903, [math.inf] + [0.0] * 4)]
    rows += [(904, []), (905, [-0.0] * 5), (906, [0.0] * 5)]
    rows += [(2000, [0.5, 0.25]), (2001, [0.5, -0.25]), (2002, [0.5, 0.75]), (3000, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame([(*r, "a", 1, 2, "b") for r in rows], SCHEMA).repartition(3)
    found = whitening.whiten(frame).collect()
    by_size = {size: {i for i, v in rows if v is not None and len(v) == size} for size in (2, 3, 5)}
    for size, ids in by_size.items():
        compare([r for r in found if r.vec_id in ids], want_rows(rows, size))
    assert {r.whitened for r in found if r.vec_id == 3000} == {None}
    assert whitening.whiten(frame.limit(0)).columns == whitening.whiten(frame).columns
    assert whitening.whiten(frame.where("vec_id = 900")).count() == 0


def test_large_entries(spark):
    """Whole numbers stay exact where squares leave 64 bits."""
    rows = [(1, [2.0**40, 1.0]), (2, [-(2.0**41), 3.0]), (3, [5.0, 2.0**20]), (4, [2.0**54, 1.0])]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id int, embedding array<double>"))
    found = found.collect()
    assert {r.vec_id for r in found} == {1, 2, 3} and all(r.deviation is None for r in found)
    x = np.array([[256.0 * c for c in v] for _, v in rows[:3]])
    covariance = np.cov(x.T, bias=True)
    top = np.linalg.eigh(covariance)[0][1] / np.trace(covariance)
    assert all(r.explained == pytest.approx(top, rel=1e-9) for r in found if r.component == 1)


def test_query(spark):
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    found = QUERIES["op13_embedding_whitening"].run(spark, SF_DIR).collect()
    compare(found, want_rows([tuple(r) for r in vectors], 64))
    assert len(found) == 4 * len(vectors)
