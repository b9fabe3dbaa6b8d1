"""What op8 moves between tasks: the texts that a comparison wants, each once, and short keys."""

import numpy as np
import pyarrow as pa

from coterie.llm import jaccard_join
from coterie.llm.buffers import SpanHash, byte_view
from coterie.llm.exchange import keyed, texts_by_bucket


def prose(seed, n=60):
    rng = np.random.default_rng(seed)
    return [f"w{i}" for i in rng.integers(0, 5000, n)]


def near(words, at):
    return [*words[:at], "changed", *words[at + 1 :]]


def test_keys_of_a_bucket_take_thirteen_bytes():
    assert sum(np.dtype(t).itemsize for _, t in jaccard_join.KEY_TYPES) <= 13


def test_texts_that_no_join_wants_are_left(spark):
    rows = spark.range(-20_000, 20_000).selectExpr("xxhash64(id) AS node", "CAST(id AS STRING) AS text")
    wanted = rows.where("text % 500 = 0").select("node")
    kept = {r.node for r in jaccard_join.likely_among(rows, wanted.unionAll(wanted)).collect()}
    assert {r.node for r in wanted.collect()} <= kept and len(kept) < 90
    assert jaccard_join.likely_among(rows, wanted.where("false")).count() == 0


def test_a_node_has_one_text(spark):
    """A repeated doc_id of two texts gives each node its own text, repeated rows give one."""
    a, b = " ".join(prose(1)), " ".join(prose(2))
    docs = spark.createDataFrame([(1, a), (1, b), (1, a), (2, b), (3, "")], "doc_id bigint, text string")
    hashes, bounds = jaccard_join.shingle_sets(*byte_view(pa.array([a, b])), SpanHash(), 5)
    node_a, node_b = jaccard_join.set_nodes(hashes, bounds, np.arange(2)).tolist()
    wanted = spark.createDataFrame([(1, node_a, 0), (1, node_b, 0)], "doc_id bigint, node bigint, bucket int")
    measure = jaccard_join._size_function(5)
    found = measure(texts_by_bucket(keyed(docs), 1).toArrow(), wanted.toArrow()).to_pylist()
    assert sorted(r["n_shingles"] for r in found) == [0, 56, 56, 56, 56]
    texts = {r["node"]: r["text"] for r in found if r["text"] is not None}
    assert len(texts) == sum(r["text"] is not None for r in found) == 2
    sets = jaccard_join.sets_of([texts[node_a], texts[node_b]], SpanHash(), 5)
    assert np.array_equal(np.concatenate(sets), hashes)


def test_components_where_doc_ids_repeat(spark):
    a, b, c = prose(1), prose(2), prose(3)
    rows = [(5, a), (5, b), (2, near(a, 59)), (7, near(b, 0)), (9, c), (9, c), (8, near(c, 30)), (4, prose(4))]
    rows += [(100 + i, near(c, 59)[:-1] + [f"end{i}"]) for i in range(8)]
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id bigint, text string")
    found = jaccard_join.similar_components(frame).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == sorted(
        (i, 2 if i in (5, 2, 7) else 4 if i == 4 else 8) for i, _ in rows
    )
