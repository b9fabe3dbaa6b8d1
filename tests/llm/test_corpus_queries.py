"""The registered corpus queries against their SQL, and the pipeline's stages."""

import pytest
from oracle import connect, difference

import corpus_pipeline
from coterie.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [name for name, query in QUERIES.items() if query.sql])
def test_query(spark, name):
    assert difference(spark, connect(SF_DIR), SF_DIR, QUERIES[name].run, QUERIES[name].sql) is None


def test_pipeline(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = {r.doc_id: r for r in documents.collect()}
    result = corpus_pipeline.run(spark, SF_DIR)
    assert result.columns == [*documents.columns, "shard"]
    found = result.collect()
    assert 0.6 * len(rows) < len({r.doc_id for r in found}) < len(rows)
    for r in found:
        assert tuple(r)[:-1] == tuple(rows[r.doc_id]) and 0 <= r.shard < corpus_pipeline.SHARDS
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality classifier"


@pytest.mark.parametrize("stage", range(5))
def test_stage_on_odd_rows(spark, stage):
    from test_operators import ROWS, SCHEMA

    schema = SCHEMA.replace("bucket", "n_words").replace("kind", "shard")
    docs = spark.createDataFrame(ROWS, schema)
    name, run = corpus_pipeline.STAGES[stage]
    result = run(spark, docs, SF_DIR)
    assert set(docs.columns) <= set(result.columns)
    known = {tuple(row)[:6] for row in docs.collect()}
    assert {tuple(row)[:6] for row in result.select(*docs.columns).collect()} <= known
    assert run(spark, docs.limit(0), SF_DIR).count() == 0


@pytest.mark.parametrize("stage", [0, 3])
def test_stage_keeps_columns_of_its_own_names(spark, stage):
    from test_operators import ROWS

    names = ["_score", "score", "_copy", "_times", "_id", "_text", "_source", "_key"]
    rows = [(d, t, "en", s, *[f"{name}{d}" for name in names]) for d, t, _, s, *_ in ROWS]
    schema = "doc_id bigint, text string, lang string, source string, "
    docs = spark.createDataFrame(rows, schema + ", ".join(f"{name} string" for name in names))
    result = corpus_pipeline.STAGES[stage][1](spark, docs, SF_DIR)
    assert result.columns == docs.columns
    found = [tuple(r) for r in result.collect()]
    assert found and set(found) <= {tuple(r) for r in docs.collect()}
