"""The registered queries against their SQL, and the pipeline stage by stage."""

import pytest
from oracle import compare, duck

import corpus_pipeline
from sparkdesk.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    diff, rows, _ = compare(spark, con, FOLDER, QUERIES[name], ORACLE.get(name))
    assert diff is None, diff
    assert rows


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        assert docs.count() <= before, name
        before = docs.count()
    assert docs.select("doc_id").distinct().count() == before
