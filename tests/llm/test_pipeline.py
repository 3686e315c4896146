"""The pipeline's stages on the smallest tables, and the queries next to their SQL."""

from pathlib import Path

import pytest

import corpus_pipeline
from gramloom.llm import queries
from gramloom.llm.common import documents, stage
from tools.check_oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the given tables")


def test_stages(spark):
    docs = documents(spark, SF_DIR)
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, apply in corpus_pipeline.STAGES[:-1]:
        after = stage(apply(spark, docs, SF_DIR), "pipeline")
        assert after.dtypes == docs.dtypes, name
        now = {r.doc_id for r in after.select("doc_id").collect()}
        assert now <= ids and len(now) > 0.7 * len(ids), name
        docs, ids = after, now
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert {r.doc_id for r in rows} == ids
    assert len(corpus_pipeline.run(spark, SF_DIR).collect()) == len(rows)


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query_equals_oracle(spark, name):
    ok, rows, difference, _, _ = compare(spark, connect(SF_DIR), SF_DIR, name)
    assert ok, difference
    assert rows > 0
