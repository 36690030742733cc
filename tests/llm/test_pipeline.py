"""The registered training-data queries and the pipeline on test tables."""

from __future__ import annotations

import check
import corpus_pipeline
import pytest
from groupledger.llm.queries import LLM_ORACLE, LLM_QUERIES

from ..conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    return check.connect(SMALL)


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_matches_sql(spark, duck, name):
    assert check.differences(spark, duck, name, SMALL) == []


def test_every_operator_is_registered():
    assert [f"op{n}_" for n in range(1, 14)] == [f"{name.split('_')[0]}_" for name in sorted(
        LLM_QUERIES, key=lambda x: int(x[2:].split("_")[0])
    )]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES, 1):
        out = stage(spark, docs, SMALL)
        if number < len(corpus_pipeline.STAGES):
            assert out.dtypes == docs.dtypes
            kept = [r.doc_id for r in out.select("doc_id").collect()]
            assert len(kept) == len(set(kept)) and set(kept) <= ids
            ids, docs = set(kept), out.cache()
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in rows} == ids
    assert all(r.round_trip for r in rows)


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0
