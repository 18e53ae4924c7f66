"""The registered queries of the subpackage and the pipeline."""

from __future__ import annotations

import importlib

import pytest
from compare import difference, duck

from textkg.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), duck(SF_DIR), ORACLES[name]) is None


def test_pipeline_stage_by_stage(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in pipeline.STAGES[:-1]:
        docs = pipeline.cut_lineage(stage(spark, docs, SF_DIR))
        assert docs.columns == names, name
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left <= ids and len(left) > 0.5 * len(ids)
        ids = left
    assert docs.filter("n_chars <> length(text)").count() == 0
    packed = pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == ids


def test_pipeline_on_no_documents(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        docs = pipeline.cut_lineage(stage(spark, docs, SF_DIR))
        assert docs.count() == 0
