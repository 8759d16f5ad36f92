"""The registered text queries and the pipeline on the smallest tables."""

import compare
import pytest

import corpus_pipeline
from parcelhouse.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_against_sql(text_spark, small, name):
    assert compare.difference(text_spark, small, name) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE_SQL])
def test_one_row_per_document_or_piece(text_spark, small, name):
    found = QUERIES[name](text_spark, small)
    documents = text_spark.read.parquet(f"{small}/documents.parquet")
    if name not in ("op3_decontamination", "op9_packing"):
        assert found.count() == documents.count()
    assert found.join(documents, "doc_id", "left_anti").isEmpty()


def test_pipeline_runs_each_stage(text_spark, small):
    docs = text_spark.read.parquet(f"{small}/documents.parquet")
    packed = corpus_pipeline.run(text_spark, small)
    ids = {r["doc_id"] for r in packed.select("doc_id").distinct().collect()}
    stages = dict(corpus_pipeline.STAGES)
    left = docs
    for name in ("quality", "exact dedup", "near dedup", "decontamination"):
        kept = stages[name](text_spark, left, small)
        assert kept.columns == docs.columns
        kept_ids = {r["doc_id"] for r in kept.collect()}
        assert kept_ids <= {r["doc_id"] for r in left.collect()}
        left = docs.where(docs["doc_id"].isin(list(kept_ids)))
    assert ids == kept_ids
