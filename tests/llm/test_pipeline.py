"""The corpus pipeline's stages against their operators, on the smallest tables."""

import os

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
def test_pipeline_keeps_contracts(spark):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [len(s) for s in c.STAGES] == [2] * 5
    now, ids = docs, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in c.STAGES[:-1]:
        now = c.materialize(stage(spark, now, SMALL), "test")
        assert now.columns == docs.columns
        kept = {r.doc_id for r in now.select("doc_id").collect()}
        assert kept <= ids and len(kept) == now.count(), name
        ids = kept
    assert now.where("n_chars <> length(text)").count() == 0
    assert {r.doc_id for r in c.run(spark, SMALL).select("doc_id").collect()} == ids
