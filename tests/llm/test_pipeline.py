"""The pipeline's stages one after another, each held against its operator on the same input."""

from __future__ import annotations

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), name)
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[0] == sizes[1] > sizes[3] > 100
    want = {tuple(r) for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()}
    assert {tuple(r) for r in corpus_pipeline.run(spark, SF).collect()} == want and len(want) == sizes[-1]


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
