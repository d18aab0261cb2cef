import os

import pytest

import corpus_pipeline

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def test_stages_keep_the_columns_and_thin_the_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, SF))
        assert docs.columns == columns
        seen.append((name, docs.count()))
    counts = [c for _, c in seen]
    assert [k for k, _ in seen] == ["toxicity", "exact_dedup", "ngram_jaccard", "pii"]
    assert n >= counts[0] > counts[1] >= counts[2] == counts[3] > n // 2
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == counts[3]


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
