"""The pipeline's stages on a small copy of documents: columns, decisions, empty input."""

import corpus_pipeline
from tagstream.llm import exact_dedup, partenum_join

SF = "/root/testdata/sf0.001"


def test_stages_follow_their_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "mix", "tokens"]
    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, at = at, stage(spark, at, SF).persist()
        assert at.columns == docs.columns
        ids = {r[0] for r in at.select("doc_id").collect()}
        if name == "exact_dedup":
            kept = exact_dedup.exact_dedup(spark, *exact_dedup.split_batches(before)).where("kept")
            assert ids == {r["doc_id"] for r in kept.collect()}
        if name == "near_dedup":
            comp = partenum_join.jaccard_components(spark, before, 5, 80, 100).where("component_id = doc_id")
            assert ids == {r["doc_id"] for r in comp.collect()}
    assert corpus_pipeline.STAGES[-1][1](spark, at, SF).count() == at.count()


def test_empty_documents_pass_through(spark):
    at = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, SF)
    assert at.count() == 0
