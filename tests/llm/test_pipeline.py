"""The corpus pipeline, stage by stage, against brute force."""

import os
import sys

from odd_rows import documents, nothing, sf
from pyspark.sql import functions as F
from test_filters import dedup_of, verdicts
from test_ngram_join import components_of

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as pipeline  # noqa: E402

from enrichlake.llm import common  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    scratch = common.Scratch(spark, "t")
    docs = sf(spark, "documents")
    columns, before, taken = docs.columns, None, {}
    for name, stage in pipeline.STAGES:
        before, docs = docs, scratch.store(stage(spark, docs, SF), name)
        taken[name] = docs
        given = [(r["doc_id"], r["text"]) for r in before.select("doc_id", "text").collect()]
        got = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if name != "packing":
            assert docs.columns == columns
        if name == "quality_rules":
            assert got == {r[0] for r in verdicts([tuple(r) for r in before.select("doc_id", "text", "lang").collect()]) if r[-1]}
        if name == "exact_dedup":
            assert got == {r[0] for r in dedup_of(given) if r[3]}
        if name == "ngram_join":
            assert got == {i for i, _, c in components_of(given, 5, 80) if i == c}
        if name == "mixing":
            tokens = lambda df: sum(len(r["text"].encode().split()) for r in df.select("text").collect())
            assert tokens(docs) == tokens(before) * 4 // 5 and docs.count() == len(got)
    assert docs.select("doc_id").distinct().count() == taken["mixing"].count()
    assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_run_and_odd_rows(spark):
    assert pipeline.run(spark, SF).count() > 0
    docs = documents(spark)
    for name, stage in pipeline.STAGES:
        docs = common.Scratch(spark, "t").store(stage(spark, docs, SF), name)


def test_no_rows(spark):
    docs = nothing(spark)
    for name, stage in pipeline.STAGES:
        docs = common.Scratch(spark, "t").store(stage(spark, docs, SF), name)
        assert docs.count() == 0
