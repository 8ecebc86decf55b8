"""A training corpus from `documents`, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes it as Parquet to the folder that the
cluster shares and hands what it reads back to the next stage. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from enrichlake.llm import common, exact_dedup, mixing, ngram_join, packing, quality_rules


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.kept_documents(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.kept_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near copies: shingles of five words, similarity of 0.8 or more."""
    return ngram_join.kept_documents(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Four fifths of the tokens, by weight; one epoch, so no document comes twice behind deduplication."""
    return mixing.mixed_documents(docs, mixing.DOMAIN, "supply * 4 div 5", mixing.WEIGHTS, max_epochs=1, seed=mixing.SEED)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", rules),
    ("exact_dedup", exact),
    ("ngram_join", near),
    ("mixing", mix),
    ("packing", pack),
]

#: Token packing cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = common.Scratch(spark, "pipeline")
    docs = common.table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.store(stage(spark, docs, sf_dir), f"{i}-{name}")
    return docs
