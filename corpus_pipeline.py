"""Corpus pipeline: toxicity, quality rules, near-duplicates, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers
from tidemark.llm import near_copies, packing, quality, toxicity
from tidemark.llm.common import freeze, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.near_dedup(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality", quality_stage),
    ("near_dedup", dedup_stage),
    ("packing", pack_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = freeze(docs, f"stage-{name}")
    return docs


# Trained scores and tokens have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None
