"""The corpus pipeline: raw documents to training shards, each stage written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from oddsline.llm import decontamination, mixing, near_dedup, quality, sharding
from oddsline.llm.common import table, written

SHARDS = 16


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule, with the toxic words learned from the labels."""
    lexicon = quality.learned_lexicon(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, lexicon=lexicon)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near duplicates."""
    return near_dedup.keep_first(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no 10-word window with a benchmark item."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix reads them, in training order."""
    return mixing.mixed_documents(docs)


def training_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard of near equal bytes."""
    return sharding.with_shard(docs, SHARDS)


STAGES = [
    ("quality_rules", good_documents),
    ("minhash_near_dedup", one_of_each_group),
    ("benchmark_decontamination", clean_of_benchmark),
    ("curriculum_mixing", mixed_sources),
    ("kd_tree_sharding", training_shards),
]

#: None: the tree of the last stage is found by refined histograms, which SQL can't state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
