"""The training-data pipeline over ``documents``: filter, deduplicate, decontaminate, mix, shard.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet
in the cluster's shared folder and read again as the next stage's ``docs``.  All stages but the
last return the columns of ``documents``; the last adds shard, slot and byte size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mallsight.llm import decontam, mixing, near_dedup, quality, sharding
from mallsight.llm.common import landed

SHARDS = 40


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among them, does not reject.

    NULL, empty and blank texts have no features and share the bias's verdict.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by similarity 0.8 of five-word shingles (the smallest id)."""
    return near_dedup.drop_near_duplicates(docs, shingle=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold less than 80 % of the five-word shingles of every benchmark item."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, repeated as the sources' weights 3, 1, 2 ask for, 150 % of all words in total."""
    return mixing.mixed_documents(docs, weights=(3, 1, 2), percent=150, limit=2)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes, numbered within each."""
    return sharding.sharded_documents(docs, SHARDS)


STAGES = [
    ("quality", quality_filter),
    ("near_dedup", near_dedup_filter),
    ("decontaminate", decontaminate),
    ("mix", mix_sources),
    ("shard", shard),
]

#: SQL cannot express the classifier's training; the tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply ``STAGES`` to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
