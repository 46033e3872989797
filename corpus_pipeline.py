"""The corpus pipeline: quality filter, exact dedup, near-dedup, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every stage's result as
Parquet to the shared checkpoint folder and gives it to the next. All stages but the last return the
columns of ``documents``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickgate.llm import bpe, exact_dedup, mixing, near_dedup, quality
from tickgate.llm.common import read, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, scores at its limit or more."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.keep_distinct(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, with the smallest id, of each group of near-duplicates."""
    return near_dedup.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mix(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, with digests of the ids and of the decoded bytes."""
    return bpe.digests(docs)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("bpe", encode_stage),
]

# A fitted classifier and BPE are beyond SQL; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
