"""The corpus pipeline: from ``documents`` to token ids.

Each stage works on all rows that the one before it kept, and its result is
written as Parquet to the shared folder and read again. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagloom.llm import bpe, decontaminate, exact_dedup, nearjoin, quality
from tagloom.llm.catalog import rank_file, table
from tagloom.llm.store import removed, stored


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each normalised text."""
    return exact_dedup.distinct_documents(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that near copies connect."""
    return nearjoin.one_of_each(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of what they decode to."""
    return bpe.round_trip(docs, bpe.read_ranks(rank_file()), with_ids=True)


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", distinct),
    ("near_join", no_near_copies),
    ("decontaminate", no_benchmark),
    ("byte_bpe", encoded),
]
#: Models and tokenizers are beyond SQL; tests/llm hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        made = stored(stage(spark, docs, sf_dir), name)
        if k:
            removed(docs)
        docs = made
    return docs
