"""Corpus pipeline: documents in, token digests out, in five stages.

Every stage is one operator of ``ledgerloom.llm``; its result is written as
Parquet and read again as the next stage's documents.

1. language id: documents without an identified language go.
2. line dedup: lines similar to an earlier line go; so do documents that lose
   all their words that way.
3. SimHash near-dedup: of linked documents the one with the smallest id stays.
4. mixing: sources to their target weights; a document stays as often as the
   mix takes it.
5. BPE: token counts and digests of ids and of the decoded text.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerloom.llm import bpe, langid, line_dedup, mixing, simhash  # noqa: E402
from ledgerloom.session import scratch_path  # noqa: E402


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_similar_lines(spark, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(spark, docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(spark, docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(docs)


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("mixing", mixture),
    ("bpe", tokens),
]

#: SQL can express neither the language model nor the merges: the tests hold
#: every stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
