"""A training corpus from raw documents, in five stages, each written and read again as the next one's documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tripflow.llm import bpe, decontaminate, language, lines, simhash
from tripflow.llm.common import stored
from tripflow.llm.queries import RANKS, learnable_language


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; those rejected go."""
    return language.keep_identified(spark, docs, language.learn(docs, learnable_language()))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their source's boilerplate lines."""
    return lines.drop_boilerplate(spark, docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.one_of_each_group(spark, docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate.decontaminate(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the token ids and of what they decode to, per document."""
    return bpe.digests(spark, docs, RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_bpe", byte_bpe),
]

# Compression, SimHash and BPE have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return docs
