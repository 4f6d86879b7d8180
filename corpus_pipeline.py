"""Corpus pipeline: language ID, exact dedup, near-dedup, mixing, byte-level BPE, each stage on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import bpe, exact_dedup, language_id, minhash, mixing
from riskframe.session import materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents to which language ID (2) gives one of the learned languages with a score of ``language_id.LEAST``
    or more; null texts and texts without a letter (``und``) go."""
    return language_id.keep_known(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of equal texts (10)."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of near-duplicates (3): five words, a similarity of 0.8 or more."""
    return minhash.deduplicate(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix (4) takes it; null and empty texts, which have no words, stay as they are."""
    return mixing.apply_mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (5) of each row, with their digests; a null text is an empty one, without ids."""
    return bpe.round_trip(docs)


STAGES = [("language_id", language), ("exact_dedup", exact), ("near_dedup", near), ("mix_sources", mixed), ("bpe", encoded)]

#: Language ID is a trained network, which SQL can't express; tests/llm checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs
