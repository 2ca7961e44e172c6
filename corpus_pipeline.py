"""A training-data pipeline over ``documents``: five stages, each one operator of surveyloom.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from surveyloom.llm import exact_dedup, language_id, minhash_dedup, mixing, packing
from surveyloom.llm.common import stored, table


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null text, no letter) go."""
    return language_id.keep_identified(docs)


def dedup_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id stays."""
    return exact_dedup.drop_exact(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8) the one with the smallest id stays."""
    return minhash_dedup.drop_near(docs, k=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in shares of 5, 2 and 1, none more than three times over; a document is repeated as often as the mix takes it."""
    return mixing.apply_mix(docs, weights=(5, 2, 1), max_repeat=3)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens, with their token ids."""
    return packing.pack_documents(docs, limit=1024, with_ids=True)


STAGES = [("language id", identify), ("exact dedup", dedup_exact), ("near dedup", dedup_near), ("mix", mix), ("pack", pack)]

#: SQL can't express the trained language model, nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
