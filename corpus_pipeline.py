"""The corpus pipeline: five stages over ``documents``, each on all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfspark.llm import bpe, decontaminate, neardup, suffixdedup, toxicity
from shelfspark.llm.util import materialize


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return neardup.keep_representatives(docs)


def _suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the 100-byte strings that start earlier."""
    return suffixdedup.drop_repeats(docs)


def _decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length and digests of each text's tokens and of the text decoded from them."""
    return bpe.digests(bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("toxicity", _toxicity),
    ("minhash_near_dedup", _near_dedup),
    ("suffix_array_dedup", _suffix_dedup),
    ("benchmark_decontamination", _decontaminate),
    ("bpe_encoding", _encode),
]

#: Learned scores, sketches and merges have no SQL form; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
