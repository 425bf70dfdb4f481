"""Corpus pipeline: five stages over `documents`, each one operator of marketlake.llm.

Each stage takes what its predecessor kept, as Parquet, and returns a DataFrame with the columns
of documents (the last one adds ids, n_tokens and round_trip).  A null or empty text fails the first stage.  Of repeated rows,
which are near duplicates of each other, one stays; ties are broken as the operators' docstrings say.  Further columns go through all
stages as they are.  An empty table gives an empty result; without labels the first stage's base rules decide alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from marketlake.llm import mixing, quality_rules, secrets, sentencepiece_scan, simhash
from marketlake.session import checkpoint_dir, configure


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the trees fitted to the labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.keep_good(docs, quality_rules.fitted(docs, labels))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: four-word shingles, four bits."""
    return simhash.keep_one(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked."""
    return secrets.mask_secrets(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix of sources takes them: up to twice, and in part."""
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their ids, number of ids, and whether decoding the ids gives the text back."""
    return sentencepiece_scan.round_trips(docs)


STAGES = [
    ("quality_rules", good_documents),
    ("simhash_near_dedup", distinct_documents),
    ("secret_scans", without_secrets),
    ("mixing", mixed),
    ("sentencepiece", encoded),
]

#: Trees, fingerprints and draws have no SQL form; tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what lies between them is written to the shared checkpoint folder."""
    configure(spark)
    folder = f"{checkpoint_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
