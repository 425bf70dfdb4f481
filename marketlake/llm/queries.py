"""Registered queries of the subpackage: name -> callable (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlake.llm import (
    alignment, chat, ctw, langid, mixing, neighbours, phrases, quality_rules, secrets, sentencepiece_scan, simhash, syncmers,
    token_files,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


QUERIES = {
    "op1_simhash_near_dedup": lambda spark, d: simhash.near_duplicate_query(_table(spark, d, "documents")),
    "op2_sentencepiece": lambda spark, d: sentencepiece_scan.sentencepiece_query(_table(spark, d, "documents")),
    "op3_document_fingerprints": lambda spark, d: syncmers.fingerprint_query(_table(spark, d, "documents")),
    "op4_secret_scans": lambda spark, d: secrets.find_secrets(_table(spark, d, "documents")),
    "op5_lm_scoring": lambda spark, d: ctw.scoring_query(_table(spark, d, "documents")),
    "op6_chat_formatting": lambda spark, d: chat.chat_query(_table(spark, d, "conversations")),
    "op7_mixing": lambda spark, d: mixing.mixing_query(_table(spark, d, "documents")),
    "op8_quality_rules": lambda spark, d: quality_rules.quality_query(
        _table(spark, d, "documents"), _table(spark, d, "labels")),
    "op9_quality_classifier": lambda spark, d: neighbours.classifier_query(
        _table(spark, d, "documents"), _table(spark, d, "labels")),
    "op10_language_id": lambda spark, d: langid.language_query(_table(spark, d, "documents")),
    "op11_token_files": lambda spark, d: token_files.token_file_query(_table(spark, d, "documents")),
    "op12_tokenizer_alignment": lambda spark, d: alignment.alignment_query(_table(spark, d, "documents")),
    "op13_phrase_mining": lambda spark, d: phrases.phrase_query(_table(spark, d, "documents")),
}

ORACLE_SQL: dict[str, str] = {"op6_chat_formatting": chat.CHAT_SQL, "op13_phrase_mining": phrases.PHRASE_SQL}
