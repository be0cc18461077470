"""The queries of this package, by name: each reads whole tables and returns its operator's full result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import ann, fingerprint, html_extract, language_id, licenses, ngram_lm, packing, sentencepiece_scan, simhash, substring
from .common import table


def tokenizer(name: str) -> str:
    """A file of the public vocabularies; read where it is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_scan.digest(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score(table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(table(spark, sf_dir, "documents"))


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).select("doc_id", "held_out", "lang_pred", "score", "bits_per_byte")


def queries():
    return {f.__name__: f for f in (op1_ann, op2_sentencepiece, op3_license_scan, op4_lm_scoring, op5_html_extraction, op6_simhash, op7_packing, op8_substring_dedup, op9_fingerprint, op10_language_id)}


def oracle_sql() -> dict[str, str]:
    from .sql import SQL

    return SQL
