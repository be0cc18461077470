"""The corpus pipeline: documents -> language filter -> near-duplicates -> repeated passages -> packed sequences.

Each stage is given all rows its predecessor kept. All but the last return the columns of documents; the last returns one row a piece of a packed sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.llm import jaccard, language_id, packing, substring
from quernstone.llm.common import NULL_ID, materialize, table
from quernstone.llm.queries import tokenizer


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language stay: `und` and texts that no learned language codes in fewer bits than their bytes have go."""
    return language_id.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by 5-word shingles (Jaccard similarity 0.8 or more) or fingerprints the one with the least id stays (of repeated rows, one)."""
    each = materialize(jaccard.groups(docs))
    # a group whose ids are all null keeps its rows without an id that differ
    keep = each.join(each.groupBy("group").agg(F.min("_id").alias("least")), "group").filter(F.col("_id") == F.col("least")).select("_id", "_row").distinct()
    rows = docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))).withColumn("_row", F.xxhash64(F.col("text").cast("string")))
    return rows.join(keep, ["_id", "_row"], "left_semi").dropDuplicates(["_id", "_row"]).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words or more that a document with a smaller id has are cut out; documents left without a word go."""
    return substring.deduplicate(docs).filter(F.col("text").rlike("[^\\x20\\x09-\\x0D]"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("packing", packed)]

#: Model scores, fingerprints and token ids have no SQL form; the pipeline is tested against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
