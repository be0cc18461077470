"""Results as files: JSON Lines, the flat CSV, one-object summaries, and incremental tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators.records import csv_rows
from .sources import jsonl

write_jsonl = jsonl.write


def write_csv(records: DataFrame, path: str, fields: list[str], numeric: list[str]) -> None:
    """A folder with UTF-8 CSV parts under one header each. The first column's name carries the byte-order mark that spreadsheets look for."""
    rows = csv_rows(records, fields, numeric)
    first = rows.columns[0]
    rows.withColumnRenamed(first, "﻿" + first).write.mode("overwrite").option("header", True).option("quoteAll", False).option("escape", '"').option("emptyValue", "").csv(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """A one-row table as one JSON object with the time of the run."""
    summary.limit(1).withColumn("generated_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")).coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_by_paper(rows: DataFrame, path: str) -> None:
    """Only the papers in rows are replaced; others stay. Idempotent, so a task or a run can be tried again."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("paper_id").parquet(path)


def upsert_new(rows: DataFrame, path: str, key: str = "chunk_id") -> DataFrame:
    """Rows whose key the table at path does not have are appended; they are returned."""
    spark = rows.sparkSession
    new = rows
    if jsonl.exists(spark, path):
        new = rows.join(spark.read.parquet(path).select(key), key, "left_anti")
    new.write.mode("append").parquet(path)
    return new


def write_screening(results: DataFrame, folder: str, results_too: bool = True) -> None:
    """Results (unless they are there already), passed and rejected rows and counts of a screening."""
    from .operators.screening import decision_counts, outputs

    passed, rejected = outputs(results)
    if results_too:
        write_jsonl(results, f"{folder}/filter_results")
    write_jsonl(passed, f"{folder}/passed")
    write_jsonl(rejected, f"{folder}/rejected")
    write_summary(decision_counts(results), f"{folder}/summary")
