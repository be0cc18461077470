"""Tagged-text exports of bibliographic records (two-character tags, `ER` at a record's end)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import collapse
from ..operators.identity import dedupe_candidates, paper_id

LISTS = ["AU", "AF", "DE", "ID", "C1", "RP"]


def records(files: DataFrame) -> DataFrame:
    """files: source_path, content (text). One row a record: source_path, record_no, fields (tag -> parts). A line that starts with a tag and white space opens a field, one that starts with a space goes on with it;
    a record ends at ER; a last record without it counts. What comes before the first record's tags belongs to it."""
    body = F.concat(F.regexp_replace("content", "\r\n?", "\n"), F.lit("\n"))
    parts = files.select("source_path", F.posexplode(F.split(body, r"(?m)^ER[ \t]*\n")).alias("record_no", "body"))
    # a continuation belongs to the line before it
    lines = F.split(F.regexp_replace("body", r"\n[ \t]+(?=\S)", "\x1e"), "\n")
    tagged = F.filter(lines, lambda x: x.rlike(r"^[A-Z0-9]{2}\s"))
    entry = F.transform(tagged, lambda x: F.struct(F.substring(x, 1, 2).alias("tag"), F.filter(F.transform(F.split(F.substring(x, 4, 1 << 30), "\x1e"), lambda x: F.trim(x)), lambda p: p != "").alias("parts")))
    tags = F.array_distinct(F.transform("entries", lambda e: e["tag"]))
    rows = parts.withColumn("entries", entry).filter(F.size("entries") > 0)
    whole = F.map_from_arrays(tags, F.transform(tags, lambda t: F.flatten(F.transform(F.filter("entries", lambda e: e["tag"] == t), lambda e: e["parts"]))))
    return rows.select("source_path", "record_no", whole.alias("fields"))


def normalise(rows: DataFrame) -> DataFrame:
    """Records as candidate papers; _pos is the place in file order."""
    text = lambda t: F.coalesce(collapse(F.array_join(F.col("fields")[t], " ")), F.lit(""))
    listed = lambda t: F.coalesce(F.filter(F.transform(F.flatten(F.transform(F.col("fields")[t], lambda p: F.split(p, ";"))), lambda x: F.trim(x)), lambda x: x != ""), F.array().cast("array<string>"))
    people = F.coalesce(F.col("fields")["AU"], F.array().cast("array<string>"))
    out = rows.select(
        F.lit("wos").alias("metadata_source"), "source_path", F.regexp_extract("source_path", r"([^/\\]+)$", 1).alias("source_file"), F.lit("metadata").alias("file_type"),
        text("TI").alias("title"), text("AB").alias("abstract"), text("AB").alias("text_for_filter"), text("DI").alias("doi"), text("PM").alias("pmid"), F.lit("").alias("pmcid"), text("UT").alias("wos_uid"),
        F.filter(F.flatten(F.transform(people, lambda p: F.split(p, ";"))), lambda x: F.trim(x) != "").alias("authors"), text("SO").alias("journal"), text("PY").alias("year"), text("DT").alias("document_type"),
        F.concat(listed("DE"), listed("ID")).alias("keywords"), "record_no",
    )
    bare = (F.col("title") == "") & (F.col("abstract") == "")
    out = out.withColumn("paper_id", paper_id()).withColumn("abstract_available", F.col("abstract") != "").withColumn("front_matter_used", F.lit(False))
    return out.withColumn("metadata_quality", F.when(bare, "title_only").otherwise("external_metadata")).withColumn("_pos", F.struct("source_path", "record_no"))


def read(spark: SparkSession, *paths: str) -> DataFrame:
    """Candidates of the .txt files at the paths (files or folders), duplicates dropped, first ones kept. A missing path raises."""
    if not paths:
        raise ValueError("no input path")
    paths = tuple(sorted(set(paths)))  # a path given twice is read once
    files = spark.read.option("pathGlobFilter", "*.txt").text(list(paths), wholetext=True).select(F.col("_metadata.file_path").alias("source_path"), F.col("value").alias("content"))
    return dedupe_candidates(normalise(records(files)))
