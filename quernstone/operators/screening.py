"""Paper screening: candidate rows, answers to criteria, decisions and their outputs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import json_object
from .identity import given

PASSED = ["paper_id", "source_path", "source_file", "file_type", "title", "abstract", "doi", "pmid", "pmcid", "wos_uid", "metadata_quality", "reason"]
REJECTED = ["paper_id", "source_path", "source_file", "file_type", "title", "doi", "pmid", "wos_uid", "reason"]


@dataclass(frozen=True)
class Criterion:
    name: str
    question: str = ""
    required: bool = True
    uncertain_policy: str = "pass"


def candidate(rows: DataFrame) -> DataFrame:
    """A metadata row made ready: texts trimmed, text_for_filter from the abstract if missing, paper_id from the first id there is, quality parse_error without title and text."""
    text = lambda c: F.coalesce(given(c), F.lit("")) if c in rows.columns else F.lit("")
    names = ["title", "abstract", "text_for_filter", "doi", "pmid", "pmcid", "wos_uid", "paper_id"]
    out = rows.withColumns({c: text(c) for c in names})
    out = out.withColumn("text_for_filter", F.coalesce(F.nullif("text_for_filter", F.lit("")), F.col("abstract")))
    ids = [F.nullif(F.col(c), F.lit("")) for c in ("paper_id", "wos_uid", "pmid", "doi")]
    out = out.withColumn("paper_id", F.coalesce(*ids, F.nullif(F.substring("title", 1, 80), F.lit("")), F.lit("unknown")))
    known = F.col("metadata_quality") if "metadata_quality" in rows.columns else F.lit(None).cast("string")
    return out.withColumn("metadata_quality", F.when((F.col("title") == "") & (F.col("text_for_filter") == ""), "parse_error").otherwise(F.coalesce(known, F.lit("external_metadata"))))


ANSWERS = "map<string,struct<answer:string,reason:string>>"


def answers(raw, criteria: list[Criterion]) -> Column:
    """A model's JSON text as criterion -> (answer, reason); unknown answers and missing criteria are uncertain. Null if there is no JSON object."""
    parsed = json_object(raw, ANSWERS)

    def one(c: Criterion):
        got = F.lower(F.trim(parsed[c.name]["answer"]))
        return F.struct(F.when(got.isin("true", "false", "uncertain"), got).otherwise("uncertain").alias("answer"), F.coalesce(parsed[c.name]["reason"], F.lit("")).alias("reason"))

    asked = [x for c in criteria if c.required for x in (F.lit(c.name), one(c))]
    return F.when(parsed.isNotNull(), F.create_map(*asked) if asked else F.create_map().cast(ANSWERS))


def decide(results, criteria: list[Criterion]) -> tuple[Column, Column]:
    """(decision, reason): a required criterion that is false rejects, and so does an uncertain one if its policy says so. Reasons come in the order of the criteria."""
    results = F.col(results) if isinstance(results, str) else results
    needed = [c for c in criteria if c.required]

    def failure(c: Criterion):
        answer = F.coalesce(results[c.name]["answer"], F.lit("uncertain"))
        why = F.coalesce(results[c.name]["reason"], F.lit(""))
        bad = F.when(answer == "false", F.concat_ws(": ", F.lit(f"{c.name}=false"), F.nullif(why, F.lit(""))))
        return bad.when((answer == "uncertain") & F.lit(c.uncertain_policy == "reject"), F.concat_ws(": ", F.lit(f"{c.name}=uncertain"), F.nullif(why, F.lit(""))))

    failures = F.array_compact(F.array(*map(failure, needed))) if needed else F.array().cast("array<string>")
    return F.when(F.size(failures) > 0, "reject").otherwise("pass"), F.when(F.size(failures) > 0, F.array_join(failures, "; ")).otherwise("all required criteria passed")


def screen(rows: DataFrame, criteria: list[Criterion], classify, dry_run: bool = False) -> DataFrame:
    """rows with criteria, decision, reason, error. classify: rows' columns -> Column with the model's raw JSON text (null: the call failed)."""
    broken = F.col("metadata_quality") == "parse_error"
    bare = (F.coalesce("title", F.lit("")) == "") & (F.coalesce("text_for_filter", F.lit("")) == "")
    if dry_run:
        return rows.withColumn("criteria", F.create_map().cast(ANSWERS)).withColumn("decision", F.when(broken, "error").otherwise("dry_run")).withColumn("reason", F.lit("")).withColumn("error", F.when(broken, "metadata could not be read"))
    out = rows.withColumn("_raw", F.when(~broken & ~bare, classify(rows)))
    out = out.withColumn("criteria", answers("_raw", criteria))
    decision, reason = decide("criteria", criteria)
    empty, failed = bare & ~broken, ~bare & ~broken & F.col("criteria").isNull()
    out = out.withColumn("decision", F.when(broken, "error").when(empty | failed, "pass").otherwise(decision))
    out = out.withColumn("reason", F.when(broken, "").when(empty, "no metadata: passed by default").when(failed, "no answer: passed by default").otherwise(reason))
    return out.withColumn("error", F.when(broken, "metadata could not be read").when(failed, "no answer")).drop("_raw")


def outputs(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(passed, rejected) rows; missing columns and nulls are ''."""
    pick = lambda names: [(F.coalesce(F.col(c).cast("string"), F.lit("")) if c in results.columns else F.lit("")).alias(c) for c in names]
    return results.filter("decision = 'pass'").select(*pick(PASSED)), results.filter("decision = 'reject'").select(*pick(REJECTED))


def decision_counts(results: DataFrame) -> DataFrame:
    """total, passed, rejected, dry_run, error in one row; a decision of no known kind is an error."""
    known = {"passed": "pass", "rejected": "reject", "dry_run": "dry_run"}
    counts = [F.count_if(F.col("decision") == d).alias(n) for n, d in known.items()]
    return results.agg(F.count("*").alias("total"), *counts, F.count_if(~F.coalesce(F.col("decision").isin(*known.values()), F.lit(False))).alias("error"))


def paper_text(limit: int = 3000) -> Column:
    """What a classifier is shown: title, text up to the limit, and a note if the text is no abstract."""
    note = F.when(F.col("metadata_quality") == "html_front_matter", "Note: the text is the start of the page, not an abstract.").when(F.col("metadata_quality") == "title_only", "Note: only the title is known.")
    return F.concat_ws("\n", F.concat(F.lit("Title: "), F.nullif("title", F.lit(""))), F.concat(F.lit("Text: "), F.substring(F.nullif("text_for_filter", F.lit("")), 1, limit)), note)
