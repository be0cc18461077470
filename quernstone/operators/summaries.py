"""Stage summaries: one-row or grouped counts, each in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def there(c: str):
    return F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) != ""


def ingest_summary(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("total"), F.count_if(there("doi")).alias("with_doi"), F.count_if(there("pmid")).alias("with_pmid"), F.count_if(there("abstract")).alias("with_abstract"))


def acquisition_summary(rows: DataFrame, statuses=("downloaded", "already_exists", "no_pmcid", "unavailable", "error")) -> DataFrame:
    return rows.agg(F.count("*").alias("total"), *(F.count_if(F.col("status") == s).alias(s) for s in statuses))


def chunk_summary(chunks: DataFrame) -> DataFrame:
    kinds = [F.count_if(F.col("chunk_type") == k).alias(f"n_{k}") for k in ("paragraph", "abstract", "table")]
    return chunks.agg(F.count("*").alias("total_chunks"), *kinds, F.count_distinct(F.when(there("paper_id"), F.col("paper_id"))).alias("parsed_ok"))


def skip_counts(now: DataFrame, before: DataFrame) -> DataFrame:
    """tag, n of two tables added up."""
    return now.unionByName(before).groupBy("tag").agg(F.sum("n").alias("n"))


def labels_by_field(labeled: DataFrame) -> DataFrame:
    each = labeled.select("paper_id", "chunk_id", F.explode("labels").alias("field"))
    papers = each.groupBy("field", "paper_id").agg(F.count("*").alias("n"))
    return papers.groupBy("field").agg(F.sum("n").alias("chunks"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("paper_id", "n")))).alias("papers"))


def labels_by_paper(labeled: DataFrame) -> DataFrame:
    return labeled.groupBy("paper_id").agg(F.count("*").alias("labeled_chunks"), F.sum(F.size("labels")).alias("assignments"))


def labeling_summary(labeled: DataFrame) -> DataFrame:
    return labeled.agg(F.count("*").alias("total_chunks"), F.coalesce(F.sum(F.size("labels")), F.lit(0)).alias("total_assignments"))


EXTRACTED = "paper_id string, status string, records_raw long, records_after_cleanup long, duplicates_removed long, endpoint_constraint_rejected long, rejected_by_combo map<string,long>, context_chunks_used long"
COUNTS = ("records_raw", "records_after_cleanup", "duplicates_removed", "endpoint_constraint_rejected")


def added(rows: DataFrame, column: str) -> DataFrame:
    """One row with a map whose values are the sums over the rows' maps."""
    each = rows.select(F.explode(column).alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n"))
    return each.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "n")))).alias(column))


def extraction_summary(papers: DataFrame, this_run: DataFrame | None = None, known: DataFrame | None = None) -> DataFrame:
    """papers: EXTRACTED, all so far; this_run: paper_ids tried now (None: all); known: all paper_ids that could be (None: those of papers). Counts, rejected pairs with their numbers, and the same for this run."""
    complete = F.coalesce(F.col("status").rlike("^(ok|skipped:no_context)"), F.lit(False))
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).alias(name)
    now = papers if this_run is None else papers.join(this_run.select("paper_id").distinct(), "paper_id", "left_semi")
    n_known = (papers if known is None else known).agg(F.count_distinct("paper_id").alias("total_papers_processed"))
    every = papers.agg(F.count_if(~complete).alias("total_papers_failed"), total("records_after_cleanup", "total_records_extracted"), *(total(c, c) for c in COUNTS))
    run = now.agg(F.count("*").alias("processed_this_run"), *(total(c, f"{c}_this_run") for c in COUNTS))
    out = n_known.crossJoin(every).crossJoin(run).crossJoin(added(papers, "rejected_by_combo"))  # rows of one each
    return out.withColumn("skipped_existing", F.col("total_papers_processed") - F.col("processed_this_run"))
