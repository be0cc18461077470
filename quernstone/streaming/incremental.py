"""The pipeline's increments as streams: new files in, what is done left out, results replaced by paper."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.identity import unfinished
from ..sinks import write_by_paper
from ..sources.jsonl import exists


def run_available(spark: SparkSession, source: str, schema: str, step, target: str, checkpoint: str, files_per_batch: int | None = None) -> StreamingQuery:
    """step(rows) -> results with paper_id, for all files that came since the last run, a batch at a time. Papers of a batch replace themselves in the target, so a batch that is run again changes nothing."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "*.json*")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def batch(rows: DataFrame, _number: int):
        write_by_paper(step(rows), target)

    return reader.json(source).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def retry_failed(spark: SparkSession, papers: DataFrame, statuses: str) -> DataFrame:
    """papers without a finished status in the table at a path; all, if there is none."""
    return unfinished(papers, spark.read.parquet(statuses)) if exists(spark, statuses) else papers


def event_windows(events: DataFrame, window: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Counts and sums of events by type in windows of event time; works on tables and on streams, where late rows are waited for."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    out = rows.groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("window_start"), "event_type", "n", "total")
