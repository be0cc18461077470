"""Contexts within a budget, numeric evidence, and tracing records to chunks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed import CONTEXT_CHARS, CUE_WORDS, ENDPOINT_TERMS, NUMERIC_CHUNKS, OTHER_SECTIONS, POTENCY_TERMS, RESULT_SECTIONS, SOURCE_CHUNKS, SOURCE_WEIGHTS, VALUE_WITH_UNIT, WORD_WEIGHT
from ..functions.text import match_score, raw_text, search_text, section_text


def numeric_score(text, section_path, chunk_type, endpoint: str = ENDPOINT_TERMS, value: str = VALUE_WITH_UNIT) -> Column:
    """0 without an endpoint and a value with unit; else 1 and what the table, section, endpoint, cue words and number of values add or take."""
    text, section = F.col(text), F.lower(section_text(section_path))
    other = reduce(lambda a, b: a | b, (section.contains(s) for s in OTHER_SECTIONS))
    score = (
        F.lit(1.0)
        + F.when(F.col(chunk_type) == "table", 4.0).otherwise(0.0)
        + F.when(section.contains(RESULT_SECTIONS), 5.0).otherwise(0.0)
        - F.when(other, 4.0).otherwise(0.0)
        + F.when(text.rlike("(?i)" + POTENCY_TERMS), 4.0).otherwise(0.0)
        + F.when(text.rlike("(?i)" + CUE_WORDS), 1.5).otherwise(0.0)
        + 0.75 * F.least(F.size(F.regexp_extract_all(text, F.lit("(?i)(" + value + ")"), F.lit(1))), F.lit(4))
    )
    return F.when(text.rlike("(?i)" + endpoint) & text.rlike("(?i)" + value), score).otherwise(0.0)


def numeric_evidence(chunks: DataFrame, limit: int = NUMERIC_CHUNKS, endpoint: str = ENDPOINT_TERMS, value: str = VALUE_WITH_UNIT) -> DataFrame:
    """The best chunks of each paper by numeric score."""
    rows = chunks.withColumn("score", numeric_score("text", "section_path", "chunk_type", endpoint, value)).filter("score > 0")
    w = Window.partitionBy("paper_id").orderBy(F.desc("score"), "chunk_index", "chunk_id")
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)


def budgeted(candidates: DataFrame, limit: int = CONTEXT_CHARS) -> DataFrame:
    """candidates: paper_id, chunk_id, chunk_index, step (1 abstracts, 2 numeric evidence, 3 labeled), n_chars. Step 1 is kept whole; steps 2 and 3 are kept up to the first chunk that would
    pass the limit, step 3 after what step 2 kept. Lengths are positive, so the first overflow is where the running sum passes. context_order numbers the kept rows by step."""
    order = [F.col("chunk_index").asc_nulls_last(), F.col("chunk_id")]
    running = Window.partitionBy("paper_id", "step").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("paper_id")
    rows = candidates.withColumn("run", F.sum("n_chars").over(running))
    rows = rows.withColumn("base1", F.coalesce(F.sum(F.when(F.col("step") == 1, F.col("n_chars"))).over(whole), F.lit(0)))
    rows = rows.withColumn("keep2", (F.col("step") == 2) & (F.col("base1") + F.col("run") <= limit))
    rows = rows.withColumn("base3", F.col("base1") + F.coalesce(F.sum(F.when(F.col("keep2"), F.col("n_chars"))).over(whole), F.lit(0)))
    kept = rows.filter((F.col("step") == 1) | F.col("keep2") | ((F.col("step") == 3) & (F.col("base3") + F.col("run") <= limit)))
    return kept.withColumn("context_order", F.row_number().over(Window.partitionBy("paper_id").orderBy("step", *order))).drop("run", "base1", "base3", "keep2")


def candidates(chunks: DataFrame, labeled: DataFrame, evidence: DataFrame) -> DataFrame:
    """Abstracts, then numeric evidence, then labeled chunks, each chunk at its first step. labeled and evidence: paper_id, chunk_id."""
    flag = lambda rows, name: rows.select("paper_id", "chunk_id").distinct().withColumn(name, F.lit(True))
    rows = chunks.join(flag(evidence, "numeric"), ["paper_id", "chunk_id"], "left").join(flag(labeled, "labeled"), ["paper_id", "chunk_id"], "left")
    step = F.when(F.col("chunk_type") == "abstract", 1).when(F.col("numeric"), 2).when(F.col("labeled"), 3)
    return rows.withColumn("step", step).filter("step is not null").drop("numeric", "labeled")


def contexts(kept: DataFrame) -> DataFrame:
    """One row a paper: the texts (column rendered) in order as one context, the ids used, and the texts by themselves with their type."""
    rows = kept.groupBy("paper_id").agg(F.array_sort(F.collect_list(F.struct("context_order", "chunk_id", "chunk_type", "rendered"))).alias("rows"))
    return rows.select("paper_id", F.array_join("rows.rendered", "\n\n").alias("context"), F.col("rows.chunk_id").alias("used_chunk_ids"), F.transform("rows", lambda r: F.struct(r["chunk_type"].alias("chunk_type"), r["rendered"].alias("rendered"))).alias("parts"))


def attribute(records: DataFrame, used: DataFrame, fields: list[str], limit: int = SOURCE_CHUNKS, word: float = WORD_WEIGHT) -> DataFrame:
    """record_id with source_chunk_ids: the best matching chunks (used: paper_id, chunk_id, context_order, text and what else a chunk has) in context order; the first ones if none matches. word: what each word of a value adds."""
    pairs = records.join(used.select("paper_id", "chunk_id", "context_order", search_text(raw_text(used.columns)).alias("_t")), "paper_id")
    score = reduce(lambda a, b: a + b, (match_score(F.col(f), F.col("_t"), SOURCE_WEIGHTS.get(f, 1.0), word) for f in fields), F.lit(0.0))
    pairs = pairs.select("record_id", "chunk_id", "context_order", score.alias("score"))
    w = Window.partitionBy("record_id").orderBy(F.desc("score"), "context_order")
    best = Window.partitionBy("record_id")
    rows = pairs.withColumn("rank", F.row_number().over(w)).withColumn("any", F.max("score").over(best) > 0)
    rows = rows.filter((F.col("rank") <= limit) & ((F.col("score") > 0) | ~F.col("any")))
    return rows.groupBy("record_id").agg(F.array_sort(F.collect_list(F.struct("context_order", "chunk_id")))["chunk_id"].alias("source_chunk_ids"))

