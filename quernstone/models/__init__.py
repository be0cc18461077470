"""Model calls behind plain functions. The defaults need no network and always answer the same.

A classifier is rows -> Column (raw JSON text), an embedder texts -> vectors, an extractor (context, fields) -> (records, status). Calls are expensive: write or checkpoint what they return before using it twice.
"""

from __future__ import annotations

import hashlib
import inspect
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import any_match
from ..operators.screening import Criterion, paper_text

TRANSPORT = ("APIConnectionError", "APITimeoutError", "ConnectionError", "TimeoutError", "RateLimitError")
#: Chunks in a batch of a second try, and the number above which there is one.
SPLIT_SIZE, SPLIT_MIN = 5, 4
SPLIT_AFTER = ("failed:LengthFinishReasonError", "failed:APITimeoutError", "failed:TimeoutError")


def keyword_classifier(criteria: list[Criterion], words: dict[str, list[str]]):
    """Answers true if one of a criterion's words is in the paper's text, false if none is, uncertain without words."""

    def classify(_rows: DataFrame) -> Column:
        text = F.lower(paper_text())
        each = []
        for c in criteria:
            some = words.get(c.name) or []
            hit = F.lit(False)
            for w in some:
                hit = hit | text.contains(w.lower())
            answer = F.when(hit, "true").otherwise("false") if some else F.lit("uncertain")
            each.append(F.struct(answer.alias("answer"), F.lit("keyword").alias("reason")).alias(c.name))
        return F.to_json(F.struct(*each))

    return classify


def hash_embedding(text: str, size: int = 64) -> list[float]:
    """Signed counts of hashed words, to unit length."""
    v = np.zeros(size)
    for w in re.findall(r"\w+", (text or "").lower()):
        h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "big")
        v[h % size] += 1 if h >> 63 else -1
    n = np.linalg.norm(v)
    return (v / n if n else v).tolist()


def embed(rows: DataFrame, text: str = "text", batch: int = 32, function=hash_embedding, retries: int = 5) -> DataFrame:
    """rows with embedding, worked out batch by batch; a batch that fails is tried again."""
    import time

    def call(texts):
        for k in range(retries + 1):
            try:
                return [function(t) for t in texts]
            except Exception:  # noqa: BLE001  whatever a backend raises
                if k == retries:
                    raise
                time.sleep(min(30, 2 * 2**k))

    @F.pandas_udf("array<double>")
    def vectors(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield pd.Series([v for k in range(0, len(s), batch) for v in call(s.iloc[k : k + batch].tolist())], index=s.index)

    return rows.withColumn("embedding", vectors(F.col(text)))


def mock_extract(context: str, fields: list[str]) -> tuple[list[dict], str]:
    """One record from the first chunk of a context: its text for the first field, nothing for the others."""
    body = re.split(r"\n", re.sub(r"^\[CHUNK [^\n]*\]\n", "", context or ""), maxsplit=1)[0].strip()
    return ([{f: (body[:200] if k == 0 else None) for k, f in enumerate(fields)}], "ok") if body else ([], "ok:no_records")


def as_text(value) -> str | None:
    """Scalars as text, lists and objects as JSON."""
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False) if isinstance(value, (list, dict, bool)) else str(value)


def in_modes(function, context: str, fields: list[str], modes: tuple[str, ...]) -> tuple[list[dict], str]:
    """What the first output mode that works gives. An error of the connection ends the attempts, another lets the next mode try. A function that takes a third argument is told the mode."""
    told, status = len(inspect.signature(function).parameters) > 2, "failed"
    for mode in modes:
        try:
            return function(context, fields, mode) if told else function(context, fields)
        except Exception as e:  # noqa: BLE001  whatever a backend raises
            status = f"failed:{type(e).__name__}"
            if type(e).__name__ in TRANSPORT:
                break
    return [], status


def in_batches(call, parts: list[dict]) -> tuple[list[dict], str] | None:
    """A context that was too much, in smaller ones: the abstracts with SPLIT_SIZE other chunks each; a batch that is still too much goes chunk by chunk. None if nothing was found that way."""
    rest = [p["rendered"] for p in parts if p["chunk_type"] != "abstract"]
    head = [p["rendered"] for p in parts if p["chunk_type"] == "abstract"] if rest else []
    rest = rest or [p["rendered"] for p in parts]
    batches, found, failed = [rest[k : k + SPLIT_SIZE] for k in range(0, len(rest), SPLIT_SIZE)], [], 0
    for batch in batches:
        rows, status = call("\n\n".join([*head, *batch]))
        if status in SPLIT_AFTER and len(batch) > 1:
            answers = [call("\n\n".join([*head, one])) for one in batch]
        else:
            answers = [(rows, status)]
        for rows, status in answers:
            found += rows if status.startswith("ok") else []
            failed += not status.startswith("ok")
    if found:
        return found, f"ok:split_retry_partial:{len(batches)}_batches:{failed}_failed" if failed else f"ok:split_retry:{len(batches)}_batches"
    return None


def extract(contexts: DataFrame, fields: list[str], function=mock_extract, modes: tuple[str, ...] = ("records",)) -> DataFrame:
    """contexts (paper_id, context and, for a second try, parts: structs with chunk_type and rendered) -> paper_id, _pos, status and fields: a row a record; a paper without one has a row with _pos null.
    A context of more than SPLIT_MIN parts that fails for its length or time is tried again in batches."""
    schema = "paper_id string, _pos int, status string, " + ", ".join(f"`{f}` string" for f in fields)
    names = ["paper_id", "_pos", "status", *fields]

    def one(paper, context, parts):
        if not context:
            return [(paper, None, "skipped:no_context", *[None] * len(fields))]
        call = lambda text: in_modes(function, text, fields, modes)
        rows, status = call(context)
        if status in SPLIT_AFTER and parts is not None and len(parts) > SPLIT_MIN:
            rows, status = in_batches(call, list(parts)) or (rows, status)
        return [(paper, k, status, *(as_text(r.get(f)) for f in fields)) for k, r in enumerate(rows)] or [(paper, None, status, *[None] * len(fields))]

    def run(frames):
        for f in frames:
            parts = f["parts"] if "parts" in f else [None] * len(f)
            out = pd.DataFrame([r for p, c, x in zip(f["paper_id"], f["context"], parts, strict=True) for r in one(p, c, x)], columns=names)
            yield out.astype({"_pos": "Int32"})

    return contexts.select("paper_id", "context", *(["parts"] if "parts" in contexts.columns else [])).mapInPandas(run, schema)


def pattern_judge(rows: DataFrame, fields: list) -> Column:
    """The default confirmation: a chunk is relevant to a field if one of the field's patterns or keywords is in its text; a field without either takes all."""
    out = F.lit(True)
    for f in fields:
        patterns = [p for some in f.patterns.values() for p in some] + [re.escape(k) for k in f.keywords]
        out = F.when(F.col("field") == f.name, any_match("text", patterns)).otherwise(out)
    return out


def confirm(evidence: DataFrame, chunks: DataFrame, fields: list, judge=pattern_judge) -> DataFrame:
    """evidence (paper_id, field, chunk_id, ...) without the chunks that a judge finds irrelevant, for fields that ask for confirmation. judge: (rows with field and text, fields) -> Column of booleans; null, as from a call that failed, keeps the chunk."""
    asked = [f.name for f in fields if f.confirm]
    if not asked:
        return evidence
    rows = evidence.join(chunks.select("chunk_id", "text"), "chunk_id", "left")
    return rows.filter(~F.col("field").isin(asked) | F.coalesce(judge(rows, fields), F.lit(True))).select(*evidence.columns)
