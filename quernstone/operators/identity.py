"""Who is who: ids, first-wins duplicates, what is done already, replacing by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import safe_id
from .records import first_by

IDS = ["paper_id", "pmcid", "pmid", "doi", "wos_uid"]


def given(c: str) -> Column:
    """The trimmed text, null if empty."""
    return F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))


def paper_id() -> Column:
    """From wos_uid, else pmid, doi, or the first 80 characters of the title."""
    uid = F.concat(F.lit("WOS_"), F.regexp_replace(given("wos_uid"), "^WOS:", ""))
    name = F.coalesce(uid, F.concat(F.lit("PMID_"), given("pmid")), F.concat(F.lit("DOI_"), given("doi")), F.concat(F.lit("WOS_TITLE_"), F.substring(given("title"), 1, 80)))
    return F.coalesce(safe_id(name), F.lit("unknown"))


def ingest_key() -> Column:
    """doi, else pmid, else wos_uid (each under its own tag), else title; lower case."""
    tagged = [F.concat(F.lit(f"{c}:"), F.lower(given(c))) for c in ("doi", "pmid", "wos_uid")]
    return F.coalesce(*tagged, F.concat(F.lit("title:"), F.coalesce(F.lower(given("title")), F.lit(""))))


def dedupe_candidates(rows: DataFrame) -> DataFrame:
    """The first row of each key by _pos."""
    return first_by(rows, [ingest_key()], [F.col("_pos")])


def identity_values(columns: list[str]) -> Column:
    """All ids of a row as texts; paths count unless the row is metadata only, and stand for their stem and name as well."""
    ids = [given(c) for c in IDS if c in columns]
    paths = [c for c in ("source_path", "source_file") if c in columns]
    if not paths:
        return F.array_distinct(F.array_compact(F.array(*ids)))
    kind = F.col("file_type") if "file_type" in columns else F.lit("")
    file = lambda c: [given(c), F.regexp_extract(given(c), r"([^/\\]+)$", 1), F.regexp_extract(given(c), r"([^/\\]+?)(?:\.[^./\\]*)?$", 1)]
    more = F.when(F.coalesce(kind, F.lit("")) == "metadata", F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*(x for c in paths for x in file(c)))))
    return F.array_distinct(F.filter(F.concat(F.array_compact(F.array(*ids)), more), lambda x: x != ""))


def pending(rows: DataFrame, done: DataFrame) -> DataFrame:
    """rows (with _pos) none of whose ids is an id of a done row; ids are compared as texts, whatever their column."""
    seen = done.select(F.explode(identity_values(done.columns)).alias("id")).distinct()
    hit = rows.select("_pos", F.explode(identity_values(rows.columns)).alias("id")).join(seen, "id", "left_semi").select("_pos").distinct()
    return rows.join(hit, "_pos", "left_anti")


def limited(rows: DataFrame, n: int | None) -> DataFrame:
    """The first n rows by _pos; None or 0: all."""
    return rows.orderBy("_pos").limit(n) if n else rows


def unfinished(papers: DataFrame, statuses: DataFrame) -> DataFrame:
    """papers without a status that starts with ok or skipped:no_context; failed ones come again."""
    return papers.join(statuses.filter(F.col("status").rlike("^(ok|skipped:no_context)")), "paper_id", "left_anti")


def acquired(rows: DataFrame, earlier: DataFrame) -> DataFrame:
    """rows not acquired earlier; errors come again."""
    return pending(rows, earlier.filter(F.coalesce(F.col("status"), F.lit("")) != "error"))


def replace_by_key(old: DataFrame, new: DataFrame, key: str = "paper_id") -> DataFrame:
    """old without the keys of new, and new."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def carried_errors(previous: DataFrame, attempted: DataFrame, parsed: DataFrame) -> DataFrame:
    """Earlier errors that were neither tried again nor parsed since."""
    return previous.join(attempted.select("paper_id").distinct(), "paper_id", "left_anti").join(parsed.select("paper_id").distinct(), "paper_id", "left_anti")


def dedupe_acquired(rows: DataFrame) -> DataFrame:
    """The first row for each smallest id; rows without any id stay."""
    least = F.array_min(identity_values(rows.columns))
    return first_by(rows, [F.coalesce(least, F.concat(F.lit("\x00"), F.col("_pos").cast("string")))], [F.col("_pos")])


def unknown_targets(targets: DataFrame, papers: DataFrame) -> DataFrame:
    """Wanted paper_ids that no paper has."""
    return targets.join(papers.select("paper_id").distinct(), "paper_id", "left_anti")
