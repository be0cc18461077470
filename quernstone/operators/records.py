"""Records: cleanup, constraints, standard terms, validity, duplicates, summaries."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed import NULL_TOKENS
from ..functions.numeric import cleaned, detect_unit, let, with_readings
from ..functions.text import compact, dedupe_text, endpoint_text


def first_by(rows: DataFrame, keys: list, order: list) -> DataFrame:
    """The first row of each key."""
    named = {f"_k{i}": k for i, k in enumerate(keys)}
    w = Window.partitionBy(*named).orderBy(*order)
    return rows.withColumns(named).withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n", *named)


def clean_records(records: DataFrame, fields: list[str], per: str = "paper_id") -> DataFrame:
    """One row for each set of field values (collapsed, lower case) of a paper: the first by _pos. Missing fields become null."""
    missing = {f: F.lit(None).cast("string") for f in fields if f not in records.columns}
    return first_by(records.withColumns(missing), [F.col(per), *(dedupe_text(f) for f in fields)], [F.col("_pos")])


def number_records(records: DataFrame) -> DataFrame:
    """record_id from the paper and the row's place in it."""
    w = Window.partitionBy("paper_id").orderBy("_pos")
    return records.withColumn("record_id", F.format_string("%s::r%04d", F.col("paper_id"), F.row_number().over(w)))


class EndpointConstraint:
    """Endpoints allowed for each type of record, and other names for them. The tables are literals of the plan: their size is the configuration's."""

    def __init__(self, allowed: dict[str, list[str]], aliases: dict[str, list[str]] | None = None):
        norm = lambda s: " ".join(__import__("re").sub(r"[\-‐-―_/]+", " ", s.strip().lower()).split())
        self.direct = {f"{norm(t)}\x1f{norm(e)}": e for t, some in allowed.items() for e in some}
        self.alias = {norm(a): norm(c) for c, some in (aliases or {}).items() for a in some}

    @classmethod
    def of(cls, config: dict | None) -> EndpointConstraint | None:
        """From configuration; None unless the mode is strict and something is allowed."""
        config = config or {}
        return cls(config["by_record_type"], config.get("aliases")) if config.get("mode") == "strict" and config.get("by_record_type") else None

    def resolve(self, record_type, endpoint) -> Column:
        """The canonical endpoint if the pair is allowed, else null."""
        table = lambda d: F.create_map(*(F.lit(x) for p in d.items() for x in p)) if d else F.create_map(F.lit(""), F.lit(""))
        direct, alias = table(self.direct), table(self.alias)
        kind, name = endpoint_text(record_type), endpoint_text(endpoint)
        key = lambda e: F.concat(kind, F.lit("\x1f"), e)
        return F.when(name != "", F.coalesce(direct[key(name)], direct[key(alias[name])]))

    def apply(self, records: DataFrame, record_type: str = "record_type", endpoint: str = "endpoint") -> DataFrame:
        return records.withColumn(endpoint, self.resolve(record_type, endpoint)).filter(F.col(endpoint).isNotNull())

    def rejected(self, records: DataFrame, record_type: str = "record_type", endpoint: str = "endpoint", *by: str) -> DataFrame:
        """Rejected rows by pair, as `type | endpoint` (and by more columns)."""
        shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
        return records.filter(self.resolve(record_type, endpoint).isNull()).groupBy(*by, F.concat(shown(record_type), F.lit(" | "), shown(endpoint)).alias("combo")).agg(F.count("*").alias("n"))


def standard_terms(c, terms: dict[str, list[str]], multiple: bool = False, match: str = "contains") -> Column:
    """Canonical terms for synonyms, in the order of the configuration: an exact hit (letters and digits only) first, else a contained alias (short ones as whole words); with `multiple`, all that occur,
    joined by '; '. Without a hit the text stays."""
    import re

    text = F.trim(F.col(c) if isinstance(c, str) else c)
    key = lambda s: re.sub("[^a-z0-9]+", "", s.lower())
    aliases = [(canonical, a, key(a)) for canonical, some in terms.items() for a in [canonical, *([some] if isinstance(some, str) else some or [])]]

    def body(v):
        short = compact(v)
        hit = lambda a, k: (v.rlike("(?i)\\b" + re.escape(a) + "\\b") if len(k) <= 3 and k.isalnum() else short.contains(k)) if k else F.lit(False)
        exact = reduce(lambda acc, x: acc.when(short == x[2], x[0]), aliases, F.when(F.lit(False), ""))
        if multiple:
            found = F.array_distinct(F.array_compact(F.array(*(F.when(hit(a, k), canonical) for canonical, a, k in aliases))))
            return F.coalesce(exact, F.when(F.size(found) > 0, F.array_join(found, "; ")), v)
        contained = reduce(lambda acc, x: acc.when(hit(x[1], x[2]), x[0]), aliases, F.when(F.lit(False), ""))
        return F.coalesce(exact, contained if match != "exact" else F.lit(None), v)

    return let(text, body)


@dataclass
class PostConfig:
    """numeric: field -> {unit, unit_from_field, detect_unit, parse_ranges, allow_multiple_numbers, integer}; standardize: field -> {terms, multiple, match}; validity lists; more null texts."""

    numeric: dict[str, dict] = field(default_factory=dict)
    standardize: dict[str, dict] = field(default_factory=dict)
    required_all: list[str] = field(default_factory=list)
    required_any: list[str] = field(default_factory=list)
    required_numeric_all: list[str] = field(default_factory=list)
    null_values: list[str] = field(default_factory=list)
    legacy_range_units: bool = False


def flagged(records: DataFrame, fields: list[str], config: PostConfig) -> DataFrame:
    """Every record with cleaned, standardised and numeric columns, and flags: invalid, invalid_numeric, n_standardized, n_parsed."""
    nulls = NULL_TOKENS + [v.lower() for v in config.null_values]
    rows = records.withColumns({f"_b_{f}": cleaned(f, nulls) for f in fields})
    values, norms, changed = {}, {}, []
    for f in fields:
        before = F.col(f"_b_{f}")
        if f in config.standardize:
            c = config.standardize[f]
            values[f] = standard_terms(before, c.get("terms", {}), bool(c.get("multiple")), c.get("match", "contains"))
            changed.append(F.when(~F.coalesce(values[f], F.lit("")).eqNullSafe(F.coalesce(before, F.lit(""))), 1).otherwise(0))
        else:
            values[f] = before
    for f, c in config.numeric.items():
        if f not in fields:
            continue
        unit = F.lit(c.get("unit")).cast("string")
        if c.get("unit_from_field"):
            unit = F.coalesce(detect_unit(F.col(f"_b_{c['unit_from_field']}")) if c["unit_from_field"] in fields else detect_unit(cleaned(c["unit_from_field"], nulls)), unit)
        options = {"detect": c.get("detect_unit", True), "ranges": c.get("parse_ranges", True), "several": c.get("allow_multiple_numbers", False), "legacy_range_units": config.legacy_range_units}
        norms[f"{f}_norm"] = (F.col(f"_b_{f}"), unit, options)
    rows = with_readings(rows, norms).withColumn("n_standardized", sum(changed, F.lit(0))).withColumns(values)
    whole = {n: F.col(n).withField("value", F.bround(F.col(f"{n}.value"))) for f, c in config.numeric.items() if c.get("integer") and (n := f"{f}_norm") in norms}
    rows = rows.withColumns(whole).drop(*(f"_b_{f}" for f in fields))
    there = lambda f: (F.coalesce(F.trim(F.col(f)), F.lit("")) != "") | (F.col(f"{f}_norm").isNotNull() if f"{f}_norm" in norms else F.lit(False))
    valid = reduce(lambda a, b: a & b, map(there, config.required_all), F.lit(True)) & reduce(lambda a, b: a | b, map(there, config.required_any or fields))
    numeric = reduce(lambda a, b: a & b, ((F.col(f"{f}_norm.value").isNotNull() if f"{f}_norm" in norms else F.lit(False)) for f in config.required_numeric_all), F.lit(True))
    parsed = sum((F.when(F.col(n).isNotNull(), 1).otherwise(0) for n in norms), F.lit(0))
    return rows.withColumn("n_parsed", parsed).withColumn("invalid", ~(valid & numeric)).withColumn("invalid_numeric", valid & ~numeric)


def post_key(fields: list[str], columns: list[str]) -> list[Column]:
    """What makes two records the same: a numeric reading without its raw text, else the text."""
    return [F.when(F.col(f"{f}_norm").isNotNull(), F.to_json(F.col(f"{f}_norm").dropFields("raw"), {"ignoreNullFields": "false"})).otherwise(dedupe_text(f)) if f"{f}_norm" in columns else dedupe_text(f) for f in fields]


def merge_duplicates(rows: DataFrame, fields: list[str]) -> DataFrame:
    """The first record of each key by _pos, with the chunk ids of all in order. Rows go once to their paper and are sorted there: most keys have one row, so nothing is gained by merging before that. Ids of one key are
    gathered; a key is one finding of one paper."""
    keys = {f"_k{i}": k for i, k in enumerate(post_key(fields, rows.columns))}
    w = Window.partitionBy("paper_id", *keys).orderBy("_pos", "source_chunk_ids")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = rows.withColumns(keys).repartition("paper_id").withColumns({"_n": F.row_number().over(w), "_ids": F.collect_list(F.struct("source_chunk_ids")).over(whole)}).filter("_n = 1")
    rest = [c for c in rows.columns if c not in ("source_chunk_ids",)]
    return out.select(*rest, F.array_distinct(F.flatten("_ids.source_chunk_ids")).alias("source_chunk_ids"))


def postprocess(records: DataFrame, fields: list[str], config: PostConfig) -> DataFrame:
    """records (paper_id, record_id, fields, source_chunk_ids, _pos) cleaned, standardised, read as numbers, validated and merged."""
    rows = flagged(records, fields, config).filter("not invalid").drop("invalid", "invalid_numeric", "n_standardized", "n_parsed")
    return merge_duplicates(rows, fields)


def postprocess_summary(records: DataFrame, fields: list[str], config: PostConfig) -> DataFrame:
    """One row of counts, in one pass over the records."""
    rows = flagged(records, fields, config)
    key = F.xxhash64("paper_id", *post_key(fields, rows.columns))
    out = rows.agg(
        F.count("*").alias("records_input"), F.count_if(~F.col("invalid")).alias("records_after_validation"), F.count_distinct(F.when(~F.col("invalid"), key)).alias("records_output"),
        F.count_if("invalid").alias("invalid_removed"), F.count_if("invalid_numeric").alias("invalid_numeric_removed"), F.sum("n_parsed").alias("numeric_values_parsed"), F.sum("n_standardized").alias("standardized_values"),
    )
    return out.withColumn("duplicates_removed", F.col("records_after_validation") - F.col("records_output"))


def csv_rows(records: DataFrame, fields: list[str], numeric: list[str]) -> DataFrame:
    """The flat export: ids, fields, six columns for each numeric field, chunk ids joined by ';'; nulls become ''."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    cols = [text(F.col("paper_id")).alias("paper_id"), text(F.col("record_id")).alias("record_id"), *(text(F.col(f)).alias(f) for f in fields)]
    for f in fields:
        if f in numeric:
            cols += [text(F.col(f"{f}_norm.{part}")).alias(f"{f}_{part}") for part in ("value", "unit", "operator", "value_min", "value_max", "error")]
    return records.select(*cols, F.array_join("source_chunk_ids", ";").alias("source_chunk_ids"))


def missing_parts(c_paper: Column, fields: list[str]) -> Column:
    """What a raw record lacks, as messages."""
    empty = reduce(lambda a, b: a & b, (F.coalesce(F.trim(F.col(f)), F.lit("")) == "" for f in fields), F.lit(True))
    return F.array_compact(F.array(F.when(F.coalesce(c_paper, F.lit("")) == "", "missing paper_id"), F.when(empty, "empty record")))
