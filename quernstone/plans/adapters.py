"""The standard tables seen as chunks, papers, candidates and records; each adapter has a Spark and an SQL form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.retrieve import Field


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SECTIONS = [["Introduction"], ["Methods"], ["Results"], ["Results", "Primary"], ["Discussion"], ["References"]]


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents as chunks."""
    lines = table(spark, sf_dir, "documents").select(F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("paper_id"), F.posexplode(F.split("text", "\n")).alias("chunk_index", "text"))
    paths = F.array(*(F.array(*map(F.lit, s)) for s in SECTIONS))
    i = F.col("chunk_index")
    return lines.select(
        "paper_id", F.format_string("%s::p%04d", "paper_id", i).alias("chunk_id"), i,
        F.when(i == 0, "abstract").when(i % 7 == 3, "table").otherwise("paragraph").alias("chunk_type"),
        F.element_at(paths, i % 6 + 1).alias("section_path"), "text",
        F.substring("text", 1, 40).alias("caption"), F.slice(F.split("text", " "), 1, 4).alias("headers"),
    )


CHUNKS = """lines AS (SELECT 'D' || doc_id AS paper_id, unnest(string_split(text, chr(10))) AS text, unnest(range(len(string_split(text, chr(10))))) AS chunk_index FROM documents),
chunks AS (SELECT paper_id, printf('%s::p%04d', paper_id, chunk_index) AS chunk_id, chunk_index,
  CASE WHEN chunk_index = 0 THEN 'abstract' WHEN chunk_index % 7 = 3 THEN 'table' ELSE 'paragraph' END AS chunk_type,
  ['Introduction', 'Methods', 'Results', 'Results > Primary', 'Discussion', 'References'][CAST(chunk_index % 6 + 1 AS INTEGER)] AS section, text,
  substr(text, 1, 40) AS caption, list_slice(string_split(text, ' '), 1, 4) AS headers FROM lines)"""

FIELDS = [
    Field("article", {"strong": [r"(^|[^a-z])the([^a-z]|$)"], "medium": [r"(^|[^a-z])and([^a-z]|$)"], "other": ["tion"]}, ["the", "tion"], include=["results"]),
    Field("romance", {"strong": [r"(^|[^a-z])de([^a-z]|$)"], "medium": [r"(^|[^a-z])la([^a-z]|$)"], "other": ["ment"]}, ["de", "ment"], include=["methods"], exclude=["references", "discussion"]),
]


def score_sql(f: Field, column: str = "text") -> str:
    weights = {"strong": 3.0, "medium": 1.5, "other": 1.0}
    return " + ".join(f"CASE WHEN regexp_matches({column}, '(?i){p}') THEN {weights[k]} ELSE 0 END" for k, some in f.patterns.items() for p in some)


def pool_sql(f: Field) -> str:
    from ..functions.fixed import SECTION_EXCLUDES

    hit = lambda words: " OR ".join(f"contains(lower(section), '{w}')" for w in words) or "FALSE"
    return f"CASE WHEN {hit(f.exclude or SECTION_EXCLUDES)} THEN 'excluded' WHEN {hit(f.include)} THEN 'preferred' ELSE 'fallback' END"


POOLED = "pooled AS (" + " UNION ALL ".join(f"SELECT *, '{f.name}' AS field, {k} AS field_ord, {pool_sql(f)} AS pool, {score_sql(f)} AS score FROM chunks" for k, f in enumerate(FIELDS)) + ")"


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as extracted records: amounts as text in seven shapes, a category and a brand."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand", "p_size")
    q = F.col("l_quantity").cast("int")
    n, text = F.col("l_linenumber"), lambda *parts: F.concat(*(p.cast("string") if not isinstance(p, str) else F.lit(p) for p in parts))
    # only the shape at hand is made: formats are slow, and the records are read more than once
    value = (
        F.when(n == 1, text(q, " months")).when(n == 2, text(q, "-", q + 5, " MPa")).when(n == 3, text(q, " +/- 2 GPa")).when(n == 4, text("<", q, " nm"))
        .when(n == 5, text(q, " (1-", q + 9, ") weeks")).when(n == 6, F.lit("not reported")).otherwise(text("grade ", q))
    )
    digits = n.cast("string")
    paper = F.concat(F.lit("O"), F.col("l_orderkey").cast("string"))
    return lines.join(parts, "l_partkey").select(
        paper.alias("paper_id"), F.concat(paper, F.lit("::r"), F.lpad(digits, F.greatest(F.length(digits), F.lit(4)), F.lit("0"))).alias("record_id"), value.alias("value"), F.col("p_type").alias("record_type"), F.col("p_brand").alias("endpoint"),
        F.array(F.concat(F.lit("c"), F.col("l_linenumber").cast("string"))).alias("source_chunk_ids"), F.col("l_linenumber").alias("_pos"), F.col("p_size").alias("size"), q.alias("quantity"),
    )


RECORDS = """records AS (SELECT 'O' || l_orderkey AS paper_id, printf('O%d::r%04d', l_orderkey, l_linenumber) AS record_id,
  CASE l_linenumber WHEN 1 THEN q || ' months' WHEN 2 THEN q || '-' || (q + 5) || ' MPa' WHEN 3 THEN q || ' +/- 2 GPa' WHEN 4 THEN '<' || q || ' nm' WHEN 5 THEN q || ' (1-' || (q + 9) || ') weeks' WHEN 6 THEN 'not reported' ELSE 'grade ' || q END AS value,
  p_type AS record_type, p_brand AS endpoint, 'c' || l_linenumber AS chunk, l_linenumber AS _pos, p_size AS size, q AS quantity
  FROM (SELECT *, CAST(l_quantity AS INTEGER) AS q FROM lineitem) JOIN part ON p_partkey = l_partkey)"""


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as bibliographic rows, with ids missing and repeated."""
    k = F.col("c_custkey")
    text = lambda cond, c: F.when(cond, c).otherwise(F.lit(""))
    return table(spark, sf_dir, "customer").select(
        text(k % 3 != 0, F.concat(F.lit("10.1/"), (k % 700).cast("string"))).alias("doi"), text(k % 4 == 0, (k % 500).cast("string")).alias("pmid"),
        text(k % 5 == 0, F.concat(F.lit("WOS:"), (k % 900).cast("string"))).alias("wos_uid"), F.col("c_name").alias("title"), text(k % 2 == 0, F.col("c_mktsegment")).alias("abstract"),
        F.lit("").alias("pmcid"), F.lit("metadata").alias("file_type"), k.alias("_pos"),
    )


CANDIDATES = """cands AS (SELECT CASE WHEN c_custkey % 3 <> 0 THEN '10.1/' || (c_custkey % 700) ELSE '' END AS doi, CASE WHEN c_custkey % 4 = 0 THEN CAST(c_custkey % 500 AS VARCHAR) ELSE '' END AS pmid,
  CASE WHEN c_custkey % 5 = 0 THEN 'WOS:' || (c_custkey % 900) ELSE '' END AS wos_uid, c_name AS title, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '' END AS abstract, c_custkey AS _pos FROM customer)"""
