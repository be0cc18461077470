"""Text functions as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import NO_VALUE, SPLIT_TOKENS, STOP_WORDS, TAIL_TOKENS, WORD_WEIGHT


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse(c) -> Column:
    """White space of any kind to one space, trimmed."""
    return F.trim(F.regexp_replace(col(c), r"(?U)\s+", " "))


def dedupe_text(c) -> Column:
    """Null to '', collapsed, lower case: the key of a value in cleanup."""
    return F.lower(collapse(F.coalesce(col(c).cast("string"), F.lit(""))))


def endpoint_text(c) -> Column:
    """Lower case; hyphens, dashes, underscores and slashes to spaces."""
    return F.coalesce(collapse(F.regexp_replace(F.lower(F.trim(col(c))), r"[\-‐-―_/]+", " ")), F.lit(""))


def compact(c) -> Column:
    """Only a-z and 0-9."""
    return F.regexp_replace(F.lower(col(c)), "[^a-z0-9]+", "")


def search_text(c) -> Column:
    """Lower case, without commas between digits, collapsed."""
    return collapse(F.regexp_replace(F.lower(col(c)), r"(?<=\d),(?=\d)", ""))


def quoted(text: str) -> str:
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def has_phrase(text, phrase) -> Column:
    """A phrase of up to three letters or digits needs word edges, any other is found anywhere. Both are Columns."""
    text, phrase = col(text), col(phrase)
    short = (F.length(phrase) <= 3) & phrase.rlike("^[a-z0-9]+$")
    edge = F.concat(F.lit("(?<![a-z0-9])"), phrase, F.lit("(?![a-z0-9])"))
    return (phrase != "") & F.when(short, F.regexp_like(text, edge)).otherwise(F.contains(text, phrase))


def numbers(c) -> Column:
    """Distinct unsigned numbers in a text."""
    return F.array_distinct(F.regexp_extract_all(col(c), F.lit(r"(?<![a-z0-9.])(\d+(?:\.\d+)?)"), F.lit(1)))


def has_number(text, number) -> Column:
    return F.regexp_like(col(text), F.concat(F.lit(r"(?<![\d.])"), F.replace(col(number), F.lit("."), F.lit("\\.")), F.lit(r"(?![\d.]*\d)")))


def tokens(c) -> Column:
    """Distinct words of three characters or more that are no stop words and not all digits."""
    found = F.array_distinct(F.regexp_extract_all(col(c), F.lit(r"([a-z0-9][a-z0-9+\-/]{2,})"), F.lit(1)))
    return F.filter(F.array_except(found, F.array(*map(F.lit, STOP_WORDS))), lambda w: ~w.rlike(r"^\d+$"))


def safe_id(c) -> Column:
    """Runs of other characters to _, no _ at the ends, `unknown` if nothing is left."""
    kept = F.trim(F.regexp_replace(col(c), "[^A-Za-z0-9_.-]+", "_"), F.lit("_"))
    return F.when(kept == "", "unknown").otherwise(kept)


def sentences(c) -> Column:
    """Cut after . ! ? before white space and a capital or digit (also behind an opening quote or bracket)."""
    return F.filter(F.transform(F.split(col(c), r"(?<=[.!?])(?U:\s+)(?=[\"'“(\[]?[A-Z0-9])"), lambda x: F.trim(x)), lambda s: s != "")


def token_estimate(c) -> Column:
    """A quarter of the characters, at least 1."""
    return F.greatest(F.lit(1), F.floor(F.length(col(c)) / 4)).cast("int")


def paragraph_chunks(c, limit: int = SPLIT_TOKENS, tail: int = TAIL_TOKENS) -> Column:
    """A paragraph within `limit` tokens whole; otherwise sentences gathered until they pass it, and cut there only if what is left has `tail` tokens or more."""
    text = collapse(c)
    parts = sentences(text)
    state = "struct<done:array<string>,open:array<string>,size:int,left:int>"
    sizes = F.aggregate(parts, F.lit(0), lambda a, s: a + token_estimate(s))
    start = F.struct(F.array().cast("array<string>").alias("done"), F.array().cast("array<string>").alias("open"), F.lit(0).alias("size"), sizes.alias("left")).cast(state)

    def step(acc, s):
        n = token_estimate(s)
        left = acc["left"] - n
        cut = (acc["size"] + n > limit) & (F.size(acc["open"]) > 0) & (acc["left"] >= tail)
        done = F.when(cut, F.concat(acc["done"], F.array(F.array_join(acc["open"], " ")))).otherwise(acc["done"])
        opened = F.when(cut, F.array(s)).otherwise(F.concat(acc["open"], F.array(s)))
        return F.struct(done.alias("done"), opened.alias("open"), F.when(cut, n).otherwise(acc["size"] + n).alias("size"), left.alias("left")).cast(state)

    def finish(acc):
        return F.when(F.size(acc["open"]) > 0, F.concat(acc["done"], F.array(F.array_join(acc["open"], " ")))).otherwise(acc["done"])

    return F.when(token_estimate(text) <= limit, F.array(text)).otherwise(F.aggregate(parts, start, step, finish))


def is_noise(c) -> Column:
    """Shorter than two characters, or without an ASCII letter or digit."""
    return (F.length(col(c)) < 2) | ~col(c).rlike("[A-Za-z0-9]")


def section_text(c) -> Column:
    return F.array_join(col(c), " > ")


def rendered(chunk_id, chunk_type, section_path, body) -> Column:
    """A chunk as it stands in a context: a head line with id, type and section, then the text."""
    head = F.concat_ws(" | ", F.concat(F.lit("CHUNK "), col(chunk_id)), col(chunk_type), F.nullif(section_text(section_path), F.lit("")))
    return F.concat(F.lit("["), head, F.lit("]\n"), col(body))


def raw_text(columns: list[str]) -> Column:
    """All that a chunk says of itself, of the columns there are: id, type, section, text, caption, table body, headers."""
    parts = [F.array_join(c, " ") if c in ("section_path", "headers") else F.col(c) for c in ("chunk_id", "chunk_type", "section_path", "text", "caption", "markdown_text", "headers") if c in columns]
    return F.concat_ws(" ", *parts)


def table_text(label, caption, headers, markdown, footnotes) -> Column:
    """A table as text for retrieval: label and caption, headers, body, notes; missing parts are left out."""
    part = lambda name, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(name), c))
    return F.concat_ws("\n", part("", F.concat_ws(". ", F.nullif(col(label), F.lit("")), F.nullif(col(caption), F.lit("")))), part("Headers: ", F.array_join(col(headers), " | ")), part("", col(markdown)), part("Footnotes: ", F.array_join(col(footnotes), " ")))


def pmcid(c) -> Column:
    """PMC ids with their prefix; digits alone get it."""
    up = F.upper(F.trim(col(c)))
    return F.when(up == "", None).when(up.rlike("^PMC"), up).when(up.rlike(r"^\d+$"), F.concat(F.lit("PMC"), up)).otherwise(up)


def match_score(value, text, weight: float, word: float = WORD_WEIGHT) -> Column:
    """How well a value is found in a (search-normalised) text: the whole phrase at the weight, its numbers at 0.7 of it, and its other words at `word` each up to half of the weight."""
    v = search_text(F.coalesce(col(value).cast("string"), F.lit("")))
    t = col(text)
    phrase = F.when(has_phrase(t, v), F.lit(weight)).otherwise(0.0)
    by_number = F.aggregate(numbers(v), F.lit(0.0), lambda a, n: a + F.when(has_number(t, n), F.lit(0.7 * weight)).otherwise(0.0))
    hits = F.size(F.filter(tokens(v), lambda w: F.contains(t, w)))
    return F.when((v == "") | v.isin(NO_VALUE), 0.0).otherwise(phrase + by_number + F.least(F.lit(0.5 * weight), word * hits))


def any_match(c, patterns: list[str]) -> Column:
    """Does any pattern (literal in the plan) match, whatever the case; no pattern: yes."""
    return reduce(lambda a, b: a | b, (col(c).rlike("(?i)" + p) for p in patterns)) if patterns else F.lit(True)


def json_object(c, schema) -> Column:
    """A JSON object from a model's answer: fences taken off, else the widest {...} in it."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(F.trim(col(c)), r"^```[a-zA-Z]*\s*", ""), r"\s*```$", ""))
    whole = F.when(bare.rlike(r"^\{"), F.from_json(bare, schema))
    return F.coalesce(whole, F.from_json(F.regexp_extract(bare, r"(?s)\{.*\}", 0), schema))


