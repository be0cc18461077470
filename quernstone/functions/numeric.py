"""Numbers and units out of text, as Column expressions (no Python on the executors)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fixed import CANONICAL_UNITS, NULL_TOKENS, NUMBER, UNIT_FACTORS, UNIT_LADDER
from .text import col, collapse

NORM = "struct<raw:string,operator:string,value:double,value_min:double,value_max:double,error:double,unit:string>"


def cleaned(c, null_values: list[str] = NULL_TOKENS) -> Column:
    """Collapsed text; null for the texts that stand for no value."""
    text = collapse(col(c).cast("string"))
    return F.when(~F.lower(text).isin(null_values), text)


def number_text(c) -> Column:
    """Dashes and signs in ASCII; commas and spaces between groups of digits dropped."""
    t = F.translate(col(c), "−–—≈", "---~")
    t = F.replace(F.replace(t, F.lit("≤"), F.lit("<=")), F.lit("≥"), F.lit(">="))
    t = F.regexp_replace(t, r"(?<=\d),(?=\d{3}\b)", "")
    t = F.regexp_replace(t, r"(?U)(?<=\d)\s+(?=\d{3}\b)", "")
    return collapse(t)


def canonical_unit(c) -> Column:
    """The usual spelling of a unit; others stay as they are."""
    raw = F.trim(col(c))
    known = F.create_map(*(F.lit(x) for pair in CANONICAL_UNITS.items() for x in pair))
    return F.when(raw == "HR", "ratio").otherwise(F.coalesce(known[F.lower(raw)], raw))


def detect_unit(c) -> Column:
    """The first unit of the ladder that occurs."""
    out = None
    for pattern, unit in UNIT_LADDER:
        hit = col(c).rlike(pattern)
        if unit is None:
            found = F.regexp_extract(col(c), pattern, 0)
            found = F.translate(found, "µμ", "uu") if "nM" in pattern else canonical_unit(F.lower(found) if "kg" in pattern else found)
        else:
            found = F.lit(unit)
        out = F.when(hit, found) if out is None else out.when(hit, found)
    return out


def let(value, body) -> Column:
    """body(value) with the value worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def conversion(unit, target) -> Column:
    """struct (factor, unit): what a number is multiplied with, and the unit it then has. Units without a known factor stay; without a source unit the target is taken for it."""
    factors = F.create_map(*(F.lit(x) for (a, b), f in UNIT_FACTORS.items() for x in (f"{a}>{b}", f)))

    def settle(pair):
        source, goal = pair["source"], pair["goal"]
        no_goal, no_source = F.coalesce(goal, F.lit("")) == "", F.coalesce(source, F.lit("")) == ""
        factor = F.when(~no_goal & ~no_source, factors[F.concat(source, F.lit(">"), goal)])
        return F.struct(F.coalesce(factor, F.lit(1.0)).alias("factor"), F.when(no_goal, source).when(no_source | (source == goal) | factor.isNotNull(), goal).otherwise(source).alias("unit"))

    spelled = lambda raw: F.struct(canonical_unit(raw["source"]).alias("source"), canonical_unit(raw["goal"]).alias("goal"))
    return let(let(F.struct(unit.alias("source"), target.alias("goal")), spelled), settle)


def parse(raw, default_unit=None, detect: bool = True, ranges: bool = True, several: bool = False, legacy_range_units: bool = False) -> Column:
    """The numeric reading of a text as NORM, null if it has none. Tried in order: estimate with a range in brackets, plus-minus, range, single number. Bounds are converted
    from the unit of the text; legacy_range_units keeps an older reading in which the upper bound of a range was not converted (nor either bound in brackets)."""
    default = F.lit(default_unit).cast("string") if default_unit is None or isinstance(default_unit, str) else default_unit
    return let(cleaned(raw), lambda shown: let(number_text(shown), lambda text: reading(shown, text, default, detect, ranges, several, legacy_range_units)))


def with_readings(rows: DataFrame, wanted: dict[str, tuple[Column, Column | None, dict]]) -> DataFrame:
    """rows with a column of readings for each name -> (text, default unit, options of parse). Each distinct pair of text and unit is read once and joined back, null or not: reading costs far more than the shuffle of a short text."""
    # always true, but not known to be: a filter on readings is then not moved below `distinct`, where it would read every row
    once = F.monotonically_increasing_id() >= 0
    for name, (raw, unit, options) in wanted.items():
        unit = F.lit(None).cast("string") if unit is None else unit
        keyed = rows.withColumns({"_text": raw, "_unit": unit})
        read = keyed.select("_text", "_unit").filter("_text is not null").distinct().select(F.col("_text").alias("_t"), F.col("_unit").alias("_u"), F.when(once, parse("_text", F.col("_unit"), **options)).alias(name))
        rows = keyed.join(read, (F.col("_text") == F.col("_t")) & F.col("_unit").eqNullSafe(F.col("_u")), "left").drop("_text", "_unit", "_t", "_u")
    return rows


def reading(shown, text, default, detect, ranges, several, legacy) -> Column:
    number = lambda c: c.try_cast("double")
    tidy = lambda c: F.round(c, 10)
    nothing = F.lit(None).cast("double")
    unit = F.coalesce(detect_unit(text) if detect else F.lit(None).cast("string"), canonical_unit(default))
    spans = rf"(?i)({NUMBER})\s*(?:-|to|~|,)\s*({NUMBER})"
    bracket = rf"(?i)({NUMBER})\s*\(\s*({NUMBER})\s*(?:-|to|~)\s*({NUMBER})\s*\)"
    within = rf"(?i)({NUMBER})\s*(?:±|\+/-|\+-)\s*({NUMBER})"
    grade = rf"(?i)\bgrade\s+({NUMBER}(?:\s*(?:or|/|-|to)\s*{NUMBER})*)"
    facts = F.struct(
        conversion(unit, default).alias("to"),
        # a number right after a letter belongs to a name (p53, IC50)
        F.filter(F.regexp_extract_all(text, F.lit(rf"(\p{{L}}?{NUMBER})"), F.lit(1)), lambda n: ~n.rlike(r"^\p{L}")).alias("measured"),
        F.flatten(F.transform(F.regexp_extract_all(text, F.lit(grade), F.lit(1)), lambda g: F.regexp_extract_all(g, F.lit(f"({NUMBER})"), F.lit(1)))).alias("grades"),
        F.try_element_at(F.regexp_extract_all(text, F.lit(spans), F.lit(0)), F.lit(-1)).alias("span"),
    )

    def choose(fact):
        factor, out = fact["to"]["factor"], fact["to"]["unit"]
        half = F.lit(1.0) if legacy else factor

        def norm(operator, value, low=nothing, high=nothing, error=nothing):
            return F.struct(shown.alias("raw"), operator.alias("operator"), tidy(value).alias("value"), tidy(low).alias("value_min"), tidy(high).alias("value_max"), tidy(error).alias("error"), out.alias("unit")).cast(NORM)

        at = lambda c, pattern, k: number(F.regexp_extract(c, pattern, k))
        b, c = at(text, bracket, 2), at(text, bracket, 3)
        bracketed = norm(F.lit("reported_with_range"), at(text, bracket, 1) * factor, F.least(b, c) * half, F.greatest(b, c) * half)
        plus_minus = norm(F.lit("plus_minus"), at(text, within, 1) * factor, error=F.abs(at(text, within, 2)) * factor)
        left, right = at(fact["span"], spans, 1), at(fact["span"], spans, 2)
        low, high = F.least(left, right) * factor, F.greatest(left, right) * half
        spanned = norm(F.lit("range"), (low + high) / 2, low, high)
        operator = F.when(text.contains("<="), "<=").when(text.contains(">="), ">=").when(text.rlike(r"(^|\s)<"), "<").when(text.rlike(r"(^|\s)>"), ">").when(text.rlike(r"(?i)(^|\s)(~|about|around|approx\.?|approximately)\b"), "approx").otherwise("eq")
        value = number(F.get(fact["measured"], F.lit(0))) * factor
        single = norm(operator, value, F.when(operator.isin(">", ">="), value), F.when(operator.isin("<", "<="), value))
        count = F.size(fact["measured"])
        only_grades = ~text.rlike(r"(?i)%|\bpercent(?:age)?\b") & (count > 0) & (F.size(fact["grades"]) > 0) & (F.array_sort(fact["measured"]) == F.array_sort(fact["grades"]))
        result = F.when(shown.isNull(), None).when(text.rlike(bracket), bracketed).when(text.rlike(within), plus_minus).when(only_grades, None)
        if ranges:
            result = result.when(fact["span"].isNotNull(), F.when(F.lit(several) | (count == 2), spanned))
        return result.when((F.lit(several) & (count > 0)) | (count == 1), single)

    return let(facts, choose)
