import pytest
from pyspark.sql import functions as F

from quernstone.functions import numeric, text

CASES = [  # text, unit, several, operator, value, min, max, error, unit
    ("200-300 MPa", "MPa", False, ("range", 250, 200, 300, None, "MPa")),
    ("<0.001", None, False, ("<", 0.001, None, 0.001, None, None)),
    (">= 5 days", None, False, (">=", 5, 5, None, None, "day")),
    ("500 nm", "um", False, ("eq", 0.5, None, None, None, "um")),
    ("500-1000 nm", "um", False, ("range", 0.75, 0.5, 1, None, "um")),
    ("20 min", None, False, ("eq", 20, None, None, None, "min")),
    ("72 h", None, False, ("eq", 72, None, None, None, "h")),
    ("72h", None, False, ("eq", 72, None, None, None, None)),
    ("0.63 HR", None, False, ("eq", 0.63, None, None, None, "ratio")),
    ("0.43 hazard ratio", None, False, ("eq", 0.43, None, None, None, "ratio")),
    ("17.1 (0.6-61.9) months", None, False, ("reported_with_range", 17.1, 0.6, 61.9, None, "month")),
    ("5.8 ± 31.1", None, False, ("plus_minus", 5.8, None, None, 31.1, None)),
    ("120 mg/m2 for 30 min", None, True, ("eq", 120, None, None, None, "mg/m2")),
    ("120 mg/m2 for 30 min", None, False, None),
    ("liver 7 (33%), lung 2 (10%)", None, False, None),
    ("grade 1 hypertension", None, False, None),
    ("increase of G2 phase cells", None, False, None),
    ("IC50 35.25 nM", None, False, ("eq", 35.25, None, None, None, "nM")),
    ("5 100 mg", None, False, ("eq", 5100, None, None, None, None)),
    ("1,200 days", None, False, ("eq", 1200, None, None, None, "day")),
    ("about 5 months", None, False, ("approx", 5, None, None, None, "month")),
    ("3, 5 days", None, False, ("range", 4, 3, 5, None, "day")),
    ("2 years", "month", False, ("eq", 24, None, None, None, "month")),
    ("−5 °C", None, False, ("eq", -5, None, None, None, "C")),
    ("not reported", None, False, None),
    ("", None, False, None),
    (None, None, False, None),
]


@pytest.mark.parametrize("several", [False, True])
def test_numeric_reading(spark, several):
    some = [c for c in CASES if c[2] == several]
    rows = spark.createDataFrame([(k, c[0], c[1]) for k, c in enumerate(some)], "k int, raw string, unit string")
    got = {r.k: r.n for r in rows.select("k", numeric.parse("raw", F.col("unit"), several=several).alias("n")).collect()}
    for k, c in enumerate(some):
        n = got[k]
        if c[3] is None:
            assert n is None, c
        else:
            assert n is not None, c
            assert (n.operator, n.value, n.value_min, n.value_max, n.error, n.unit) == pytest.approx(c[3]), c


def test_older_range_units(spark):
    n = spark.range(1).select(numeric.parse(F.lit("500-1000 nm"), "um", legacy_range_units=True).alias("n")).first().n
    assert (n.value_min, n.value_max) == (0.5, 1000)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_text(spark):
    assert one(spark, text.collapse(F.lit(" a  b\n"))) == "a b"
    assert one(spark, text.endpoint_text(F.lit("In-Vitro_Efficacy/x "))) == "in vitro efficacy x"
    assert one(spark, text.safe_id(F.lit("__a b/c__"))) == "a_b_c"
    assert one(spark, text.safe_id(F.lit("//"))) == "unknown"
    assert one(spark, text.sentences(F.lit("A b. C d! e? (F g). 3 h"))) == ["A b.", "C d! e?", "(F g).", "3 h"]
    assert one(spark, text.token_estimate(F.lit("abc"))) == 1
    assert one(spark, text.has_phrase(F.lit("cell cycle"), F.lit("cl"))) is False
    assert one(spark, text.has_phrase(F.lit("the cl value"), F.lit("cl"))) is True
    assert one(spark, text.pmcid(F.lit("123"))) == "PMC123"
    assert one(spark, text.json_object(F.lit('```json\n{"a": "1"}\n```'), "map<string,string>")) == {"a": "1"}
    assert one(spark, text.json_object(F.lit('so {"a": "1"} it is'), "map<string,string>")) == {"a": "1"}


def test_match_score(spark):
    score = lambda v, t: one(spark, text.match_score(F.lit(v), F.lit(t), 4.0))
    assert score("not reported", "not reported") == 0
    assert score("12.5 months", "it took 12.5 months") == pytest.approx(4 + 2.8 + 0.25)
    assert score(None, "x") == 0


def test_paragraph_chunks(spark):
    from quernstone.sources.jats import split_paragraph

    for body in ("Short one.", " ".join(f"Sentence number {k} has some words in it." for k in range(200)), "x" * 5000, " ".join(["Word."] * 700)):
        assert one(spark, text.paragraph_chunks(F.lit(body))) == split_paragraph(body)
        assert "".join(split_paragraph(body)).replace(" ", "") == body.replace(" ", "")
