import math

import pytest
from pyspark.sql import functions as F

from costwatch import settings
from costwatch.functions import measures, rules, text


def values(spark, rows, schema, expression):
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema)
    return [r["v"] for r in frame.select("i", expression.alias("v")).orderBy("i").collect()]


def test_text_parsing(spark):
    texts = ["  A\tB\n\nC　", "", None]
    assert values(spark, [(t,) for t in texts], "t string", text.normalize_text(F.col("t"))) == [
        "a b c",
        "",
        None,
    ]
    assert values(spark, [(t,) for t in texts], "t string", text.strip(F.col("t"))) == [
        "A\tB\n\nC",
        "",
        None,
    ]
    tokens = values(
        spark, [("Café 2024-05-01 a-b--c 3.5",)], "t string", text.tokenize(F.col("t"))
    )
    assert tokens == [["caf", "2024-05-01", "a-b", "c", "3", "5"]]
    grams = values(
        spark, [("The cat, a Große day",), ("x",)], "t string",
        text.word_ngrams(F.col("t"), ["the"]),
    )
    assert grams == [["cat", "große", "day", "cat große", "große day"], []]


def test_display_expressions(spark):
    pcts = [0.25, 0.35, 12.75, -0.04, math.inf, None, 20.0]
    phrase = "x"
    expected = [
        "N/A" if p is None else f"{'+' if p >= 0 else ''}{p:.1f}% x" for p in pcts
    ]
    assert values(
        spark, [(p,) for p in pcts], "p double", text.comparison_text(F.col("p"), phrase)
    ) == expected
    shown = ["+12.5% vs", "N/A", "no", None]
    rows = [(s,) for s in shown]
    assert values(spark, rows, "s string", text.extract_percent(F.col("s"))) == [
        "+12.5%", "N/A", "no", None,
    ]
    assert values(spark, rows, "s string", text.parse_number(F.col("s"))) == [
        12.5, None, None, None,
    ]
    ids = [(" N1 ",), ("nan",), ("",), (None,), ("None",)]
    assert values(spark, ids, "s string", text.clean_note_id(F.col("s"))) == [
        "N1", None, None, None, None,
    ]
    assert values(spark, [(1234.5,), (None,)], "p double", text.format_money(F.col("p"))) == [
        "₹1234.50", "N/A",
    ]


def test_round_exact_agrees_with_python(spark):
    numbers = [0.15, 0.25, 0.35, 2.675, 1.005, 19.9177625, 1.0139025, 5e-7, 123456.7890125, 0.0]
    for decimals in (1, 2, 6):
        got = values(
            spark, [(x,) for x in numbers], "x double", measures.decimal_text(F.col("x"), decimals)
        )
        assert got == [f"{x:.{decimals}f}" for x in numbers]


def test_snippet(spark):
    long = "Context: " + "a" * 61 + ". rest"
    rows = [("Note ID: 1. Context: Short one. Rest",), (long,), ("No marker. x",)]
    assert values(spark, rows, "t string", text.note_snippet(F.col("t"))) == [
        "Short one", "a" * 60 + "...", "No marker",
    ]


@pytest.mark.parametrize(
    "value,base,expected",
    [(12.0, 10.0, 20.0), (5.0, 0.0, math.inf), (0.0, 0.0, None), (1.0, None, None), (0.0, 4.0, -100.0)],
)
def test_pct_difference(spark, value, base, expected):
    got = values(
        spark, [(value, base)], "v double, b double",
        measures.pct_difference(F.col("v"), F.col("b")),
    )
    assert got == [expected]


EVIDENCE = [
    ("A temporary SURCHARGE applied on the lane", True, False),
    ("Detours and higher\n  trip costs", True, False),
    ("Fuel prices in the region have increased", True, False),
    ("fuel shortages pushing up delivery costs", True, False),
    ("toll changes pushed up all costs", True, False),
    ("Toll plaza opened", False, False),
    ("Flooding and heavy disruption", False, False),
    ("A surcharge was discussed, no surcharge agreed", True, True),
    ("costs were not significantly affected", False, True),
    ("stable demand this quarter", False, True),
    ("compliance costs were absorbed", False, True),
    ("demand remained stable with no major disruptions", False, True),
    ("limited truck availability led to extra cost", True, False),
    ("limited truck availability", False, False),
]


def test_evidence_patterns(spark):
    rows = [(t,) for t, _, _ in EVIDENCE]
    assert values(spark, rows, "t string", text.has_positive_evidence(F.col("t"))) == [
        p for _, p, _ in EVIDENCE
    ]
    assert values(spark, rows, "t string", text.has_negative_evidence(F.col("t"))) == [
        n for _, _, n in EVIDENCE
    ]


def test_evidence_patterns_agree_with_plain_alternation(spark):
    """Substring look-up against the patterns as one regular expression, on random phrases."""
    import random

    random.seed(7)
    patterns = settings.POSITIVE_PATTERNS + settings.NEGATIVE_PATTERNS
    words = sorted({w for p in patterns for w in p.replace(".*", " ").replace("?", "").split()})
    words = [w.strip("()").replace("|", " ") for w in words]
    rows = [(" ".join(random.choices(words, k=random.randint(2, 9))),) for _ in range(5000)]
    frame = spark.createDataFrame(rows, "t string")
    normal = text.normalize_text(F.col("t"))
    for found, listed in (
        (text.has_positive_evidence, settings.POSITIVE_PATTERNS),
        (text.has_negative_evidence, settings.NEGATIVE_PATTERNS),
    ):
        wrong = frame.filter(found(F.col("t")) != normal.rlike("|".join(listed)))
        assert wrong.count() == 0


def test_route_and_date_rules(spark):
    rows = [
        ("A-B", "A-B", "2025-01-06", "2025-01-13"),
        ("all ROUTES ", "A-B", "2025-01-06", "2025-01-14"),
        ("a-b", "A-B", "2025-01-20", "2025-01-13"),
        ("A-C", "A-B", "2025-01-05", "2025-01-13"),
    ]
    schema = "n string, r string, d string, w string"
    strict = rules.route_matches(F.col("n"), F.col("r"))
    lenient = rules.route_matches_lenient(F.col("n"), F.col("r"))
    near = rules.date_matches(F.col("d").cast("date"), F.col("w").cast("date"), 7)
    assert values(spark, rows, schema, strict) == [True, True, False, False]
    assert values(spark, rows, schema, lenient) == [True, True, True, False]
    assert values(spark, rows, schema, near) == [True, False, True, False]
