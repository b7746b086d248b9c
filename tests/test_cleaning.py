"""Cleaning, names and display text, edge by edge."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from panelforge.functions import clean
from panelforge.functions.dictionaries import FACILITY, MEASURES
from panelforge.functions.measures import (
    facility_label,
    month_text,
    number_text,
    percent_of,
    strength_text,
)
from panelforge.functions.names import (
    MONTHS,
    normalize_header,
    normalize_prefix,
    safe_name,
    snapshot_month,
)

D = datetime.date


def apply(spark, expression, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_text(spark):
    values = ["  Sunny Home ", "   ", "", None, "Data Not Available", "\t a "]
    assert apply(spark, clean.text, values) == [
        "Sunny Home", None, None, None, "Data Not Available", "\t a"
    ]


def test_yes_no(spark):
    assert apply(spark, clean.yes_no, [" y ", "N", " ", None]) == ["Y", "N", None, None]


NUMBERS = [
    (" $1,234.5 ", 1234.5), ("52.1%", 52.1), ("Not Available", None), ("abc", None),
    ("Data Not Available", None), ("n/a", None), (" NA ", None), ("", None), ("NaN", None),
    ("9,13", 913.0), ("1e3", 1000.0), ("(5)", None), ("1 2", None), ("-4", -4.0), (None, None),
    ("$", None),
]


def test_to_double_equals_try_cast(spark):
    values = ["5", " 5 ", "\t5", "-.5e3", "+7", "1.5d", "Infinity", "-inf", "INF", "x5", "Not 5", "",
              "0x1p3", "1_0", None, "e5", ".", "-"]
    assert apply(spark, clean.to_double, values) == apply(
        spark, lambda c: c.try_cast("double"), values
    )
    assert apply(spark, clean.to_double, ["nan", "NaN", "-NaN", "+nan"]) == [None] * 4


def test_number(spark):
    values, expected = zip(*NUMBERS)
    assert apply(spark, clean.number, values) == list(expected)


DATES = [
    ("10/01/2024", D(2024, 10, 1)), ("1/5/2024", D(2024, 1, 5)), ("2024-10-01", D(2024, 10, 1)),
    ("10-01-2024", D(2024, 10, 1)), (" 2/29/2024 ", D(2024, 2, 29)), ("13/45/2024", None),
    ("2/30/2024", None), ("junk", None), ("n/a", None), (" ", None), (None, None),
    ("2024-1-5", None), ("1-5-2024", None), ("1/5/24", None), ("1/5/2024x", None),
]


def test_date(spark):
    values, expected = zip(*DATES)
    assert apply(spark, clean.date, values) == list(expected)


def test_date_equals_trying_every_layout(spark):
    def every(c):
        return F.coalesce(*(F.try_to_date(F.trim(c), f) for f in clean.DATE_FORMATS))

    values = [v for v, _ in DATES] + [
        "01/5/2024", "1/05/2024", "0/1/2024", "00/10/2024", "12/31/1999", "1/32/2024", "11/31/2024",
        "2024-13-01", "2023-02-29", "10-32-2024", "001/1/2024", "2024-10-1", "10/1/20245",
        "1/1/0000", "-2024-01-01", "1/1/-2024", "+2024-01-01", "+20245-01-01", "1/1/+20245",
        "-20245-01-01", "10-01--2024", "1 /1/2024", "1/1/2024 ", "2024-10-01T00:00:00", "0001-01-01",
    ]

    def as_text(cleaner):
        return apply(spark, lambda c: cleaner(c).cast("string"), values)

    assert as_text(clean.date) == as_text(every)


def test_snapshot_month(spark):
    names = [
        "NH_ProviderInfo_Oct2024.csv", "x_October2024.csv", "x_OCT2024.CSV", "x_may2025.csv",
        "x_Foo2024.csv", "x_Sept2024.csv", "x_2024.csv", "Oct2024.csv", "x_Oct2024.txt",
        "x_Oct0000.csv", "x_Oct24.csv", "x_Oct-202.csv", "x_Oct2024.csv.csv", "_a_dec1999.csv",
        "", None, "x_9Oct2024.csv", "x_",
    ]
    october = D(2024, 10, 1)
    assert apply(spark, snapshot_month, names) == [
        october, october, october, D(2025, 5, 1), *[None] * 9, D(1999, 12, 1), *[None] * 4
    ]


def test_snapshot_month_reads_every_month(spark):
    names = [f"x_{m}2020.csv" for m in MONTHS] + [f"x_{m[:3].title()}2020.csv" for m in MONTHS]
    assert apply(spark, snapshot_month, names) == [D(2020, 1 + i % 12, 1) for i in range(24)]


def test_header_names():
    assert normalize_header(" Average Number of Residents per Day ") == (
        "AVERAGE_NUMBER_OF_RESIDENTS_PER_DAY"
    )
    assert normalize_header("City/Town") == "CITY_TOWN"
    assert normalize_header("CMS Certification Number (CCN)") == "CCN"
    assert normalize_header("_a--b_") == "A_B"


def test_paths(spark):
    assert normalize_prefix(" /a/b// ") == "a/b/"
    assert normalize_prefix(" / ") == ""
    assert apply(spark, safe_name, ["a/b\\c"]) == ["a_b_c"]


def test_dictionaries():
    counts = {k: list(FACILITY.kinds.values()).count(k) for k in set(FACILITY.kinds.values())}
    assert counts == {"text": 14, "yes_no": 5, "date": 5, "number": 79}
    assert len(MEASURES.kinds) == 17
    assert FACILITY.with_kinds(ZIP_CODE="text").kinds["ZIP_CODE"] == "text"
    assert FACILITY.kinds["ZIP_CODE"] == "number"


@pytest.mark.parametrize(
    "beds, residents, expected",
    [(100.0, 80.0, 80.0), (0.0, 5.0, None), (None, 5.0, None), (10.0, None, None), (10.0, 12.0, 120.0)],
)
def test_percent(spark, beds, residents, expected):
    df = spark.createDataFrame([(residents, beds)], "r double, b double")
    value = df.select(percent_of(F.col("r"), F.col("b"))).first()[0]
    assert value == (expected if expected is None else pytest.approx(expected))


def test_strength(spark):
    values = [0.2, 0.4, -0.8, 0.0, None, 0.1999, -0.5, 0.79]
    texts = apply(spark, strength_text, values, "double")
    words = [" ".join(t.split()[3:5]) for t in texts]
    assert words[:3] == ["weak positive", "moderate positive", "very strong"]
    assert "very strong negative" in texts[2]
    assert "essentially no" in texts[3]
    assert texts[4].startswith("Not enough data")
    assert "very weak positive" in texts[5]
    assert "moderate negative" in texts[6]
    assert "strong positive" in texts[7] and "very" not in texts[7]


def test_display_text(spark):
    assert apply(spark, lambda c: number_text(c, 1, "%"), [1234.56, None], "double") == [
        "1,234.6%", "N/A"
    ]
    assert apply(spark, month_text, [D(2024, 10, 1), None], "date") == ["October 2024", "Unknown"]
    df = spark.createDataFrame([("A", "1"), (None, None)], "n string, c string")
    labels = [r[0] for r in df.select(facility_label(F.col("n"), F.col("c"))).collect()]
    assert labels == ["A (1)", "Unknown facility (Unknown CCN)"]
