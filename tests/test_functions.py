import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from helpers import date
from silverlode import fixed_values as fixed
from silverlode import functions as X


def apply(spark, schema, values, **columns):
    df = spark.createDataFrame(values, schema).select(*[c.alias(n) for n, c in columns.items()])
    return [tuple(row) for row in df.collect()]


def test_int_div_truncates_toward_zero_and_survives_zero(spark):
    pairs = [(7, 2), (-7, 2), (7, -2), (-7, -2), (1, 0), (None, 2), (5, None)]
    got = apply(spark, "a int, b int", pairs, q=X.int_div(F.col("a"), F.col("b")))
    assert [row[0] for row in got] == [3, -3, -3, 3, None, None, None]


def test_int_avg_truncates(spark):
    df = spark.createDataFrame([(1, -1), (1, -2), (1, None), (2, None)], "k int, v int")
    got = {row.k: row.a for row in df.groupBy("k").agg(X.int_avg(F.col("v")).alias("a")).collect()}
    assert got == {1: -1, 2: None}


def test_sum_or_zero(spark):
    df = spark.createDataFrame([(None,)], "v int")
    assert df.agg(X.sum_or_zero(F.col("v"))).first()[0] == 0
    assert df.filter("false").agg(X.sum_or_zero(F.col("v"))).first()[0] == 0


@pytest.mark.parametrize("number, expected", [
    (20101229, "2010-12-29"), (20240229, "2024-02-29"), (20230229, None), (20101301, None),
    (20100100, None), (20100132, None), (20100431, None), (0, None), (32154, None), (5489, None),
    (101229, "2010-12-29"), (490101, None), (500101, "1950-01-01"), (991231, "1999-12-31"),
    (300101, "2030-01-01"), (310101, None), (101329, None), (100000, None), (2010, "2010-01-01"),
    (1999, "1999-01-01"), (2031, None), (999, None), (1000, "1000-01-01"), (1012290, None), (-20101229, None), (201012290, None), (2147483647, None), (20301231, "2030-12-31"),
    (20310101, None), (10000101, "1000-01-01"), (99991231, None), (None, None),
])
def test_int_date(spark, number, expected):
    got = apply(spark, "n int", [(number,)], d=X.int_date(F.col("n"), fixed.LATEST_SALES_DATE))
    assert got == [(expected and date(expected),)]


def test_int_date_agrees_with_the_calendar(spark):
    """Every number from 19990101 to 20001331: a date if and only if the calendar has it."""
    numbers = spark.range(19990101, 20001332).select(F.col("id").cast("int").alias("n"))
    got = numbers.select("n", X.int_date(F.col("n"), fixed.LATEST_SALES_DATE).alias("d")).collect()

    def calendar(n):
        try:
            return dt.date(n // 10000, n // 100 % 100, n % 100)
        except ValueError:
            return None

    assert all(row.d == calendar(row.n) for row in got)
    assert sum(row.d is not None for row in got) == 365 + 366


def test_differences_count_boundaries(spark):
    pairs = [
        (date("2024-01-31"), date("2024-02-01")), (date("2023-12-31"), date("2024-01-01")),
        (date("2024-02-01"), date("2024-02-29")), (date("2024-03-01"), date("2023-12-31")),
        (None, date("2024-01-01")),
    ]
    got = apply(
        spark, "a date, b date", pairs,
        m=X.month_diff(F.col("a"), F.col("b")), y=X.year_diff(F.col("a"), F.col("b")),
    )
    assert got == [(1, 0), (1, 1), (0, 0), (-3, -1), (None, None)]


def test_month_start_and_null_after(spark):
    got = apply(
        spark, "d date", [(date("2024-02-29"),), (date("2025-12-31"),), (date("2026-01-01"),), (None,)],
        m=X.month_start(F.col("d")), n=X.null_after(F.col("d"), F.lit(date("2025-12-31"))),
    )
    assert got == [
        (date("2024-02-01"), date("2024-02-29")), (date("2025-12-01"), date("2025-12-31")),
        (date("2026-01-01"), None), (None, None),
    ]


def test_text_length_ignores_trailing_spaces_only(spark):
    got = apply(spark, "s string", [(" ab  ",), ("ab\t",), ("",), (None,)], n=X.text_length(F.col("s")))
    assert [row[0] for row in got] == [3, 3, 0, None]


def test_trim_keeps_tabs(spark):
    assert apply(spark, "s string", [(" \ta ",)], t=F.trim("s")) == [("\ta",)]


def test_concat_blank(spark):
    name = X.concat_blank(F.col("a"), F.lit(" "), F.col("b"))
    got = apply(spark, "a string, b string", [("x", "y"), (None, "y"), ("x", None), (None, None)], n=name)
    assert [row[0] for row in got] == ["x y", " y", "x ", " "]


def test_keys(spark):
    got = apply(
        spark, "k string", [("CO-RF-FR-R92B-58",), ("AB-CD",), (None,)],
        c=X.category_of_key(F.col("k")), p=X.product_of_key(F.col("k")),
    )
    assert got == [("CO_RF", "FR-R92B-58"), ("AB_CD", ""), (None, None)]


def test_prefix_and_hyphens(spark):
    got = apply(
        spark, "c string", [("NASAW001",), ("AW001",), ("nasAW",), ("NAS",), (None,)],
        p=X.strip_prefix(F.col("c"), "NAS"),
    )
    assert [row[0] for row in got] == ["AW001", "AW001", "nasAW", "", None]
    assert apply(spark, "c string", [("A-W--1",)], h=X.remove_hyphens(F.col("c"))) == [("AW1",)]


def test_map_codes(spark):
    codes = [("S",), (" m ",), ("x",), ("",), (None,)]
    got = apply(spark, "c string", codes, l=X.map_codes(F.col("c"), fixed.MARITAL_STATUS))
    assert [row[0] for row in got] == ["Single", "Married", "N/A", "N/A", "N/A"]
    countries = [("de",), ("US ",), ("United States",), ("Uk",), ("AUSTRALIA",), ("can",), ("Fr",), ("IT",)]
    got = apply(spark, "c string", countries, l=X.map_codes(F.col("c"), fixed.COUNTRY))
    assert [row[0] for row in got] == [
        "Germany", "United States", "United States", "United Kingdom", "Australia", "Canada",
        "France", "N/A",
    ]


def test_prefer(spark):
    pairs = [("Male", "Female"), ("N/A", "Female"), ("N/A", None), (None, "Male"), (None, None)]
    got = apply(spark, "a string, b string", pairs, g=X.prefer(F.col("a"), F.col("b")))
    assert [row[0] for row in got] == ["Male", "Female", "N/A", "Male", "N/A"]


def test_bands(spark):
    ages = [(19,), (20,), (29,), (30,), (49,), (59,), (60,), (65,), (66,), (None,)]
    got = apply(spark, "a int", ages, b=X.band(F.col("a"), fixed.AGE_BANDS, fixed.AGE_ABOVE))
    assert [row[0] for row in got] == [
        "Under 20", "20-29", "20-29", "30-39", "40-49", "50-59", "60-65", "60-65", "Above 65", "Above 65",
    ]


def test_percent_label(spark):
    cases = [
        (1, 1, "100%"), (1, 2, "50%"), (1, 8, "12.5%"), (1, 3, "33.33%"), (2, 3, "66.67%"),
        (1, 20000, "0.01%"), (1, 20001, "0%"), (0, 5, "0%"), (-1, 8, "-12.5%"), (-1, -8, "12.5%"),
        (None, 5, "%"), (5, 0, "%"), (10**15, 3 * 10**15, "33.33%"),
    ]
    got = apply(
        spark, "p bigint, w bigint", [case[:2] for case in cases],
        l=X.percent_label(F.col("p"), F.col("w")),
    )
    assert [row[0] for row in got] == [case[2] for case in cases]


def test_percent_label_agrees_with_decimals(spark):
    pairs = [(part, whole) for whole in (7, 16, 333, 40000) for part in range(0, whole, max(1, whole // 97))]
    got = apply(spark, "p bigint, w bigint", pairs, l=X.percent_label(F.col("p"), F.col("w")))
    for (part, whole), (label,) in zip(pairs, got, strict=True):
        exact = (Decimal(part) * 100 / Decimal(whole)).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert Decimal(label[:-1]) == exact, (part, whole)


def test_round_goes_away_from_zero(spark):
    got = apply(spark, "v double", [(0.25,), (-0.25,), (2.5,)], r=F.round("v", 1), w=F.round("v", 0))
    assert got == [(0.3, 0.0), (-0.3, -0.0), (2.5, 3.0)]
