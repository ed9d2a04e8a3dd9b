"""Date functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_date(number: Column, latest: dt.date) -> Column:
    """Date from a number; NULL when it is no date or lies after `latest`.

    Eight digits are yyyymmdd, six are yymmdd (00 to 49 in this century, 50 to 99 in the last),
    four are the first of January of that year. Other lengths are no dates.
    """
    whole = (
        F.when(number.between(1_000, 9_999), number * 10_000 + 101)
        .when(number.between(100_000, 499_999), number + 20_000_000)
        .when(number.between(500_000, 999_999), number + 19_000_000)
        .when(number.between(10_000_101, 99_991_231), number)
    )
    year, month, day = _div(whole, 10_000), _div(whole, 100) % 100, whole % 100
    # Built by calendar arithmetic, which a broken number turns into NULL without a parser.
    real_month = F.when(month.between(1, 12) & day.between(1, 31), month)
    date = F.date_add(F.make_date(year, real_month, F.lit(1)), day - 1)
    # A day past the end of its month lands in the next one.
    return F.when((F.month(date) == month) & (date <= F.lit(latest)), date)


def _div(number: Column, by: int) -> Column:
    return F.call_function("div", number, F.lit(by)).cast("int")


def null_after(date: Column, latest: Column) -> Column:
    """NULL for dates after `latest`."""
    return F.when(date <= latest, date)


def year_diff(start: Column, end: Column) -> Column:
    """Number of year boundaries crossed."""
    return F.year(end) - F.year(start)


def month_diff(start: Column, end: Column) -> Column:
    """Number of month boundaries crossed (Spark's own month difference counts whole months)."""
    return year_diff(start, end) * 12 + F.month(end) - F.month(start)


def month_start(date: Column) -> Column:
    return F.trunc(date, "MM")
