"""Number functions: whole-number division and averages truncate toward zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_div(numerator: Column, denominator: Column) -> Column:
    """Whole-number division, NULL for a zero denominator."""
    return F.call_function("div", numerator, F.nullif(denominator, F.lit(0)))


def int_avg(value: Column) -> Column:
    """Average of whole numbers as a whole number."""
    return F.call_function("div", F.sum(value), F.nullif(F.count(value), F.lit(0)))


def sum_or_zero(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0).cast("bigint"))


def percent_label(part: Column, whole: Column) -> Column:
    """Share as text with up to two decimals ('12.5%'); exact, as it uses whole numbers only."""
    part = part.cast("decimal(20,0)")
    whole = whole.cast("decimal(20,0)")
    # Half away from zero: twice the part scaled to 1/100 percent, plus or minus one whole.
    doubled = F.abs(part) * F.lit(20000) + F.abs(whole)
    hundredths = int_div(doubled, F.abs(whole) * F.lit(2))
    signed = F.when((part < 0) != (whole < 0), -hundredths).otherwise(hundredths)
    text = (signed.cast("decimal(20,0)") / F.lit(100)).cast("decimal(24,2)").cast("string")
    return F.concat(F.coalesce(F.regexp_replace(text, r"\.?0+$", ""), F.lit("")), F.lit("%"))
