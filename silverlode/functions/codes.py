"""Code tables, bands and source preference as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverlode.fixed_values import NOT_AVAILABLE


def map_codes(code: Column, labels: Mapping[str, str], default: str = NOT_AVAILABLE) -> Column:
    """Label of a code, ignoring case and surrounding spaces."""
    cleaned = F.upper(F.trim(code))
    by_label: dict[str, list[str]] = {}
    for known, label in labels.items():
        by_label.setdefault(label, []).append(known)
    cases = reduce(
        lambda chain, item: chain.when(cleaned.isin(item[1]), F.lit(item[0])), by_label.items(), F
    )
    return cases.otherwise(F.lit(default))


def band(value: Column, bands: Sequence[tuple[int, str]], above: str) -> Column:
    """Label of the first band whose top is not exceeded; NULL goes to `above`."""
    cases = reduce(lambda chain, item: chain.when(value <= item[0], F.lit(item[1])), bands, F)
    return cases.otherwise(F.lit(above))


def prefer(first: Column, second: Column, missing: str = NOT_AVAILABLE) -> Column:
    """`first` unless it is missing, then `second`."""
    return F.when(first != missing, first).otherwise(F.coalesce(second, F.lit(missing)))
