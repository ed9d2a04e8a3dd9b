"""Column functions with the semantics the cleaning and report rules rely on."""

from silverlode.functions.codes import band, map_codes, prefer
from silverlode.functions.dates import int_date, month_diff, month_start, null_after, year_diff
from silverlode.functions.numbers import int_avg, int_div, percent_label, sum_or_zero
from silverlode.functions.text import (
    category_of_key,
    concat_blank,
    product_of_key,
    remove_hyphens,
    strip_prefix,
    text_equals,
    text_like,
    text_length,
)

__all__ = [
    "band", "map_codes", "prefer",
    "int_date", "month_diff", "month_start", "null_after", "year_diff",
    "int_avg", "int_div", "percent_label", "sum_or_zero",
    "category_of_key", "concat_blank", "product_of_key", "remove_hyphens", "strip_prefix",
    "text_equals", "text_like",
    "text_length",
]
