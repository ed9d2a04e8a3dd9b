"""Text functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverlode.fixed_values import CATEGORY_ID_LENGTH, PRODUCT_TAIL_START


def text_length(text: Column) -> Column:
    """Length without trailing spaces."""
    return F.length(F.rtrim(text))


def concat_blank(*parts: Column) -> Column:
    """Concatenate, with NULL as the empty string (Spark's concat would give NULL)."""
    return F.concat(*[F.coalesce(part, F.lit("")) for part in parts])


def remove_hyphens(text: Column) -> Column:
    return F.replace(text, F.lit("-"), F.lit(""))


def _tail(text: Column, start: int) -> Column:
    return F.substr(text, F.lit(start), text_length(text))


def text_equals(text: Column, value: str, collation: str | None = None) -> Column:
    """Whether a text is `value`, exactly or as a collation says."""
    return (F.collate(text, collation) if collation else text) == value


def text_like(text: Column, pattern: str, collation: str | None = None) -> Column:
    """LIKE, exactly or as a collation says; one that ends in _RTRIM passes over the trailing
    spaces of the text (Spark's own LIKE takes no such collation)."""
    if collation is None:
        return text.like(pattern)
    trimmed = F.rtrim(text) if collation.endswith("_RTRIM") else text
    return F.collate(trimmed, collation.removesuffix("_RTRIM")).like(pattern)


def strip_prefix(text: Column, prefix: str, collation: str | None = None) -> Column:
    if collation is None:
        found = text.startswith(prefix)
    else:
        found = F.collate(F.substring(text, 1, len(prefix)), collation) == prefix
    return F.when(found, _tail(text, len(prefix) + 1)).otherwise(text)


def category_of_key(key: Column) -> Column:
    """Leading category part of a composite product key, in the category table's spelling."""
    return F.replace(F.substring(key, 1, CATEGORY_ID_LENGTH), F.lit("-"), F.lit("_"))


def product_of_key(key: Column) -> Column:
    """Product part of a composite product key."""
    return _tail(key, PRODUCT_TAIL_START)
