"""Top-k and bottom-k. Each task keeps k rows, so only k rows per task reach the final sort, which
is one task: k is the caller's choice and has to fit there."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, value: str, k: int, tie_break: Sequence[str]) -> DataFrame:
    """The k rows with the greatest value; ties go to the lowest `tie_break`."""
    return df.orderBy(F.desc_nulls_last(value), *tie_break).limit(k)


def bottom_k(df: DataFrame, value: str, k: int, tie_break: Sequence[str]) -> DataFrame:
    """The k rows with the least value; ties go to the lowest `tie_break`."""
    return df.orderBy(F.asc_nulls_first(value), *tie_break).limit(k)


def top_row_numbers(
    df: DataFrame, value: str, k: int, tie_break: Sequence[str], name: str
) -> DataFrame:
    """`top_k` with its row number. The window sees only the k rows left."""
    window = Window.orderBy(F.desc_nulls_last(value), *tie_break)
    return top_k(df, value, k, tie_break).withColumn(name, F.row_number().over(window))


def top_dense_ranks(df: DataFrame, value: str, k: int, name: str) -> DataFrame:
    """All rows with one of the k greatest values, with the rank of that value.

    The ranks are made on the k distinct values alone and joined back, so any number of tied
    rows stays spread over the tasks.
    """
    values = df.select(F.col(value).alias("_value")).distinct()
    values = values.orderBy(F.desc_nulls_last("_value")).limit(k)
    ranks = values.withColumn(name, F.row_number().over(Window.orderBy(F.desc_nulls_last("_value"))))
    same = F.col(value).eqNullSafe(F.col("_value"))
    return df.join(F.broadcast(ranks), same).select(*df.columns, name)
