"""Several aggregates of one table as labelled rows, and totals beside their parts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.job import PARTITIONS, Job
from silverlode.operators.joins import hot_keys, split_hot


def long_measures(
    df: DataFrame, label_columns: Sequence[str], value_column: str,
    measures: Mapping[tuple[str, ...], Column],
) -> DataFrame:
    """One row per measure: its labels and its value. The table is scanned once for all."""
    wide = df.agg(*[value.cast("bigint").alias(f"m{i}") for i, value in enumerate(measures.values())])
    rows = [
        F.struct(
            *[F.lit(text).alias(column) for column, text in zip(label_columns, labels, strict=True)],
            F.col(f"m{i}").alias(value_column),
        )
        for i, labels in enumerate(measures)
    ]
    return wide.select(F.inline(F.array(*rows)))


def group_with_distinct(
    job: Job, df: DataFrame, key: str, measures: Sequence[Column], distinct: Mapping[str, str]
) -> DataFrame:
    """Measures and several distinct counts ({name: column}) per non-NULL key of a stored table.

    Each distinct count is an aggregate of its own over just the key and its column, and they
    meet on the key they are partitioned by already. In a single aggregate every row would be
    copied once per distinct column, with all columns.

    A table of more rows than the session's shuffle partitions should get is dealt over a task for
    every `limits.task_rows` rows: by its key, so that one shuffle does for both steps of a distinct
    count, and the rows of hot keys by key and column.
    """
    known = df.filter(F.col(key).isNotNull())
    tasks = -(-df.count() // job.limits.task_rows)
    if tasks <= int(job.spark.conf.get(PARTITIONS)):
        return _grouped(known, key, measures, distinct, lambda rows, column: rows)
    hot = hot_keys(job, df, key)
    if hot is None:
        return _grouped(known, key, measures, distinct, lambda rows, _: rows.repartition(tasks, key))
    cold_rows, hot_rows = split_hot(known, key, hot)
    cold = _grouped(cold_rows, key, measures, distinct, lambda rows, _: rows.repartition(tasks, key))
    return cold.unionByName(_grouped(
        hot_rows, key, measures, distinct, lambda rows, column: rows.repartition(tasks, key, column)
    ))


def _grouped(
    known: DataFrame, key: str, measures: Sequence[Column], distinct: Mapping[str, str],
    deal: Callable[[DataFrame, str], DataFrame],
) -> DataFrame:
    result = None
    for name, column in distinct.items():
        count = F.count_distinct(column).alias(name)
        extra = measures if result is None else []
        part = deal(known, column).groupBy(key).agg(*extra, count)
        result = part if result is None else result.join(part, key)
    return result


def with_grand_total(df: DataFrame, value: str, name: str) -> DataFrame:
    """Add the sum of `value` over all rows, as a scalar subquery: no window over everything."""
    return df.withColumn(name, df.agg(F.sum(value)).scalar())
