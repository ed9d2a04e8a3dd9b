"""Per-key operators: latest row, group maximum on every row, next row's value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverlode.job import Job
from silverlode.operators.joins import hot_keys, split_hot
from silverlode.operators.keys import add_dense_key


def latest_per_key(df: DataFrame, key: str, by: str) -> DataFrame:
    """One row per key: the one with the greatest `by`, ties decided by the other columns in
    order (greatest first, NULL lowest).

    An aggregate, not a ranking window: each task keeps one row per key before the shuffle, so
    a key with any number of copies sends one row per task.
    """
    rest = [name for name in df.columns if name not in (key, by)]
    newest = df.groupBy(key).agg(F.max(F.struct(by, *rest)).alias("_row"))
    return newest.select(key, "_row.*").select(df.columns)


def with_group_max(job: Job, df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Replace each of `columns` by its maximum over the rows with the same key.

    Normal keys: one window, i.e. one shuffle on the key. Rows of hot keys do not move at all:
    their maxima are aggregated with partial results and broadcast (one row per hot key).
    """
    window = Window.partitionBy(key)

    def over_window(rows: DataFrame) -> DataFrame:
        return rows.withColumns({name: F.max(name).over(window) for name in columns})

    hot = hot_keys(job, df, key)
    if hot is None:
        return over_window(df)
    cold_rows, hot_rows = split_hot(df, key, hot)
    maxima = hot_rows.groupBy(F.col(key).alias("_key")).agg(
        *[F.max(name).alias(f"_max_{name}") for name in columns]
    )
    healed = hot_rows.join(F.broadcast(maxima), F.col(key).eqNullSafe(F.col("_key")), "left")
    healed = healed.withColumns({name: F.col(f"_max_{name}") for name in columns})
    return over_window(cold_rows).unionByName(healed.select(df.columns))


def with_next_value(
    job: Job, df: DataFrame, key: str, order: Sequence[str], value: str, name: str
) -> DataFrame:
    """Add `name`: the `value` of the next row of the same key in `order`, NULL on the last.

    Normal keys: one window. Rows of hot keys are sorted across tasks, numbered, and each is
    joined to the row one number later, so no task holds a whole hot key. Rows that tie in
    `order` follow each other by their other columns, so both ways give the same.
    """
    order = [*order, *(column for column in df.columns if column not in (key, *order))]
    window = Window.partitionBy(key).orderBy(*[F.asc_nulls_first(column) for column in order])

    def over_window(rows: DataFrame) -> DataFrame:
        return rows.withColumn(name, F.lead(value).over(window))

    hot = hot_keys(job, df, key)
    if hot is None:
        return over_window(df)
    cold_rows, hot_rows = split_hot(df, key, hot)
    numbered = add_dense_key(job, hot_rows, [key, *order], "_number")
    following = numbered.select(
        F.col(key).alias("_next_key"),
        (F.col("_number") - 1).alias("_before"),
        F.col(value).alias(name),
    )
    same_key = F.col(key).eqNullSafe(F.col("_next_key"))
    linked = numbered.join(following, (F.col("_number") == F.col("_before")) & same_key, "left")
    return over_window(cold_rows).unionByName(linked.select(*df.columns, name))
