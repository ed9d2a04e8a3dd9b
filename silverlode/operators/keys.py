"""Dense surrogate keys without sorting a whole table in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverlode.job import Job

# Spark's monotonically_increasing_id holds the task number above 33 bits of row position.
_POSITION_BITS = 33


def in_ranges(
    job: Job, df: DataFrame, order: Sequence[str], stored: bool = False
) -> DataFrame:
    """The rows of `df` staged in sorted ranges, with `_range` and `_position` (from 0) of each.

    See `add_dense_key` for what makes the order total and repeatable.
    """
    staged = (df if stored else job.stage(df, "keyless")).withColumn(
        "_number", F.monotonically_increasing_id()
    )
    total_order = [F.asc_nulls_first(column) for column in [*order, "_number"]]
    ranged = staged.repartitionByRange(*total_order).sortWithinPartitions(*total_order)
    place = F.monotonically_increasing_id()
    placed = ranged.select(*df.columns, place.alias("_place")).select(
        *df.columns,
        F.shiftright("_place", _POSITION_BITS).alias("_range"),
        F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_position"),
    )
    return job.stage(placed, "placed")


def add_dense_key(
    job: Job, df: DataFrame, order: Sequence[str], name: str, stored: bool = False
) -> DataFrame:
    """Add `name`: 1..n over all rows in `order` (ascending, NULL first), as a bigint.

    The rows are range-partitioned and sorted in parallel; a row's key is its position in its
    range plus the number of rows in the ranges before it. The number of the row in the scan of
    the staged files ends the sort order, which makes it total: copies of one value are split
    over several ranges, and a repeated task gives the same positions. Say `stored` when `df` is
    a stored table or columns of one, which need not be staged.
    """
    placed = in_ranges(job, df, order, stored)

    # One row per range, so this window sees as many rows as there are shuffle partitions.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_range").agg(F.count("*").alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    keyed = placed.join(F.broadcast(offsets), "_range")
    key = (F.col("_offset") + F.col("_position") + 1).cast("bigint")
    return keyed.select(key.alias(name), *df.columns)
