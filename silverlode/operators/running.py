"""Running sums and counts over unaggregated rows, with no task that holds a whole group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverlode.job import Job
from silverlode.operators.keys import in_ranges

_TAKEN = ("_number", "_place", "_range", "_position")


def with_running(
    job: Job, df: DataFrame, group: Sequence[str], order: Sequence[str],
    sums: Mapping[str, str], counts: Mapping[str, str] | None = None, stored: bool = False,
) -> DataFrame:
    """Add running sums and counts ({new name: column}), from the first row of a group in `order`
    up to each row. Rows that tie in `order` follow each other by their other columns.

    NULL is neither summed nor counted; a sum is NULL until the first value. A group of NULLs is a
    group, and NULL is ordered first. An empty `group` runs over the whole table.

    The rows are sorted into ranges across tasks, so a group of any size lies in several of them. Rows
    are summed up inside their range; what the ranges before it hold of the same group is added.
    Only the first group of a range can have begun before it, so there is at most one such
    remainder per range, and these alone are broadcast.
    """
    counts = dict(counts or {})
    clash = {*sums, *counts, *_TAKEN} & {*df.columns} | {*sums} & {*counts}
    if clash:
        raise ValueError(f"names are taken: {', '.join(sorted(clash))}")
    rest = [name for name in df.columns if name not in (*group, *order)]
    placed = in_ranges(job, df, [*group, *order, *rest], stored)
    block = Window.partitionBy("_range", *group)
    so_far = block.orderBy("_position").rowsBetween(Window.unboundedPreceding, 0)

    def totals(over=None) -> dict[str, Column]:
        found = {name: F.sum(column) for name, column in sums.items()}
        found |= {name: F.count(column) for name, column in counts.items()}
        return found if over is None else {name: f.over(over) for name, f in found.items()}

    blocks = placed.groupBy("_range", *group).agg(
        *(total.alias(name) for name, total in totals().items()), F.min("_position").alias("_first")
    )
    # Blocks that begin a range, each with the earlier blocks of its group: those of whole ranges
    # and the one at the end of the range in which the group began.
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(
        "_range", "_first", *group,
        F.count(F.lit(1)).over(earlier).alias("_blocks"),
        *(F.sum(name).over(earlier).alias(f"_before_{name}") for name in totals()),
    ).filter("_first = 0 and _blocks > 0")
    carried = job.stage(carried.select(
        F.col("_range").alias("_in"), *(F.col(name).alias(f"_of_{name}") for name in group),
        *(f"_before_{name}" for name in totals()),
    ), "carried")

    same = F.col("_range") == F.col("_in")
    for name in group:
        same &= F.col(name).eqNullSafe(F.col(f"_of_{name}"))
    met = placed.withColumns(totals(so_far)).join(F.broadcast(carried), same, "left")
    return met.select(*df.columns, *(
        F.coalesce(F.col(f"_before_{name}") + F.col(name), F.col(name), F.col(f"_before_{name}"))
        .alias(name) for name in totals()
    ))
