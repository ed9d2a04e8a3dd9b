"""Contiguous shards of nearly equal size, with DataFrame functions only.

The rows are put in order, each gets the sum of all sizes before it, and the total is cut at
equal targets: a row goes to the shard in whose target the middle of its size lies. Shards are
therefore runs of the order, and each differs from the mean by less than the largest size on
either side.

The prefix sums are global without one task seeing all rows: a range partitioning with a sort
inside each range, running sums inside a range, one total per range, and the sums of the totals
before it, which is one row per range. The range bounds come from all of `order` and the number of
the row in the scan of the staged rows, so copies of one row are split as well and a hot key is no
hot range. Only `order`, sizes and the other columns given move; give ids, not texts.

A null size counts as 0, negative sizes are refused. Nulls come first in the order; rows alike in
all of `order` keep the order of the scan of the staged rows. No rows give no shards, and fewer
rows than shards, or a row above the target, leave some shards empty. Texts of any length are
measured whole. A result replaces an input column of its name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverlode.job import Job
from silverlode.llm import text as tx

SHARDS = 40
# Bytes that a row takes beside its text.
OVERHEAD = 16
# monotonically_increasing_id holds the task number above 33 bits of row position.
_POSITION_BITS = 33


def text_size(text: str = "text", overhead: int = OVERHEAD) -> Column:
    """UTF-8 bytes of a text (none for null) and what its row takes beside it."""
    return F.coalesce(F.octet_length(f"`{text}`"), F.lit(0)).cast("long") + overhead


def contiguous_shards(
    spark: SparkSession, rows: DataFrame, size: str = "size", order: Sequence[str] = ("doc_id",),
    shards: int = SHARDS,
) -> DataFrame:
    """Every row with its shard (0 to shards - 1) and slot (its place there, gapless from 0)."""
    if shards < 1:
        raise ValueError("at least one shard")
    job = Job(spark).part("shards")
    packed = rows.select(
        tx.whole_row(rows), *(F.col(f"`{name}`").alias(f"_o{k}") for k, name in enumerate(order)),
        _checked(F.col(f"`{size}`")).alias("_size"),
    )
    staged = job.stage(packed, "unordered").withColumn("_n", F.monotonically_increasing_id())
    total_order = [F.asc_nulls_first(f"_o{k}") for k in range(len(order))] + [F.asc("_n")]
    ranged = staged.repartitionByRange(*total_order).sortWithinPartitions(*total_order)
    place = ranged.withColumn("_at", F.monotonically_increasing_id()).select(
        "_row", "_size", F.shiftright("_at", _POSITION_BITS).alias("_range"),
        F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_position"),
    )
    placed = job.stage(place, "ordered")

    # One row per range, so these windows see as many rows as there are shuffle partitions.
    totals = placed.groupBy("_range").agg(
        F.sum("_size").alias("_bytes"), F.count("*").alias("_rows")
    )
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("_range").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    offsets = totals.select(
        "_range", F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(every).alias("_total"),
    )
    running = Window.partitionBy("_range").orderBy("_position").rowsBetween(
        Window.unboundedPreceding, -1
    )
    summed = placed.withColumn("_before", F.coalesce(F.sum("_size").over(running), F.lit(0)))
    middle = 2 * (F.col("_bytes_before") + F.col("_before")) + F.col("_size")
    shard = F.least(_div(middle, F.col("_total"), shards), F.lit(shards - 1)).cast("int")
    dealt = summed.join(F.broadcast(offsets), "_range").select(
        "_row", shard.alias("_shard"), (F.col("_rows_before") + F.col("_position")).alias("_place")
    )
    dealt = job.stage(dealt, "dealt")
    first = dealt.groupBy("_shard").agg(F.min("_place").alias("_first"))  # one row per shard
    return tx.unfold(dealt.join(F.broadcast(first), "_shard"), rows, {
        "shard": F.col("_shard"), "slot": F.col("_place") - F.col("_first"),
    })


def _checked(size: Column) -> Column:
    whole = F.coalesce(size.cast("long"), F.lit(0))
    refused = F.raise_error(F.concat(F.lit("negative size: "), whole.cast("string")))
    return F.when(whole >= 0, whole).otherwise(refused.cast("long"))


def _div(middle: Column, total: Column, shards: int) -> Column:
    """The target that holds the middle (twice the place), in whole numbers beyond 64 bits; 0 if
    all sizes are 0."""
    wide = middle.cast("decimal(20,0)") * shards
    return F.when(total > 0, F.floor(wide / (total.cast("decimal(20,0)") * 2))).otherwise(0)


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write the rows by shard, in slot order: folder `shard=N`, files in order of their names.

    The rows are dealt out by shard and slot, so a shard of any size is written by many tasks.
    """
    order = [F.col("shard"), F.col("slot")]
    sharded.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy(
        "shard"
    ).parquet(path)
