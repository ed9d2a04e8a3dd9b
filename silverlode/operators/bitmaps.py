"""Bitmaps built by the tasks: filters that spare a shuffle, and distinct counts that roll up.

A bitmap lies in chunks of `CHUNK` bits (4 KB), one row each, so tasks build and merge parts of it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.job import Job
from silverlode.operators.joins import ROW_ID, balanced_join, number_rows

CHUNK = 1 << 15
# Bits of a filter: 8 MB, whatever the number of keys. A power of two, at least a chunk.
FILTER_BITS = 1 << 26


def _place(job: Job, df: DataFrame, key: str, bits: int) -> Column:
    column = F.col(key)
    if job.collation and isinstance(df.schema[key].dataType, T.StringType):
        column = F.collate(column, job.collation)
    return F.when(F.col(key).isNotNull(), F.xxhash64(column).bitwiseAND(F.lit(bits - 1)))


def key_filter(job: Job, df: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """(_chunk, _bits): a bit per hash of a key, merged from partial bitmaps of the tasks. Its size
    is bounded by `bits`; a full one lets every row through."""
    place = _place(job, df, key, bits)
    return job.stage(
        df.select(place.alias("place")).filter("place is not null")
        .groupBy(F.shiftright("place", 15).alias("_chunk"))
        .agg(F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit(CHUNK - 1))).alias("_bits")),
        "key_filter",
    )


def reduced_join(
    job: Job, left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str,
    bits: int = FILTER_BITS,
) -> DataFrame:
    """Left-semi or left-anti equi-join of two stored tables whose left rows meet a bitmap of the
    right keys where they are scanned, before any shuffle.

    A row without its bit has no partner: a semi-join drops it there, an anti-join keeps it there.
    Only rows with their bit are joined exactly, so the result does not depend on the bitmap.
    NULL keys have no partner.
    """
    if how not in ("left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    keys = job.stage(right.select(F.col(right_key).alias("_key")).distinct(), "distinct_keys")
    chunks = key_filter(job, keys, "_key", bits)
    place = _place(job, left, left_key, bits)
    probed = number_rows(left).withColumn("_place", place).join(
        F.broadcast(chunks), F.shiftright("_place", 15) == F.col("_chunk"), "left"
    )
    at = F.col("_place").bitwiseAND(F.lit(CHUNK - 1)).cast("int")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10)
    bit = F.call_function("shiftright", byte.cast("int"), at % 8) % 2
    marked = probed.select(*left.columns, ROW_ID, (F.coalesce(bit, F.lit(0)) == 1).alias("_may"))
    may = marked.filter("_may").drop("_may")
    if how == "left_semi":
        return balanced_join(job, may, keys, left_key, "_key", how, left_source=left).select(
            left.columns
        )
    sure = marked.filter("not _may").select(left.columns)
    met = balanced_join(job, may, keys, left_key, "_key", "left", left_source=left)
    return sure.unionByName(met.filter(F.col("_key").isNull()).select(left.columns))


def rolled_up_distinct(
    job: Job, df: DataFrame, levels: Sequence[str], distinct: Mapping[str, str]
) -> DataFrame:
    """Exact distinct counts ({name: column}) on every level from all of `levels` (finest last) up
    to the whole table: one row per group, levels it does not have as NULL, and its `level`.

    The columns hold dense surrogate keys (numbers from 0 or 1 on), NULL is not counted. The table
    is read once: each key sets a bit of its finest group's bitmap, in partial aggregates. Those
    bitmaps are staged, and the coarser groups merge the ones below them, not counting again. Made for few groups with
    many keys; a group's bitmap has a row per chunk of keys that it holds.
    """
    pairs = F.array(*(
        F.struct(F.lit(name).alias("of"), F.col(column).cast("bigint").alias("key"))
        for name, column in distinct.items()
    ))
    bitmaps = df.select(*levels, F.inline(pairs)).groupBy(
        *levels, "of", F.shiftright("key", 15).alias("chunk")
    ).agg(F.bitmap_construct_agg(F.col("key").bitwiseAND(F.lit(CHUNK - 1))).alias("bits"))

    def merged(bitmaps: DataFrame, kept: Sequence[str]) -> DataFrame:
        return bitmaps.groupBy(*kept, "of", "chunk").agg(F.bitmap_or_agg("bits").alias("bits"))

    def counted(bitmaps: DataFrame, kept: Sequence[str]) -> DataFrame:
        counts = bitmaps.groupBy(*kept).agg(*(
            F.coalesce(F.sum(F.when((F.col("of") == name) & F.col("chunk").isNotNull(),
                                    F.bitmap_count("bits"))), F.lit(0)).alias(name)
            for name in distinct
        ))
        missing = [F.lit(None).cast(df.schema[level].dataType).alias(level)
                   for level in levels[len(kept):]]
        return counts.select(F.lit(len(kept)).alias("level"), *kept, *missing, *distinct)

    bitmaps = job.stage(bitmaps, "bitmaps")
    results = [counted(bitmaps, levels)]
    for size in range(len(levels) - 1, -1, -1):
        bitmaps = merged(bitmaps, levels[:size])
        results.append(counted(bitmaps, levels[:size]))
    return reduce(DataFrame.unionByName, results)
