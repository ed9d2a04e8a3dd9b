"""Equi-joins that stay balanced when one key value holds a large part of a side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.job import Job

# Optional column with a fixed number per row, given at the scan by `number_rows`.
ROW_ID = "_row_id"


def number_rows(df: DataFrame) -> DataFrame:
    """Number the rows of a table scan. Use on stored tables only: there a retried task sees
    the same rows in the same order, so the numbers do not change."""
    return df.withColumn(ROW_ID, F.monotonically_increasing_id())


# Sampled rows expected of a key at the hot limit; half of them make a key hot, so that a key at
# the limit is practically never missed and one at a quarter of it practically never taken.
_HITS = 100


def hot_keys(job: Job, df: DataFrame, key: str) -> DataFrame | None:
    """Values of `key` (NULL included) with more rows than the hot limit, as (key, rows); None
    when there are none.

    `df` is a stored table: its row count comes from the file footers, and a table smaller than
    the limit ends here. Else the key column is sampled, thinly enough that about ten million
    sampled rows at most are grouped. Which keys count as hot decides how rows are spread, never which
    rows come out, so the sample cannot change a result. At most `2 * hot_keys` values can
    qualify, which bounds what is broadcast. A job looks at the same key of the same rows once.
    """
    asked = (df.semanticHash(), key, job.limits)
    for before, found in job.found_hot.get(asked, []):
        if before.sameSemantics(df):
            return found
    found = _find_hot(job, df, key)
    job.found_hot.setdefault(asked, []).append((df, found))
    return found


def _find_hot(job: Job, df: DataFrame, key: str) -> DataFrame | None:
    total = df.count()
    limit = job.limits.hot_limit(total)
    if total <= limit:
        return None
    fraction = min(1.0, _HITS / limit)
    seen, needed = df.select(F.col(key).alias("key")), float(limit)
    if fraction < 1.0:
        seen, needed = seen.sample(fraction, seed=1), _HITS / 2
    counts = seen.groupBy("key").agg(F.count("*").alias("seen"))
    rows = F.ceil(F.col("seen") / F.lit(fraction)).cast("bigint")
    hot = job.stage(counts.filter(F.col("seen") > needed).select("key", rows.alias("rows")), "hot_keys")
    return None if hot.isEmpty() else hot


def split_hot(df: DataFrame, key: str, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is not hot, and rows whose key is."""
    match = F.col(key).eqNullSafe(F.col("hot.key"))
    side = F.broadcast(hot).alias("hot")
    return df.join(side, match, "left_anti"), df.join(side, match, "left_semi")


def is_small(job: Job, df: DataFrame) -> bool:
    """Whether `df` may be broadcast. Its rows are counted first, for a stored table from the
    file footers; only a table of few rows is read, to sum the bytes of its values, since the
    declared text lengths are not enforced."""
    if df.count() > job.limits.broadcast_rows:
        return False
    values = [F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) for name in df.columns]
    size = df.agg(F.sum(reduce(Column.__add__, values).cast("bigint"))).first()[0] or 0
    return size <= job.limits.broadcast_bytes


def balanced_join(
    job: Job, left: DataFrame, right: DataFrame, left_key: str, right_key: str,
    how: str = "left", left_source: DataFrame | None = None,
) -> DataFrame:
    """Left, inner or left-semi equi-join of two stored tables (or row-wise selections of them).

    When `left` already is a join, `left_source` names the stored table its rows come from: hot
    keys are looked up there, and `left` has to carry the row numbers of `number_rows`.

    - right side small, as measured: broadcast, the left side does not move;
    - otherwise a shuffle join; if a key is hot on either side, its rows are dealt over a grid
      of cells (left rows over the cell rows, right rows over the cell columns) and each cell is
      joined alone. Every matching pair still meets exactly once.

    Text keys meet as `job.collation` says. Hashes, hot keys and cells follow it as well, since
    they are taken from the collated keys; each row keeps its own spelling.
    """
    if how not in ("left", "inner", "left_semi"):
        raise ValueError(f"unsupported join type {how}")
    if job.collation is None or not isinstance(left.schema[left_key].dataType, T.StringType):
        return _joined(job, left, right, left_key, right_key, how, left_source)
    joined = _joined(
        job, *(_collated(df, key, job.collation) for df, key in (
            (left, left_key), (right, right_key))), left_key, right_key, how,
        None if left_source is None else _collated(left_source, left_key, job.collation),
    )
    # The result's keys compare exactly again, as every other column.
    return joined.withColumns({key: F.collate(key, "UTF8_BINARY") for key in (left_key, right_key)
                               if key in joined.columns})


def _collated(df: DataFrame, key: str, collation: str) -> DataFrame:
    return df.withColumn(key, F.collate(key, collation))


def _joined(
    job: Job, left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str,
    left_source: DataFrame | None,
) -> DataFrame:
    if how == "left_semi":
        keys = right.select(right_key)
        right = keys.distinct()
        if keys.count() > job.limits.broadcast_rows:
            right = job.stage(right, "distinct_keys")  # made distinct once, measured and joined
    on_key = F.col(left_key) == F.col(right_key)
    if is_small(job, right):
        return left.join(F.broadcast(right), on_key, how)

    hot_left = hot_keys(job, left if left_source is None else left_source, left_key)
    hot_right = None if how == "left_semi" else hot_keys(job, right, right_key)
    if hot_left is None and hot_right is None:
        return left.join(right, on_key, how)
    grid = _grid(job, hot_left, hot_right)

    keep = list(left.columns)
    if ROW_ID not in keep:
        left = number_rows(left)
    left = _deal(left, left_key, grid, own="left_parts", other="right_parts")
    left = left.withColumnsRenamed({"_own": "_left_part", "_copy": "_right_part"})
    if how == "left_semi":
        # Right keys are distinct here, so they carry no parts of their own.
        right = _deal(right, right_key, grid, own=None, other="left_parts")
        right = right.select(right_key, F.col("_copy").alias("_part"))
        cell = on_key & (F.col("_left_part") == F.col("_part"))
        return left.join(right, cell, how).select(keep)

    right_columns = list(right.columns)
    right = _deal(number_rows(right), right_key, grid, own="right_parts", other="left_parts")
    right = right.select(
        *right_columns, F.col("_own").alias("_r_part"), F.col("_copy").alias("_l_part")
    )
    cell = on_key & (F.col("_left_part") == F.col("_l_part")) & (F.col("_right_part") == F.col("_r_part"))
    joined = left.join(right, cell, how)
    if how == "left":
        # A left row copied into several cells has a match in at least one of them, so its
        # copies without a match are dropped; rows in a single cell are kept as they are.
        joined = joined.filter((F.col("_cells") == 1) | F.col("_r_part").isNotNull())
    return joined.select(*keep, *right_columns)


def _grid(job: Job, hot_left: DataFrame | None, hot_right: DataFrame | None) -> DataFrame:
    """Per hot key: into how many parts each side is dealt."""

    def parts(hot: DataFrame, name: str) -> DataFrame:
        count = F.ceil(F.col("rows") / F.lit(job.limits.hot_rows)).cast("int")
        return hot.select("key", count.alias(name))

    sides = [
        parts(hot, name)
        for hot, name in ((hot_left, "left_parts"), (hot_right, "right_parts"))
        if hot is not None
    ]
    if len(sides) == 1:
        return sides[0].withColumns({
            name: F.lit(1) for name in {"left_parts", "right_parts"} - set(sides[0].columns)
        })
    merged = sides[0].unionByName(sides[1], allowMissingColumns=True)
    return merged.groupBy("key").agg(
        F.coalesce(F.max("left_parts"), F.lit(1)).alias("left_parts"),
        F.coalesce(F.max("right_parts"), F.lit(1)).alias("right_parts"),
    )


def _deal(df: DataFrame, key: str, grid: DataFrame, own: str | None, other: str) -> DataFrame:
    """Give each row its part on its own side and copy it to every part of the other side."""
    # NULL keys match nothing: they are spread, never copied.
    def parts(name: str) -> Column:
        return F.coalesce(F.col(f"_grid.{name}"), F.lit(1))

    own_part = F.lit(0) if own is None else F.pmod(F.col(ROW_ID), parts(own)).cast("int")
    copies = F.when(F.col(key).isNull(), F.lit(1)).otherwise(parts(other))
    dealt = df.join(
        F.broadcast(grid).alias("_grid"), F.col(key).eqNullSafe(F.col("_grid.key")), "left"
    )
    return dealt.select(
        *[F.col(name) for name in df.columns], own_part.alias("_own"), copies.alias("_cells")
    ).withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_cells") - 1)))
