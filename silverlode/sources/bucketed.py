"""Stored tables laid out by a key, so that joins on it move no rows."""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.job import Job
from silverlode.operators.joins import balanced_join, hot_keys, is_small, split_hot
from silverlode.sources.files import Files

# Rows of hot keys lie in a folder of their own, as they came.
_HOT = "hot_key"
_LAYOUT = "_layout.json"
HOWS = ("inner", "left", "left_semi")


class Buckets(NamedTuple):
    """How a table is laid out: the rows of a key lie in one of `count` buckets, sorted by key."""

    key: str
    count: int


class BucketedTable(NamedTuple):
    """A table with a layout: the rows in buckets, the rows of hot keys, and those keys."""

    layout: Buckets
    rows: DataFrame
    hot_rows: DataFrame
    hot_keys: DataFrame

    def all_rows(self) -> DataFrame:
        return self.rows.unionByName(self.hot_rows)

    def selected(self, **names: str) -> BucketedTable:
        """The columns `names` (new name: stored name) alone; the key has to be among them."""
        key = {stored: new for new, stored in names.items()}[self.layout.key]

        def select(df: DataFrame) -> DataFrame:
            return df.select(*(F.col(stored).alias(new) for new, stored in names.items()))

        return self._replace(
            layout=self.layout._replace(key=key), rows=select(self.rows),
            hot_rows=select(self.hot_rows),
        )


def write_bucketed(job: Job, df: DataFrame, path: str, layout: Buckets) -> None:
    """Write a stored table (or row-wise selections of one) anew in buckets by `layout.key`.

    The rows are shuffled once here, to a task and a file per bucket, instead of in every join.
    Rows of hot keys, NULL included, stay where they are and go beside the buckets, so that no
    bucket grows with one key. The layout is stored with the rows.
    """
    if {_HOT, "_key"} & set(df.columns):
        raise ValueError(f"the columns {_HOT} and _key are taken")
    spark = job.spark
    hot = hot_keys(job, df, layout.key)
    if hot is None:
        cold_rows, hot_rows = df, df.limit(0)
        keys = df.select(F.col(layout.key).alias("key")).limit(0)
    else:
        cold_rows, hot_rows = split_hot(df, layout.key, hot)
        keys = hot.select("key")
    table = f"bucketed_{uuid.uuid4().hex}"
    # Only a table of the catalog can be written in buckets; what counts are its files.
    cold_rows.repartition(layout.count, layout.key).write.format("parquet").bucketBy(
        layout.count, layout.key
    ).sortBy(layout.key).option("path", f"{path}/{_HOT}=false").saveAsTable(table)
    spark.sql(f"drop table {table}")
    hot_rows.write.parquet(f"{path}/{_HOT}=true")
    keys.write.parquet(f"{path}/_hot_keys")
    Files(spark).write_new(f"{path}/{_LAYOUT}", json.dumps(layout._asdict()))


def read_layout(job: Job, path: str) -> Buckets | None:
    """The layout that is stored with a table; None for one without."""
    files = Files(job.spark)
    if _LAYOUT not in files.names(path):
        return None
    return Buckets(**json.loads(files.read(f"{path}/{_LAYOUT}")))


def read_bucketed(job: Job, path: str, schema: T.StructType) -> BucketedTable:
    """Read a table of `write_bucketed` with its layout, in any session.

    The session's catalog gets a name for the files, under which Spark knows their buckets; it is
    the same for every reader of a version and holds no rows.
    """
    spark, layout = job.spark, read_layout(job, path)
    if layout is None:
        raise ValueError(f"{path} has no buckets")
    table = f"bucketed_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
    columns = ", ".join(
        f"{_quoted(field.name)} {field.dataType.simpleString()}" for field in schema.fields
    )
    place = f"{path}/{_HOT}=false".replace("\\", "\\\\").replace("'", "\\'")
    key = _quoted(layout.key)
    spark.sql(
        f"create table if not exists {table} ({columns}) using parquet clustered by ({key}) "
        f"sorted by ({key}) into {layout.count} buckets location '{place}'"
    )
    key_type = schema[layout.key].dataType
    return BucketedTable(
        layout, spark.table(table),
        spark.read.schema(schema).parquet(f"{path}/{_HOT}=true"),
        spark.read.schema(T.StructType([T.StructField("key", key_type)])).parquet(f"{path}/_hot_keys"),
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def bucketed_join(job: Job, left: BucketedTable, right: BucketedTable, how: str = "left") -> DataFrame:
    """Left, inner or left-semi equi-join of two tables on the keys of their layouts.

    - A right side that was measured to be small is broadcast.
    - Else buckets of the same number meet where they lie, without a shuffle on either side. With
      different numbers of buckets Spark shuffles the side that has fewer of them.
    - The keys that are hot in either table, a bounded number, leave both sides' buckets at the
      scan and meet by `balanced_join`, dealt over several tasks. Each key is on one of the two
      ways only, so the result is the same as that of a plain join. Text keys compare exactly.
    """
    if how not in HOWS:
        raise ValueError(f"unsupported join type {how}")
    if set(left.rows.columns) & set(right.rows.columns):
        raise ValueError("columns of both tables have the same name; rename them by selected()")
    if job.collation is not None and isinstance(
        left.rows.schema[left.layout.key].dataType, T.StringType
    ):
        raise ValueError("buckets compare text exactly; join by balanced_join under a collation")
    left_key, right_key = left.layout.key, right.layout.key
    if is_small(job, right.all_rows()):
        on_key = F.col(left_key) == F.col(right_key)
        return left.all_rows().join(F.broadcast(right.all_rows()), on_key, how)

    hot = left.hot_keys.unionByName(right.hot_keys).distinct()
    if hot.isEmpty():
        return _meet(left.rows, right.rows, left_key, right_key, how)
    hot = job.stage(hot, "hot_of_either")
    left_rows, left_more = split_hot(left.rows, left_key, hot)
    right_rows, right_more = split_hot(right.rows, right_key, hot)
    met = _meet(left_rows, right_rows, left_key, right_key, how)
    spread = balanced_join(
        job, left_more.unionByName(left.hot_rows), right_more.unionByName(right.hot_rows),
        left_key, right_key, how,
    )
    return met.unionByName(spread)


def _meet(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str) -> DataFrame:
    """A merge join, whatever sizes Spark expects: a broadcast is decided by a measure alone."""
    return left.join(right.hint("merge"), F.col(left_key) == F.col(right_key), how)
