"""Stored tables: versions with counted rows and set-aside rejects, and the log of all loads."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from silverlode.schemas import RUN_LOG
from silverlode.sources.delimited import REJECT, SOURCE_FILE

_REFUSED = "refused"
# Versions take about a quarter less storage than in Spark's own choice, snappy.
_CODEC = "zstd"


class LoadFailed(RuntimeError):
    """A load had more rejected lines, or more exceptions in a check, than allowed."""


class RunLog:
    """One row per table load and one per whole layer, kept as a table beside the layers."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path
        self._entries: list[tuple] = []

    def add(
        self, layer: str, table: str, rows: int | None, rejected: int | None, seconds: float,
        status: str, message: str | None = None,
    ) -> None:
        now = dt.datetime.now()
        self._entries.append((layer, table, rows, rejected, seconds, status, now, message))

    def write(self) -> DataFrame:
        """Append the collected entries to the stored log; returns them."""
        entries, self._entries = self._entries, []
        lines = self.spark.createDataFrame(entries, RUN_LOG).coalesce(1)
        lines.write.mode("append").parquet(self.path)
        return lines

    def read(self) -> DataFrame:
        return self.spark.read.schema(RUN_LOG).parquet(self.path)


class Written(NamedTuple):
    """Where the good rows of a version are, their number, that of the rejected ones, and what was
    asked of the good ones."""

    place: str
    rows: int
    rejected: int
    facts: dict[str, int]


def write_version(
    rows: DataFrame, path: str, facts: Mapping[str, Column] | None = None
) -> Written:
    """Write rows to a new folder.

    Rows are counted while they are written, and `facts`, aggregates by name, are taken in the same
    pass, so the input is read once. Lines that `read_extract` marked as rejected go to a folder of their
    own; facts are asked of rows without such marks only.
    """
    facts, watch = dict(facts or {}), Observation()
    marked = REJECT in rows.columns
    if facts and marked:
        raise ValueError("facts are taken of cleaned rows, not of marked ones")
    names = {f"fact_{i}": name for i, name in enumerate(facts)}
    asked = [facts[name].alias(column) for column, name in names.items()]
    if marked:
        asked.append(F.count(F.col(REJECT)).alias("rejected"))
    counted = rows.observe(watch, F.count(F.lit(1)).alias("rows"), *asked)
    if not marked:
        counted.write.parquet(path, compression=_CODEC)
        seen = watch.get
        return Written(path, seen["rows"], 0, {name: seen[column] for column, name in names.items()})
    marked_rows = counted.withColumn(_REFUSED, F.col(REJECT).isNotNull())
    marked_rows.write.partitionBy(_REFUSED).parquet(path, compression=_CODEC)
    rejected = watch.get["rejected"]
    good = watch.get["rows"] - rejected
    place = f"{path}/{_REFUSED}=false"
    if not good:  # no row, no folder
        rows.limit(0).write.parquet(place)
    return Written(place, good, rejected, {})


def rejected_lines(spark: SparkSession, path: str, load_id: str, table: str) -> DataFrame:
    """(load_id, table_name, file, line) of the lines set aside by `write_version`."""
    aside = spark.read.schema(f"{SOURCE_FILE} string, {REJECT} string").parquet(
        f"{path}/{_REFUSED}=true"
    )
    return aside.select(
        F.lit(load_id).alias("load_id"), F.lit(table).alias("table_name"),
        F.col(SOURCE_FILE).alias("file"), F.col(REJECT).alias("line"),
    )
