"""A table in folders by month, replaced month by month and read by date range."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.job import Job
from silverlode.sources.files import Files

MONTH = "month_begin"
_LOAD = "_load"
# What Spark calls the folder of rows without a date.
_UNDATED = "__HIVE_DEFAULT_PARTITION__"


class MonthlyTable:
    """Rows under `root/month_begin=<first day>/_load=<id>`; a published file names the load that
    is current for each month.

    A replacement writes its own months only, beside the current ones, and publishes them all at
    once. Readers list the folders of the months that they ask for. What the last publication
    showed is kept for queries that still read it. One replacement at a time.
    """

    def __init__(self, job: Job, root: str, schema: T.StructType, date: str) -> None:
        if {MONTH, _LOAD} & set(schema.fieldNames()):
            raise ValueError(f"the columns {MONTH} and {_LOAD} are taken")
        self.job, self.root, self.date = job, root.rstrip("/"), date
        self.schema = schema
        self.files = Files(job.spark)

    def _published(self) -> list[str]:
        names = self.files.names(f"{self.root}/_published")
        return [f"{self.root}/_published/{name}" for name in names if name.endswith(".json")]

    def loads(self) -> dict[str, str]:
        """The current load of each month; months are named by their folders."""
        published = self._published()
        return json.loads(self.files.read(published[-1])) if published else {}

    def read(self, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """All rows, or those of the dates from `first` to `last` (both included), with the month
        as `month_begin`. Only folders of months in that range are listed and read; a join on
        `month_begin` prunes further while it runs. Rows without a date are in no range."""
        ranged = first is not None or last is not None
        places = [
            f"{self.root}/{MONTH}={month}/{_LOAD}={load}" for month, load in self.loads().items()
            if not ranged or _meets(month, first, last)
        ]
        stored = T.StructType([
            *self.schema.fields, T.StructField(MONTH, T.DateType()), T.StructField(_LOAD, T.StringType())
        ])
        if not places:
            return self.job.spark.createDataFrame([], stored).drop(_LOAD)
        rows = self.job.spark.read.schema(stored).option("basePath", self.root).parquet(*places)
        if first is not None:
            rows = rows.filter(F.col(self.date) >= F.lit(first))
        if last is not None:
            rows = rows.filter(F.col(self.date) <= F.lit(last))
        return rows.drop(_LOAD)

    def replace(self, rows: DataFrame, months: Iterable[dt.date] | None = None) -> int:
        """Put `rows` in place of all rows of their months; returns their number.

        With `months` (any day of each) exactly these are replaced: those without new rows become
        empty, and a row of another month, or without a date, fails the load before anything is
        published. Without it the months of the rows are replaced, and the undated rows as one
        more when there are any. AQE splits a month over tasks by its size, whatever its share.
        """
        month, watch = F.trunc(F.col(self.date), "month"), Observation()
        asked = None if months is None else sorted({day.replace(day=1) for day in months})
        stray = F.lit(0) if asked is None else F.count_if(
            ~F.coalesce(month.isin(asked), F.lit(False))
        )
        load = uuid.uuid4().hex
        dated = rows.select(self.schema.fieldNames()).withColumns({MONTH: month, _LOAD: F.lit(load)})
        counted = dated.hint("rebalance", MONTH).observe(
            watch, F.count(F.lit(1)).alias("rows"), stray.cast("bigint").alias("stray")
        )
        try:
            counted.write.mode("append").partitionBy(MONTH, _LOAD).parquet(self.root)
            if watch.get["stray"]:
                raise ValueError(f"{watch.get['stray']} rows are of none of the months to replace")
        except Exception:
            self._remove(load)
            raise
        written = self._months_of(load)
        current = self.loads()
        for day in asked or ():
            current.pop(day.isoformat(), None)
        self._publish(current | {name: load for name in written})
        return watch.get["rows"]

    def _month_folders(self) -> list[str]:
        prefix = f"{MONTH}="
        return [name.removeprefix(prefix) for name in self.files.names(self.root) if name.startswith(prefix)]

    def _months_of(self, load: str) -> list[str]:
        return [month for month in self._month_folders()
                if f"{_LOAD}={load}" in self.files.names(f"{self.root}/{MONTH}={month}")]

    def _remove(self, load: str) -> None:
        for month in self._months_of(load):
            self.files.remove(f"{self.root}/{MONTH}={month}/{_LOAD}={load}")

    def _publish(self, current: dict[str, str]) -> None:
        last, number = self.loads(), len(self._published()) + 1
        self.files.write_new(f"{self.root}/_published/{number:08d}.json", json.dumps(current))
        for month in self._month_folders():
            kept = {current.get(month), last.get(month)}
            for name in self.files.names(f"{self.root}/{MONTH}={month}"):
                if name.startswith(f"{_LOAD}=") and name.removeprefix(f"{_LOAD}=") not in kept:
                    self.files.remove(f"{self.root}/{MONTH}={month}/{name}")


def _meets(month: str, first: dt.date | None, last: dt.date | None) -> bool:
    if month == _UNDATED:
        return False
    begin = dt.date.fromisoformat(month)
    return (first is None or begin >= first.replace(day=1)) and (last is None or begin <= last)
