"""What a run shares: session, evaluation date, size limits and the shared scratch folder."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITIONS = "spark.sql.shuffle.partitions"


@dataclass(frozen=True)
class Limits:
    """Sizes at which a plan changes its way of moving rows. Results never depend on them."""

    # A join side is broadcast only when it was measured and has at most this many rows and
    # this many bytes of values.
    broadcast_rows: int = 250_000
    broadcast_bytes: int = 64 * 1024 * 1024
    # A key value with more rows than this is hot and is spread over several tasks.
    hot_rows: int = 1_000_000
    # At most this many key values can be hot: the hot limit grows with the table.
    hot_keys: int = 100_000
    # A shuffle of a load has a partition for so many bytes of stored input, at least.
    task_bytes: int = 4 * 1024 * 1024
    # Where rows are dealt apart from a load, a task gets about this many of them.
    task_rows: int = 250_000

    def hot_limit(self, rows: int) -> int:
        return max(self.hot_rows, rows // self.hot_keys)


@dataclass
class Job:
    spark: SparkSession
    as_of: dt.date | None = None
    limits: Limits = field(default_factory=Limits)
    folder: str | None = None
    # How joins and patterns compare text: exactly, or by a collation such as UTF8_LCASE_RTRIM.
    collation: str | None = None
    # Hot keys that were looked up, by what was asked (see `operators.joins.hot_keys`).
    found_hot: dict = field(default_factory=dict, repr=False, compare=False)

    def __post_init__(self) -> None:
        if self.folder is None:
            self.folder = f"{shared_folder(self.spark)}/silverlode-{uuid.uuid4().hex}"

    def today(self) -> Column:
        """The evaluation date: a fixed one when given, else the clock."""
        return F.current_date() if self.as_of is None else F.lit(self.as_of)

    def new_path(self, name: str) -> str:
        return f"{self.folder}/staged/{name}-{uuid.uuid4().hex}"

    def part(self, name: str) -> Job:
        """A job with a folder of its own inside this one's, to be removed when it is done."""
        return replace(self, folder=f"{self.folder}/{name}-{uuid.uuid4().hex}", found_hot={})

    def remove(self) -> None:
        """Remove the folder with all that was staged; nothing read from it may be used later."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)

    @contextmanager
    def shuffles_for(self, size: int) -> Iterator[None]:
        """What runs inside shuffles into a partition for every `limits.task_bytes` of `size`, the
        bytes of stored input, so that what a task sorts does not grow with the input and need
        not spill. The session's own number holds where it is greater, and afterwards."""
        own, wanted = self.spark.conf.get(PARTITIONS), -(-size // self.limits.task_bytes)
        if wanted <= int(own):
            yield
            return
        self.spark.conf.set(PARTITIONS, str(wanted))
        try:
            yield
        finally:
            self.spark.conf.set(PARTITIONS, own)

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write once to the shared folder and read back, so later steps see one fixed copy.

        Unlike a cache it survives lost executors, and unlike a checkpoint it keeps column
        pruning and the row position of each file.
        """
        path = self.new_path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary folder only in local mode without one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return tempfile.mkdtemp(prefix="silverlode-")
    raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
