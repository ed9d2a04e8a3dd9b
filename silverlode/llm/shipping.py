"""Python tasks that import this library wherever they run."""

from __future__ import annotations

import ctypes
import gc
import io
import sys
import threading
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

import silverlode
from silverlode.job import Job
from silverlode.sources import Files

# Bytes of the batches that go to a task; a longer row is a batch of its own. Spark sets none, so
# that 10,000 texts of any length stay in memory on both sides at once, and double where they grow.
BATCH_BYTES = 4 * 1024 * 1024
_MOST = "spark.sql.execution.arrow.maxBytesPerBatch"

_shipped: set[str] = set()
_shipping = threading.Lock()


def in_arrow(df: DataFrame, work: Callable, schema: T.StructType) -> DataFrame:
    """`df.mapInArrow` whose tasks can import this library, get batches of few bytes, and begin and
    leave their worker process without free memory that it kept. The size of batches is a setting
    of the session, which stays; the session's own holds where it has one."""
    _ship(df.sparkSession)
    if df.sparkSession.conf.get(_MOST, None) is None:
        df.sparkSession.conf.set(_MOST, str(BATCH_BYTES))

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        yield from work(batches)
        give_back()

    return df.mapInArrow(lean, schema)


def give_back() -> None:
    """Free memory goes back to the system; workers are reused, also by stages of other work."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def _ship(spark: SparkSession) -> None:
    """Send the library's modules to the executors, once per application, through the shared
    folder; the driver may have them on a path of its own only."""
    with _shipping:
        if spark.sparkContext.applicationId in _shipped:
            return
        top = Path(silverlode.__file__).parent
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
            for module in sorted(top.rglob("*.py")):
                archive.write(module, module.relative_to(top.parent))
        path = f"{Job(spark).folder}/silverlode.zip"
        Files(spark).write_new(path, packed.getvalue())
        spark.sparkContext.addPyFile(path)
        _shipped.add(spark.sparkContext.applicationId)
