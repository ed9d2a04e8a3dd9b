"""Answers from the statistics in Parquet footers, without reading rows."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What Spark says of a row group that has no bounds, since all of its values are NULL.
_NO_BOUNDS = "No min/max found"


def footer_session(spark: SparkSession) -> SparkSession:
    """A session over the same tables that answers least, greatest and counted values of whole
    Parquet tables from footers. `spark` keeps its own settings."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def bounds(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows, and low_i, high_i, count_i of each column."""
    return table.agg(F.count(F.lit(1)).alias("rows"), *(
        fact(name).alias(f"{label}_{i}") for i, name in enumerate(columns)
        for label, fact in (("low", F.min), ("high", F.max), ("count", F.count))
    ))


def extremes(
    spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str]
) -> DataFrame:
    """Two rows with the least and the greatest value of each column of a stored table, NULL for a
    column without values; they come from one row of facts, computed here and now.

    Footers hold the bounds of numbers and dates. If one row group has NULLs alone, or a column is
    of another type, the columns are read instead, and those alone.
    """
    try:
        found = bounds(footer_session(spark).read.schema(schema).parquet(path), columns).first()
    except (Py4JJavaError, PySparkException) as error:
        if _NO_BOUNDS not in str(error):
            raise
        found = bounds(spark.read.schema(schema).parquet(path), columns).first()
    kept = T.StructType([schema[name] for name in columns])
    return spark.createDataFrame(
        [tuple(found[f"{label}_{i}"] for i in range(len(columns))) for label in ("low", "high")],
        T.StructType([T.StructField(field.name, field.dataType) for field in kept]),
    )
