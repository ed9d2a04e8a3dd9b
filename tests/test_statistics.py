import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows
from silverlode.sources.statistics import bounds, extremes, footer_session


def stored(spark, job, where="true", files=3):
    path = job.new_path("stored")
    spark.sql(
        "select id as n, case when id % 3 > 0 then date_add(date'2020-01-01', cast(id % 900 as int)) end as d,"
        f" cast(id as string) as t, cast(null as int) as none from range(5000) where {where}"
    ).repartition(files).write.parquet(path)
    return path, spark.read.parquet(path).schema


def test_bounds_come_from_footers(spark, job):
    path, schema = stored(spark, job)
    found = bounds(footer_session(spark).read.schema(schema).parquet(path), ["n", "d"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(n), MAX(n), COUNT(n), MIN(d), MAX(d), COUNT(d)]" in plan
    assert rows(found) == [
        (5000, 0, 4999, 5000, dt.date(2020, 1, 2), dt.date(2022, 6, 18), 3333)
    ]
    # The caller's session reads as before.
    assert "FileScan" in spark.read.parquet(path).agg({"n": "max"})._jdf.queryExecution().toString()


@pytest.mark.parametrize("where", ["true", "id < 0", "id % 3 = 0", "id = 4"])
def test_extremes_like_a_scan(spark, job, where):
    path, schema = stored(spark, job, where)
    columns = ["d", "t", "none", "n"]
    table = spark.read.parquet(path)
    scanned = [tuple(table.agg(*map(fact, columns)).first()) for fact in (F.min, F.max)]
    assert rows(extremes(spark, path, schema, columns)) == sorted(scanned, key=repr)


def test_a_row_group_of_nulls_beside_others(spark, job):
    path, schema = stored(spark, job, "id % 3 > 0", 1)
    spark.read.parquet(path).withColumn("d", F.lit(None).cast("date")).write.mode("append").parquet(path)
    found = [row.d for row in extremes(spark, path, schema, ["d"]).collect()]
    assert found == [dt.date(2020, 1, 2), dt.date(2022, 6, 18)]
