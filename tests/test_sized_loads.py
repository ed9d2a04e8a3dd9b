"""Loads deal their shuffles by the size of their input, and leave the session as it was."""

import pytest
from pyspark.sql import functions as F

from helpers import AS_OF, date, rows
from silverlode import Job, Limits, Warehouse
from silverlode.plans import silver
from silverlode.schemas import BRONZE

PARTITIONS = "spark.sql.shuffle.partitions"


def raw(spark):
    found = {name: spark.createDataFrame([], BRONZE[name]) for name in BRONZE}
    found["crm_cust_info"] = spark.createDataFrame(
        [(i % 7, f"AW{i}", "A", "B", "S", "M", date("2020-01-01")) for i in range(50)],
        BRONZE["crm_cust_info"],
    )
    return found


def load(spark, limits, monkeypatch):
    """The cleaned customers, and the number of partitions while they were cleaned."""
    seen, clean = [], silver.clean_customers
    monkeypatch.setattr(silver, "clean_customers", lambda table: (
        seen.append(int(spark.conf.get(PARTITIONS))), clean(table))[1])
    store = Warehouse(Job(spark, AS_OF, limits))
    store.load_bronze(raw(spark))
    store.load_silver()
    return rows(store.silver("crm_cust_info").drop("dwh_create_date")), seen


def test_a_load_has_a_partition_for_so_many_bytes_of_input(spark, monkeypatch):
    own = spark.conf.get(PARTITIONS)
    few, seen_few = load(spark, Limits(), monkeypatch)
    many, seen_many = load(spark, Limits(task_bytes=500), monkeypatch)
    assert few == many and len(many) == 7
    assert seen_few[0] == int(own) < seen_many[0]
    assert spark.conf.get(PARTITIONS) == own


def test_raw_rows_count_by_the_files_they_come_from(spark, tmp_path):
    spark.range(1000).withColumn("text", F.lit("a b")).write.parquet(f"{tmp_path}/a table")
    store = Warehouse(Job(spark, AS_OF))
    files = spark.read.parquet(f"{tmp_path}/a table").inputFiles()
    assert sum(map(store.files.size, files)) == sum(
        file.stat().st_size for file in tmp_path.rglob("part-*")
    )


def test_a_failed_load_leaves_the_session_as_it_was(spark, monkeypatch):
    own = spark.conf.get(PARTITIONS)
    store = Warehouse(Job(spark, AS_OF, Limits(task_bytes=500)))
    store.load_bronze(raw(spark))

    def fail(table):
        raise RuntimeError("no cleaning")

    monkeypatch.setattr(silver, "clean_customers", fail)
    with pytest.raises(RuntimeError, match="no cleaning"):
        store.load_silver()
    assert spark.conf.get(PARTITIONS) == own


def test_versions_are_written_as_zstd(spark):
    store = Warehouse(Job(spark, AS_OF))
    store.load_bronze(raw(spark))
    assert all("zstd" in file for file in store.bronze("crm_cust_info").inputFiles())
