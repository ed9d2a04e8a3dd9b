import pytest
from pyspark.sql import functions as F

from helpers import AS_OF, rows
from silverlode import Job, Limits
from silverlode.operators import group_with_distinct

# Rows by key: one with half of them, NULL keys, NULL and repeated values.
SALES = [(None, "o1", 7, 5)] * 6 + [(1, f"o{i % 5}", i % 3, i) for i in range(20)] + [
    (2, None, 1, 4), (2, "o1", None, None), (3, "o9", 2, 1), (3, "o9", 2, 1), (4, None, None, 2),
]
EXPECTED = [(1, 190, 20, 5, 3), (2, 4, 2, 1, 1), (3, 2, 2, 1, 1), (4, 2, 1, 0, 0)]


@pytest.fixture
def sales(spark, tmp_path):
    df = spark.createDataFrame(SALES, "product int, number string, buyer int, amount int")
    df.repartition(3).write.parquet(f"{tmp_path}/sales")
    return spark.read.parquet(f"{tmp_path}/sales")


def grouped(spark, sales, limits):
    return group_with_distinct(
        Job(spark, AS_OF, limits), sales, "product",
        [F.sum("amount").alias("amount"), F.count("*").alias("lines")],
        {"orders": "number", "buyers": "buyer"},
    )


@pytest.mark.parametrize("limits", [
    Limits(), Limits(task_rows=3), Limits(task_rows=3, hot_rows=4), Limits(task_rows=1, hot_rows=1),
])
def test_every_way_gives_the_same(spark, sales, limits):
    assert rows(grouped(spark, sales, limits)) == EXPECTED


def test_a_large_table_is_dealt_by_its_size_and_shuffled_once_per_count(spark, sales):
    def exchanges(limits):
        plan = grouped(spark, sales, limits)._jdf.queryExecution().executedPlan().toString()
        return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]

    own = spark.conf.get("spark.sql.shuffle.partitions")
    assert all(f", {own})" in line for line in exchanges(Limits())) and len(exchanges(Limits())) == 4
    large = exchanges(Limits(task_rows=3))
    assert len(large) == 2 and all(f", {-(-len(SALES) // 3)})" in line for line in large)
