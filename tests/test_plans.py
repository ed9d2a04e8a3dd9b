"""Physical plans of the registered queries: what must not be in them, and what must."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.queries import build, queries
from silverlode import Job
from silverlode.plans import explore, reports, silver, trends

SF_DIR = "/root/testdata/sf0.001"
QUERIES = queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_no_product_no_python_no_unbounded_window(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert "Python" not in text and "Pandas" not in text
    # A window without a partition may only see the rows of a top-k or the counts per range.
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if undivided(line) and "windowspecdefinition(_range" not in line:
            assert "TakeOrderedAndProject" in lines[i + 1], line


def undivided(line):
    """Whether a plan line is a window without partition columns."""
    first = re.search(r"Window .*?windowspecdefinition\(([^,]+),", line)
    return bool(first) and bool(re.search(r" (ASC|DESC) |^specifiedwindowframe", first.group(1)))


def test_undivided_windows_are_recognised(spark):
    df = spark.range(9)
    order = Window.orderBy("id")
    by_key = Window.partitionBy(F.col("id") % 3).orderBy("id")

    def windows(column):
        return [undivided(line) for line in plan(df.select(column)).splitlines() if "Window " in line]

    assert windows(F.row_number().over(order)) == [True]
    assert windows(F.sum("id").over(Window.partitionBy())) == [True]
    assert windows(F.row_number().over(by_key)) == [False]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_needed_columns_are_read(spark):
    b = build(spark, SF_DIR)
    text = plan(trends.monthly_trend(b.sales))
    assert "ReadSchema: struct<customer_key:bigint,order_date:date,sales_amount:int,quantity:int>" in text
    assert "PushedFilters: [IsNotNull(order_date)]" in text
    text = plan(explore.customers_by_country(b.customers))
    assert "ReadSchema: struct<customer_key:bigint,country:string>" in text


def test_cleaning_sales_shuffles_them_once(spark):
    b = build(spark, SF_DIR)
    text = plan(silver.clean_sales(b.job, b.bronze("crm_sales_details")))
    assert text.count("Exchange") == 1


def test_cleaning_erp_customers_does_not_shuffle(spark):
    b = build(spark, SF_DIR)
    assert "Exchange" not in plan(silver.clean_erp_customers(b.job, b.bronze("erp_cust_az12")))


def test_customer_report_moves_aggregated_sales_only(spark, no_broadcast):
    """Sales are aggregated before each of their exchanges, and the join reuses the last one."""
    b = build(spark, SF_DIR)
    text = plan(reports.report_customers(Job(spark, b.job.as_of, folder=b.job.folder), b.customers, b.sales))
    for below in re.findall(r"Exchange hashpartitioning[^\n]*\n([^\n]*)", text):
        assert "HashAggregate" in below or "FileScan" in below or "Filter" in below, below
    assert text.count("Exchange") == 5
