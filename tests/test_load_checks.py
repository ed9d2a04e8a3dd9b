import pytest

from helpers import AS_OF, date, rows
from silverlode import Job, Warehouse
from silverlode import fixed_values as fixed
from silverlode.plans import audits
from silverlode.schemas import BRONZE, SILVER
from silverlode.sources import LoadFailed, write_version

DAY = date("2020-01-01")


@pytest.fixture
def store(spark):
    """A warehouse whose customers hold an id that is missing and whose ERP ids keep a prefix."""
    store = Warehouse(Job(spark, AS_OF))
    found = {name: spark.createDataFrame([], BRONZE[name]) for name in BRONZE}
    found["crm_cust_info"] = spark.createDataFrame(
        [(1, "AW1", "A", "B", "S", "M", DAY), (2, "AW2", "A", "B", "S", "F", DAY)], BRONZE["crm_cust_info"]
    )
    found["erp_cust_az12"] = spark.createDataFrame(
        [("NASAW1", None, "M"), ("NASNASAW2", None, "F"), ("NASNASAW3", None, None)], BRONZE["erp_cust_az12"]
    )
    store.load_bronze(found)
    return store


def test_checks_of_a_load_are_those_of_its_tables(store):
    checks = store.load_silver().checks
    s = store.silver
    again = audits.load_diagnostics(
        s("crm_cust_info"), s("crm_prd_info"), s("crm_sales_details"), s("erp_cust_az12"), s("erp_loc_a101")
    )
    assert rows(checks["load diagnostics"]) == rows(again)
    assert checks["load diagnostics"].columns == again.columns
    assert ("erp_cust_az12", fixed.LOAD_PREFIX, 2) in rows(again)
    assert rows(checks["row counts"]) == rows(audits.row_counts({t: s(t) for t in SILVER}, "row_count"))


def test_checks_read_no_table(store):
    checks = store.load_silver().checks
    for report in checks.values():
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert "FileScan" not in plan and "BatchScan" not in plan


def test_a_check_that_does_not_hold_publishes_nothing(store):
    store.load_silver(max_issues=2)
    before = store.versions("silver")
    with pytest.raises(LoadFailed, match="2 of .* 1 allowed"):
        store.load_silver(max_issues=1)
    assert store.versions("silver") == before
    assert rows(store.log.read().filter("status = 'failed'").select("table_name")) == [
        ("(all)",), ("erp_cust_az12",)
    ]
    with pytest.raises(LoadFailed):
        store.reload_silver("erp_cust_az12", max_issues=0)
    store.reload_silver("crm_cust_info", max_issues=0)


def test_facts_are_asked_of_cleaned_rows(spark, job):
    from pyspark.sql import functions as F

    from silverlode.sources.delimited import REJECT

    written = write_version(spark.range(5), job.new_path("t"), {"a name": F.count_if(F.col("id") > 2)})
    assert written[1:] == (5, 0, {"a name": 2})
    marked = spark.range(5).withColumn(REJECT, F.lit("x"))
    with pytest.raises(ValueError, match="marked"):
        write_version(marked, job.new_path("t"), {"n": F.count("id")})
