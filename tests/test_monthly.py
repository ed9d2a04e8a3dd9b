import pytest
from pyspark.sql import functions as F

from helpers import date, rows
from silverlode import Job
from silverlode.plans import trends
from silverlode.schemas import GOLD
from silverlode.sources.monthly import MONTH, MonthlyTable

SCHEMA = "n bigint, d date"


def lines(spark, *pairs):
    return spark.createDataFrame([(n, d and date(d)) for n, d in pairs], SCHEMA)


@pytest.fixture
def table(spark, job):
    first = lines(spark, (1, "2024-12-31"), (2, "2025-01-01"), (3, "2025-01-31"), (4, "2025-02-01"),
                  (5, None), (6, "2025-02-28"), (6, "2025-02-28"))
    table = MonthlyTable(job, job.new_path("monthly"), first.schema, "d")
    assert table.replace(first) == 7
    return table


def numbers(df):
    return sorted(row.n for row in df.collect())


def test_rows_and_ranges(table):
    assert numbers(table.read()) == [1, 2, 3, 4, 5, 6, 6]
    assert numbers(table.read(date("2025-01-01"))) == [2, 3, 4, 6, 6]
    assert numbers(table.read(date("2024-12-31"), date("2025-01-15"))) == [1, 2]
    assert numbers(table.read(last=date("2025-02-01"))) == [1, 2, 3, 4]
    assert numbers(table.read(date("2026-01-01"))) == []
    assert rows(table.read().select("n", MONTH).filter("n = 6").distinct()) == [(6, date("2025-02-01"))]


def test_months_of_the_rows_are_replaced(spark, table):
    before = table.loads()
    assert table.replace(lines(spark, (7, "2025-01-09"))) == 1
    assert numbers(table.read()) == [1, 4, 5, 6, 6, 7]
    kept = {month for month, load in table.loads().items() if before.get(month) == load}
    assert "2025-02-01" in kept and "2025-01-01" not in kept and len(kept) == 3
    table.replace(lines(spark, (8, None)))
    assert numbers(table.read()) == [1, 4, 6, 6, 7, 8]


def test_named_months_are_replaced(spark, table):
    table.replace(lines(spark, (9, "2025-01-02")), [date("2025-01-20"), date("2025-02-03")])
    assert numbers(table.read()) == [1, 5, 9]
    for stray in ("2025-03-01", None):
        with pytest.raises(ValueError, match="1 rows are of none"):
            table.replace(lines(spark, (10, "2025-01-02"), (11, stray)), [date("2025-01-01")])
    assert numbers(table.read()) == [1, 5, 9]
    assert not [name for name in table.files.names(f"{table.root}/{MONTH}=2025-03-01")]


def test_the_last_publication_can_still_be_read(spark, table):
    old = table.read()
    table.replace(lines(spark, (7, "2025-01-09")))
    assert numbers(old) == [1, 2, 3, 4, 5, 6, 6]
    table.replace(lines(spark, (8, "2025-01-09")))
    assert len(table.files.names(f"{table.root}/{MONTH}=2025-01-01")) == 2


def test_no_rows(spark, job):
    none = lines(spark).limit(0)
    table = MonthlyTable(job, job.new_path("monthly"), none.schema, "d")
    assert table.loads() == {} and numbers(table.read()) == []
    assert table.replace(none) == 0 and numbers(table.read()) == []
    with pytest.raises(ValueError, match="taken"):
        MonthlyTable(job, table.root, none.withColumnRenamed("n", MONTH).schema, "d")


def test_a_question_on_a_year_lists_its_folders_alone(spark, job):
    days = [date(f"{year}-{month:02d}-05") for year in (2023, 2024, 2025) for month in (1, 6, 12)]
    sales = spark.createDataFrame(
        [(f"o{n}", 1, n, day, day, day, 10, 1, 10) for n, day in enumerate(days)], GOLD["fact_sales"]
    )
    table = MonthlyTable(job, job.new_path("sales"), GOLD["fact_sales"], "order_date")
    table.replace(sales)
    year = table.read(date("2024-01-01"), date("2024-12-31"))
    assert {name.split(f"{MONTH}=")[1][:4] for name in year.inputFiles()} == {"2024"}
    assert rows(trends.monthly_trend(year).select("order_year", "order_month")) == [
        (2024, 1), (2024, 12), (2024, 6)
    ]
    # Months that only a join knows prune the scan while it runs.
    chosen = spark.createDataFrame([(date("2025-06-01"), "x")], "chosen date, why string")
    chosen = Job(spark).stage(chosen, "chosen").filter("why = 'x'")
    joined = table.read().join(F.broadcast(chosen), F.col(MONTH) == F.col("chosen"))
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString()
    assert numbers(joined.select(F.col("customer_key").alias("n"))) == [7]
