"""Profiles that merge: exact facts equal those of all rows, estimates within their errors."""

from pyspark.sql import functions as F

from helpers import date
from silverlode import Warehouse
from silverlode.plans.profiles import merged_profile, profile_sketches
from silverlode.schemas import BRONZE

SCHEMA = "month int, id bigint, code string, `paid.on` date, price decimal(12,2), `month_2` string"


def sample(spark, n=60_000):
    """Three months; every tenth code is NULL, the last column has NULLs alone."""
    return spark.range(n).select(
        (F.col("id") % 3).cast("int").alias("month"), F.col("id"),
        F.when(F.col("id") % 10 > 0, F.concat(F.lit("c"), F.floor(F.sqrt(F.col("id") % 900))))
        .alias("code"),
        F.date_add(F.lit(date("2020-01-01")), (F.col("id") % 1000).cast("int")).alias("paid.on"),
        (F.col("id") / 4).cast("decimal(12,2)").alias("price"),
        F.lit(None).cast("string").alias("month_2"),
    )


def facts(profile):
    names = ("row_count", "null_count", "min_value", "max_value", "max_length")
    return {row.column_name: tuple(row[name] for name in names) for row in profile.collect()}


def test_months_merge_to_the_profile_of_all_rows(spark, job):
    df = sample(spark)
    monthly = job.stage(profile_sketches(df, [F.col("month")]), "monthly")
    assert monthly.count() == 3
    merged, direct = merged_profile(monthly, df.schema), merged_profile(profile_sketches(df), df.schema)
    assert facts(merged) == facts(direct)
    found = {row.column_name: row for row in merged.collect()}
    assert facts(merged)["id"] == (60_000, 0, "0", "59999", 5)
    assert facts(merged)["month_2"] == (60_000, 60_000, None, None, None)
    exact = df.agg(*(F.countDistinct(f"`{name}`").alias(str(i)) for i, name in enumerate(df.columns)))
    for i, count in enumerate(exact.first()):
        assert abs(found[df.columns[i]].distinct_estimate - count) <= 0.065 * count
    for share, value in zip((0.25, 0.5, 0.75), found["id"].quartiles):
        assert abs(int(value) / 60_000 - share) < 0.02
    for share, value in zip((0.25, 0.5, 0.75), found["paid.on"].quartiles):
        assert abs((date(value) - date("2020-01-01")).days / 1000 - share) < 0.02
    assert found["code"].quartiles is None and found["month_2"].frequent_values is None
    times = {row.code: row["count"] for row in df.groupBy("code").count().collect()}
    assert len(found["code"].frequent_values) == 5
    assert [one["count"] for one in found["code"].frequent_values] == sorted(
        (n for code, n in times.items() if code), reverse=True)[:5]
    assert all(times[one.value] == one["count"] for one in found["code"].frequent_values)


def test_frequent_values_among_many_others(spark):
    rare = F.concat(F.lit("r"), F.col("id"))
    df = spark.range(50_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(rare).alias("v"))
    top = merged_profile(profile_sketches(df), df.schema, most_frequent=1).first().frequent_values
    assert top[0].value == "hot" and abs(top[0]["count"] - 16_667) <= 100


def test_empty_tables_and_no_sketches(spark):
    df = sample(spark, 0)
    for sketches in (profile_sketches(df), profile_sketches(df, [F.col("month")])):
        rows = merged_profile(sketches, df.schema).collect()
        assert [row.column_name for row in rows] == df.columns
        assert {(row.row_count, row.null_count, row.distinct_estimate, row.quartiles) for row in rows} == {
            (0, 0, 0, None)
        }


def test_profile_is_kept_with_its_version(spark, job):
    store = Warehouse(job)
    locations = lambda *rows: {"erp_loc_a101": spark.createDataFrame(rows, BRONZE["erp_loc_a101"])}
    store.load_bronze(locations(("A1", "Germany"), ("A2", None)))
    first = store.sketches("bronze", "erp_loc_a101")
    assert facts(store.profile("bronze", "erp_loc_a101"))["cntry"] == (2, 1, "Germany", "Germany", 7)
    assert store.bronze("erp_loc_a101").count() == 2
    kept = first.collect()
    assert store.sketches("bronze", "erp_loc_a101").collect() == kept
    store.load_bronze(locations(("A3", "France")))
    second = store.sketches("bronze", "erp_loc_a101")
    both = merged_profile(first.unionByName(second), BRONZE["erp_loc_a101"])
    assert facts(both)["cntry"] == (3, 1, "France", "Germany", 7)
