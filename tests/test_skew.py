"""The whole chain on extracts where single keys hold about a third of the rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

from checks.compare import oracle_rows, spark_rows
from checks.extracts import spark_extracts
from checks.oracle import ORACLE, with_blocks
from checks.queries import ANSWERS, Build
from helpers import date, rows
from silverlode import Job, Limits
from silverlode.operators import balanced_join, hot_keys, with_group_max, with_next_value
from silverlode.operators.joins import number_rows

SF_DIR = "/root/testdata/sf0.001"
LIMITS = Limits(broadcast_rows=0, hot_rows=20)


def third(column):
    return F.pmod(F.xxhash64(column), F.lit(3)) == 0


def skewed_extracts(spark):
    tables = spark_extracts(spark, SF_DIR)
    hot = "AW00000007"
    sales = tables["crm_sales_details"]
    tables["crm_sales_details"] = sales.select(
        F.when(third("sls_prd_key"), F.lit("SO7"))
        .when(F.col("sls_quantity") % 7 == 0, F.lit(None)).otherwise(F.col("sls_ord_num")).alias("sls_ord_num"),
        F.when(third("sls_ord_num"), F.lit("P0000007")).otherwise(F.col("sls_prd_key")).alias("sls_prd_key"),
        F.when(third("sls_cust_id"), F.lit(7)).when(F.col("sls_quantity") % 5 == 0, F.lit(None))
        .otherwise(F.col("sls_cust_id")).alias("sls_cust_id"),
        *sales.columns[3:],
    )
    customers = tables["crm_cust_info"]
    tables["crm_cust_info"] = customers.select(
        F.when(third("cst_key"), F.lit(7)).otherwise(F.col("cst_id")).alias("cst_id"),
        F.when(third("cst_lastname"), F.lit(hot)).otherwise(F.col("cst_key")).alias("cst_key"),
        *customers.columns[2:],
    )
    products = tables["crm_prd_info"]
    tables["crm_prd_info"] = products.select(
        "prd_id",
        F.when(third("prd_nm"), F.lit("EC-ON-P0000007")).otherwise(F.col("prd_key")).alias("prd_key"),
        *products.columns[2:5],
        F.when(third("prd_nm"), F.date_add("prd_start_dt", F.col("prd_id") % 50))
        .otherwise(F.col("prd_start_dt")).alias("prd_start_dt"),
        "prd_end_dt",
    )
    locations = tables["erp_loc_a101"]
    tables["erp_loc_a101"] = locations.select(
        F.when(third("cid"), F.lit("AW-" + hot[2:])).otherwise(F.col("cid")).alias("cid"), "cntry"
    )
    return tables


@pytest.fixture(scope="module")
def skewed(spark):
    return Build(spark, SF_DIR, LIMITS, skewed_extracts(spark))


@pytest.fixture(scope="module")
def answers(skewed):
    skewed.bronze("crm_cust_info")
    return {
        f"bronze_{table}": f"select * from read_parquet('{skewed.store.path('bronze', table)}/*.parquet')"
        for table in skewed.extracts
    }


def test_single_keys_are_hot(skewed):
    job = skewed.job
    for table, key in [("crm_sales_details", "sls_ord_num"), ("crm_sales_details", "sls_prd_key"),
                       ("crm_sales_details", "sls_cust_id"), ("crm_prd_info", "prd_key"),
                       ("crm_cust_info", "cst_id"), ("crm_cust_info", "cst_key"), ("erp_loc_a101", "cid")]:
        df = skewed.bronze(table)
        assert hot_keys(job, df, key).agg(F.max("rows")).first()[0] > df.count() / 5, (table, key)


@pytest.mark.parametrize("name", [
    "t1_clean_customers", "t2_clean_products", "t3_clean_sales", "t5_clean_locations",
    "g1_dim_customer", "g2_dim_product", "g3_fact_sales",
    "r1_report_customers", "r2_report_products", "e13_top_products", "e15_top_customers",
    "k2_demographics", "k4_top_spenders", "v3_year_over_year", "q12_orphans", "q_fan_out",
])
def test_skewed_query(skewed, answers, name):
    expected = oracle_rows(duckdb.connect(), with_blocks(ORACLE[name].strip(), answers))
    assert spark_rows(ANSWERS[name](skewed)) == expected


@pytest.fixture(scope="module")
def sampled(spark):
    """Large enough to be sampled for hot keys: a third one key, a third NULL, the rest unique."""
    job = Job(spark, date("2025-12-31"), Limits(broadcast_rows=0, hot_rows=1000))
    ids = spark.range(0, 30000, 1, 5)
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 3 == 1, F.col("id"))
    return job, job.stage(ids.select("id", key.cast("bigint").alias("k"), (F.col("id") % 17).alias("v")), "wide")


def test_sampling_finds_the_hot_keys(sampled):
    job, df = sampled
    found = {row.key: row.rows for row in hot_keys(job, df, "k").collect()}
    assert set(found) == {-1, None}
    assert all(7000 < count < 13000 for count in found.values())


def test_sampled_jobs_are_exact(spark, sampled):
    job, df = sampled
    plain = Job(spark, folder=job.folder)
    assert rows(with_group_max(job, df, "k", ["v"])) == rows(with_group_max(plain, df, "k", ["v"]))
    assert rows(with_next_value(job, df, "k", ["id"], "v", "n")) == rows(
        with_next_value(plain, df, "k", ["id"], "v", "n"))
    right = job.stage(spark.range(-1, 20000).select(F.col("id").alias("rk"), (F.col("id") * 2).alias("w")), "right")
    for how in ("left", "inner", "left_semi"):
        got = balanced_join(job, df, right, "k", "rk", how)
        assert rows(got) == rows(df.join(right, F.col("k") == F.col("rk"), how))


def test_joined_rows_keep_their_numbers(spark, sampled):
    """A second join deals rows by the numbers given at the scan."""
    job, df = sampled
    right = job.stage(spark.range(-1, 20000).select(F.col("id").alias("rk"), (F.col("id") * 2).alias("w")), "right")
    other = right.select(F.col("rk").alias("ok"), F.col("w").alias("x"))
    joined = balanced_join(job, number_rows(df), right, "k", "rk")
    twice = balanced_join(job, joined, other, "k", "ok", left_source=df)
    assert twice.select("_row_id").distinct().count() == 30000
    assert rows(twice.select("id", "w", "x")) == rows(
        df.join(right, F.col("k") == F.col("rk"), "left").select("id", "w", F.col("w").alias("x")))
