"""Cleaning rules: one function per table, raw rows in, cleaned rows out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode import fixed_values as fixed
from silverlode.functions import (
    category_of_key,
    int_date,
    int_div,
    map_codes,
    null_after,
    product_of_key,
    remove_hyphens,
    strip_prefix,
)
from silverlode.job import Job
from silverlode.operators import balanced_join, latest_per_key, with_group_max, with_next_value
from silverlode.schemas import BRONZE


def clean_customers(raw: DataFrame) -> DataFrame:
    """Latest row of every customer id, names trimmed, codes spelled out."""
    known = raw.filter(F.col("cst_id").isNotNull())
    return latest_per_key(known, "cst_id", by="cst_create_date").withColumns({
        "cst_firstname": F.trim("cst_firstname"),
        "cst_lastname": F.trim("cst_lastname"),
        "cst_marital_status": map_codes(F.col("cst_marital_status"), fixed.MARITAL_STATUS),
        "cst_gndr": map_codes(F.col("cst_gndr"), fixed.CRM_GENDER),
    })


def clean_products(job: Job, raw: DataFrame) -> DataFrame:
    """Every product version, valid until the day before the next one of the same full key.

    The delivered end dates are unreliable and not used.
    """
    versions = with_next_value(
        job, raw.drop("prd_end_dt"), "prd_key", ["prd_start_dt", "prd_id"], "prd_start_dt", "_next"
    )
    return versions.select(
        "prd_id",
        category_of_key(F.col("prd_key")).alias("cat_id"),
        product_of_key(F.col("prd_key")).alias("prd_key"),
        F.trim("prd_nm").alias("prd_nm"),
        F.coalesce("prd_cost", F.lit(0)).alias("prd_cost"),
        map_codes(F.col("prd_line"), fixed.PRODUCT_LINE).alias("prd_line"),
        "prd_start_dt",
        F.date_sub("_next", 1).alias("prd_end_dt"),
    )


def clean_sales(job: Job, raw: DataFrame) -> DataFrame:
    """Sales lines with real dates (shared by all lines of an order) and consistent money.

    The amount is rebuilt from quantity and price unless it already agrees with them; a missing
    or non-positive price is then rebuilt from that amount.
    """
    dates = ["sls_order_dt", "sls_ship_dt", "sls_due_dt"]
    amount, quantity, price = F.col("sls_sales"), F.col("sls_quantity"), F.col("sls_price")
    expected = quantity * F.abs(price)
    # An unknown expected amount compares as NULL, which keeps a positive amount.
    repaired = F.when(amount.isNull() | (amount <= 0) | (amount != expected), expected)
    parsed = raw.withColumns(
        {name: int_date(F.col(name), fixed.LATEST_SALES_DATE) for name in dates}
    ).withColumn("sls_sales", repaired.otherwise(amount))
    from_amount = int_div(amount, quantity).cast("int")
    return with_group_max(job, parsed, "sls_ord_num", dates).withColumn(
        "sls_price", F.when(price.isNull() | (price <= 0), from_amount).otherwise(price)
    ).select(BRONZE["crm_sales_details"].fieldNames())


def clean_erp_customers(job: Job, raw: DataFrame) -> DataFrame:
    """ERP customer details under the CRM's customer number, without future birthdates."""
    return raw.select(
        strip_prefix(F.col("cid"), fixed.ERP_ID_PREFIX, job.collation).alias("cid"),
        null_after(F.col("bdate"), job.today()).alias("bdate"),
        map_codes(F.col("gen"), fixed.ERP_GENDER).alias("gen"),
    )


def clean_locations(job: Job, raw: DataFrame, customers: DataFrame) -> DataFrame:
    """Countries of the customers that exist in the cleaned customer table."""
    located = raw.select(
        remove_hyphens(F.col("cid")).alias("cid"),
        map_codes(F.col("cntry"), fixed.COUNTRY).alias("cntry"),
    )
    return balanced_join(job, located, customers, "cid", "cst_key", "left_semi")


def clean_categories(raw: DataFrame) -> DataFrame:
    return raw.select(BRONZE["erp_px_cat_g1v2"].fieldNames())
