"""Star schema: two dimensions with surrogate keys and the sales fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.functions import prefer
from silverlode.job import Job
from silverlode.operators import ROW_ID, add_dense_key, balanced_join
from silverlode.operators.joins import number_rows
from silverlode.schemas import GOLD


def dim_customer(
    job: Job, customers: DataFrame, erp_customers: DataFrame, locations: DataFrame
) -> DataFrame:
    """Customers with ERP birthdate and country; the CRM's gender wins over the ERP's.

    A customer number that the ERP lists twice gives two rows, as the left joins say.
    """
    details = erp_customers.select(F.col("cid").alias("_detail_id"), "bdate", "gen")
    places = locations.select(F.col("cid").alias("_place_id"), "cntry")
    numbered = number_rows(customers)
    joined = balanced_join(job, numbered, details, "cst_key", "_detail_id")
    joined = balanced_join(job, joined, places, "cst_key", "_place_id", left_source=customers)
    rows = joined.select(
        F.col("cst_id").alias("customer_id"),
        F.col("cst_key").alias("customer_number"),
        F.col("cst_firstname").alias("first_name"),
        F.col("cst_lastname").alias("last_name"),
        F.col("cntry").alias("country"),
        F.col("cst_marital_status").alias("marital_status"),
        prefer(F.col("cst_gndr"), F.col("gen")).alias("gender"),
        F.col("bdate").alias("birthdate"),
        F.col("cst_create_date").alias("create_date"),
    )
    # The columns after the id only matter for an id that occurs twice.
    order = ["customer_id", "birthdate", "gender", "country"]
    return add_dense_key(job, rows, order, "customer_key").select(GOLD["dim_customer"].fieldNames())


def dim_product(job: Job, products: DataFrame, categories: DataFrame) -> DataFrame:
    """Products valid today with their category."""
    current = number_rows(products.filter(F.col("prd_end_dt").isNull()))
    kinds = categories.select("id", "cat", "subcat", "maintenance")
    joined = balanced_join(job, current, kinds, "cat_id", "id")
    rows = joined.select(
        F.col("prd_id").alias("product_id"),
        F.col("prd_key").alias("product_number"),
        F.col("cat_id").alias("category_id"),
        F.col("prd_nm").alias("product_name"),
        F.col("cat").alias("category"),
        F.col("subcat").alias("subcategory"),
        F.col("prd_line").alias("product_line"),
        "maintenance",
        F.col("prd_cost").alias("cost"),
        F.col("prd_start_dt").alias("start_date"),
    )
    order = ["start_date", "product_number", "product_id"]
    return add_dense_key(job, rows, order, "product_key").select(GOLD["dim_product"].fieldNames())


def fact_sales(job: Job, sales: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Sales lines with the surrogate keys of both dimensions, NULL where there is no member."""
    buyers = customers.select("customer_id", "customer_key")
    goods = products.select("product_number", "product_key")
    joined = balanced_join(job, number_rows(sales), buyers, "sls_cust_id", "customer_id")
    joined = balanced_join(
        job, joined, goods, "sls_prd_key", "product_number", left_source=sales
    )
    return joined.drop(ROW_ID).select(
        F.col("sls_ord_num").alias("order_number"),
        "product_key",
        "customer_key",
        F.col("sls_order_dt").alias("order_date"),
        F.col("sls_ship_dt").alias("shipping_date"),
        F.col("sls_due_dt").alias("due_date"),
        F.col("sls_sales").alias("sales_amount"),
        F.col("sls_quantity").alias("quantity"),
        F.col("sls_price").alias("price"),
    )
