"""Further questions: unsold products, demographics, product lines, top spenders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.functions import concat_blank, int_div, sum_or_zero
from silverlode.job import Job
from silverlode.operators import balanced_join, top_k
from silverlode.plans.explore import per_key


def unsold_products(products: DataFrame, sales: DataFrame) -> DataFrame:
    # Distinct keys first: the sales lines of a product are reduced to one before the shuffle.
    sold = sales.select("product_key").distinct()
    return products.join(sold, "product_key", "left_anti").select("product_number", "product_name")


def demographics(job: Job, customers: DataFrame, sales: DataFrame) -> DataFrame:
    """Sales, quantity and order value per marital status and gender.

    Orders are counted over all customers of a group, so the lines meet their customer before
    they are aggregated.
    """
    buyers = customers.select(F.col("customer_key").alias("_buyer"), "marital_status", "gender")
    lines = sales.select("customer_key", "order_number", "sales_amount", "quantity")
    revenue = F.sum("sales_amount")
    return (
        balanced_join(job, lines, buyers, "customer_key", "_buyer")
        .groupBy("marital_status", "gender")
        .agg(
            revenue.alias("total_revenue"),
            F.sum("quantity").alias("total_quantity"),
            int_div(revenue, F.count_distinct("order_number")).alias("average_order_value"),
        )
        .orderBy(F.desc("total_revenue"), "marital_status", "gender")
    )


def product_lines(products: DataFrame, sales: DataFrame) -> DataFrame:
    sold = per_key(
        sales, "product_key", F.sum("quantity").alias("items"), F.sum("sales_amount").alias("sales")
    )
    return (
        products.select("product_key", "product_line").join(sold, "product_key", "left")
        .groupBy("product_line")
        .agg(
            F.count_distinct("product_key").alias("total_products"),
            sum_or_zero(F.col("items")).alias("total_quantity"),
            sum_or_zero(F.col("sales")).alias("total_sales"),
        )
        .orderBy(F.desc("total_sales"), "product_line")
    )


def top_spenders(customers: DataFrame, sales: DataFrame, k: int = 10) -> DataFrame:
    spent = per_key(sales, "customer_key", F.sum("sales_amount").alias("spent"))
    name = concat_blank(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("customer")
    totals = (
        customers.join(spent, "customer_key")
        .groupBy("customer_id", name, "country").agg(F.sum("spent").alias("total_spent"))
    )
    return top_k(totals, "total_spent", k, ["customer_id", "customer", "country"])
