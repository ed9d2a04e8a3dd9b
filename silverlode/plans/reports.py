"""Wide reports: one row per customer and one row per sold product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode import fixed_values as fixed
from silverlode.functions import band, concat_blank, int_div, month_diff, sum_or_zero, year_diff
from silverlode.job import Job
from silverlode.operators import group_with_distinct


def customer_segment(months: Column, sales: Column) -> Column:
    """VIP or regular after a year of orders, by sales; everyone else is new."""
    loyal = months >= fixed.LOYAL_MONTHS
    return (
        F.when(loyal & (sales >= fixed.VIP_SALES), F.lit(fixed.VIP))
        .when(loyal & (sales < fixed.VIP_SALES), F.lit(fixed.REGULAR))
        .otherwise(F.lit(fixed.NEW))
    )


def _per_order(sales: Column, orders: Column) -> Column:
    return F.coalesce(int_div(sales, orders), F.lit(0))


def _per_month(sales: Column, months: Column) -> Column:
    """Sales per month of activity; unknown when there are sales but no dated order."""
    whole = F.when((sales == 0) | (months == 0), sales)
    return whole.otherwise(int_div(sales, months))


def report_customers(job: Job, customers: DataFrame, sales: DataFrame) -> DataFrame:
    """Sales are aggregated per customer before they meet the dimension, which keeps customers
    without sales and moves one row per customer instead of every sales line."""
    activity = group_with_distinct(job, sales, "customer_key", [
        F.sum("sales_amount").alias("sales"),
        F.sum("quantity").alias("items"),
        F.min("order_date").alias("first_order"),
        F.max("order_date").alias("last_order"),
    ], {"orders": "order_number", "products": "product_key"})
    zero = F.lit(0).cast("bigint")
    facts = customers.join(activity, "customer_key", "left").select(
        "customer_key",
        "customer_number",
        concat_blank(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("customer_name"),
        year_diff(F.col("birthdate"), job.today()).alias("age"),
        "last_order",
        month_diff(F.col("first_order"), F.col("last_order")).alias("lifespan"),
        *[
            F.coalesce(column, zero).alias(f"total_{column}")
            for column in ("orders", "sales")
        ],
        F.coalesce("items", zero).alias("total_quantity"),
        F.coalesce("products", zero).alias("total_products"),
    )
    total, months = F.col("total_sales"), F.col("lifespan")
    return facts.select(
        "customer_key", "customer_number", "customer_name", "age",
        band(F.col("age"), fixed.AGE_BANDS, fixed.AGE_ABOVE).alias("age_category"),
        customer_segment(months, total).alias("customer_category"),
        "last_order",
        month_diff(F.col("last_order"), job.today()).alias("recency"),
        "total_orders", "total_sales", "total_quantity", "total_products",
        _per_order(total, F.col("total_orders")).alias("avg_order_value"),
        _per_month(total, months).alias("avg_monthly_spend"),
    )


def report_products(job: Job, products: DataFrame, sales: DataFrame) -> DataFrame:
    """Products with at least one dated sale; others are not listed."""
    # Decimals add up to the same whatever their order, so rounding never depends on it.
    unit_price = F.col("sales_amount").cast("decimal(20,0)") / F.nullif("quantity", F.lit(0)).cast(
        "decimal(10,0)"
    )
    activity = group_with_distinct(job, sales, "product_key", [
        sum_or_zero(F.col("sales_amount")).alias("total_sales"),
        sum_or_zero(F.col("quantity")).alias("total_quantity"),
        F.round(F.avg(unit_price), 1).cast("double").alias("avg_selling_price"),
        F.min("order_date").alias("first_sale_date"),
        F.max("order_date").alias("last_sale_date"),
    ], {"total_orders": "order_number", "total_customers": "customer_key"})
    activity = activity.filter(F.col("last_sale_date").isNotNull())
    total = F.col("total_sales")
    months = month_diff(F.col("first_sale_date"), F.col("last_sale_date"))
    return products.join(activity, "product_key").select(
        "product_key", "product_name", "category", "subcategory", "cost", "last_sale_date",
        month_diff(F.col("last_sale_date"), job.today()).alias("recency"),
        band(total, fixed.PRODUCT_SALES_BANDS, fixed.PRODUCT_SALES_ABOVE).alias("prod_performance"),
        "total_orders", "total_sales", "total_quantity", "total_customers", "avg_selling_price",
        _per_order(total, F.col("total_orders")).alias("avg_order_revenue"),
        _per_month(total, months).alias("avg_monthly_revenue"),
    )
