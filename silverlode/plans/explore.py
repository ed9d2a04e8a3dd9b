"""Exploratory questions on the star schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode import fixed_values as fixed
from silverlode.functions import concat_blank, int_avg, sum_or_zero, year_diff
from silverlode.job import Job
from silverlode.operators import (
    bottom_k,
    long_measures,
    top_dense_ranks,
    top_row_numbers,
)


def per_key(sales: DataFrame, key: str, *measures: Column) -> DataFrame:
    """Measures per dimension key, ready to join the dimension: one row per key, none for
    unmapped sales."""
    return sales.filter(F.col(key).isNotNull()).groupBy(key).agg(*measures)


def column_profile(df: DataFrame) -> DataFrame:
    """Type, row, NULL and distinct counts, least and greatest value and longest text of every
    column. Distinct values are counted as (column, value) rows, so all columns share one
    shuffle that is reduced before it."""
    facts, pairs = [], []
    for i, field in enumerate(df.schema.fields):
        value = F.col(field.name)
        text = value.cast("string")
        facts += [
            F.count(value).alias(f"n{i}"),
            F.min(value).cast("string").alias(f"lo{i}"),
            F.max(value).cast("string").alias(f"hi{i}"),
            F.max(F.length(text)).cast("bigint").alias(f"len{i}"),
        ]
        pairs.append(F.struct(F.lit(field.name).alias("column_name"), text.alias("value")))
    wide = df.agg(F.count("*").alias("rows"), *facts)
    rows = [
        F.struct(
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            (F.col("rows") - F.col(f"n{i}")).alias("null_count"),
            F.col(f"lo{i}").alias("min_value"),
            F.col(f"hi{i}").alias("max_value"),
            F.col(f"len{i}").alias("max_length"),
        )
        for i, field in enumerate(df.schema.fields)
    ]
    distinct = (
        df.select(F.inline(F.array(*pairs))).filter(F.col("value").isNotNull()).distinct()
        .groupBy("column_name").agg(F.count("*").alias("distinct_count"))
    )
    described = wide.select(F.inline(F.array(*rows))).join(distinct, "column_name", "left")
    return described.withColumn("distinct_count", F.coalesce("distinct_count", F.lit(0)))


def product_catalog(products: DataFrame) -> DataFrame:
    return products.select("category", "subcategory", "product_name").distinct()


def order_span(sales: DataFrame) -> DataFrame:
    """First and last order date; the rows may be all sales or the extremes of their dates."""
    return sales.agg(
        F.min("order_date").alias("first_transaction_date"),
        F.max("order_date").alias("last_transaction_date"),
        year_diff(F.min("order_date"), F.max("order_date")).alias("tracking_span_years"),
    )


def average_age_by_gender(job: Job, customers: DataFrame) -> DataFrame:
    age = year_diff(F.col("birthdate"), job.today())
    return customers.groupBy("gender").agg(int_avg(age).alias("average_customer_age"))


def kpi_sheet(sales: DataFrame) -> DataFrame:
    """Totals in one scan; each distinct count scans its own column only, so that every column
    is read once and no row is copied per count."""
    def sheet(measures: dict[str, Column]) -> DataFrame:
        named = {(name,): value for name, value in measures.items()}
        return long_measures(sales, ["measure_name"], "measure_value", named)

    totals = sheet({
        fixed.KPI_SALES: F.sum("sales_amount"),
        fixed.KPI_QUANTITY: F.sum("quantity"),
        fixed.KPI_PRICE: int_avg(F.col("price")),
    })
    counts = [
        sheet({fixed.KPI_ORDERS: F.count_distinct("order_number")}),
        sheet({fixed.KPI_PRODUCTS: F.count_distinct("product_key")}),
        sheet({fixed.KPI_CUSTOMERS: F.count_distinct("customer_key")}),
    ]
    return reduce(DataFrame.unionByName, counts, totals)


def _members(dimension: DataFrame, attribute: str, key: str, name: str) -> DataFrame:
    counted = dimension.groupBy(attribute).agg(F.count(key).alias(name))
    return counted.orderBy(F.desc(name), attribute)


def customers_by_country(customers: DataFrame) -> DataFrame:
    return _members(customers, "country", "customer_key", "total_customers")


def customers_by_gender(customers: DataFrame) -> DataFrame:
    return _members(customers, "gender", "customer_key", "total_customers")


def products_by_category(products: DataFrame) -> DataFrame:
    return _members(products, "category", "product_key", "total_products")


def average_cost_by_category(products: DataFrame) -> DataFrame:
    costs = products.groupBy("category").agg(int_avg(F.col("cost")).alias("average_cost"))
    return costs.orderBy(F.desc("average_cost"), "category")


def revenue_by_category(products: DataFrame, sales: DataFrame) -> DataFrame:
    sold = per_key(sales, "product_key", F.sum("sales_amount").alias("revenue"))
    return (
        products.select("product_key", "category").join(sold, "product_key", "left")
        .groupBy("category").agg(sum_or_zero(F.col("revenue")).alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "category")
    )


def revenue_by_customer(customers: DataFrame, sales: DataFrame) -> DataFrame:
    spent = per_key(sales, "customer_key", F.sum("sales_amount").alias("revenue"))
    revenue = F.coalesce("revenue", F.lit(0)).alias("total_revenue")
    return (
        customers.join(spent, "customer_key", "left")
        .select("customer_key", "first_name", "last_name", revenue)
        .orderBy(F.desc("total_revenue"), "customer_key")
    )


def quantity_by_country(customers: DataFrame, sales: DataFrame) -> DataFrame:
    bought = per_key(sales, "customer_key", F.sum("quantity").alias("items"))
    return (
        customers.select("customer_key", "country").join(bought, "customer_key", "left")
        .groupBy("country").agg(sum_or_zero(F.col("items")).alias("total_quantity_sold"))
        .orderBy(F.desc("total_quantity_sold"), "country")
    )


def top_products(products: DataFrame, sales: DataFrame, k: int = 5) -> DataFrame:
    """Products (by name) with one of the k greatest revenues; equal revenues share a rank."""
    sold = sales.groupBy("product_key").agg(F.sum("sales_amount").alias("revenue"))
    by_name = (
        sold.join(products.select("product_key", "product_name"), "product_key", "left")
        .groupBy("product_name").agg(F.sum("revenue").alias("total_revenue"))
    )
    return top_dense_ranks(by_name, "total_revenue", k, "product_rank")


def worst_products(products: DataFrame, sales: DataFrame, k: int = 5) -> DataFrame:
    """The k products with the least revenue, unsold ones included."""
    sold = per_key(sales, "product_key", F.sum("sales_amount").alias("revenue"))
    revenue = F.coalesce("revenue", F.lit(0)).alias("total_revenue")
    listed = products.join(sold, "product_key", "left").select("product_key", "product_name", revenue)
    return bottom_k(listed, "total_revenue", k, ["product_key"])


def top_customers(customers: DataFrame, sales: DataFrame, k: int = 10) -> DataFrame:
    """The k greatest spenders with their row number; unmapped sales count as one customer."""
    spent = sales.groupBy("customer_key").agg(F.sum("sales_amount").alias("total_spent"))
    name = concat_blank(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("customer")
    named = spent.join(customers, "customer_key", "left").select("customer_key", name, "total_spent")
    return top_row_numbers(named, "total_spent", k, ["customer_key"], "spending_rank")


def fewest_orders(customers: DataFrame, sales: DataFrame, k: int = 3) -> DataFrame:
    placed = per_key(sales, "customer_key", F.count_distinct("order_number").alias("placed"))
    orders = F.coalesce("placed", F.lit(0)).alias("orders")
    listed = customers.join(placed, "customer_key", "left")
    listed = listed.select("customer_key", "first_name", "last_name", orders)
    return bottom_k(listed, "orders", k, ["customer_key"])
