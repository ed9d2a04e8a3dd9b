"""Trends, year-over-year changes, shares and segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverlode import fixed_values as fixed
from silverlode.functions import band, int_avg, int_div, month_diff, month_start, percent_label
from silverlode.job import Job
from silverlode.operators import with_grand_total, with_running
from silverlode.plans.reports import customer_segment


def _dated(sales: DataFrame) -> DataFrame:
    return sales.filter(F.col("order_date").isNotNull())


def monthly_trend(sales: DataFrame) -> DataFrame:
    date = F.col("order_date")
    return (
        _dated(sales).groupBy(F.year(date).alias("order_year"), F.month(date).alias("order_month"))
        .agg(
            F.sum("sales_amount").alias("total_sales"),
            F.count_distinct("customer_key").alias("total_customers"),
            F.sum("quantity").alias("total_quantity"),
        )
        .orderBy("order_year", "order_month")
    )


def running_totals(sales: DataFrame) -> DataFrame:
    """Monthly sales with running sales and running average price, both restarting each year.
    The windows see at most twelve rows per year."""
    monthly = _dated(sales).groupBy(month_start(F.col("order_date")).alias("order_month")).agg(
        F.sum("sales_amount").alias("total_sales"), int_avg(F.col("price")).alias("average_price")
    )
    so_far = Window.partitionBy(F.year("order_month")).orderBy("order_month")
    average = int_div(F.sum("average_price").over(so_far), F.count("average_price").over(so_far))
    return monthly.select(
        "order_month", "total_sales",
        F.sum("total_sales").over(so_far).alias("running_total_sales"),
        average.alias("moving_average_price"),
    ).orderBy("order_month")


def running_line_totals(job: Job, sales: DataFrame) -> DataFrame:
    """Every dated sales line with the sales so far and the average price so far in its year. Lines
    of a day follow each other by order number and their other columns. `sales` is a stored
    table; no task holds a whole year."""
    lines = _dated(sales).withColumn("order_year", F.year("order_date"))
    so_far = with_running(
        job, lines, ["order_year"], ["order_date", "order_number"],
        {"running_sales": "sales_amount", "_prices": "price"}, {"_priced": "price"}, stored=True,
    )
    average = int_div(F.col("_prices"), F.col("_priced"))
    return so_far.withColumn("running_average_price", average).drop("_prices", "_priced")


def _by_sign(difference: Column, above: str, below: str, same: str) -> Column:
    return (
        F.when(difference > 0, F.lit(above)).when(difference < 0, F.lit(below)).otherwise(F.lit(same))
    )


def year_over_year(products: DataFrame, sales: DataFrame) -> DataFrame:
    """Yearly sales per product name against the previous year sold and the product's average.
    The windows see one row per year of a name."""
    yearly = (
        _dated(sales).groupBy("product_key", F.year("order_date").alias("order_year"))
        .agg(F.sum("sales_amount").alias("amount"))
        .join(products.select("product_key", "product_name"), "product_key", "left")
        .groupBy("order_year", "product_name").agg(F.sum("amount").alias("current_year"))
    )
    name = Window.partitionBy("product_name")
    average = int_div(F.sum("current_year").over(name), F.count("current_year").over(name))
    compared = yearly.withColumns({
        "previous_year": F.lag("current_year", 1, 0).over(name.orderBy("order_year")),
        "average_sales": average,
    }).withColumns({
        "yearly_change": F.col("current_year") - F.col("previous_year"),
        "diff_avg": F.col("current_year") - F.col("average_sales"),
    })
    return compared.select(
        "order_year", "product_name", "current_year", "previous_year", "yearly_change",
        _by_sign(F.col("yearly_change"), fixed.SALES_UP, fixed.SALES_DOWN, fixed.SALES_SAME)
        .alias("performance"),
        "average_sales", "diff_avg",
        _by_sign(F.col("diff_avg"), fixed.ABOVE_AVERAGE, fixed.BELOW_AVERAGE, fixed.AT_AVERAGE)
        .alias("average_change"),
    ).orderBy("product_name", "order_year")


def category_shares(products: DataFrame, sales: DataFrame) -> DataFrame:
    by_category = (
        sales.groupBy("product_key").agg(F.sum("sales_amount").alias("amount"))
        .join(products.select("product_key", "category"), "product_key", "left")
        .groupBy("category").agg(F.sum("amount").alias("total_sales"))
    )
    whole = with_grand_total(by_category, "total_sales", "overall_sales")
    share = percent_label(F.col("total_sales"), F.col("overall_sales"))
    return whole.withColumn("part", share).orderBy(F.desc("total_sales"), "category")


def cost_tiers(products: DataFrame) -> DataFrame:
    segment = band(F.col("cost"), fixed.COST_BANDS, fixed.COST_ABOVE)
    return (
        products.groupBy(segment.alias("segment")).agg(F.count("*").alias("total_products"))
        .orderBy(F.desc("total_products"), "segment")
    )


def customer_segments(sales: DataFrame) -> DataFrame:
    months = month_diff(F.min("order_date"), F.max("order_date"))
    history = sales.filter(F.col("customer_key").isNotNull()).groupBy("customer_key").agg(
        months.alias("months"), F.sum("sales_amount").alias("spent")
    )
    segment = customer_segment(F.col("months"), F.col("spent")).alias("segment")
    return (
        history.groupBy(segment).agg(F.count("*").alias("total_customers"))
        .orderBy(F.desc("total_customers"), "segment")
    )
