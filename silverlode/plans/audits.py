"""Data-quality audits. Every count is an exception count; judging it is up to the caller.

All counts of one table come from one scan of it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode import fixed_values as fixed
from silverlode.functions import text_length
from silverlode.job import Job
from silverlode.operators import long_measures


def _union(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _blank(text: Column) -> Column:
    return text.isNull() | (text == "")


def _not_in(value: Column, accepted: list[str]) -> Column:
    """Count of values outside the accepted ones; NULL is not counted."""
    return F.count_if(~value.isin(accepted))


def _repeats(column: str) -> Column:
    return F.count(column) - F.count_distinct(column)


def _checks(df: DataFrame, labels: list[str], table: str, checks: dict[str, Column]) -> DataFrame:
    return long_measures(
        df, labels[:2], labels[2], {(table, check): count for check, count in checks.items()}
    )


_SILVER_LABELS = ["table_name", "audit_test", "exception_count"]
_GOLD_LABELS = ["dimensional_object", "quality_check", "exception_count"]


# Row counts

def row_counts(tables: dict[str, DataFrame], name: str) -> DataFrame:
    """Rows per table; the counts come from the file footers."""
    return _union(*[
        df.agg(F.count("*").alias(name)).select(F.lit(table).alias("table_name"), name)
        for table, df in tables.items()
    ])


# Checks made right after the silver load

def load_checks() -> dict[str, dict[str, Column]]:
    """Exception counts of each cleaned table by name, as aggregates that one pass over its rows
    can answer, such as the one that writes them."""
    return {
        "crm_cust_info": {
            fixed.LOAD_KEYS:
                F.count_if(F.col("cst_id").isNull()) + _not_in(F.col("cst_gndr"), fixed.GENDERS),
        },
        "crm_prd_info": {
            fixed.LOAD_DATES: F.count_if(F.col("prd_end_dt") < F.col("prd_start_dt")),
        },
        "crm_sales_details": {
            fixed.LOAD_MATH:
                F.count_if(F.col("sls_sales") != F.col("sls_quantity") * F.col("sls_price")),
        },
        "erp_cust_az12": {
            fixed.LOAD_PREFIX: F.count_if(F.col("cid").startswith(fixed.ERP_ID_PREFIX)),
        },
        "erp_loc_a101": {fixed.LOAD_HYPHENS: F.count_if(F.col("cid").contains("-"))},
    }


LOAD_LABELS = ["profiling_target", "metrics", "issue_count"]


def load_diagnostics(
    customers: DataFrame, products: DataFrame, sales: DataFrame, erp_customers: DataFrame,
    locations: DataFrame,
) -> DataFrame:
    """The load checks of tables that are stored already."""
    tables = {
        "crm_cust_info": customers, "crm_prd_info": products, "crm_sales_details": sales,
        "erp_cust_az12": erp_customers, "erp_loc_a101": locations,
    }
    return _union(*(
        _checks(tables[table], LOAD_LABELS, table, checks) for table, checks in load_checks().items()
    ))


def repeated_or_null(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once, and NULL if it occurs at all."""
    counts = df.groupBy(key).agg(F.count("*").alias("duplicate_count"))
    return counts.filter((F.col("duplicate_count") > 1) | F.col(key).isNull())


def untidy_product_names(products: DataFrame) -> DataFrame:
    name = F.col("prd_nm")
    untidy = name.startswith(" ") | name.endswith(" ") | _blank(name)
    return products.filter(untidy).select(
        "prd_id", "prd_nm", text_length(name).alias("current_length")
    )


def reversed_product_dates(products: DataFrame) -> DataFrame:
    reversed_dates = products.filter(F.col("prd_start_dt") > F.col("prd_end_dt"))
    return reversed_dates.select("prd_id", "prd_key", "prd_start_dt", "prd_end_dt")


def malformed_categories(products: DataFrame) -> DataFrame:
    category = F.col("cat_id")
    length = text_length(category)
    malformed = category.isNull() | (length != fixed.CATEGORY_ID_LENGTH) | category.contains("-")
    return products.filter(malformed).select("prd_id", "cat_id", length.alias("cat_id_length"))


def doubtful_costs_or_lines(products: DataFrame) -> DataFrame:
    doubtful = (F.col("prd_cost") < 0) | (F.col("prd_line") == fixed.NOT_AVAILABLE)
    return products.filter(doubtful).select("prd_id", "prd_cost", "prd_line")


def erp_customer_quality(job: Job, erp_customers: DataFrame) -> DataFrame:
    return erp_customers.agg(
        F.count("*").alias("total_rows_checked"),
        F.count_if(_blank(F.col("cid"))).alias("count_missing_customer_ids"),
        F.count_if(F.col("cid").startswith(fixed.ERP_ID_PREFIX)).alias("count_escaped_nas_prefixes"),
        F.count_if(F.col("bdate") > job.today()).alias("count_invalid_future_birthdates"),
        _not_in(F.col("gen"), fixed.GENDERS).alias("count_invalid_gender_formats"),
    )


def location_quality(locations: DataFrame) -> DataFrame:
    return locations.agg(
        F.count("*").alias("total_rows_checked"),
        F.count_if(_blank(F.col("cid"))).alias("count_missing_customer_ids"),
        F.count_if(F.col("cid").contains("-")).alias("count_escaped_hyphens"),
        _not_in(F.col("cntry"), fixed.COUNTRIES).alias("count_invalid_country_formats"),
    )


def category_quality(categories: DataFrame) -> DataFrame:
    return categories.agg(
        F.count("*").alias("total_rows_checked"),
        F.count_if(_blank(F.col("id"))).alias("count_missing_ids"),
        F.count_if(_blank(F.col("cat"))).alias("count_missing_categories"),
        F.count_if(_blank(F.col("subcat"))).alias("count_missing_subcategories"),
    )


# Silver audit

def silver_completeness(customers: DataFrame, products: DataFrame) -> DataFrame:
    return _union(
        _checks(customers, _SILVER_LABELS, "silver.crm_cust_info", {
            fixed.DUPLICATE_CUSTOMERS: _repeats("cst_id"),
            fixed.MISSING_CUSTOMER_KEYS: F.count_if(_blank(F.col("cst_key"))),
        }),
        _checks(products, _SILVER_LABELS, "silver.crm_prd_info", {
            fixed.DUPLICATE_PRODUCTS: F.count("*") - F.count_distinct("prd_key"),
            fixed.MISSING_PRODUCT_NAMES: F.count_if(_blank(F.col("prd_nm"))),
        }),
    )


def silver_domains(
    customers: DataFrame, erp_customers: DataFrame, locations: DataFrame
) -> DataFrame:
    return _union(
        _checks(customers, _SILVER_LABELS, "silver.crm_cust_info", {
            fixed.BAD_GENDER: _not_in(F.col("cst_gndr"), fixed.GENDERS),
            fixed.BAD_MARITAL: _not_in(F.col("cst_marital_status"), fixed.MARITAL_STATUSES),
        }),
        _checks(erp_customers, _SILVER_LABELS, "silver.erp_cust_az12", {
            fixed.OLD_BIRTHDATES: F.count_if(F.col("bdate") < F.lit(fixed.EARLIEST_BIRTHDATE)),
        }),
        _checks(locations, _SILVER_LABELS, "silver.erp_loc_a101", {
            fixed.UNMAPPED_COUNTRIES: F.count_if(F.col("cntry") == fixed.NOT_AVAILABLE),
        }),
    )


def _off(amount: Column, quantity: Column, price: Column) -> Column:
    return F.count_if(F.abs(amount - quantity * price) > fixed.MATH_TOLERANCE)


def silver_rules(products: DataFrame, sales: DataFrame) -> DataFrame:
    amount, quantity, price = F.col("sls_sales"), F.col("sls_quantity"), F.col("sls_price")
    return _union(
        _checks(products, _SILVER_LABELS, "silver.crm_prd_info", {
            fixed.END_BEFORE_START: F.count_if(F.col("prd_end_dt") < F.col("prd_start_dt")),
        }),
        _checks(sales, _SILVER_LABELS, "silver.crm_sales_details", {
            fixed.SHIPPED_EARLY: F.count_if(F.col("sls_ship_dt") < F.col("sls_order_dt")),
            fixed.NEGATIVE_SALES: F.count_if((amount < 0) | (quantity < 0) | (price < 0)),
            fixed.SALES_MATH: _off(amount, quantity, price),
        }),
    )


def _orphans(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, relation: str, check: str
) -> DataFrame:
    """Rows of `child` without a parent. Both sides shrink to one row per key value before they
    meet, so a key with many rows costs no more than any other."""
    counted = child.groupBy(child_key).agg(F.count("*").alias("rows"))
    parents = parent.select(F.col(parent_key).alias("_parent")).distinct()
    orphans = counted.join(parents, F.col(child_key) == F.col("_parent"), "left_anti")
    return orphans.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("exception_count")).select(
        F.lit(relation).alias("data_relationship"), F.lit(check).alias("audit_test"),
        "exception_count",
    )


def silver_orphans(
    customers: DataFrame, products: DataFrame, sales: DataFrame, locations: DataFrame
) -> DataFrame:
    return _union(
        _orphans(
            sales, "sls_cust_id", customers, "cst_id",
            "silver.crm_sales_details -> silver.crm_cust_info", fixed.ORPHAN_CUSTOMERS,
        ),
        _orphans(
            sales, "sls_prd_key", products, "prd_key",
            "silver.crm_sales_details -> silver.crm_prd_info", fixed.ORPHAN_PRODUCTS,
        ),
        _orphans(
            locations, "cid", customers, "cst_key",
            "silver.erp_loc_a101 -> silver.crm_cust_info", fixed.ORPHAN_LOCATIONS,
        ),
    )


# Gold audit

def gold_keys(customers: DataFrame, products: DataFrame) -> DataFrame:
    def keys(df: DataFrame, table: str, key: str, duplicates: str) -> DataFrame:
        return _checks(df, _GOLD_LABELS, table, {
            duplicates: _repeats(key), fixed.NULL_SURROGATES: F.count_if(F.col(key).isNull()),
        })

    return _union(
        keys(customers, "gold.dim_customer", "customer_key", fixed.DUPLICATE_CUSTOMER_KEYS),
        keys(products, "gold.dim_product", "product_key", fixed.DUPLICATE_PRODUCT_KEYS),
    )


def gold_domains(customers: DataFrame, products: DataFrame) -> DataFrame:
    unplaced = F.col("category").isNull() | F.col("subcategory").isNull()
    return _union(
        _checks(customers, _GOLD_LABELS, "gold.dim_customer", {
            fixed.GOLD_GENDER: _not_in(F.col("gender"), fixed.GENDERS),
            fixed.GOLD_MARITAL: _not_in(F.col("marital_status"), fixed.MARITAL_STATUSES),
        }),
        _checks(products, _GOLD_LABELS, "gold.dim_product", {
            fixed.GOLD_COST: F.count_if(F.col("cost") < 0),
            fixed.GOLD_CATEGORY: F.count_if(unplaced),
        }),
    )


def gold_facts(sales: DataFrame) -> DataFrame:
    amount, quantity = F.col("sales_amount"), F.col("quantity")
    return _checks(sales, _GOLD_LABELS, "gold.fact_sales", {
        fixed.GOLD_SHIPPED_EARLY: F.count_if(F.col("shipping_date") < F.col("order_date")),
        fixed.GOLD_NEGATIVE: F.count_if((amount < 0) | (quantity < 0)),
        fixed.GOLD_MATH: _off(amount, quantity, F.col("price")),
    })


def gold_references(sales: DataFrame) -> DataFrame:
    labels = ["star_relationship", "quality_check"]
    return long_measures(sales, labels, "exception_count", {
        ("gold.fact_sales -> gold.dim_customer", fixed.GOLD_NULL_CUSTOMER):
            F.count_if(F.col("customer_key").isNull()),
        ("gold.fact_sales -> gold.dim_product", fixed.GOLD_NULL_PRODUCT):
            F.count_if(F.col("product_key").isNull()),
    })


def fan_out(clean_sales: DataFrame, sales: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Surplus fact rows, and the repeated business keys that cause them."""
    surplus = sales.agg(F.count("*").alias("n")).select(
        F.lit("gold.fact_sales").alias("dimensional_object"),
        F.lit("Rows above the cleaned sales lines").alias("quality_check"),
        (F.col("n") - clean_sales.agg(F.count("*")).scalar()).alias("exception_count"),
    )
    return _union(
        surplus,
        _checks(customers, _GOLD_LABELS, "gold.dim_customer", {
            "Repeated customer ids": _repeats("customer_id")
        }),
        _checks(products, _GOLD_LABELS, "gold.dim_product", {
            "Repeated product numbers": _repeats("product_number")
        }),
    )
