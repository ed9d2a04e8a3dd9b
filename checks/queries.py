"""Every registered query: (session, folder of the given tables) -> DataFrame."""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.extracts import spark_extracts
from silverlode import Job, Limits, Warehouse
from silverlode.plans import audits, explore, gold, practice, reports, silver, trends

AS_OF = dt.date(2025, 12, 31)

Query = Callable[[SparkSession, str], DataFrame]


class Build:
    """One warehouse over one folder of given tables, loaded layer by layer when first needed.

    As in production the layers are tables on shared storage: a query on the star schema reads
    those tables and does not clean the extracts again.
    """

    def __init__(
        self, spark: SparkSession, sf_dir: str, limits: Limits | None = None,
        extracts: dict[str, DataFrame] | None = None,
    ) -> None:
        self.sf_dir = sf_dir
        self.job = Job(spark, AS_OF, limits or Limits())
        self.extracts = extracts
        self.store = Warehouse(self.job)
        self._loaded: set[str] = set()
        self._loading = threading.Lock()

    def _need(self, layer: str) -> Warehouse:
        loads = {
            "bronze": lambda: self.store.load_bronze(
                self.extracts or spark_extracts(self.job.spark, self.sf_dir)
            ),
            "silver": self.store.load_silver,
            "gold": self.store.load_gold,
        }
        with self._loading:
            for step, load in loads.items():
                if step not in self._loaded:
                    load()
                    self._loaded.add(step)
                if step == layer:
                    return self.store
        raise ValueError(f"unknown layer {layer}")

    def bronze(self, table: str) -> DataFrame:
        return self._need("bronze").bronze(table)

    def silver(self, table: str) -> DataFrame:
        return self._need("silver").silver(table)

    def gold(self, table: str) -> DataFrame:
        return self._need("gold").gold(table)

    def gold_extremes(self, table: str, *columns: str) -> DataFrame:
        return self._need("gold").extremes("gold", table, *columns)

    @property
    def customers(self) -> DataFrame:
        return self.gold("dim_customer")

    @property
    def products(self) -> DataFrame:
        return self.gold("dim_product")

    @property
    def sales(self) -> DataFrame:
        return self.gold("fact_sales")


_BUILDS: dict[tuple[str, str], Build] = {}
_BUILDING = threading.Lock()


def build(spark: SparkSession, sf_dir: str) -> Build:
    key = (spark.sparkContext.applicationId, sf_dir)
    with _BUILDING:
        if key not in _BUILDS:
            _BUILDS[key] = Build(spark, sf_dir)
        return _BUILDS[key]


def _query(answer: Callable[[Build], DataFrame]) -> Query:
    return lambda spark, sf_dir: answer(build(spark, sf_dir))


ANSWERS: dict[str, Callable[[Build], DataFrame]] = {
    # cleaned tables, from the raw ones
    "t1_clean_customers": lambda b: silver.clean_customers(b.bronze("crm_cust_info")),
    "t2_clean_products": lambda b: silver.clean_products(b.job, b.bronze("crm_prd_info")),
    "t3_clean_sales": lambda b: silver.clean_sales(b.job, b.bronze("crm_sales_details")),
    "t4_clean_erp_customers": lambda b: silver.clean_erp_customers(b.job, b.bronze("erp_cust_az12")),
    "t5_clean_locations": lambda b: silver.clean_locations(
        b.job, b.bronze("erp_loc_a101"), b.silver("crm_cust_info")
    ),
    "t6_categories": lambda b: silver.clean_categories(b.bronze("erp_px_cat_g1v2")),
    # star schema, from the cleaned tables
    "g1_dim_customer": lambda b: gold.dim_customer(
        b.job, b.silver("crm_cust_info"), b.silver("erp_cust_az12"), b.silver("erp_loc_a101")
    ),
    "g2_dim_product": lambda b: gold.dim_product(
        b.job, b.silver("crm_prd_info"), b.silver("erp_px_cat_g1v2")
    ),
    "g3_fact_sales": lambda b: gold.fact_sales(
        b.job, b.silver("crm_sales_details"), b.customers, b.products
    ),
    # reports
    "r1_report_customers": lambda b: reports.report_customers(b.job, b.customers, b.sales),
    "r2_report_products": lambda b: reports.report_products(b.job, b.products, b.sales),
    # exploration
    "e1_profile": lambda b: explore.column_profile(b.customers),
    "e2_catalog": lambda b: explore.product_catalog(b.products),
    "e3_order_span": lambda b: explore.order_span(b.sales),
    "e3_order_span_footers": lambda b: explore.order_span(
        b.gold_extremes("fact_sales", "order_date")
    ),
    "e4_age_by_gender": lambda b: explore.average_age_by_gender(b.job, b.customers),
    "e5_kpis": lambda b: explore.kpi_sheet(b.sales),
    "e6_customers_by_country": lambda b: explore.customers_by_country(b.customers),
    "e7_customers_by_gender": lambda b: explore.customers_by_gender(b.customers),
    "e8_products_by_category": lambda b: explore.products_by_category(b.products),
    "e9_cost_by_category": lambda b: explore.average_cost_by_category(b.products),
    "e10_revenue_by_category": lambda b: explore.revenue_by_category(b.products, b.sales),
    "e11_revenue_by_customer": lambda b: explore.revenue_by_customer(b.customers, b.sales),
    "e12_quantity_by_country": lambda b: explore.quantity_by_country(b.customers, b.sales),
    "e13_top_products": lambda b: explore.top_products(b.products, b.sales),
    "e14_worst_products": lambda b: explore.worst_products(b.products, b.sales),
    "e15_top_customers": lambda b: explore.top_customers(b.customers, b.sales),
    "e16_fewest_orders": lambda b: explore.fewest_orders(b.customers, b.sales),
    # trends
    "v1_monthly_trend": lambda b: trends.monthly_trend(b.sales),
    "v2_running_totals": lambda b: trends.running_totals(b.sales),
    "w8_running_line_totals": lambda b: trends.running_line_totals(b.job, b.sales),
    "v3_year_over_year": lambda b: trends.year_over_year(b.products, b.sales),
    "v4_category_shares": lambda b: trends.category_shares(b.products, b.sales),
    "v5_cost_tiers": lambda b: trends.cost_tiers(b.products),
    "v6_segments": lambda b: trends.customer_segments(b.sales),
    # further questions
    "k1_unsold": lambda b: practice.unsold_products(b.products, b.sales),
    "k2_demographics": lambda b: practice.demographics(b.job, b.customers, b.sales),
    "k3_product_lines": lambda b: practice.product_lines(b.products, b.sales),
    "k4_top_spenders": lambda b: practice.top_spenders(b.customers, b.sales),
    # audits
    "q1_bronze_rows": lambda b: audits.row_counts(
        {f"bronze.{table}": b.bronze(table) for table in _TABLES}, "total_rows_loaded"
    ),
    "q2_silver_rows": lambda b: audits.row_counts(
        {f"silver.{table}": b.silver(table) for table in _TABLES}, "total_rows_retained"
    ),
    "q3_load_diagnostics": lambda b: audits.load_diagnostics(
        b.silver("crm_cust_info"), b.silver("crm_prd_info"), b.silver("crm_sales_details"),
        b.silver("erp_cust_az12"), b.silver("erp_loc_a101"),
    ),
    "q4_repeated_customer_ids": lambda b: audits.repeated_or_null(b.silver("crm_cust_info"), "cst_id"),
    "q4_repeated_raw_customer_ids": lambda b: audits.repeated_or_null(
        b.bronze("crm_cust_info"), "cst_id"
    ),
    "q5_repeated_product_ids": lambda b: audits.repeated_or_null(b.silver("crm_prd_info"), "prd_id"),
    "q5_untidy_names": lambda b: audits.untidy_product_names(b.silver("crm_prd_info")),
    "q5_untidy_raw_names": lambda b: audits.untidy_product_names(b.bronze("crm_prd_info")),
    "q5_reversed_dates": lambda b: audits.reversed_product_dates(b.silver("crm_prd_info")),
    "q5_malformed_categories": lambda b: audits.malformed_categories(b.silver("crm_prd_info")),
    "q5_costs_or_lines": lambda b: audits.doubtful_costs_or_lines(b.silver("crm_prd_info")),
    "q6_erp_customers": lambda b: audits.erp_customer_quality(b.job, b.silver("erp_cust_az12")),
    "q7_locations": lambda b: audits.location_quality(b.silver("erp_loc_a101")),
    "q8_categories": lambda b: audits.category_quality(b.silver("erp_px_cat_g1v2")),
    "q9_completeness": lambda b: audits.silver_completeness(
        b.silver("crm_cust_info"), b.silver("crm_prd_info")
    ),
    "q10_domains": lambda b: audits.silver_domains(
        b.silver("crm_cust_info"), b.silver("erp_cust_az12"), b.silver("erp_loc_a101")
    ),
    "q11_rules": lambda b: audits.silver_rules(
        b.silver("crm_prd_info"), b.silver("crm_sales_details")
    ),
    "q12_orphans": lambda b: audits.silver_orphans(
        b.silver("crm_cust_info"), b.silver("crm_prd_info"), b.silver("crm_sales_details"),
        b.silver("erp_loc_a101"),
    ),
    "q13_gold_keys": lambda b: audits.gold_keys(b.customers, b.products),
    "q14_gold_domains": lambda b: audits.gold_domains(b.customers, b.products),
    "q15_gold_facts": lambda b: audits.gold_facts(b.sales),
    "q16_gold_references": lambda b: audits.gold_references(b.sales),
    "q_fan_out": lambda b: audits.fan_out(
        b.silver("crm_sales_details"), b.sales, b.customers, b.products
    ),
}

_TABLES = [
    "crm_cust_info", "crm_prd_info", "crm_sales_details", "erp_cust_az12", "erp_loc_a101",
    "erp_px_cat_g1v2",
]


def queries() -> dict[str, Query]:
    from checks import operator_queries

    return {name: _query(answer) for name, answer in (ANSWERS | operator_queries.ANSWERS).items()}
