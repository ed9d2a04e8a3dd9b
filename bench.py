"""Time the loads and the headline queries; prints one JSON line.

BENCH_SF_DIR: folder of the given tables (default /root/testdata/sf0.1)
BENCH_CPUS:   local cores (default 8)
BENCH_RUNS:   timed runs per query after one warm-up; the median counts (default 3)
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.compare import local_session
from checks.operator_queries import write_extract
from checks.queries import build, queries
from silverlode.operators import add_dense_key
from silverlode.schemas import EXTRACTS

# Cleaning, star schema, reports, analyses and the audits, as a user would run them.
HEADLINE = [
    "t1_clean_customers", "t2_clean_products", "t3_clean_sales", "t4_clean_erp_customers",
    "t5_clean_locations", "t6_categories",
    "g1_dim_customer", "g2_dim_product", "g3_fact_sales",
    "r1_report_customers", "r2_report_products",
    "e1_profile", "e2_catalog", "e3_order_span", "e4_age_by_gender", "e5_kpis",
    "e6_customers_by_country", "e7_customers_by_gender", "e8_products_by_category",
    "e9_cost_by_category", "e10_revenue_by_category", "e11_revenue_by_customer",
    "e12_quantity_by_country", "e13_top_products", "e14_worst_products", "e15_top_customers",
    "e16_fewest_orders",
    "v1_monthly_trend", "v2_running_totals", "v3_year_over_year", "v4_category_shares",
    "v5_cost_tiers", "v6_segments",
    "k1_unsold", "k2_demographics", "k3_product_lines", "k4_top_spenders",
    "q3_load_diagnostics", "q9_completeness", "q10_domains", "q11_rules", "q12_orphans",
    "q13_gold_keys", "q14_gold_domains", "q15_gold_facts", "q16_gold_references",
]


def seconds(work: Callable[[], object]) -> float:
    started = time.perf_counter()
    work()
    return time.perf_counter() - started


def drain(df: DataFrame) -> None:
    """Compute every row and column without bringing them to the driver."""
    df.write.format("noop").mode("overwrite").save()


def comparisons(spark: SparkSession, sf_dir: str, runs: int) -> dict[str, float]:
    """Median seconds of two ways to do the same: not part of the total."""
    built = build(spark, sf_dir)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    one_task = F.row_number().over(Window.orderBy("o_custkey", "o_orderkey"))
    fact = built.sales
    checks = [
        F.count_if(F.col("shipping_date") < F.col("order_date")),
        F.count_if((F.col("sales_amount") < 0) | (F.col("quantity") < 0)),
        F.count_if(F.abs(F.col("sales_amount") - F.col("quantity") * F.col("price")) > 0.05),
        F.count_if(F.col("customer_key").isNull()),
        F.count_if(F.col("product_key").isNull()),
    ]
    ways = {
        "dense_key": lambda: add_dense_key(built.job, orders, ["o_custkey", "o_orderkey"], "n", stored=True),
        "one_task_window_key": lambda: orders.withColumn("n", one_task),
        "audit_one_scan": lambda: fact.agg(*checks),
        "audit_scan_per_check": lambda: reduce(
            DataFrame.union, [fact.agg(check.alias("n")) for check in checks]
        ),
    }
    return {
        name: statistics.median([seconds(lambda: drain(way())) for _ in range(runs + 1)][1:])
        for name, way in ways.items()
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores, partitions=int(cores))

    built, times = build(spark, sf_dir), {}
    # The extract files are made once, untimed; the bronze load reads them.
    folder = built.job.new_path("extracts")
    for extract in EXTRACTS:
        rows = built.bronze(extract.table)
        write_extract(rows, f"{folder}/{extract.file}", extract.quoted)
    loads = {
        "load_bronze": lambda: built.store.load_extracts(folder),
        "load_silver": built.store.load_silver,
        "load_gold": built.store.load_gold,
    }
    first = {name: seconds(load) for name, load in loads.items()}
    for name, load in loads.items():
        times[name] = statistics.median(seconds(load) for _ in range(runs))
    built.gold("fact_sales")

    registered = queries()
    for name in HEADLINE:
        samples = [seconds(lambda: drain(registered[name](spark, sf_dir))) for _ in range(runs + 1)]
        times[name] = statistics.median(samples[1:])

    compared = comparisons(spark, sf_dir, runs)

    print(json.dumps({
        "metric": "three layer loads and headline queries, sum of medians",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in times.items()},
        "first_load": {name: round(value, 3) for name, value in first.items()},
        "compared": {name: round(value, 3) for name, value in compared.items()},
        "sales_rows_per_sec": round(built.silver("crm_sales_details").count() / times["t3_clean_sales"]),
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "config": {
            "spark": spark.version, "master": spark.sparkContext.master, "runs": runs,
            "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
        },
    }))
    spark.stop()


if __name__ == "__main__":
    main()
