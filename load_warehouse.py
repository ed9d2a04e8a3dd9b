"""Load a warehouse from extracts: spark-submit load_warehouse.py --extracts DIR --root DIR.

Loads the six extracts into bronze, cleans them into silver, builds the star schema in gold, and
shows the run log and the audits. Everything but these small summaries stays on the cluster.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from silverlode import Job, Warehouse
from silverlode.plans import audits
from silverlode.schemas import SILVER


def audit_reports(store: Warehouse) -> dict[str, DataFrame]:
    """The audits of both layers, each a short table of (object, check, exceptions)."""
    s, g = store.silver, store.gold
    customers, products, sales = s("crm_cust_info"), s("crm_prd_info"), s("crm_sales_details")
    places, details = s("erp_loc_a101"), s("erp_cust_az12")
    return {
        "silver completeness": audits.silver_completeness(customers, products),
        "silver domains": audits.silver_domains(customers, details, places),
        "silver rules": audits.silver_rules(products, sales),
        "silver orphans": audits.silver_orphans(customers, products, sales, places),
        "gold keys": audits.gold_keys(g("dim_customer"), g("dim_product")),
        "gold domains": audits.gold_domains(g("dim_customer"), g("dim_product")),
        "gold facts": audits.gold_facts(g("fact_sales")),
        "gold references": audits.gold_references(g("fact_sales")),
        "fan-out": audits.fan_out(sales, g("fact_sales"), g("dim_customer"), g("dim_product")),
    }


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--extracts", required=True, help="folder with source_crm/ and source_erp/")
    parser.add_argument("--root", required=True, help="folder of the warehouse, new or to be replaced")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, help="evaluation date (default: today)")
    parser.add_argument("--max-rejects", type=int, default=0, help="rejected lines allowed per extract; they are kept in bronze_rejects")
    parser.add_argument("--max-issues", type=int, help="exceptions allowed in a check of a cleaned table (default: any number)")
    options = parser.parse_args()

    spark = SparkSession.builder.appName("load warehouse").getOrCreate()
    store = Warehouse(Job(spark, options.as_of), options.root)
    store.load_extracts(options.extracts, max_rejects=options.max_rejects).show(truncate=False)
    log, checks = store.load_silver(options.max_issues)
    log.show(truncate=False)
    for name, report in checks.items():
        print(name)
        report.show(truncate=False)
    for table in SILVER:
        for name, report in store.audit_silver(table).items():
            print(f"{table}: {name}")
            report.show(truncate=False)
    store.load_gold().show(truncate=False)
    for name, report in audit_reports(store).items():
        print(name)
        report.show(truncate=False)


if __name__ == "__main__":
    main()
