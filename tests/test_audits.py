"""Every check must find a planted bad row, and nothing else on clean data."""

from concurrent.futures import ThreadPoolExecutor

from helpers import date
from silverlode import fixed_values as fixed
from silverlode.plans import audits
from silverlode.schemas import CLEAN, GOLD

DAY = date("2025-01-01")
GOOD = {
    "crm_cust_info": [(1, "AW1", "A", "B", "Single", "Male", DAY), (2, "AW2", "A", "B", "N/A", "N/A", DAY)],
    "crm_prd_info": [(1, "AC_HE", "P1", "Thing", 5, "Road", DAY, None), (2, "AC_HE", "P2", "Thing", 5, "Road", DAY, DAY)],
    "crm_sales_details": [("A", "P1", 1, DAY, DAY, DAY, 10, 2, 5), ("B", "P2", 2, None, DAY, DAY, None, 2, None)],
    "erp_cust_az12": [("AW1", date("1980-01-01"), "Male"), ("AW2", None, "N/A")],
    "erp_loc_a101": [("AW1", "Germany")],
    "erp_px_cat_g1v2": [("AC_HE", "Acc", "Helmets", "Yes")],
    "dim_customer": [(1, 1, "AW1", "A", "B", "Germany", "Single", "Male", None, DAY)],
    "dim_product": [(1, 1, "P1", "AC_HE", "Thing", "Acc", "Helmets", "Road", "Yes", 5, DAY)],
    "fact_sales": [("A", 1, 1, DAY, DAY, DAY, 10, 2, 5), ("B", 1, 1, None, DAY, DAY, None, 2, None)],
}


def found(spark, job, **bad):
    """Checks with exceptions, after adding bad rows to some tables."""
    values = {name: good + bad.get(name, []) for name, good in GOOD.items()}
    schemas = CLEAN | GOLD
    t = {name: spark.createDataFrame(values[name], schemas[name]) for name in values}
    counts = [
        audits.load_diagnostics(t["crm_cust_info"], t["crm_prd_info"], t["crm_sales_details"],
                                t["erp_cust_az12"], t["erp_loc_a101"]),
        audits.silver_completeness(t["crm_cust_info"], t["crm_prd_info"]),
        audits.silver_domains(t["crm_cust_info"], t["erp_cust_az12"], t["erp_loc_a101"]),
        audits.silver_rules(t["crm_prd_info"], t["crm_sales_details"]),
        audits.silver_orphans(t["crm_cust_info"], t["crm_prd_info"], t["crm_sales_details"], t["erp_loc_a101"]),
        audits.gold_keys(t["dim_customer"], t["dim_product"]),
        audits.gold_domains(t["dim_customer"], t["dim_product"]),
        audits.gold_facts(t["fact_sales"]),
        audits.gold_references(t["fact_sales"]),
    ]
    wide = [audits.erp_customer_quality(job, t["erp_cust_az12"]), audits.location_quality(t["erp_loc_a101"]),
            audits.category_quality(t["erp_px_cat_g1v2"])]
    lists = {
        "customer ids": audits.repeated_or_null(t["crm_cust_info"], "cst_id"),
        "product ids": audits.repeated_or_null(t["crm_prd_info"], "prd_id"),
        "names": audits.untidy_product_names(t["crm_prd_info"]),
        "dates": audits.reversed_product_dates(t["crm_prd_info"]),
        "categories": audits.malformed_categories(t["crm_prd_info"]),
        "costs or lines": audits.doubtful_costs_or_lines(t["crm_prd_info"]),
    }
    with ThreadPoolExecutor(8) as pool:
        results = list(pool.map(lambda df: df.collect(), [*counts, *wide, *lists.values()]))
    long = {tuple(row)[:2]: row[2] for result in results[: len(counts)] for row in result}
    for df, result in zip(wide, results[len(counts):]):
        for name, count in result[0].asDict().items():
            if name != "total_rows_checked":
                long[df.columns[-1], name] = count
    for name, result in zip(lists, results[len(counts) + len(wide):]):
        long["list", name] = len(result)
    return {check: count for (_, check), count in long.items() if count}


def test_clean_data_has_no_exceptions(spark, job):
    assert found(spark, job) == {}


def test_bad_customers_and_sales(spark, job):
    assert found(
        spark, job,
        crm_cust_info=[(1, "AW9", "A", "B", "Single", "Male", DAY), (None, "", "A", "B", "S", "m", DAY)],
        crm_sales_details=[
            ("C", "P1", 1, DAY, date("2024-12-31"), DAY, 10, 2, 5),
            ("C", "P1", 1, DAY, DAY, DAY, -10, 2, -5),
            ("C", "P1", 1, DAY, DAY, DAY, 11, 2, 5),
            ("C", "P1", 9, DAY, DAY, DAY, 10, 2, 5),
            ("C", None, None, DAY, DAY, DAY, 10, 2, 5),
        ],
    ) == {
        fixed.DUPLICATE_CUSTOMERS: 1, fixed.MISSING_CUSTOMER_KEYS: 1, fixed.BAD_GENDER: 1,
        fixed.BAD_MARITAL: 1, fixed.LOAD_KEYS: 2, "customer ids": 2,
        fixed.SHIPPED_EARLY: 1, fixed.NEGATIVE_SALES: 1, fixed.SALES_MATH: 1, fixed.LOAD_MATH: 1,
        fixed.ORPHAN_CUSTOMERS: 2, fixed.ORPHAN_PRODUCTS: 1,
    }


def test_bad_products(spark, job):
    assert found(spark, job, crm_prd_info=[
        (1, "AC_HE", "P1", " x", -1, "Road", DAY, date("2024-12-31")),
        (None, "AC-HE", "P3", None, 1, "N/A", DAY, None),
        (3, "AC_H", "P4", "", 1, "Road", DAY, None),
        (4, None, "P5", "x ", 1, "Road", DAY, None),
    ]) == {
        fixed.DUPLICATE_PRODUCTS: 1, fixed.END_BEFORE_START: 1, fixed.LOAD_DATES: 1,
        fixed.MISSING_PRODUCT_NAMES: 2, "product ids": 2, "names": 4, "dates": 1, "categories": 3,
        "costs or lines": 2,
    }


def test_bad_erp_rows(spark, job):
    assert found(
        spark, job,
        erp_cust_az12=[("NASAW1", date("1909-12-31"), "male"), ("", date("2026-01-01"), "Male")],
        erp_px_cat_g1v2=[(None, "", None, None)],
    ) == {
        fixed.LOAD_PREFIX: 1, fixed.OLD_BIRTHDATES: 1, "count_escaped_nas_prefixes": 1,
        "count_invalid_gender_formats": 1, "count_missing_customer_ids": 1,
        "count_invalid_future_birthdates": 1, "count_missing_ids": 1, "count_missing_categories": 1,
        "count_missing_subcategories": 1,
    }
    assert found(spark, job, erp_loc_a101=[("AW-1", "N/A"), (None, "DE")]) == {
        fixed.LOAD_HYPHENS: 1, fixed.UNMAPPED_COUNTRIES: 1, fixed.ORPHAN_LOCATIONS: 2,
        "count_escaped_hyphens": 1, "count_missing_customer_ids": 1, "count_invalid_country_formats": 1,
    }


def test_bad_gold_rows(spark, job):
    assert found(
        spark, job,
        dim_customer=[(1, 2, "AW2", "A", "B", None, "S", "F", None, DAY)],
        dim_product=[(None, 2, "P2", "X", "T", "Acc", None, "Road", "Yes", -5, DAY)],
        fact_sales=[("C", None, None, DAY, date("2024-12-31"), DAY, -11, 2, 5)],
    ) == {
        fixed.DUPLICATE_CUSTOMER_KEYS: 1, fixed.GOLD_GENDER: 1, fixed.GOLD_MARITAL: 1,
        fixed.NULL_SURROGATES: 1, fixed.GOLD_COST: 1, fixed.GOLD_CATEGORY: 1,
        fixed.GOLD_SHIPPED_EARLY: 1, fixed.GOLD_NEGATIVE: 1, fixed.GOLD_MATH: 1,
        fixed.GOLD_NULL_CUSTOMER: 1, fixed.GOLD_NULL_PRODUCT: 1,
    }
    assert found(
        spark, job,
        dim_customer=[(None, 2, "AW2", "A", "B", None, "N/A", "N/A", None, DAY)],
        dim_product=[(1, 2, "P2", "X", "T", "Acc", "Sub", "Road", "Yes", 5, DAY)],
    ) == {fixed.NULL_SURROGATES: 1, fixed.DUPLICATE_PRODUCT_KEYS: 1}


def test_counts_of_empty_tables_are_zero(spark):
    empty = spark.createDataFrame([], GOLD["fact_sales"])
    assert {row.exception_count for row in audits.gold_facts(empty).collect()} == {0}
    customers = spark.createDataFrame([], CLEAN["crm_cust_info"])
    products = spark.createDataFrame([], CLEAN["crm_prd_info"])
    sales = spark.createDataFrame([], CLEAN["crm_sales_details"])
    places = spark.createDataFrame([], CLEAN["erp_loc_a101"])
    orphans = audits.silver_orphans(customers, products, sales, places)
    assert [row.exception_count for row in orphans.collect()] == [0, 0, 0]
