import pytest

from helpers import date, rows
from silverlode.plans import silver
from silverlode.schemas import BRONZE, CLEAN


def raw(spark, table, values):
    return spark.createDataFrame(values, BRONZE[table])


def test_customers_keep_the_latest_row(spark):
    df = raw(spark, "crm_cust_info", [
        (1, "K1", " Old", "Name", "S", "M", date("2024-01-01")),
        (1, "K1", " New ", "Name ", " m ", "f", date("2025-01-01")),
        (2, "K2", "a", None, "x", None, None),
        (2, "K2", "b", None, None, "", date("2020-01-01")),
        (None, "K3", "c", "d", "S", "M", date("2025-01-01")),
        # Same day: the greater remaining columns win, so the result does not vary.
        (4, "K4", "a", "x", "S", "M", date("2025-01-01")),
        (4, "K4", "b", "x", "M", "F", date("2025-01-01")),
    ])
    assert rows(silver.clean_customers(df)) == sorted([
        (1, "K1", "New", "Name", "Married", "Female", date("2025-01-01")),
        (2, "K2", "b", None, "N/A", "N/A", date("2020-01-01")),
        (4, "K4", "b", "x", "Married", "Female", date("2025-01-01")),
    ], key=repr)


def test_product_versions_end_before_the_next(spark, job):
    df = raw(spark, "crm_prd_info", [
        (212, "AC-HE-HL-U509-R", "Helmet Red", 12, "S ", date("2011-07-01"), date("2007-12-28")),
        (213, "AC-HE-HL-U509-R", " Helmet Red ", 14, "s", date("2012-07-01"), date("2008-12-27")),
        (214, "AC-HE-HL-U509-R", "Helmet Red", None, "S", date("2013-07-01"), None),
        (210, "CO-RF-FR-R92B-58", "Frame", None, "R ", date("2003-07-01"), None),
        # The same tail under another prefix has its own history.
        (300, "ZZ-ZZ-HL-U509-R", "Other", 1, None, date("2012-01-01"), None),
    ])
    got = {row.prd_id: row for row in silver.clean_products(job, df).collect()}
    assert [got[i].prd_end_dt for i in (212, 213, 214, 210, 300)] == [
        date("2012-06-30"), date("2013-06-30"), None, None, None,
    ]
    assert (got[212].cat_id, got[212].prd_key) == ("AC_HE", "HL-U509-R")
    assert (got[300].cat_id, got[300].prd_key) == ("ZZ_ZZ", "HL-U509-R")
    assert [got[i].prd_line for i in (212, 213, 210, 300)] == ["Other Sales", "Other Sales", "Road", "N/A"]
    assert (got[213].prd_nm, got[214].prd_cost, got[210].prd_cost) == ("Helmet Red", 0, 0)


def sale(order="SO1", dates=(20250101, 20250105, 20250110), money=(10, 2, 5)):
    return (order, "P1", 7, *dates, *money)


@pytest.mark.parametrize("money, expected", [
    # (sales, quantity, price) -> (sales, price)
    ((10, 2, 5), (10, 5)),
    ((None, 2, 5), (10, 5)),
    ((0, 2, 5), (10, 5)),
    ((-3, 2, 5), (10, 5)),
    ((11, 2, 5), (10, 5)),
    ((10, 2, -5), (10, 5)),
    ((10, 2, 0), (0, 0)),
    ((10, 2, None), (10, 5)),
    ((7, 2, None), (7, 3)),
    ((None, 2, None), (None, None)),
    ((-1, 2, None), (None, None)),
    ((10, 0, 5), (0, 5)),
    ((10, 0, None), (10, None)),
    ((10, None, 5), (10, 5)),
    ((None, None, 5), (None, 5)),
    ((10, -2, 5), (-10, 5)),
    ((7, -2, None), (7, -3)),
])
def test_money_is_made_consistent(spark, job, money, expected):
    df = raw(spark, "crm_sales_details", [sale(money=money)])
    row = silver.clean_sales(job, df).first()
    assert (row.sls_sales, row.sls_price, row.sls_quantity) == (*expected, money[1])


def test_dates_are_shared_by_the_lines_of_an_order(spark, job, hot_job):
    df = raw(spark, "crm_sales_details", [
        sale("A", (20250101, 20250103, 20250110)),
        sale("A", (0, 20250104, None)),
        sale("A", (32154, 5489, 20310101)),
        sale("B", (0, 0, 0)),
        sale("B", (20250230, None, 123)),
        sale(None, (20240101, None, None)),
        sale(None, (20240102, None, None)),
        sale(None, (0, 0, 0)),
    ])
    expected = sorted(
        [("A", date("2025-01-01"), date("2025-01-04"), date("2025-01-10"))] * 3
        + [("B", None, None, None)] * 2 + [(None, date("2024-01-02"), None, None)] * 3, key=repr,
    )
    columns = ["sls_ord_num", "sls_order_dt", "sls_ship_dt", "sls_due_dt"]
    for one_job in (job, hot_job):
        got = silver.clean_sales(one_job, job.stage(df, "sales"))
        assert got.columns == CLEAN["crm_sales_details"].fieldNames()
        assert rows(got.select(columns)) == expected


def test_erp_customers(spark, job):
    df = raw(spark, "erp_cust_az12", [
        ("NASAW1", date("1980-05-05"), "Male"), ("AW2", date("2026-01-01"), " female"),
        ("AW3", date("2025-12-31"), "f"), ("AW4", None, None), (None, date("1900-01-01"), "?"),
    ])
    assert rows(silver.clean_erp_customers(job, df)) == sorted([
        ("AW1", date("1980-05-05"), "Male"), ("AW2", None, "Female"),
        ("AW3", date("2025-12-31"), "Female"), ("AW4", None, "N/A"), (None, date("1900-01-01"), "N/A"),
    ], key=repr)


def test_locations_need_a_customer(spark, job, hot_job):
    customers = job.stage(spark.createDataFrame([
        (1, "AW1", None, None, None, None, None), (2, "AW2", None, None, None, None, None),
        (3, None, None, None, None, None, None), (4, "AW1", None, None, None, None, None),
    ], CLEAN["crm_cust_info"]), "customers")
    df = raw(spark, "erp_loc_a101", [("AW-1", "DE"), ("A-W-1", "us "), ("AW-9", "FR"), (None, "FR"), ("AW2", None)]
             + [("AW-1", "xx")] * 5)
    df = job.stage(df, "locations")
    expected = sorted([("AW1", "Germany"), ("AW1", "United States"), ("AW2", "N/A")] + [("AW1", "N/A")] * 5)
    assert rows(silver.clean_locations(job, df, customers)) == expected
    assert rows(silver.clean_locations(hot_job, df, customers)) == expected
