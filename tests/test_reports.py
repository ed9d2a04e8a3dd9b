import pytest

from helpers import date, rows
from silverlode.plans import explore, practice, reports, trends
from silverlode.schemas import GOLD


def customer(key, birthdate=None, first="A", last="B", country="Germany", gender="Male", marital="Single"):
    return (key, key * 10, f"AW{key}", first, last, country, marital, gender,
            birthdate and date(birthdate), date("2025-01-01"))


def product(key, name="Thing", category="Bikes", cost=10, line="Road"):
    return (key, key * 10, f"P{key}", "BI_KE", name, category, "Sub", line, "Yes", cost, date("2020-01-01"))


def sale(order, product_key, customer_key, day, amount, quantity=1, price=None):
    day = day and date(day)
    return (order, product_key, customer_key, day, day, day, amount, quantity,
            amount if price is None else price)


@pytest.fixture(scope="session")
def gold(spark):
    def make(customers=(), products=(), sales=()):
        return [
            spark.createDataFrame(list(values), GOLD[table])
            for table, values in (("dim_customer", customers), ("dim_product", products), ("fact_sales", sales))
        ]

    return make


def by_key(df, key):
    return {row[key]: row for row in df.collect()}


def test_customer_report(job, gold):
    customers, _, sales = gold(
        [customer(1, "2006-12-31"), customer(2, "2005-01-01"), customer(3, None, None, "Solo"),
         customer(4, "1960-06-01"), customer(5, "1959-06-01"), customer(6)],
        sales=[
            sale("A", 1, 1, "2024-01-31", 4000), sale("A", 2, 1, "2024-01-31", 999, 3),
            sale("B", 1, 1, "2025-01-01", 1),
            sale("C", 1, 2, "2024-02-01", 4999), sale("D", 1, 2, "2025-02-01", 0),
            sale("E", 1, 4, "2025-11-30", 9000), sale("E", None, 4, "2025-11-30", 1000),
            sale("F", 1, 5, None, 7), sale("G", 1, 5, None, 8),
            sale("H", 1, 6, "2024-01-01", 0), sale("X", 1, None, "2024-01-01", 77),
        ],
    )
    got = by_key(reports.report_customers(job, customers, sales), "customer_key")
    assert sorted(got) == [1, 2, 3, 4, 5, 6]
    assert [got[i].age for i in range(1, 7)] == [19, 20, None, 65, 66, None]
    assert [got[i].age_category for i in range(1, 7)] == [
        "Under 20", "20-29", "Above 65", "60-65", "Above 65", "Above 65",
    ]
    assert [got[i].customer_category for i in range(1, 7)] == ["VIP", "Regular", "New", "New", "New", "New"]
    assert [got[i].customer_name for i in (1, 3)] == ["A B", " Solo"]
    assert (got[1].total_orders, got[1].total_sales, got[1].total_quantity, got[1].total_products) == (2, 5000, 5, 2)
    assert (got[1].last_order, got[1].recency) == (date("2025-01-01"), 11)
    assert (got[1].avg_order_value, got[1].avg_monthly_spend) == (2500, 416)
    # No sales at all: zeros. One month: the total. Undated orders: no monthly value.
    assert (got[3].total_orders, got[3].avg_order_value, got[3].avg_monthly_spend, got[3].recency) == (0, 0, 0, None)
    assert (got[4].total_products, got[4].avg_monthly_spend) == (1, 10000)
    assert (got[5].total_orders, got[5].avg_order_value, got[5].avg_monthly_spend) == (2, 7, None)
    assert got[6].avg_monthly_spend == 0


def test_product_report(job, gold):
    _, products, sales = gold(
        products=[product(1), product(2), product(3), product(4), product(5)],
        sales=[
            sale("A", 1, 1, "2024-01-01", 500000, 2), sale("B", 1, 2, "2024-03-01", 1, 0),
            sale("B", 2, 2, "2024-03-01", 500000, 3),
            sale("C", 3, 1, "2024-03-01", 900001, 1), sale("C", 3, None, None, None, 1, 5),
            sale("D", 4, 1, None, 10),
        ],
    )
    got = by_key(reports.report_products(job, products, sales), "product_key")
    assert sorted(got) == [1, 2, 3]
    assert [got[i].prod_performance for i in (1, 2, 3)] == ["Mid-Performer", "Low-Performer", "High-Performer"]
    assert (got[1].total_orders, got[1].total_customers, got[1].avg_selling_price) == (2, 2, 250000.0)
    assert (got[1].avg_order_revenue, got[1].avg_monthly_revenue, got[1].recency) == (250000, 250000, 21)
    assert got[2].avg_selling_price == 166666.7
    assert (got[3].total_sales, got[3].total_customers, got[3].avg_monthly_revenue) == (900001, 1, 900001)


def test_rankings_with_ties(gold):
    customers, products, sales = gold(
        [customer(i) for i in range(1, 5)],
        [product(1, "N1"), product(2, "N1"), product(3, "N3"), product(4, "N4")],
        [sale("A", 1, 1, "2024-01-01", 5), sale("B", 2, 2, "2024-01-01", 5), sale("C", 3, 2, "2024-01-01", 10),
         sale("C", None, None, "2024-01-01", 10), sale("D", 3, 3, None, None, 1, 1)],
    )
    # Equal names merge, unmapped sales are a group of their own, equal revenues share a rank.
    assert rows(explore.top_products(products, sales)) == sorted(
        [("N1", 10, 1), ("N3", 10, 1), (None, 10, 1)], key=repr
    )
    assert [tuple(r) for r in explore.worst_products(products, sales, 3).collect()] == [
        (4, "N4", 0), (1, "N1", 5), (2, "N1", 5),
    ]
    assert [tuple(r) for r in explore.top_customers(customers, sales, 3).collect()] == [
        (2, "A B", 15, 1), (None, " ", 10, 2), (1, "A B", 5, 3),
    ]
    assert [r.customer_key for r in explore.fewest_orders(customers, sales).collect()] == [4, 1, 3]
    assert [tuple(r) for r in practice.top_spenders(customers, sales, 2).collect()] == [
        (20, "A B", "Germany", 15), (10, "A B", "Germany", 5),
    ]
    assert rows(practice.unsold_products(products, sales)) == [("P4", "N4")]


def test_truncated_averages(job, gold):
    customers, products, sales = gold(
        [customer(1, "2000-01-01"), customer(2, "2001-01-01"), customer(3, None, gender="Female")],
        [product(1, cost=10), product(2, cost=11), product(3, category=None, cost=None)],
        [sale("A", 1, 1, "2024-01-01", 10, 1), sale("A", 1, 2, "2024-01-01", 5, 2), sale("B", 1, 1, "2024-01-01", 2)],
    )
    assert rows(explore.average_age_by_gender(job, customers)) == [("Female", None), ("Male", 24)]
    assert rows(explore.average_cost_by_category(products)) == [("Bikes", 10), (None, None)]
    kpis = dict(rows(explore.kpi_sheet(sales)))
    assert kpis["Average Price"] == 5 and kpis["Total Orders"] == 2 and kpis["Total Sales"] == 17
    assert rows(practice.demographics(job, customers, sales)) == [("Single", "Male", 17, 4, 8)]


def test_kpis_of_an_empty_fact(gold):
    _, _, sales = gold()
    assert dict(rows(explore.kpi_sheet(sales))) == {
        "Total Sales": None, "Total Quantity": None, "Average Price": None, "Total Orders": 0,
        "Total Products": 0, "Total Customers Ordered": 0,
    }


def test_running_totals_restart_each_year(gold):
    _, _, sales = gold(sales=[
        sale("A", 1, 1, "2023-11-30", 10, 1, 5), sale("B", 1, 1, "2023-12-01", 20, 1, 8),
        sale("C", 1, 1, "2024-01-15", 5, 1, 3), sale("D", 1, 1, "2024-01-20", 6, 1, 4),
        sale("E", 1, 1, None, 100),
    ])
    assert rows(trends.running_totals(sales)) == [
        (date("2023-11-01"), 10, 10, 5), (date("2023-12-01"), 20, 30, 6), (date("2024-01-01"), 11, 11, 3),
    ]
    assert rows(trends.monthly_trend(sales)) == [(2023, 11, 10, 1, 1), (2023, 12, 20, 1, 1), (2024, 1, 11, 1, 2)]


def test_year_over_year_compares_with_the_previous_year_sold(gold):
    _, products, sales = gold(
        products=[product(1, "N1"), product(2, "N1")],
        sales=[sale("A", 1, 1, "2020-05-01", 10), sale("A", 2, 1, "2020-06-01", 5),
               sale("B", 1, 1, "2023-05-01", 4), sale("C", 1, 1, "2024-05-01", 4),
               sale("D", None, 1, "2024-05-01", -7)],
    )
    got = [tuple(row) for row in trends.year_over_year(products, sales).collect()]
    assert got == [
        (2024, None, -7, 0, -7, "Decrease Sales", -7, 0, "Average"),
        (2020, "N1", 15, 0, 15, "Increase Sales", 7, 8, "Above Average"),
        (2023, "N1", 4, 15, -11, "Decrease Sales", 7, -3, "Below Average"),
        (2024, "N1", 4, 4, 0, "Static / NA", 7, -3, "Below Average"),
    ]


def test_category_shares(gold):
    _, products, sales = gold(
        products=[product(1, category="A"), product(2, category="B"), product(3, category="C")],
        sales=[sale("A", 1, 1, None, 1), sale("A", 2, 1, None, 2), sale("A", None, 1, None, 5),
               sale("A", 3, 1, None, None, 1, 1)],
    )
    assert rows(trends.category_shares(products, sales)) == sorted(
        [("A", 1, 8, "12.5%"), ("B", 2, 8, "25%"), (None, 5, 8, "62.5%"), ("C", None, 8, "%")], key=repr
    )


def test_segments_and_tiers(gold):
    _, products, sales = gold(
        products=[product(1, cost=1000), product(2, cost=1001), product(3, cost=2000), product(4, cost=2001),
                  product(5, cost=0), product(6, cost=None)],
        sales=[sale("A", 1, 1, "2023-01-31", 5000), sale("B", 1, 1, "2024-01-01", None, 1, 1),
               sale("C", 1, 2, "2023-01-31", 4999), sale("D", 1, 2, "2024-01-01", 0),
               sale("E", 1, 3, None, 9999), sale("F", 1, None, "2024-01-01", 9999),
               sale("G", 1, 4, "2023-01-31", None, 1, 1), sale("G", 1, 4, "2024-01-31", None, 1, 1)],
    )
    assert rows(trends.cost_tiers(products)) == [("1-1000", 2), ("1001-2000", 2), ("Above 2000", 2)]
    assert rows(trends.customer_segments(sales)) == [("New", 2), ("Regular", 1), ("VIP", 1)]


def test_zero_filled_groups(gold):
    customers, products, sales = gold(
        [customer(1, country="Germany"), customer(2, country=None), customer(3, country="France")],
        [product(1, category="A", line="Road"), product(2, category="B", line="Road"), product(3, category=None, line="N/A")],
        [sale("A", 1, 1, None, 5, 2), sale("B", 1, 2, None, None, 3, 1), sale("C", None, None, None, 9, 9)],
    )
    assert rows(explore.revenue_by_category(products, sales)) == sorted([("A", 5), ("B", 0), (None, 0)], key=repr)
    assert rows(explore.quantity_by_country(customers, sales)) == sorted(
        [("Germany", 2), (None, 3), ("France", 0)], key=repr)
    assert [tuple(r) for r in explore.revenue_by_customer(customers, sales).collect()] == [
        (1, "A", "B", 5), (2, "A", "B", 0), (3, "A", "B", 0)]
    assert rows(practice.product_lines(products, sales)) == [("N/A", 1, 0, 0), ("Road", 2, 5, 5)]


def test_column_profile(spark):
    df = spark.createDataFrame([(1, "bb"), (10, None), (9, "a"), (9, "a")], "n int, s string")
    got = {row.column_name: row.asDict() for row in explore.column_profile(df).collect()}
    assert got["n"] == {"column_name": "n", "data_type": "int", "null_count": 0, "distinct_count": 3,
                        "min_value": "1", "max_value": "10", "max_length": 2}
    assert got["s"]["null_count"] == 1 and got["s"]["distinct_count"] == 2 and got["s"]["max_length"] == 2
    empty = {row.column_name: row for row in explore.column_profile(df.filter("n > 99")).collect()}
    assert empty["s"].distinct_count == 0 and empty["n"].min_value is None
