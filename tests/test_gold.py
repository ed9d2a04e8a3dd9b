from helpers import date, rows
from silverlode.plans import audits, gold
from silverlode.schemas import GOLD, CLEAN


def clean(job, table, values):
    return job.stage(job.spark.createDataFrame(values, CLEAN[table]), table)


def customer(cst_id, key, gender="N/A"):
    return (cst_id, key, f"F{cst_id}", f"L{cst_id}", "Single", gender, date("2025-01-01"))


def product(prd_id, key, cat="AC_HE", start="2020-01-01", end=None):
    return (prd_id, cat, key, f"Product {key}", 10, "Road", date(start), end and date(end))


def sale(order, key, cst_id):
    day = date("2025-03-01")
    return (order, key, cst_id, day, day, day, 10, 2, 5)


def build(job, customers, details, places, products, categories, sales):
    dim_customer = job.stage(gold.dim_customer(
        job, clean(job, "crm_cust_info", customers), clean(job, "erp_cust_az12", details),
        clean(job, "erp_loc_a101", places),
    ), "dim_customer")
    dim_product = job.stage(gold.dim_product(
        job, clean(job, "crm_prd_info", products), clean(job, "erp_px_cat_g1v2", categories),
    ), "dim_product")
    lines = clean(job, "crm_sales_details", sales)
    return dim_customer, dim_product, lines, gold.fact_sales(job, lines, dim_customer, dim_product)


CATEGORIES = [("AC_HE", "Accessories", "Helmets", "Yes")]


def test_star_schema(job, hot_job):
    for one_job in (job, hot_job):
        customers, products, lines, sales = build(
            one_job,
            [customer(30, "K30"), customer(7, "K7", "Male"), customer(11, None)],
            [("K30", date("1980-01-01"), "Female"), ("K7", None, "Female")],
            [("K7", "Germany")],
            [product(1, "P1", start="2019-01-01", end="2019-12-31"), product(2, "P1"),
             product(3, "P0", cat="XX_XX"), product(4, "P9", start="2018-01-01")],
            CATEGORIES,
            [sale("A", "P1", 7), sale("A", "P0", 7), sale("B", "P1", 99), sale("C", "??", None)],
        )
        assert customers.schema.names == GOLD["dim_customer"].fieldNames()
        assert dict(customers.dtypes)["customer_key"] == "bigint"
        got = {row.customer_id: row for row in customers.collect()}
        assert {i: got[i].customer_key for i in got} == {7: 1, 11: 2, 30: 3}
        assert {i: got[i].gender for i in got} == {7: "Male", 11: "N/A", 30: "Female"}
        assert {i: got[i].country for i in got} == {7: "Germany", 11: None, 30: None}

        assert rows(products.select("product_key", "product_id", "product_number", "category")) == [
            (1, 4, "P9", "Accessories"), (2, 3, "P0", None), (3, 2, "P1", "Accessories"),
        ]
        assert rows(sales.select("order_number", "product_key", "customer_key")) == sorted(
            [("A", 3, 1), ("A", 2, 1), ("B", 3, None), ("C", None, None)], key=repr
        )
        assert sales.columns == GOLD["fact_sales"].fieldNames()


def test_repeated_erp_ids_fan_out_and_are_audited(job, hot_job):
    for one_job in (job, hot_job):
        customers, products, lines, sales = build(
            one_job,
            [customer(1, "K1"), customer(2, "K2")],
            [("K1", date("1980-01-01"), "Male"), ("K1", date("1990-01-01"), "Female")]
            + [("K1", None, "N/A")] * 4,
            [("K1", "Germany"), ("K1", "France")],
            # Two prefixes share one product tail.
            [product(1, "P1"), product(2, "P1", cat="BB_BB")],
            CATEGORIES,
            [sale("A", "P1", 1), sale("B", "P1", 2)],
        )
        assert sorted(row.customer_key for row in customers.collect()) == list(range(1, 14))
        assert customers.filter("customer_id = 1").count() == 12
        assert sales.count() == 12 * 2 + 2
        found = {row.quality_check: row.exception_count
                 for row in audits.fan_out(lines, sales, customers, products).collect()}
        assert found == {
            "Rows above the cleaned sales lines": 24, "Repeated customer ids": 11,
            "Repeated product numbers": 1,
        }


def test_keys_do_not_depend_on_partitioning(spark, job):
    values = [customer(i * 7 % 101, f"K{i % 13}") for i in range(101)]
    details = [(f"K{i}", date(f"19{50 + i}-01-01"), "Male") for i in range(13)]
    results = []
    for partitions in (1, 3, 9):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        customers = job.stage(
            spark.createDataFrame(values, CLEAN["crm_cust_info"]).repartition(partitions), "customers"
        )
        results.append(rows(gold.dim_customer(
            job, customers, clean(job, "erp_cust_az12", details), clean(job, "erp_loc_a101", []),
        )))
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert results[0] == results[1] == results[2]
    assert len(results[0]) == 101
