"""Queries for single operators and functions, each over whole tables.

The ones ending in `_hot` run a job with limits so low that its ways for large tables and hot
keys are taken on the given data; they must give the same rows as the normal job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checks.queries import AS_OF, Build
from silverlode import Job, Limits, Warehouse
from silverlode import fixed_values as fixed
from silverlode import functions as X
from silverlode.operators import (
    add_dense_key,
    balanced_join,
    latest_per_key,
    long_measures,
    reduced_join,
    rolled_up_distinct,
    top_dense_ranks,
    with_group_max,
    with_next_value,
)
from silverlode.plans import explore, gold, practice, silver
from silverlode.plans.profiles import QUARTILES, merged_profile, profile_sketches
from silverlode.schemas import BRONZE, EXTRACTS, GOLD, LOAD_TIME, Extract
from silverlode.sources import (
    BucketedTable,
    Buckets,
    LoadFailed,
    MonthlyTable,
    bucketed_join,
    read_bucketed,
    read_extract,
    split_rejects,
    write_bucketed,
)
from silverlode.warehouse import SilverLoad

TINY = Limits(broadcast_rows=20, hot_rows=3)


def given(b: Build, table: str) -> DataFrame:
    return b.job.spark.read.parquet(f"{b.sf_dir}/{table}.parquet")


def tiny(b: Build) -> Job:
    return Job(b.job.spark, AS_OF, TINY, b.job.folder)


# Extracts and loads

def write_extract(df: DataFrame, path: str, quoted: bool) -> None:
    """Write rows as an extract: header, plain or RFC 4180 quoting, spaces kept."""
    writer = (
        df.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if quoted:
        writer = writer.option("quote", '"').option("escape", '"')
    else:
        # Without a quote an empty text and NULL look the same.
        writer = writer.option("quote", "\u0000").option("emptyValue", "")
    writer.csv(path)


def extract_rows(b: Build, table: str, quoted: bool) -> DataFrame:
    path = b.job.new_path(f"extract-{table}")
    write_extract(b.bronze(table), path, quoted)
    return split_rejects(read_extract(b.job.spark, path, BRONZE[table], quoted))[0]


def load_extracts(b: Build) -> DataFrame:
    folder = b.job.new_path("extracts")
    for extract in EXTRACTS:
        write_extract(b.bronze(extract.table), f"{folder}/{extract.table}", extract.quoted)
    store = Warehouse(b.job, b.job.new_path("loaded"))
    files = [Extract(extract.table, extract.table, extract.quoted) for extract in EXTRACTS]
    return counted(store.load_extracts(folder, files))


def counted(log: DataFrame) -> DataFrame:
    return log.select("layer", "table_name", "rows_loaded", "rows_rejected", "status")


def reload_twice(b: Build) -> DataFrame:
    store = Warehouse(b.job, b.job.new_path("reloaded"))
    store.load_bronze({"erp_loc_a101": b.bronze("erp_loc_a101")})
    store.load_bronze({"erp_loc_a101": b.bronze("erp_loc_a101").filter(F.col("cntry") != "")})
    return store.bronze("erp_loc_a101")


def loaded(b: Build, name: str) -> tuple[Warehouse, SilverLoad]:
    """A warehouse of its own over the raw tables, cleaned."""
    store = Warehouse(b.job, b.job.new_path(name))
    store.load_bronze({table: b.bronze(table) for table in BRONZE})
    return store, store.load_silver()


def load_diagnostics(b: Build) -> DataFrame:
    return loaded(b, "diagnosed")[1].checks["load diagnostics"]


def reload_products(b: Build) -> DataFrame:
    store, _ = loaded(b, "one_reloaded")
    return store.reload_silver("crm_prd_info").checks["doubtful costs or lines"]


def stamped_rows(b: Build) -> DataFrame:
    """Rows of each cleaned table, and how many carry their load time."""
    return reduce(DataFrame.unionByName, (
        b.silver(table).agg(
            F.lit(table).alias("table_name"), F.count("*").alias("row_count"),
            F.count(LOAD_TIME).alias("stamped"),
        ) for table in BRONZE
    ))


def loaded_customers(b: Build, name: str, df: DataFrame) -> Warehouse:
    """A warehouse with customers loaded from a quoted extract, whatever lines it refuses."""
    store = Warehouse(b.job, b.job.new_path(name))
    refill_customers(b, store, df, None)
    return store


def refill_customers(b: Build, store: Warehouse, df: DataFrame, max_rejects: int | None) -> None:
    folder = b.job.new_path("extracts")
    write_extract(df, f"{folder}/customers", quoted=True)
    store.load_extracts(folder, [Extract("crm_cust_info", "customers")], max_rejects)


def line_breaks(b: Build) -> DataFrame:
    """All customers with line breaks in the first, a middle and the last text field."""
    broken = b.bronze("crm_cust_info").withColumns({
        "cst_key": F.concat(F.lit("A\n"), "cst_key"),
        "cst_firstname": F.concat("cst_firstname", F.lit('\n"quoted", and more\n')),
        "cst_gndr": F.concat("cst_gndr", F.lit("\n")),
    })
    return loaded_customers(b, "line_breaks", broken).bronze("crm_cust_info")


def open_quotes(b: Build) -> DataFrame:
    """What is loaded of all customers, and what refused, when every seventh has a quote left open
    in its first, a middle or its last field; those come twice, so all quotes have a partner."""
    key = F.col("cst_key").substr(3, 20).cast("bigint")
    fields = [
        F.concat(F.when(key % 21 == 0, F.lit('"')).otherwise(F.lit("")),
                 F.coalesce(F.col("cst_id").cast("string"), F.lit(""))),
        F.concat(F.lit('"'), "cst_key", F.lit('"')), F.lit("a"),
        F.when(key % 21 == 7, F.lit('"b, c')).otherwise(F.lit('"b, c"')), F.lit("S"), F.lit("F"),
        F.when(key % 21 == 14, F.lit('"2025-01-02')).otherwise(F.lit("2025-01-02")),
    ]
    lines = b.bronze("crm_cust_info").select(F.concat_ws(",", *fields).alias("line"), F.explode(
        F.when(key % 7 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    ).alias("copy")).select("line")
    folder = b.job.new_path("extracts")
    lines.write.options(header=True, quote="\u0000", sep="\u0001").csv(f"{folder}/customers")
    store = Warehouse(b.job, b.job.new_path("open_quotes"))
    store.load_extracts(folder, [Extract("crm_cust_info", "customers")], None)
    loaded_rows = store.bronze("crm_cust_info").select(
        F.lit("row").alias("kind"), F.concat_ws("/", "cst_key", "cst_lastname").alias("text")
    )
    return loaded_rows.unionByName(
        store.rejects().select(F.lit("reject").alias("kind"), F.col("line").alias("text"))
    )


def doubtful_customers(b: Build) -> DataFrame:
    """Customers as texts; every fifth has an id or a date that is none, others odd spellings."""
    key = F.col("cst_key").substr(3, 20).cast("bigint")
    return b.bronze("crm_cust_info").filter("cst_firstname <> 'STALE'").select(
        F.when(key % 5 == 0, F.concat(F.lit("x"), key)).when(key % 7 == 0, F.lit(""))
        .otherwise(F.concat(F.lit(" "), key)).alias("cst_id"),
        "cst_key", F.lit("a, b").alias("cst_firstname"), F.lit("c").alias("cst_lastname"),
        F.lit("S").alias("cst_marital_status"), F.lit("F").alias("cst_gndr"),
        F.when(key % 3 == 0, F.lit("2025-01-02 00:00:00")).when(key % 10 == 5, F.lit("2025-13-01"))
        .otherwise(F.lit("2025-01-02")).alias("cst_create_date"),
    )


def rejected_lines(b: Build) -> DataFrame:
    store = loaded_customers(b, "rejects", doubtful_customers(b))
    return store.rejects().select("table_name", "line")


def lenient_fields(b: Build) -> DataFrame:
    """What is loaded beside the rejected lines."""
    return loaded_customers(b, "lenient", doubtful_customers(b)).bronze("crm_cust_info")


def refused_load(b: Build) -> DataFrame:
    """The table of a good load after another load with bad lines has failed."""
    store = loaded_customers(b, "refused", b.bronze("crm_cust_info"))
    try:
        refill_customers(b, store, doubtful_customers(b), 0)
    except LoadFailed:
        return store.bronze("crm_cust_info")
    raise AssertionError("the load should have failed")


def views_after_reload(b: Build) -> DataFrame:
    """A view that was registered before the table was loaded anew."""
    store = Warehouse(b.job, b.job.new_path("viewed"))
    store.load_bronze({"erp_loc_a101": b.bronze("erp_loc_a101").filter("cntry = ''")})
    store.register_views()
    store.load_bronze({"erp_loc_a101": b.bronze("erp_loc_a101")})
    return b.job.spark.sql("select cid, cntry from bronze_erp_loc_a101")


def sql_on_views(b: Build) -> DataFrame:
    """Sales are summed per customer and product before they meet the dimensions, so that no
    task gets all lines of one key."""
    b.gold("fact_sales")
    b.store.register_views()
    return b.job.spark.sql("""
        select c.country, p.category, r.customer_category, sum(s.items) as items
        from (
            select customer_key, product_key, sum(quantity) as items
            from gold_fact_sales group by customer_key, product_key) s
          left join gold_dim_customer c on c.customer_key = s.customer_key
          left join gold_dim_product p on p.product_key = s.product_key
          left join gold_report_customers r on r.customer_key = s.customer_key
        group by c.country, p.category, r.customer_category""")


# Predicates, projections and functions

def predicates(b: Build) -> DataFrame:
    """One column per kind of predicate over all raw sales lines; unknown stays NULL."""
    amount, price = F.col("sls_sales"), F.col("sls_price")
    return b.bronze("crm_sales_details").select(
        "sls_ord_num", "sls_prd_key", "sls_quantity",
        (F.col("sls_cust_id") == -1).alias("equal"),
        amount.isNull().alias("missing"),
        (amount > price).alias("greater"),
        (F.col("sls_ship_dt") != F.col("sls_order_dt")).alias("different"),
        F.col("sls_quantity").isin(1, 2, 3).alias("listed"),
        (~amount.isin(-5, 1)).alias("not_listed"),
        F.col("sls_prd_key").like("P0000%").alias("pattern"),
        ((amount <= 0) | (price <= 0)).alias("either"),
        ((amount > 100) & (price > 100)).alias("both"),
    )


def text_functions(b: Build) -> DataFrame:
    first, last = F.col("cst_firstname"), F.col("cst_lastname")
    return b.bronze("crm_cust_info").select(
        "cst_key",
        F.trim(first).alias("trimmed"),
        F.upper(first).alias("upper"),
        F.replace(F.col("cst_key"), F.lit("0"), F.lit("_")).alias("replaced"),
        F.substring("cst_key", 3, 4).alias("middle"),
        X.text_length(last).alias("length"),
        X.concat_blank(first, F.lit(" "), last).alias("full_name"),
        X.strip_prefix(F.col("cst_key"), "AW0").alias("stripped"),
        F.coalesce(last, first).alias("either_name"),
        X.map_codes(F.col("cst_gndr"), fixed.CRM_GENDER).alias("gender"),
        X.prefer(X.map_codes(F.col("cst_gndr"), fixed.CRM_GENDER), F.lit("Other")).alias("preferred"),
    )


def key_functions(b: Build) -> DataFrame:
    key = F.col("prd_key")
    return b.bronze("crm_prd_info").select(
        "prd_id", X.category_of_key(key).alias("category"), X.product_of_key(key).alias("product"),
        X.remove_hyphens(key).alias("joined"),
        X.band(F.col("prd_cost"), fixed.COST_BANDS, fixed.COST_ABOVE).alias("tier"),
    )


def number_functions(b: Build) -> DataFrame:
    """Whole-number arithmetic on signed values, with zero as a divisor for some."""
    balance = F.col("c_acctbal").cast("int")
    nation = F.col("c_nationkey")
    return given(b, "customer").select(
        "c_custkey",
        balance.alias("balance"),
        F.abs(balance).alias("absolute"),
        X.int_div(balance, nation).alias("per_nation"),
        F.nullif(nation, F.lit(0)).alias("not_zero"),
        (balance * 2 - nation + 1).alias("arithmetic"),
        F.round(balance.cast("double") / F.lit(8), 2).alias("eighth"),
    )


def misspelt(text: Column, number: Column) -> Column:
    """The text in lower case, with spaces at its end, or as it is."""
    return F.when(number % 3 == 0, F.lower(text)).when(number % 3 == 1, F.concat(text, F.lit("  "))) \
        .otherwise(text)


LIKE_THE_SERVER = "UTF8_LCASE_RTRIM"


def collated_keys(b: Build, limits: Limits | None = None) -> DataFrame:
    """All customers with the birthdates of the ERP, whose numbers are spelt in other ways."""
    job = Job(b.job.spark, AS_OF, limits or Limits(), b.job.folder, LIKE_THE_SERVER)
    details = b.silver("erp_cust_az12")
    number = F.regexp_extract("cid", "[0-9]+", 0).cast("bigint")
    details = details.select(misspelt(F.col("cid"), number).alias("cid"), "bdate")
    customers = b.silver("crm_cust_info").select("cst_id", "cst_key")
    details = job.stage(details, "misspelt")
    return balanced_join(job, customers, details, "cst_key", "cid")


def collated_load(b: Build) -> DataFrame:
    """The customer dimension of a warehouse that compares text as the collation says, from ERP
    extracts in other spellings."""
    job = Job(b.job.spark, AS_OF, Limits(), b.job.folder, LIKE_THE_SERVER)
    store = Warehouse(job, b.job.new_path("collated"))
    tables = {table: b.bronze(table) for table in BRONZE}
    for table in ("erp_cust_az12", "erp_loc_a101"):
        number = F.regexp_extract("cid", "[0-9]+", 0).cast("bigint")
        tables[table] = tables[table].withColumn("cid", misspelt(F.col("cid"), number))
    store.load_bronze(tables)
    store.load_silver()
    store.load_gold()
    return store.gold("dim_customer")


def collated_patterns(b: Build) -> DataFrame:
    """Every ERP customer with what patterns and an equation say of its id in other spellings."""
    number = F.regexp_extract("cid", "[0-9]+", 0).cast("bigint")
    cid = F.col("cid")
    rows = b.bronze("erp_cust_az12").withColumn("cid", misspelt(F.col("cid"), number))
    return rows.select(
        "cid", X.text_like(cid, "NAS%", LIKE_THE_SERVER).alias("prefixed"),
        X.text_like(cid, "%_w0%7", LIKE_THE_SERVER).alias("ends"),
        X.text_like(cid, "NAS%").alias("exactly"),
        X.text_equals(F.substring(cid, 1, 5), "nasaw", LIKE_THE_SERVER).alias("equal"),
        X.strip_prefix(cid, "NAS", LIKE_THE_SERVER).alias("stripped"),
    )


def int_dates(b: Build) -> DataFrame:
    dates = {
        f"{name}_date": X.int_date(F.col(name), fixed.LATEST_SALES_DATE)
        for name in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")
    }
    return b.bronze("crm_sales_details").select(
        "sls_ord_num", "sls_prd_key", *[date.alias(name) for name, date in dates.items()]
    )


def date_functions(b: Build) -> DataFrame:
    ordered = F.to_date("o_orderdate")
    return given(b, "orders").select(
        "o_orderkey",
        F.year(ordered).alias("order_year"),
        F.month(ordered).alias("order_month"),
        X.month_start(ordered).alias("month_begin"),
        X.month_diff(ordered, F.lit(AS_OF)).alias("months_to_date"),
        X.year_diff(ordered, F.lit(AS_OF)).alias("years_to_date"),
        F.date_sub(ordered, 1).alias("day_before"),
        X.null_after(ordered, F.lit("1999-12-31").cast("date")).alias("last_century"),
    )


def share_labels(b: Build) -> DataFrame:
    """Each part's share of all ordered pieces, as a percent label."""
    pieces = given(b, "lineitem").groupBy("l_partkey").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("pieces")
    )
    whole = given(b, "lineitem").agg(F.sum(F.col("l_quantity").cast("bigint"))).scalar()
    # One hundredth of the whole, so that the labels have decimals to show.
    return pieces.withColumn("total", F.call_function("div", whole, F.lit(100))).select(
        "l_partkey", "pieces", X.percent_label(F.col("pieces"), F.col("total")).alias("share")
    )


# Operators

def numbered_orders(b: Build) -> DataFrame:
    orders = given(b, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return add_dense_key(b.job, orders, ["o_custkey", "o_orderdate", "o_orderkey"], "order_number", stored=True)


def latest_orders(b: Build) -> DataFrame:
    """The latest order of every customer, from all orders; equal dates go to the higher key."""
    orders = given(b, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    return latest_per_key(orders, "o_custkey", by="o_orderdate")


def next_orders(b: Build) -> DataFrame:
    orders = given(b, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    order = ["o_orderdate", "o_orderkey"]
    return with_next_value(tiny(b), orders, "o_custkey", order, "o_orderkey", "next_orderkey")


def group_maxima(b: Build) -> DataFrame:
    lines = given(b, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    return with_group_max(tiny(b), lines, "l_orderkey", ["l_quantity", "l_shipdate"])


def average_balances(b: Build) -> DataFrame:
    balance = F.col("c_acctbal").cast("int")
    return given(b, "customer").groupBy("c_nationkey").agg(
        X.int_avg(balance).alias("average_balance"),
        X.sum_or_zero(F.when(balance < -100_000, balance)).alias("far_below"),
        F.count_if(balance < 0).alias("overdrawn"),
        (F.count("c_mktsegment") - F.count_distinct("c_mktsegment")).alias("repeated_segments"),
    )


def line_measures(b: Build) -> DataFrame:
    return long_measures(given(b, "lineitem"), ["subject", "measure"], "value", {
        ("lines", "count"): F.count("*"),
        ("lines", "parts"): F.count_distinct("l_partkey"),
        ("lines", "orders"): F.count_distinct("l_orderkey"),
        ("quantity", "sum"): F.sum(F.col("l_quantity").cast("bigint")),
        ("quantity", "above 40"): F.count_if(F.col("l_quantity") > 40),
    })


def ranked_quantities(b: Build) -> DataFrame:
    """All lines with one of the three greatest quantities: thousands of ties per rank."""
    lines = given(b, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    return top_dense_ranks(lines, "l_quantity", 3, "quantity_rank")


def joined_lines(b: Build, how: str) -> DataFrame:
    """Lines with their order, dealt over a grid for hot orders; a left and a semi join meet the
    open orders only, so that some lines find none."""
    lines = given(b, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = given(b, "orders")
    if how != "inner":
        orders = orders.filter(F.col("o_orderstatus") == "O")
    orders = orders.select("o_orderkey", "o_custkey")
    return balanced_join(tiny(b), lines, orders, "l_orderkey", "o_orderkey", how)


def reduced_lines(b: Build, how: str, limits: Limits | None = None) -> DataFrame:
    """All lines, and as many again of orders that do not exist, with or without their order."""
    job = Job(b.job.spark, AS_OF, limits or Limits(), b.job.folder)
    lines = given(b, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    strays = lines.withColumn("l_orderkey", F.col("l_orderkey") + 900_000_000_000)
    lines = job.stage(lines.unionByName(strays), "lines_and_strays")
    return reduced_join(job, lines, given(b, "orders"), "l_orderkey", "o_orderkey", how)


def replaced_months(b: Build) -> DataFrame:
    """The sales after every second month was replaced by lines of twice the quantity."""
    table = MonthlyTable(b.job, b.job.new_path("monthly"), GOLD["fact_sales"], "order_date")
    table.replace(b.sales)
    even = b.sales.filter(F.month("order_date") % 2 == 0)
    table.replace(even.withColumn("quantity", F.col("quantity") * 2))
    return table.read()


# Nothing is broadcast, so tables in buckets meet by them.
BY_BUCKETS = Limits(broadcast_rows=0)


def fact_with_buyers(job: Job, sales: BucketedTable, customers: BucketedTable) -> DataFrame:
    sales = sales.selected(
        order_number="order_number", product_key="product_key", customer_key="customer_key",
        sales_amount="sales_amount", quantity="quantity",
    )
    buyers = customers.selected(
        buyer_key="customer_key", customer_number="customer_number", country="country"
    )
    return bucketed_join(job, sales, buyers)


def bucketed_fact(b: Build) -> DataFrame:
    """Every sales line with its customer, from a warehouse that keeps both in buckets by key."""
    job = Job(b.job.spark, AS_OF, BY_BUCKETS, b.job.folder)
    by_customer = Buckets("customer_key", 8)
    store = Warehouse(job, job.new_path("in_buckets"), {
        ("gold", "fact_sales"): by_customer, ("gold", "dim_customer"): by_customer,
    })
    store.load_bronze({table: b.bronze(table) for table in BRONZE})
    store.load_silver()
    store.load_gold()
    return fact_with_buyers(
        job, store.bucketed("gold", "fact_sales"), store.bucketed("gold", "dim_customer")
    )


def bucketed_fact_hot(b: Build) -> DataFrame:
    """The same from the loaded tables, with customers of more than three lines as hot keys."""
    job, tables = tiny(b), []
    for name, df in (("fact_sales", b.sales), ("dim_customer", b.customers)):
        path = job.new_path(f"hot-{name}")
        write_bucketed(job, df, path, Buckets("customer_key", 8))
        tables.append(read_bucketed(job, path, df.schema))
    return fact_with_buyers(job, *tables)


def rolled_up_buyers(b: Build) -> DataFrame:
    """Distinct customers and products of every month, year and of all sales."""
    sales = b.sales.withColumns({
        "year": F.year("order_date"), "month": F.month("order_date"),
    })
    return rolled_up_distinct(
        b.job, sales, ["year", "month"], {"customers": "customer_key", "products": "product_key"}
    )


def merged_sales_profile(b: Build) -> DataFrame:
    """The profile of all sales from the stored sketches of every order year, and whether each
    estimate is as near to the exact answer as it promises (four standard errors)."""
    sales = b.sales
    yearly = b.job.stage(
        profile_sketches(sales, [F.year("order_date").alias("year")]), "yearly_profiles"
    )
    merged = merged_profile(yearly, sales.schema)
    # One row of facts per column, to ask the table how good the estimates are.
    measures = {}
    for found in merged.collect():
        value, values = F.col(found.column_name), found.row_count - found.null_count
        near = F.lit(True)
        for share, quartile in zip(QUARTILES, found.quartiles or []):
            at = F.lit(quartile).cast(sales.schema[found.column_name].dataType)
            low, high = F.count_if(value < at), F.count_if(value <= at)
            near &= (low <= (share + 0.02) * values) & (high >= (share - 0.02) * values)
        for one in found.frequent_values or []:
            times = F.count_if(value.cast("string") == one.value)
            near &= F.abs(times - one["count"]) <= 0.002 * found.row_count
        measures[found.column_name] = near
    held = long_measures(sales, ["column_name"], "ranks_and_counts_near", {
        (name,): near for name, near in measures.items()
    })
    exact = explore.column_profile(sales).select("column_name", "distinct_count")
    error = F.abs(F.col("distinct_estimate") - F.col("distinct_count"))
    return merged.join(exact, "column_name").join(held, "column_name").select(
        "column_name", "data_type", "row_count", "null_count", "min_value", "max_value",
        "max_length", (error <= 0.065 * F.col("distinct_count")).alias("distinct_near"),
        F.col("ranks_and_counts_near").cast("boolean").alias("ranks_and_counts_near"),
    )


ANSWERS = {
    "e1_profile_merged": merged_sales_profile,
    "j7_reduced_semi": lambda b: reduced_lines(b, "left_semi"),
    "j8_reduced_anti": lambda b: reduced_lines(b, "left_anti"),
    "j8_reduced_anti_hot": lambda b: reduced_lines(b, "left_anti", TINY),
    "j2_bucketed_fact": bucketed_fact,
    "j2_bucketed_fact_hot": bucketed_fact_hot,
    "a6_rolled_up_distinct": rolled_up_buyers,
    "s1_quoted_extract": lambda b: extract_rows(b, "crm_cust_info", quoted=True),
    "s1_quoted_locations": lambda b: extract_rows(b, "erp_loc_a101", quoted=True),
    "s2_plain_extract": lambda b: extract_rows(b, "erp_cust_az12", quoted=False),
    "s3_full_reload": reload_twice,
    "s3_replaced_months": replaced_months,
    "s4_load_time": stamped_rows,
    "s5_table_scan": lambda b: b.bronze("crm_sales_details"),
    "s6_sql_on_views": sql_on_views,
    "t7_load_bronze": load_extracts,
    "t8_load_silver": lambda b: counted(loaded(b, "silver_loaded")[1].log),
    "t8_load_diagnostics": load_diagnostics,
    "t9_reload_products": reload_products,
    "s1_line_breaks": line_breaks,
    "s1_open_quotes": open_quotes,
    "s1_lenient_fields": lenient_fields,
    "s10_rejected_lines": rejected_lines,
    "s11_refused_load_keeps_table": refused_load,
    "s12_views_after_reload": views_after_reload,
    "j1_collated_keys": collated_keys,
    "j1_collated_keys_hot": lambda b: collated_keys(b, TINY),
    "g1_collated_dim_customer": collated_load,
    "f5_collated_patterns": collated_patterns,
    "f_predicates": predicates,
    "x_text": text_functions,
    "x_keys": key_functions,
    "x_numbers": number_functions,
    "x19_int_dates": int_dates,
    "x22_dates": date_functions,
    "x26_share_labels": share_labels,
    "w1_latest_orders": latest_orders,
    "w2_dense_key": numbered_orders,
    "w4_ranked_quantities": ranked_quantities,
    "w5_next_orders_hot": next_orders,
    "w7_group_maxima_hot": group_maxima,
    "a_averages": average_balances,
    "u1_long_measures": line_measures,
    "j4_left_join_hot": lambda b: joined_lines(b, "left"),
    "j6_inner_join_hot": lambda b: joined_lines(b, "inner"),
    "j7_semi_join_hot": lambda b: joined_lines(b, "left_semi"),
    "t2_clean_products_hot": lambda b: silver.clean_products(tiny(b), b.bronze("crm_prd_info")),
    "t3_clean_sales_hot": lambda b: silver.clean_sales(tiny(b), b.bronze("crm_sales_details")),
    "t5_clean_locations_hot": lambda b: silver.clean_locations(
        tiny(b), b.bronze("erp_loc_a101"), b.silver("crm_cust_info")
    ),
    "g1_dim_customer_hot": lambda b: gold.dim_customer(
        tiny(b), b.silver("crm_cust_info"), b.silver("erp_cust_az12"), b.silver("erp_loc_a101")
    ),
    "g3_fact_sales_hot": lambda b: gold.fact_sales(
        tiny(b), b.silver("crm_sales_details"), b.customers, b.products
    ),
    "k2_demographics_hot": lambda b: practice.demographics(tiny(b), b.customers, b.sales),
}
