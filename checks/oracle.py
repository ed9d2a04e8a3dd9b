"""The expected answers as DuckDB SQL, written independently of the Spark code."""

from __future__ import annotations

import re

from checks.extracts import EXTRACT_SQL, duckdb_extract

AS_OF = "date '2025-12-31'"


def _label(column: str, pairs: dict[str, str]) -> str:
    listed = " ".join(f"when '{code}' then '{label}'" for code, label in pairs.items())
    return f"case upper(trim({column}, ' ')) {listed} else 'N/A' end"


def _date(column: str) -> str:
    text = (
        f"case when {column} between 1000 and 9999 then {column}::varchar || '0101' "
        f"when {column} between 100000 and 999999 "
        f"then (case when {column} < 500000 then '20' else '19' end) || {column}::varchar "
        f"when {column} between 10000101 and 99991231 then {column}::varchar end"
    )
    return f"try_strptime({text}, '%Y%m%d')::date"


# Labels and codes below are fixed values: answers must have them.
_COUNTRIES = {
    "DE": "Germany", "GERMANY": "Germany",
    "USA": "United States", "US": "United States", "UNITED STATES": "United States",
    "UK": "United Kingdom", "UNITED KINGDOM": "United Kingdom",
    "AU": "Australia", "AUSTRALIA": "Australia",
    "CAN": "Canada", "CANADA": "Canada",
    "FR": "France", "FRANCE": "France",
}

# Named building blocks; a query gets those it mentions, and those they mention.
_BLOCKS: dict[str, str] = {f"bronze_{table}": duckdb_extract(table) for table in EXTRACT_SQL}

_BLOCKS["silver_crm_cust_info"] = f"""
select distinct on (cst_id) cst_id, cst_key,
  trim(cst_firstname, ' ') as cst_firstname, trim(cst_lastname, ' ') as cst_lastname,
  {_label("cst_marital_status", {"S": "Single", "M": "Married"})} as cst_marital_status,
  {_label("cst_gndr", {"M": "Male", "F": "Female"})} as cst_gndr,
  cst_create_date
from bronze_crm_cust_info b
where cst_id is not null
order by cst_id, b.cst_create_date desc nulls last, b.cst_key desc nulls last,
  b.cst_firstname desc nulls last, b.cst_lastname desc nulls last,
  b.cst_marital_status desc nulls last, b.cst_gndr desc nulls last
"""

_BLOCKS["silver_crm_prd_info"] = f"""
select prd_id, replace(left(prd_key, 5), '-', '_') as cat_id, prd_key[7:] as prd_key,
  trim(prd_nm, ' ') as prd_nm, ifnull(prd_cost, 0) as prd_cost,
  {_label("prd_line", {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"})} as prd_line,
  prd_start_dt,
  lead(prd_start_dt) over (
    partition by b.prd_key order by prd_start_dt nulls first, prd_id nulls first
  ) - 1 as prd_end_dt
from bronze_crm_prd_info b
"""

_BLOCKS["sales_dates"] = f"""
select *,
  {_date("sls_order_dt")} as o, {_date("sls_ship_dt")} as s, {_date("sls_due_dt")} as d,
  sls_quantity * abs(sls_price) as worth
from bronze_crm_sales_details
"""

_BLOCKS["order_dates"] = """
select sls_ord_num as ord,
  max(o) filter (where o <= date '2030-12-31') as order_dt,
  max(s) filter (where s <= date '2030-12-31') as ship_dt,
  max(d) filter (where d <= date '2030-12-31') as due_dt
from sales_dates group by all
"""

_BLOCKS["sales_money"] = """
select *,
  case when sls_sales > 0 and ifnull(sls_sales = worth, true) then sls_sales else worth end as amount
from sales_dates
"""

_BLOCKS["silver_crm_sales_details"] = """
select sls_ord_num, sls_prd_key, sls_cust_id,
  order_dt as sls_order_dt, ship_dt as sls_ship_dt, due_dt as sls_due_dt,
  amount as sls_sales, sls_quantity,
  case when sls_price > 0 then sls_price else (amount // nullif(sls_quantity, 0))::int end as sls_price
from sales_money join order_dates on sls_ord_num is not distinct from ord
"""

_BLOCKS["silver_erp_cust_az12"] = f"""
select regexp_replace(cid, '^NAS', '') as cid,
  case when not bdate > {AS_OF} then bdate end as bdate,
  {_label("gen", {"M": "Male", "MALE": "Male", "F": "Female", "FEMALE": "Female"})} as gen
from bronze_erp_cust_az12
"""

_BLOCKS["silver_erp_loc_a101"] = f"""
select replace(cid, '-', '') as cid, {_label("cntry", _COUNTRIES)} as cntry
from bronze_erp_loc_a101 l semi join silver_crm_cust_info c on replace(l.cid, '-', '') = c.cst_key
"""

_BLOCKS["silver_erp_px_cat_g1v2"] = "select id, cat, subcat, maintenance from bronze_erp_px_cat_g1v2"

_BLOCKS["gold_dim_customer"] = """
select row_number() over (
    order by cst_id nulls first, bdate nulls first, cst_gndr, gen nulls first, cntry nulls first
  ) as customer_key,
  cst_id as customer_id, cst_key as customer_number,
  cst_firstname as first_name, cst_lastname as last_name, cntry as country,
  cst_marital_status as marital_status,
  ifnull(nullif(cst_gndr, 'N/A'), ifnull(gen, 'N/A')) as gender,
  bdate as birthdate, cst_create_date as create_date
from silver_crm_cust_info c
  left join silver_erp_cust_az12 a on a.cid = c.cst_key
  left join silver_erp_loc_a101 l on l.cid = c.cst_key
"""

_BLOCKS["gold_dim_product"] = """
select row_number() over (
    order by prd_start_dt nulls first, prd_key nulls first, prd_id nulls first
  ) as product_key,
  prd_id as product_id, prd_key as product_number, cat_id as category_id, prd_nm as product_name,
  cat as category, subcat as subcategory, prd_line as product_line, maintenance,
  prd_cost as cost, prd_start_dt as start_date
from silver_crm_prd_info left join silver_erp_px_cat_g1v2 on id = cat_id
where prd_end_dt is null
"""

_BLOCKS["gold_fact_sales"] = """
select sls_ord_num as order_number, product_key, customer_key, sls_order_dt as order_date,
  sls_ship_dt as shipping_date, sls_due_dt as due_date,
  sls_sales as sales_amount, sls_quantity as quantity, sls_price as price
from silver_crm_sales_details
  left join gold_dim_customer on customer_id = sls_cust_id
  left join gold_dim_product on product_number = sls_prd_key
"""

_BLOCKS["customer_activity"] = f"""
select d.customer_key, customer_number,
  concat(first_name, ' ', last_name) as customer_name,
  date_diff('year', birthdate, {AS_OF}) as age,
  count(distinct order_number) as orders, count(distinct product_key) as products,
  ifnull(sum(sales_amount), 0)::bigint as sales, ifnull(sum(quantity), 0)::bigint as items,
  max(order_date) as last_order, date_diff('month', min(order_date), max(order_date)) as months
from gold_dim_customer d left join gold_fact_sales f on f.customer_key = d.customer_key
group by d.customer_key, customer_number, first_name, last_name, birthdate
"""

_BLOCKS["product_activity"] = """
select d.product_key, product_name, category, subcategory, cost,
  max(order_date) as last_sale_date, date_diff('month', min(order_date), max(order_date)) as months,
  count(distinct order_number) as orders, count(distinct customer_key) as buyers,
  ifnull(sum(sales_amount), 0)::bigint as sales, ifnull(sum(quantity), 0)::bigint as items,
  round(avg(sales_amount::double / nullif(quantity, 0)), 1) as unit_price
from gold_dim_product d left join gold_fact_sales f on f.product_key = d.product_key
group by all
having last_sale_date is not null
"""

_SEGMENT = """case when months >= 12 and {sales} >= 5000 then 'VIP'
    when months >= 12 and {sales} < 5000 then 'Regular' else 'New' end"""


def _column_facts(column: str, kind: str) -> str:
    return (
        f"select '{column}' as column_name, '{kind}' as data_type, "
        f"count(*) - count({column}) as null_count, count(distinct {column}) as distinct_count, "
        f"min({column})::varchar as min_value, max({column})::varchar as max_value, "
        f"max(length({column}::varchar))::bigint as max_length from gold_dim_customer"
    )


def _counts(layer: str, name: str) -> str:
    return "\nunion all ".join(
        f"select '{layer}.{table}' as table_name, count(*) as {name} from {layer}_{table}"
        for table in EXTRACT_SQL
    )


def _check(columns: tuple[str, str, str], *rows: tuple[str, str, str, str]) -> str:
    first, second, third = columns
    return "\nunion all ".join(
        f"select '{place}' as {first}, '{check}' as {second}, {count} as {third} from {source}"
        for place, check, count, source in rows
    )


def _n(condition: str) -> str:
    return f"count(*) filter (where {condition})"


_SILVER = ("table_name", "audit_test", "exception_count")
_GOLD = ("dimensional_object", "quality_check", "exception_count")

ORACLE: dict[str, str] = {
    # cleaned tables
    "t1_clean_customers": "select * from silver_crm_cust_info",
    "t2_clean_products": "select * from silver_crm_prd_info",
    "t3_clean_sales": "select * from silver_crm_sales_details",
    "t4_clean_erp_customers": "select * from silver_erp_cust_az12",
    "t5_clean_locations": "select * from silver_erp_loc_a101",
    "t6_categories": "select * from silver_erp_px_cat_g1v2",
    # star schema
    "g1_dim_customer": "select * from gold_dim_customer",
    "g2_dim_product": "select * from gold_dim_product",
    "g3_fact_sales": "select * from gold_fact_sales",
    # reports
    "r1_report_customers": f"""
select customer_key, customer_number, customer_name, age::int as age,
  case when age < 20 then 'Under 20' when age < 30 then '20-29' when age < 40 then '30-39'
    when age < 50 then '40-49' when age < 60 then '50-59' when age < 66 then '60-65'
    else 'Above 65' end as age_category,
  {_SEGMENT.format(sales="sales")} as customer_category,
  last_order, date_diff('month', last_order, {AS_OF})::int as recency,
  orders as total_orders, sales as total_sales, items as total_quantity,
  products as total_products,
  if(orders = 0, 0, sales // orders) as avg_order_value,
  case when sales = 0 then 0 when months = 0 then sales else sales // months end as avg_monthly_spend
from customer_activity""",
    "r2_report_products": f"""
select product_key, product_name, category, subcategory, cost, last_sale_date,
  date_diff('month', last_sale_date, {AS_OF})::int as recency,
  case when sales > 900000 then 'High-Performer' when sales > 500000 then 'Mid-Performer'
    else 'Low-Performer' end as prod_performance,
  orders as total_orders, sales as total_sales, items as total_quantity,
  buyers as total_customers, unit_price as avg_selling_price,
  if(orders = 0, 0, sales // orders) as avg_order_revenue,
  case when sales = 0 then 0 when months = 0 then sales else sales // months end as avg_monthly_revenue
from product_activity""",
    # exploration
    "e1_profile": "\nunion all ".join(
        _column_facts(column, kind)
        for column, kind in {
            "customer_key": "bigint", "customer_id": "int", "customer_number": "string",
            "first_name": "string", "last_name": "string", "country": "string",
            "marital_status": "string", "gender": "string", "birthdate": "date",
            "create_date": "date",
        }.items()
    ),
    "e2_catalog": "select category, subcategory, product_name from gold_dim_product group by all",
    "e3_order_span": """
select min(order_date) as first_transaction_date, max(order_date) as last_transaction_date,
  (year(max(order_date)) - year(min(order_date)))::int as tracking_span_years
from gold_fact_sales""",
    "e4_age_by_gender": f"""
select gender, (sum(date_diff('year', birthdate, {AS_OF})) // count(birthdate))::bigint as average_customer_age
from gold_dim_customer group by gender""",
    "e5_kpis": """
unpivot (
  select sum(sales_amount)::bigint as "Total Sales", sum(quantity)::bigint as "Total Quantity",
    (sum(price) // count(price))::bigint as "Average Price",
    count(distinct order_number) as "Total Orders", count(distinct product_key) as "Total Products",
    count(distinct customer_key) as "Total Customers Ordered"
  from gold_fact_sales
) on columns(*) into name measure_name value measure_value""",
    "e6_customers_by_country":
        "select country, count(*) as total_customers from gold_dim_customer group by 1",
    "e7_customers_by_gender":
        "select gender, count(*) as total_customers from gold_dim_customer group by 1",
    "e8_products_by_category":
        "select category, count(*) as total_products from gold_dim_product group by 1",
    "e9_cost_by_category": """
select category, (sum(cost) // count(cost))::bigint as average_cost from gold_dim_product group by 1""",
    "e10_revenue_by_category": """
select category, ifnull(sum(sales_amount), 0)::bigint as total_revenue
from gold_fact_sales right join gold_dim_product using (product_key) group by 1""",
    "e11_revenue_by_customer": """
select customer_key, first_name, last_name,
  ifnull((select sum(sales_amount) from gold_fact_sales f where f.customer_key = d.customer_key), 0)::bigint
    as total_revenue
from gold_dim_customer d""",
    "e12_quantity_by_country": """
select country, ifnull(sum(quantity), 0)::bigint as total_quantity_sold
from gold_fact_sales right join gold_dim_customer using (customer_key) group by 1""",
    "e13_top_products": """
with named as (
  select product_name, sum(sales_amount)::bigint as total_revenue
  from gold_fact_sales left join gold_dim_product using (product_key) group by 1)
select *, dense_rank() over (order by total_revenue desc nulls last)::int as product_rank
from named qualify product_rank <= 5""",
    "e14_worst_products": """
select product_key, product_name, ifnull(sum(sales_amount), 0)::bigint as total_revenue
from gold_dim_product left join gold_fact_sales using (product_key)
group by all order by total_revenue, product_key limit 5""",
    "e15_top_customers": """
with spent as (
  select f.customer_key, concat(first_name, ' ', last_name) as customer,
    sum(sales_amount)::bigint as total_spent
  from gold_fact_sales f left join gold_dim_customer d on d.customer_key = f.customer_key group by all)
select *, row_number() over (order by total_spent desc nulls last, customer_key nulls first)::int as spending_rank
from spent qualify spending_rank <= 10""",
    "e16_fewest_orders": """
select customer_key, first_name, last_name, count(distinct order_number) as orders
from gold_dim_customer left join gold_fact_sales using (customer_key)
group by all order by orders, customer_key limit 3""",
    # trends
    "v1_monthly_trend": """
select year(order_date)::int as order_year, month(order_date)::int as order_month,
  sum(sales_amount)::bigint as total_sales, count(distinct customer_key) as total_customers,
  sum(quantity)::bigint as total_quantity
from gold_fact_sales where order_date is not null group by 1, 2""",
    "v2_running_totals": """
with monthly as (
  select date_trunc('month', order_date)::date as order_month, sum(sales_amount)::bigint as total_sales,
    (sum(price) // count(price))::bigint as price
  from gold_fact_sales where order_date is not null group by 1)
select a.order_month, any_value(a.total_sales) as total_sales,
  sum(b.total_sales)::bigint as running_total_sales,
  (sum(b.price) // count(b.price))::bigint as moving_average_price
from monthly a join monthly b on year(a.order_month) = year(b.order_month) and b.order_month <= a.order_month
group by a.order_month""",
    "w8_running_line_totals": """
select *, year(order_date)::int as order_year, sum(sales_amount) over so_far::bigint as running_sales,
  (sum(price) over so_far // nullif(count(price) over so_far, 0))::bigint as running_average_price
from gold_fact_sales where order_date is not null
window so_far as (partition by year(order_date) order by order_date, order_number,
    product_key nulls first, customer_key nulls first, shipping_date nulls first, due_date nulls first,
    sales_amount nulls first, quantity nulls first, price nulls first
  rows between unbounded preceding and current row)""",
    "v3_year_over_year": """
with yearly as (
  select year(order_date)::int as order_year, product_name, sum(sales_amount)::bigint as current_year
  from gold_fact_sales left join gold_dim_product using (product_key)
  where order_date is not null group by 1, 2),
compared as (
  select *, lag(current_year, 1, 0) over (partition by product_name order by order_year) as previous_year,
    (sum(current_year) over (partition by product_name)
      // count(current_year) over (partition by product_name))::bigint as average_sales
  from yearly)
select order_year, product_name, current_year, previous_year,
  current_year - previous_year as yearly_change,
  case sign(current_year - previous_year) when 1 then 'Increase Sales' when -1 then 'Decrease Sales'
    else 'Static / NA' end as performance,
  average_sales, current_year - average_sales as diff_avg,
  case sign(current_year - average_sales) when 1 then 'Above Average' when -1 then 'Below Average'
    else 'Average' end as average_change
from compared""",
    "v4_category_shares": """
with parts as (
  select category, sum(sales_amount)::bigint as total_sales
  from gold_fact_sales left join gold_dim_product using (product_key) group by 1),
whole as (select sum(sales_amount)::bigint as overall_sales from gold_fact_sales),
hundredths as (
  select *, (total_sales::hugeint * 20000 + overall_sales) // (2 * overall_sales::hugeint) as h
  from parts, whole)
select category, total_sales, overall_sales,
  concat((h // 100)::varchar,
    case when h % 100 = 0 then '' when h % 10 = 0 then concat('.', (h % 100 // 10)::varchar)
      else concat('.', lpad((h % 100)::varchar, 2, '0')) end, '%') as part
from hundredths""",
    "v5_cost_tiers": """
select case when cost > 2000 or cost is null then 'Above 2000' when cost > 1000 then '1001-2000'
  else '1-1000' end as segment, count(*) as total_products
from gold_dim_product group by 1""",
    "v6_segments": f"""
with history as (
  select customer_key, date_diff('month', min(order_date), max(order_date)) as months,
    sum(sales_amount) as spent
  from gold_fact_sales where customer_key is not null group by 1)
select {_SEGMENT.format(sales="spent")} as segment, count(*) as total_customers
from history group by 1""",
    # further questions
    "k1_unsold": """
select product_number, product_name from gold_dim_product
where product_key not in (select product_key from gold_fact_sales where product_key is not null)""",
    "k2_demographics": """
select marital_status, gender, sum(sales_amount)::bigint as total_revenue,
  sum(quantity)::bigint as total_quantity,
  (sum(sales_amount) // count(distinct order_number))::bigint as average_order_value
from gold_fact_sales f left join gold_dim_customer d on d.customer_key = f.customer_key
group by 1, 2""",
    "k3_product_lines": """
select product_line, count(distinct d.product_key) as total_products,
  ifnull(sum(quantity), 0)::bigint as total_quantity,
  ifnull(sum(sales_amount), 0)::bigint as total_sales
from gold_dim_product d left join gold_fact_sales f on f.product_key = d.product_key group by 1""",
    "k4_top_spenders": """
select customer_id, concat(first_name, ' ', last_name) as customer, country,
  sum(sales_amount)::bigint as total_spent
from gold_fact_sales join gold_dim_customer using (customer_key)
group by all order by total_spent desc nulls last, customer_id, customer, country limit 10""",
    # audits
    "q1_bronze_rows": _counts("bronze", "total_rows_loaded"),
    "q2_silver_rows": _counts("silver", "total_rows_retained"),
    "q3_load_diagnostics": _check(
        ("profiling_target", "metrics", "issue_count"),
        ("crm_cust_info", "Missing Keys/Invalid Flags",
         _n("cst_id is null or cst_gndr not in ('Male', 'Female', 'N/A')"), "silver_crm_cust_info"),
        ("crm_prd_info", "Invalid Date Chronology", _n("prd_end_dt < prd_start_dt"),
         "silver_crm_prd_info"),
        ("crm_sales_details", "Broken Financial Calculations",
         _n("abs(sls_sales - sls_quantity * sls_price) > 0.05"), "silver_crm_sales_details"),
        ("erp_cust_az12", 'Unprocessed "NAS" Prefixes', _n("starts_with(cid, 'NAS')"),
         "silver_erp_cust_az12"),
        ("erp_loc_a101", "Escaped Key Hyphens", _n("contains(cid, '-')"), "silver_erp_loc_a101"),
    ),
    "q4_repeated_customer_ids": """
select cst_id, count(*) as duplicate_count from silver_crm_cust_info
group by 1 having duplicate_count > 1 or cst_id is null""",
    "q4_repeated_raw_customer_ids": """
select cst_id, count(*) as duplicate_count from bronze_crm_cust_info
group by 1 having duplicate_count > 1 or cst_id is null""",
    "q5_repeated_product_ids": """
select prd_id, count(*) as duplicate_count from silver_crm_prd_info
group by 1 having duplicate_count > 1 or prd_id is null""",
    "q5_untidy_names": """
select prd_id, prd_nm, length(rtrim(prd_nm, ' '))::int as current_length from silver_crm_prd_info
where prd_nm is null or prd_nm = '' or prd_nm <> trim(prd_nm, ' ')""",
    "q5_untidy_raw_names": """
select prd_id, prd_nm, length(rtrim(prd_nm, ' '))::int as current_length from bronze_crm_prd_info
where prd_nm is null or prd_nm = '' or prd_nm <> trim(prd_nm, ' ')""",
    "q5_reversed_dates": """
select prd_id, prd_key, prd_start_dt, prd_end_dt from silver_crm_prd_info
where prd_end_dt < prd_start_dt""",
    "q5_malformed_categories": """
select prd_id, cat_id, length(rtrim(cat_id, ' '))::int as cat_id_length from silver_crm_prd_info
where cat_id is null or length(rtrim(cat_id, ' ')) <> 5 or contains(cat_id, '-')""",
    "q5_costs_or_lines": """
select prd_id, prd_cost, prd_line from silver_crm_prd_info where prd_cost < 0 or prd_line = 'N/A'""",
    "q6_erp_customers": f"""
select count(*) as total_rows_checked, {_n("ifnull(cid, '') = ''")} as count_missing_customer_ids,
  {_n("starts_with(cid, 'NAS')")} as count_escaped_nas_prefixes,
  {_n(f"bdate > {AS_OF}")} as count_invalid_future_birthdates,
  {_n("gen not in ('Male', 'Female', 'N/A')")} as count_invalid_gender_formats
from silver_erp_cust_az12""",
    "q7_locations": f"""
select count(*) as total_rows_checked, {_n("ifnull(cid, '') = ''")} as count_missing_customer_ids,
  {_n("contains(cid, '-')")} as count_escaped_hyphens,
  {_n("cntry not in ('N/A', " + ", ".join(f"'{c}'" for c in dict.fromkeys(_COUNTRIES.values())) + ")")}
    as count_invalid_country_formats
from silver_erp_loc_a101""",
    "q8_categories": f"""
select count(*) as total_rows_checked, {_n("ifnull(id, '') = ''")} as count_missing_ids,
  {_n("ifnull(cat, '') = ''")} as count_missing_categories,
  {_n("ifnull(subcat, '') = ''")} as count_missing_subcategories
from silver_erp_px_cat_g1v2""",
    "q9_completeness": _check(
        _SILVER,
        ("silver.crm_cust_info", "Duplicate Customer IDs", "count(cst_id) - count(distinct cst_id)",
         "silver_crm_cust_info"),
        ("silver.crm_prd_info", "Duplicate Product Keys", "count(*) - count(distinct prd_key)",
         "silver_crm_prd_info"),
        ("silver.crm_cust_info", "Missing Customer Keys (NULL/Blank)", _n("ifnull(cst_key, '') = ''"),
         "silver_crm_cust_info"),
        ("silver.crm_prd_info", "Missing Product Names", _n("ifnull(prd_nm, '') = ''"),
         "silver_crm_prd_info"),
    ),
    "q10_domains": _check(
        _SILVER,
        ("silver.crm_cust_info", "Unstandardized Gender Codes",
         _n("cst_gndr not in ('Male', 'Female', 'N/A')"), "silver_crm_cust_info"),
        ("silver.crm_cust_info", "Unstandardized Marital Status",
         _n("cst_marital_status not in ('Single', 'Married', 'N/A')"), "silver_crm_cust_info"),
        ("silver.erp_cust_az12", "Extreme/Outlier Birthdates (< Year 1910)", _n("year(bdate) < 1910"),
         "silver_erp_cust_az12"),
        ("silver.erp_loc_a101", "Unmapped Country Formats", _n("cntry = 'N/A'"), "silver_erp_loc_a101"),
    ),
    "q11_rules": _check(
        _SILVER,
        ("silver.crm_prd_info", "Timeline Clashes (End Date before Start Date)",
         _n("prd_end_dt < prd_start_dt"), "silver_crm_prd_info"),
        ("silver.crm_sales_details", "Logistical Chronology Breaks (Shipped Before Ordered)",
         _n("sls_ship_dt < sls_order_dt"), "silver_crm_sales_details"),
        ("silver.crm_sales_details", "Negative Values In Financial Transactions",
         _n("least(sls_sales, sls_quantity, sls_price) < 0"), "silver_crm_sales_details"),
        ("silver.crm_sales_details", "Gross Financial Math Inconsistencies (Sales != Qty * Price)",
         _n("abs(sls_sales - sls_quantity * sls_price) > 0.05"), "silver_crm_sales_details"),
    ),
    "q12_orphans": _check(
        ("data_relationship", "audit_test", "exception_count"),
        ("silver.crm_sales_details -> silver.crm_cust_info",
         "Orphaned Transaction Sales pointing to Missing Customer IDs", "count(*)",
         "silver_crm_sales_details anti join silver_crm_cust_info on sls_cust_id = cst_id"),
        ("silver.crm_sales_details -> silver.crm_prd_info",
         "Orphaned Transaction Sales pointing to Missing Product Keys", "count(*)",
         "silver_crm_sales_details anti join silver_crm_prd_info on sls_prd_key = prd_key"),
        ("silver.erp_loc_a101 -> silver.crm_cust_info",
         "ERP Customer Locations Missing completely from Master CRM Customer Records", "count(*)",
         "silver_erp_loc_a101 anti join silver_crm_cust_info on cid = cst_key"),
    ),
    "q13_gold_keys": _check(
        _GOLD,
        ("gold.dim_customer", "Duplicate Customer Surrogate Keys",
         "count(customer_key) - count(distinct customer_key)", "gold_dim_customer"),
        ("gold.dim_product", "Duplicate Product Surrogate Keys",
         "count(product_key) - count(distinct product_key)", "gold_dim_product"),
        ("gold.dim_customer", "NULL Surrogate Keys Detected", _n("customer_key is null"),
         "gold_dim_customer"),
        ("gold.dim_product", "NULL Surrogate Keys Detected", _n("product_key is null"),
         "gold_dim_product"),
    ),
    "q14_gold_domains": _check(
        _GOLD,
        ("gold.dim_customer", "Gender Non-conformed Leakage (Expected: Male/Female/N/A)",
         _n("gender not in ('Male', 'Female', 'N/A')"), "gold_dim_customer"),
        ("gold.dim_customer", "Marital Status Non-conformed Leakage (Expected: Single/Married/N/A)",
         _n("marital_status not in ('Single', 'Married', 'N/A')"), "gold_dim_customer"),
        ("gold.dim_product", "Negative Base Product Cost Anomalies", _n("cost < 0"),
         "gold_dim_product"),
        ("gold.dim_product", "Missing Category or Subcategory Context Mapping",
         _n("category is null or subcategory is null"), "gold_dim_product"),
    ),
    "q15_gold_facts": _check(
        _GOLD,
        ("gold.fact_sales", "Logistical Sequence Errors (Shipping Date Before Order Date)",
         _n("shipping_date < order_date"), "gold_fact_sales"),
        ("gold.fact_sales", "Negative Sales Revenue or Quantity Flags",
         _n("least(sales_amount, quantity) < 0"), "gold_fact_sales"),
        ("gold.fact_sales", "Revenue Discrepancy Faults (Sales Amount != Qty * Price)",
         _n("abs(sales_amount - quantity * price) > 0.05"), "gold_fact_sales"),
    ),
    "q16_gold_references": _check(
        ("star_relationship", "quality_check", "exception_count"),
        ("gold.fact_sales -> gold.dim_customer",
         "Unmapped Customer Records (NULL customer_key in Fact)", _n("customer_key is null"),
         "gold_fact_sales"),
        ("gold.fact_sales -> gold.dim_product",
         "Unmapped Product Records (NULL product_key in Fact)", _n("product_key is null"),
         "gold_fact_sales"),
    ),
    "q_fan_out": _check(
        _GOLD,
        ("gold.fact_sales", "Rows above the cleaned sales lines",
         "count(*) - (select count(*) from silver_crm_sales_details)", "gold_fact_sales"),
        ("gold.dim_customer", "Repeated customer ids",
         "count(customer_id) - count(distinct customer_id)", "gold_dim_customer"),
        ("gold.dim_product", "Repeated product numbers",
         "count(product_number) - count(distinct product_number)", "gold_dim_product"),
    ),
}


def oracle_sql() -> dict[str, str]:
    from checks.operator_oracle import OPERATOR_ORACLE

    return {name: with_blocks(sql.strip()) for name, sql in (ORACLE | OPERATOR_ORACLE).items()}


def with_blocks(sql: str, replaced: dict[str, str] | None = None) -> str:
    """Put the blocks that `sql` needs in front of it, each after those it needs itself."""
    known = _BLOCKS | (replaced or {})
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in re.findall(r"\w+", text):
            if name in known and name not in pending:
                pending.add(name)
                need(known[name])
                ordered.append(name)

    pending: set[str] = set()
    need(sql)
    blocks = [f"{name} as ({known[name].strip()})" for name in ordered]
    if not blocks:
        return sql
    if sql.lower().startswith("with "):
        return "with " + ",\n".join(blocks) + ",\n" + sql[5:]
    return "with " + ",\n".join(blocks) + "\n" + sql
