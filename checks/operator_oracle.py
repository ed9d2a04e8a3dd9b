"""Expected answers of the operator queries, as DuckDB SQL."""

from __future__ import annotations

from checks.oracle import AS_OF, ORACLE

_TABLES = [
    "crm_cust_info", "crm_prd_info", "crm_sales_details", "erp_cust_az12", "erp_loc_a101",
    "erp_px_cat_g1v2",
]


def _log(layer: str) -> str:
    tables = "\nunion all ".join(
        f"select '{table}' as table_name, count(*) as n from {layer}_{table}" for table in _TABLES
    )
    return f"""
with t as ({tables})
select '{layer}' as layer, table_name, n as rows_loaded, 0::bigint as rows_rejected, 'ok' as status from t
union all select '{layer}', '(all)', sum(n)::bigint, null, 'ok' from t"""


_JOIN_ORDERS = "(select o_orderkey, o_custkey from orders where o_orderstatus = 'O') o on l_orderkey = o_orderkey"

_MISSPELT = """case n % 3 when 0 then lower(cid) when 1 then cid || '  ' else cid end"""
_COLLATED_KEYS = f"""
select cst_id, cst_key, details.cid, bdate from silver_crm_cust_info
left join (select {_MISSPELT} as cid, bdate from (
  select *, regexp_extract(cid, '[0-9]+')::bigint as n from silver_erp_cust_az12)) details
on lower(rtrim(cst_key, ' ')) = lower(rtrim(details.cid, ' '))"""

_FACT_WITH_BUYERS = """
select order_number, product_key, f.customer_key, sales_amount, quantity,
  c.customer_key as buyer_key, customer_number, country
from gold_fact_sales f left join gold_dim_customer c on c.customer_key = f.customer_key"""

_STRAYS = """(select l_orderkey, l_partkey, l_quantity from lineitem union all
  select l_orderkey + 900000000000, l_partkey, l_quantity from lineitem) lines"""
_REDUCED_ANTI = f"select * from {_STRAYS} anti join orders on l_orderkey = o_orderkey"


def _distinct_by(level: int, year: str, month: str, by: str) -> str:
    return f"""
select {level} as level, {year}::int as year, {month}::int as month,
  count(distinct customer_key) as customers, count(distinct product_key) as products
from gold_fact_sales {by}"""


def _sales_facts(column: str, kind: str) -> str:
    return f"""
select '{column}' as column_name, '{kind}' as data_type, count(*) as row_count,
  count(*) - count({column}) as null_count, min({column})::varchar as min_value,
  max({column})::varchar as max_value, max(length({column}::varchar))::bigint as max_length,
  true as distinct_near, true as ranks_and_counts_near
from gold_fact_sales"""


OPERATOR_ORACLE: dict[str, str] = {
    "e1_profile_merged": "\nunion all ".join(_sales_facts(column, kind) for column, kind in {
        "order_number": "string", "product_key": "bigint", "customer_key": "bigint",
        "order_date": "date", "shipping_date": "date", "due_date": "date",
        "sales_amount": "int", "quantity": "int", "price": "int",
    }.items()),
    "j7_reduced_semi": f"select * from {_STRAYS} semi join orders on l_orderkey = o_orderkey",
    "j8_reduced_anti": _REDUCED_ANTI,
    "j8_reduced_anti_hot": _REDUCED_ANTI,
    "a6_rolled_up_distinct": "union all".join((
        _distinct_by(2, "year(order_date)", "month(order_date)", "group by all "),
        _distinct_by(1, "year(order_date)", "null", "group by all "), _distinct_by(0, "null", "null", ""),
    )),
    "s1_quoted_extract": "select * from bronze_crm_cust_info",
    "s1_quoted_locations": "select * from bronze_erp_loc_a101",
    "s2_plain_extract": "select cid, bdate, nullif(gen, '') as gen from bronze_erp_cust_az12",
    "s3_full_reload": "select * from bronze_erp_loc_a101 where cntry <> ''",
    "s4_load_time": "\nunion all ".join(
        f"select '{table}' as table_name, count(*) as row_count, count(*) as stamped from silver_{table}"
        for table in _TABLES
    ),
    "s5_table_scan": "select * from bronze_crm_sales_details",
    "s6_sql_on_views": """
select country, category,
  case when a.customer_key is null then null when months >= 12 and sales >= 5000 then 'VIP'
    when months >= 12 then 'Regular' else 'New' end as customer_category,
  sum(quantity)::bigint as items
from gold_fact_sales f
  left join gold_dim_customer c on f.customer_key = c.customer_key
  left join gold_dim_product p on f.product_key = p.product_key
  left join customer_activity a on f.customer_key = a.customer_key
group by all""",
    "t7_load_bronze": _log("bronze"),
    "t8_load_silver": _log("silver"),
    "t8_load_diagnostics": ORACLE["q3_load_diagnostics"],
    "t9_reload_products": ORACLE["q5_costs_or_lines"],
    "s1_line_breaks": """
select cst_id, concat('A', chr(10), cst_key) as cst_key,
  cst_firstname || chr(10) || '"quoted", and more' || chr(10) as cst_firstname, cst_lastname,
  cst_marital_status, cst_gndr || chr(10) as cst_gndr, cst_create_date
from bronze_crm_cust_info""",
    "s1_open_quotes": """
select 'row' as kind, cst_key || '/b, c' as text from bronze_crm_cust_info
where cst_key[3:]::bigint % 7 <> 0
union all
select 'reject', concat(case when c % 21 = 0 then '"' else '' end, cst_id, ',"', cst_key, '",a,',
  case when c % 21 = 7 then '"b, c' else '"b, c"' end, ',S,F,',
  case when c % 21 = 14 then '"' else '' end, '2025-01-02')
from (select *, cst_key[3:]::bigint as c from bronze_crm_cust_info), range(2) where c % 7 = 0""",
    "s1_lenient_fields": """
select case when c % 7 <> 0 then c::int end as cst_id, cst_key, 'a, b' as cst_firstname,
  'c' as cst_lastname, 'S' as cst_marital_status, 'F' as cst_gndr,
  date '2025-01-02' as cst_create_date
from (select *, cst_key[3:]::bigint as c from bronze_crm_cust_info where cst_firstname <> 'STALE')
where c % 5 <> 0""",
    "s10_rejected_lines": """
select 'crm_cust_info' as table_name,
  concat('x', c, ',', cst_key, ',"a, b",c,S,F,',
    case when c % 3 = 0 then '2025-01-02 00:00:00' when c % 10 = 5 then '2025-13-01'
      else '2025-01-02' end) as line
from (select *, cst_key[3:]::bigint as c from bronze_crm_cust_info where cst_firstname <> 'STALE')
where c % 5 = 0""",
    "s11_refused_load_keeps_table": "select * from bronze_crm_cust_info",
    "s12_views_after_reload": "select * from bronze_erp_loc_a101",
    "j1_collated_keys": _COLLATED_KEYS,
    "j1_collated_keys_hot": _COLLATED_KEYS,
    "f5_collated_patterns": f"""
select cid, rtrim(cid, ' ') ilike 'NAS%' as prefixed, rtrim(cid, ' ') ilike '%_w0%7' as ends,
  cid like 'NAS%' as exactly, rtrim(lower(cid[:5]), ' ') = 'nasaw' as equal,
  case when lower(cid[:3]) = 'nas' then substr(cid, 4, length(rtrim(cid, ' '))) else cid end as stripped
from (select {_MISSPELT} as cid from (
  select cid, regexp_extract(cid, '[0-9]+')::bigint as n from bronze_erp_cust_az12))""",
    "f_predicates": """
select sls_ord_num, sls_prd_key, sls_quantity,
  sls_cust_id = -1 as equal, sls_sales is null as missing, sls_sales > sls_price as greater,
  sls_ship_dt <> sls_order_dt as different, sls_quantity between 1 and 3 as listed,
  sls_sales not in (-5, 1) as not_listed, starts_with(sls_prd_key, 'P0000') as pattern,
  sls_sales <= 0 or sls_price <= 0 as either, sls_sales > 100 and sls_price > 100 as both
from bronze_crm_sales_details""",
    "x_text": """
select cst_key, trim(cst_firstname, ' ') as trimmed, upper(cst_firstname) as upper,
  translate(cst_key, '0', '_') as replaced, cst_key[3:6] as middle,
  length(rtrim(cst_lastname, ' '))::int as length,
  concat(cst_firstname, ' ', cst_lastname) as full_name,
  regexp_replace(cst_key, '^AW0', '') as stripped,
  ifnull(cst_lastname, cst_firstname) as either_name,
  case upper(trim(cst_gndr)) when 'M' then 'Male' when 'F' then 'Female' else 'N/A' end as gender,
  case upper(trim(cst_gndr)) when 'M' then 'Male' when 'F' then 'Female' else 'Other' end as preferred
from bronze_crm_cust_info""",
    "x_keys": """
select prd_id, concat(prd_key[1:2], '_', prd_key[4:5]) as category, prd_key[7:] as product,
  translate(prd_key, '-', '') as joined,
  case when prd_cost <= 1000 then '1-1000' when prd_cost between 1001 and 2000 then '1001-2000'
    else 'Above 2000' end as tier
from bronze_crm_prd_info""",
    "x_numbers": """
with b as (select c_custkey, c_nationkey, trunc(c_acctbal)::int as balance from customer)
select c_custkey, balance, greatest(balance, -balance) as absolute,
  (balance // nullif(c_nationkey, 0))::bigint as per_nation,
  case when c_nationkey <> 0 then c_nationkey end as not_zero,
  balance + balance - c_nationkey + 1 as arithmetic,
  round(balance::double / 8, 2) as eighth
from b""",
    "x19_int_dates": """
select sls_ord_num, sls_prd_key,
  case when o <= date '2030-12-31' then o end as sls_order_dt_date,
  case when s <= date '2030-12-31' then s end as sls_ship_dt_date,
  case when d <= date '2030-12-31' then d end as sls_due_dt_date
from sales_dates""",
    "x22_dates": f"""
select o_orderkey, year(o_orderdate)::int as order_year, month(o_orderdate)::int as order_month,
  date_trunc('month', o_orderdate)::date as month_begin,
  date_diff('month', o_orderdate::date, {AS_OF})::int as months_to_date,
  date_diff('year', o_orderdate::date, {AS_OF})::int as years_to_date,
  o_orderdate::date - 1 as day_before,
  case when year(o_orderdate) < 2000 then o_orderdate::date end as last_century
from orders""",
    "x26_share_labels": """
with pieces as (select l_partkey, sum(l_quantity::bigint)::bigint as pieces from lineitem group by 1),
whole as (select (sum(pieces) // 100)::hugeint as total from pieces),
h as (select l_partkey, pieces, (pieces::hugeint * 20000 + total) // (2 * total) as h from pieces, whole)
select l_partkey, pieces,
  concat((h // 100)::varchar,
    case when h % 100 = 0 then '' when h % 10 = 0 then concat('.', (h % 100 // 10)::varchar)
      else concat('.', lpad((h % 100)::varchar, 2, '0')) end, '%') as share
from h""",
    "w1_latest_orders": """
select o_custkey, max(o_orderdate) as o_orderdate,
  max(o_orderkey) as o_orderkey, arg_max(o_orderstatus, o_orderkey) as o_orderstatus
from orders semi join (select o_custkey as c, max(o_orderdate) as d from orders group by 1) m
  on c = o_custkey and d = o_orderdate
group by o_custkey""",
    "w2_dense_key": """
select o_orderkey, o_custkey, o_orderdate,
  row_number() over (order by o_custkey, o_orderdate, o_orderkey) as order_number
from orders""",
    "w4_ranked_quantities": """
with top as (select distinct l_quantity from lineitem order by 1 desc limit 3)
select l_orderkey, l_partkey, l_linenumber, l.l_quantity,
  (1 + (select count(*) from top where top.l_quantity > l.l_quantity))::int as quantity_rank
from lineitem l semi join top on top.l_quantity = l.l_quantity""",
    "w5_next_orders_hot": """
select o_orderkey, o_custkey, o_orderdate,
  lead(o_orderkey) over (partition by o_custkey order by o_orderdate, o_orderkey) as next_orderkey
from orders""",
    "w7_group_maxima_hot": """
select l.l_orderkey, l_partkey, m.q as l_quantity, m.s as l_shipdate
from lineitem l join (select l_orderkey, max(l_quantity) as q, max(l_shipdate) as s from lineitem group by 1) m
  on m.l_orderkey = l.l_orderkey""",
    "a_averages": """
with b as (select c_nationkey, c_mktsegment, trunc(c_acctbal)::int as balance from customer)
select c_nationkey, (sum(balance) // count(balance))::bigint as average_balance,
  ifnull(sum(balance) filter (where balance < -100000), 0)::bigint as far_below,
  count(*) filter (where balance < 0) as overdrawn,
  count(c_mktsegment) - count(distinct c_mktsegment) as repeated_segments
from b group by 1""",
    "u1_long_measures": """
select 'lines' as subject, 'count' as measure, count(*) as value from lineitem
union all select 'lines', 'parts', count(distinct l_partkey) from lineitem
union all select 'lines', 'orders', count(distinct l_orderkey) from lineitem
union all select 'quantity', 'sum', sum(l_quantity::bigint)::bigint from lineitem
union all select 'quantity', 'above 40', count(*) filter (where l_quantity > 40) from lineitem""",
    "s3_replaced_months": """
select * replace (case when month(order_date) % 2 = 0 then quantity * 2 else quantity end as quantity),
  date_trunc('month', order_date)::date as month_begin
from gold_fact_sales""",
    "e3_order_span_footers": ORACLE["e3_order_span"],
    "j2_bucketed_fact": _FACT_WITH_BUYERS,
    "j2_bucketed_fact_hot": _FACT_WITH_BUYERS,
    "j4_left_join_hot": f"""
select l_orderkey, l_partkey, l_quantity, o_orderkey, o_custkey from lineitem left join {_JOIN_ORDERS}""",
    "j6_inner_join_hot": """
select l_orderkey, l_partkey, l_quantity, o_orderkey, o_custkey
from lineitem join orders on l_orderkey = o_orderkey""",
    "j7_semi_join_hot": f"""
select l_orderkey, l_partkey, l_quantity from lineitem semi join {_JOIN_ORDERS}""",
    "t2_clean_products_hot": ORACLE["t2_clean_products"],
    "t3_clean_sales_hot": ORACLE["t3_clean_sales"],
    "t5_clean_locations_hot": ORACLE["t5_clean_locations"],
    "g1_collated_dim_customer": ORACLE["g1_dim_customer"],
    "g1_dim_customer_hot": ORACLE["g1_dim_customer"],
    "g3_fact_sales_hot": ORACLE["g3_fact_sales"],
    "k2_demographics_hot": ORACLE["k2_demographics"],
}
