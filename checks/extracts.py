"""Dirty extracts derived from the given tables, as SQL that Spark and DuckDB both run.

`{name}` stands for a given table. The rows contain what the cleaning rules repair: missing and
repeated ids, padded and mixed-case codes, missing costs, dates as years, as six digits and
impossible ones, wrong end dates, contradictory money, prefixed and hyphenated ids, future
birthdates, locations without a customer. Every given row of a table is delivered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CUST_INFO = """
select cast(case when c_custkey % 97 = 0 then null else c_custkey end as int) cst_id,
 concat('AW', {customer_digits}) cst_key,
 case when c_custkey % 5 = 0 then concat('  ', c_mktsegment) else c_mktsegment end cst_firstname,
 case when c_custkey % 7 = 0 then concat(c_name, ' ') when c_custkey % 83 = 0 then null else c_name end cst_lastname,
 case c_custkey % 4 when 0 then 'S' when 1 then ' m ' when 2 then null else 'X' end cst_marital_status,
 case c_custkey % 5 when 0 then 'M' when 1 then 'f ' when 2 then null when 3 then 'F' else 'm' end cst_gndr,
 date'2025-10-01' + cast(c_custkey % 120 as int) cst_create_date
from {customers}
union all
select cast(c_custkey as int), concat('AW', {customer_digits}), 'STALE', c_name, null, null,
 date'2024-01-01' + cast(c_custkey % 120 as int) from {customer} where c_custkey % 10 = 0 and c_custkey % 97 <> 0
"""

# One to three versions per part; {versions} makes the rows (p_*, v) with v = 0 .. p_partkey % 3.
PRD_INFO = """
select cast(p_partkey * 3 + v as int) prd_id,
 concat(case p_type when 'ECONOMY' then 'EC-ON' when 'MEDIUM' then 'ME-DI' when 'SMALL' then 'SM-AL' when 'LARGE' then 'LA-RG' when 'STANDARD' then 'ST-AN' else 'PR-OM' end, '-', {part_number}) prd_key,
 concat(' ', p_name) prd_nm,
 case when p_partkey % 50 = 0 then null else cast(floor(p_retailprice) as int) + v end prd_cost,
 case p_size % 5 when 0 then 'M ' when 1 then 'r' when 2 then 'S' when 3 then ' T' else null end prd_line,
 date'1994-07-01' + cast(v * 365 as int) prd_start_dt,
 case v when 0 then date'1994-06-01' when 1 then date'2007-12-28' end prd_end_dt
from {versions}
"""
# Products that were never sold and customers who never bought, beside the given ones.
MEMBERS = {
    "{parts}": "(select p_partkey, p_name, p_type, p_size, p_retailprice from {part} union all "
    "select p_partkey + 90000000, p_name, p_type, p_size, p_retailprice from {part} "
    "where p_partkey % 40 = 0) members",
    "{customers}": "(select c_custkey, c_name, c_mktsegment from {customer} union all "
    "select c_custkey + 70000000, c_name, c_mktsegment from {customer} "
    "where c_custkey % 50 = 0) members",
}
SPARK_VERSIONS = (
    "(select *, explode(sequence(0, cast(p_partkey % 3 as int))) v from {parts}) versions"
)
DUCKDB_VERSIONS = (
    "(select *, unnest(range(0, cast(p_partkey % 3 as int) + 1))::int v from {parts}) versions"
)

SALES_DETAILS = """
select concat('SO', cast(l_orderkey as string)) sls_ord_num, {line_part_number} sls_prd_key,
 cast(case when l_orderkey % 331 = 0 then -1 else o_custkey end as int) sls_cust_id,
 case when l_linenumber = 1 and l_orderkey % 7 = 0 then 0 when l_linenumber = 2 and l_orderkey % 11 = 0 then 32154 when l_linenumber = 3 and l_orderkey % 13 = 0 then 5489
  when l_linenumber = 4 and l_orderkey % 37 = 0 then year(o_orderdate) when l_linenumber = 4 and l_orderkey % 41 = 0 then cast(year(o_orderdate) % 100 * 10000 + month(o_orderdate) * 100 + day(o_orderdate) as int)
  when l_linenumber = 5 and l_orderkey % 43 = 0 then 101229 when l_linenumber = 5 and l_orderkey % 47 = 0 then 991341
  else cast(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) as int) end sls_order_dt,
 cast(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) as int) sls_ship_dt,
 cast(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + 28 as int) sls_due_dt,
 case when l_orderkey % 17 = 0 then null when l_orderkey % 19 = 0 then -5 when l_orderkey % 23 = 0 then 1 else q * p end sls_sales,
 q sls_quantity,
 case when l_orderkey % 29 = 0 then null when l_orderkey % 31 = 0 then -1 * p else p end sls_price
from (select *, cast(case when o_custkey % 13 = 0 then 1 else l_quantity end as int) q,
  cast(floor(l_extendedprice / l_quantity / (case when o_custkey % 13 = 0 then 20 when l_partkey % 9 = 0 then 4 when l_partkey % 9 = 1 then 2 else 1 end)) as int) p
 from {lineitem} join {orders} on l_orderkey = o_orderkey) t
"""

CUST_AZ12 = """
select concat(case when c_custkey % 2 = 0 then 'NAS' else '' end, 'AW', {customer_digits}) cid,
 case when c_custkey % 89 = 0 then date'2050-01-01' else date'1905-01-01' + cast((c_custkey * 37) % 40000 as int) end bdate,
 case c_custkey % 6 when 0 then 'Male' when 1 then 'F' when 2 then ' female' when 3 then 'M ' when 4 then '' else null end gen
from {customer}
"""

LOC_A101 = """
select concat('AW-', {location_digits}) cid,
 case c_nationkey % 9 when 0 then 'DE' when 1 then 'Germany' when 2 then 'USA' when 3 then ' us' when 4 then 'United Kingdom' when 5 then 'Australia ' when 6 then 'CAN' when 7 then 'fr' else '' end cntry
from {customer}
"""

# The categories of the parts at hand; promotional parts have none.
PX_CAT = """
select distinct
 case p_type when 'ECONOMY' then 'EC_ON' when 'MEDIUM' then 'ME_DI' when 'SMALL' then 'SM_AL' when 'LARGE' then 'LA_RG' else 'ST_AN' end id,
 case p_type when 'ECONOMY' then 'Accessories' when 'MEDIUM' then 'Bikes' when 'SMALL' then 'Clothing' else 'Components' end cat,
 case p_type when 'ECONOMY' then 'Economy' when 'MEDIUM' then 'Medium' when 'SMALL' then 'Small' when 'LARGE' then 'Large' else 'Standard' end subcat,
 case when p_type in ('ECONOMY', 'MEDIUM', 'LARGE') then 'Yes' else 'No' end maintenance
from {part} where p_type in ('ECONOMY', 'MEDIUM', 'SMALL', 'LARGE', 'STANDARD')
"""

EXTRACT_SQL = {
    "crm_cust_info": CUST_INFO,
    "crm_prd_info": PRD_INFO,
    "crm_sales_details": SALES_DETAILS,
    "erp_cust_az12": CUST_AZ12,
    "erp_loc_a101": LOC_A101,
    "erp_px_cat_g1v2": PX_CAT,
}
_GIVEN = ("customer", "part", "lineitem", "orders")


def _digits(number: str, width: int) -> str:
    """Zero-padded number; longer numbers keep all digits (lpad alone would cut them)."""
    text = f"cast({number} as string)"
    return f"lpad({text}, greatest({width}, cast(length({text}) as int)), '0')"


def _number(part: str) -> str:
    return f"concat('P', case when {part} % 4 = 0 then '-' else '' end, {_digits(part, 7)})"


_DIGITS = {
    "customer_digits": _digits("c_custkey", 8),
    # Some locations belong to no customer.
    "location_digits": _digits(
        "case when c_custkey % 61 = 0 then c_custkey + 90000000 else c_custkey end", 8
    ),
    # Some product numbers hold a hyphen of their own.
    "part_number": _number("p_partkey"),
    "line_part_number": _number("l_partkey"),
}


def _text(table: str, versions: str) -> str:
    text = EXTRACT_SQL[table].replace("{versions}", versions)
    for name, members in MEMBERS.items():
        text = text.replace(name, members)
    for name, expression in _DIGITS.items():
        text = text.replace(f"{{{name}}}", expression)
    return text.strip()


def spark_extracts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    given = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in _GIVEN}
    extracts = {}
    for table in EXTRACT_SQL:
        text = _text(table, SPARK_VERSIONS)
        used = {name: df for name, df in given.items() if f"{{{name}}}" in text}
        extracts[table] = spark.sql(text, **used)
    return extracts


def duckdb_extract(table: str) -> str:
    return _text(table, DUCKDB_VERSIONS).format(**{name: name for name in _GIVEN})
