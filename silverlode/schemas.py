"""Declared schemas of every stored table, and how each extract file is read.

Column names and types of the three layers are fixed values: results must have them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _schema(columns: str) -> T.StructType:
    """Schema from 'name type, name type'; unlike Spark's own parser it needs no session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


BRONZE = {
    "crm_cust_info": _schema(
        "cst_id int, cst_key string, cst_firstname string, cst_lastname string, "
        "cst_marital_status string, cst_gndr string, cst_create_date date"
    ),
    "crm_prd_info": _schema(
        "prd_id int, prd_key string, prd_nm string, prd_cost int, prd_line string, "
        "prd_start_dt date, prd_end_dt date"
    ),
    "crm_sales_details": _schema(
        "sls_ord_num string, sls_prd_key string, sls_cust_id int, sls_order_dt int, "
        "sls_ship_dt int, sls_due_dt int, sls_sales int, sls_quantity int, sls_price int"
    ),
    "erp_cust_az12": _schema("cid string, bdate date, gen string"),
    "erp_loc_a101": _schema("cid string, cntry string"),
    "erp_px_cat_g1v2": _schema("id string, cat string, subcat string, maintenance string"),
}

# Every cleaned table also carries the moment it was written.
LOAD_TIME = "dwh_create_date"

CLEAN = {
    "crm_cust_info": BRONZE["crm_cust_info"],
    "crm_prd_info": _schema(
        "prd_id int, cat_id string, prd_key string, prd_nm string, prd_cost int, "
        "prd_line string, prd_start_dt date, prd_end_dt date"
    ),
    "crm_sales_details": _schema(
        "sls_ord_num string, sls_prd_key string, sls_cust_id int, sls_order_dt date, "
        "sls_ship_dt date, sls_due_dt date, sls_sales int, sls_quantity int, sls_price int"
    ),
    "erp_cust_az12": BRONZE["erp_cust_az12"],
    "erp_loc_a101": BRONZE["erp_loc_a101"],
    "erp_px_cat_g1v2": BRONZE["erp_px_cat_g1v2"],
}

SILVER = {
    table: T.StructType([*schema.fields, T.StructField(LOAD_TIME, T.TimestampType())])
    for table, schema in CLEAN.items()
}

GOLD = {
    "dim_customer": _schema(
        "customer_key bigint, customer_id int, customer_number string, first_name string, "
        "last_name string, country string, marital_status string, gender string, "
        "birthdate date, create_date date"
    ),
    "dim_product": _schema(
        "product_key bigint, product_id int, product_number string, category_id string, "
        "product_name string, category string, subcategory string, product_line string, "
        "maintenance string, cost int, start_date date"
    ),
    "fact_sales": _schema(
        "order_number string, product_key bigint, customer_key bigint, order_date date, "
        "shipping_date date, due_date date, sales_amount int, quantity int, price int"
    ),
}

RUN_LOG = _schema(
    "layer string, table_name string, rows_loaded bigint, rows_rejected bigint, "
    "seconds double, status string, finished_at timestamp, message string"
)

REJECTS = _schema("load_id string, table_name string, file string, line string")


@dataclass(frozen=True)
class Extract:
    """One delimited extract: its table, its file under the extract folder, and its quoting."""

    table: str
    file: str
    quoted: bool = True


# File names and the one extract that is delivered without quoting.
EXTRACTS = (
    Extract("crm_cust_info", "source_crm/cust_info.csv"),
    Extract("crm_prd_info", "source_crm/prd_info.csv"),
    Extract("crm_sales_details", "source_crm/sales_details.csv"),
    Extract("erp_cust_az12", "source_erp/CUST_AZ12.csv", quoted=False),
    Extract("erp_loc_a101", "source_erp/LOC_A101.csv"),
    Extract("erp_px_cat_g1v2", "source_erp/PX_CAT_G1V2.csv"),
)
