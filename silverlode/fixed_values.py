"""Codes, labels, bands and bounds that results must match. No logic here."""

import datetime as dt

NOT_AVAILABLE = "N/A"

# Source code -> label
MARITAL_STATUS = {"S": "Single", "M": "Married"}
CRM_GENDER = {"M": "Male", "F": "Female"}
ERP_GENDER = {"M": "Male", "MALE": "Male", "F": "Female", "FEMALE": "Female"}
PRODUCT_LINE = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}
COUNTRY = {
    "DE": "Germany",
    "GERMANY": "Germany",
    "USA": "United States",
    "US": "United States",
    "UNITED STATES": "United States",
    "UK": "United Kingdom",
    "UNITED KINGDOM": "United Kingdom",
    "AU": "Australia",
    "AUSTRALIA": "Australia",
    "CAN": "Canada",
    "CANADA": "Canada",
    "FR": "France",
    "FRANCE": "France",
}

# Accepted labels after cleaning
GENDERS = ["Male", "Female", "N/A"]
MARITAL_STATUSES = ["Single", "Married", "N/A"]
COUNTRIES = [
    "Germany", "United States", "United Kingdom", "Australia", "Canada", "France", "N/A",
]

# Bounds
LATEST_SALES_DATE = dt.date(2030, 12, 31)
EARLIEST_BIRTHDATE = dt.date(1910, 1, 1)
MATH_TOLERANCE = 0.05
ERP_ID_PREFIX = "NAS"
CATEGORY_ID_LENGTH = 5
PRODUCT_TAIL_START = 7

# Bands: (highest value in the band, label), then the label above the last one
AGE_BANDS = [(19, "Under 20"), (29, "20-29"), (39, "30-39"), (49, "40-49"), (59, "50-59"), (65, "60-65")]
AGE_ABOVE = "Above 65"
PRODUCT_SALES_BANDS = [(500000, "Low-Performer"), (900000, "Mid-Performer")]
PRODUCT_SALES_ABOVE = "High-Performer"
COST_BANDS = [(1000, "1-1000"), (2000, "1001-2000")]
COST_ABOVE = "Above 2000"
LOYAL_MONTHS = 12
VIP_SALES = 5000
VIP, REGULAR, NEW = "VIP", "Regular", "New"

# Year-over-year labels
SALES_UP, SALES_DOWN, SALES_SAME = "Increase Sales", "Decrease Sales", "Static / NA"
ABOVE_AVERAGE, BELOW_AVERAGE, AT_AVERAGE = "Above Average", "Below Average", "Average"

# Measure names of the KPI sheet
KPI_SALES = "Total Sales"
KPI_QUANTITY = "Total Quantity"
KPI_PRICE = "Average Price"
KPI_ORDERS = "Total Orders"
KPI_PRODUCTS = "Total Products"
KPI_CUSTOMERS = "Total Customers Ordered"

# Names of the checks made right after the silver load
LOAD_KEYS = "Missing Keys/Invalid Flags"
LOAD_DATES = "Invalid Date Chronology"
LOAD_MATH = "Broken Financial Calculations"
LOAD_PREFIX = 'Unprocessed "NAS" Prefixes'
LOAD_HYPHENS = "Escaped Key Hyphens"

# Names of the silver audit checks
DUPLICATE_CUSTOMERS = "Duplicate Customer IDs"
DUPLICATE_PRODUCTS = "Duplicate Product Keys"
MISSING_CUSTOMER_KEYS = "Missing Customer Keys (NULL/Blank)"
MISSING_PRODUCT_NAMES = "Missing Product Names"
BAD_GENDER = "Unstandardized Gender Codes"
BAD_MARITAL = "Unstandardized Marital Status"
OLD_BIRTHDATES = "Extreme/Outlier Birthdates (< Year 1910)"
UNMAPPED_COUNTRIES = "Unmapped Country Formats"
END_BEFORE_START = "Timeline Clashes (End Date before Start Date)"
SHIPPED_EARLY = "Logistical Chronology Breaks (Shipped Before Ordered)"
NEGATIVE_SALES = "Negative Values In Financial Transactions"
SALES_MATH = "Gross Financial Math Inconsistencies (Sales != Qty * Price)"
ORPHAN_CUSTOMERS = "Orphaned Transaction Sales pointing to Missing Customer IDs"
ORPHAN_PRODUCTS = "Orphaned Transaction Sales pointing to Missing Product Keys"
ORPHAN_LOCATIONS = "ERP Customer Locations Missing completely from Master CRM Customer Records"

# Names of the gold audit checks
DUPLICATE_CUSTOMER_KEYS = "Duplicate Customer Surrogate Keys"
DUPLICATE_PRODUCT_KEYS = "Duplicate Product Surrogate Keys"
NULL_SURROGATES = "NULL Surrogate Keys Detected"
GOLD_GENDER = "Gender Non-conformed Leakage (Expected: Male/Female/N/A)"
GOLD_MARITAL = "Marital Status Non-conformed Leakage (Expected: Single/Married/N/A)"
GOLD_COST = "Negative Base Product Cost Anomalies"
GOLD_CATEGORY = "Missing Category or Subcategory Context Mapping"
GOLD_SHIPPED_EARLY = "Logistical Sequence Errors (Shipping Date Before Order Date)"
GOLD_NEGATIVE = "Negative Sales Revenue or Quantity Flags"
GOLD_MATH = "Revenue Discrepancy Faults (Sales Amount != Qty * Price)"
GOLD_NULL_CUSTOMER = "Unmapped Customer Records (NULL customer_key in Fact)"
GOLD_NULL_PRODUCT = "Unmapped Product Records (NULL product_key in Fact)"
