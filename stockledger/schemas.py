"""Declared schemas of the mart's stored tables.

Type choices: surrogate keys and counts are ``bigint`` (the source declares
NUMBER(38,0) but every value is a key or a count); amounts are ``double``;
ratios are ``decimal(38,6)``; version dates are ``timestamp_ntz``.
"""

from __future__ import annotations

from pyspark.sql import types as T

L = T.LongType()
I = T.IntegerType()
S = T.StringType()
D = T.DoubleType()
DEC6 = T.DecimalType(38, 6)
TS = T.TimestampNTZType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw inventory as declared for the CSV drop (three columns are NOT NULL in the
# source DDL; file readers force nullability, so the ingest filters instead).
INVENTORY = _struct(
    ("inv_data_sk", L),
    ("inv_item_sk", L),
    ("inv_quantity_on_hand", L),
    ("inv_warehouse_sk", L),
)
INVENTORY_NOT_NULL = ("inv_data_sk", "inv_item_sk", "inv_warehouse_sk")

DATE_DIM = _struct(
    ("d_date_sk", L),
    ("cal_dt", T.DateType()),
    ("wk_num", I),
    ("yr_num", I),
    ("day_of_wk_num", I),
)

DAILY_AGGREGATED_SALES = _struct(
    ("warehouse_sk", L),
    ("item_sk", L),
    ("sold_date_sk", L),
    ("sold_wk_num", L),
    ("sold_yr_num", L),
    ("daily_qty", L),
    ("daily_sales_amt", D),
    ("daily_net_profit", D),
)

WEEKLY_SALES_INVENTORY = _struct(
    ("warehouse_sk", L),
    ("item_sk", L),
    ("sold_wk_sk", L),
    ("sold_wk_num", L),
    ("sold_yr_num", L),
    ("sum_qty_wk", L),
    ("sum_amt_wk", D),
    ("sum_profit_wk", D),
    ("avg_qty_dy", DEC6),
    ("inv_qty_wk", L),
    ("wks_sply", DEC6),
    ("low_stock_flg_wk", T.BooleanType()),
)

# The customer attributes of the raw CUSTOMER table and the
# customer snapshot, in the order of the source DDL.
CUSTOMER_COLUMNS = (
    "c_salutation",
    "c_preferred_cust_flag",
    "c_first_sales_date_sk",
    "c_customer_sk",
    "c_login",
    "c_current_cdemo_sk",
    "c_first_name",
    "c_current_hdemo_sk",
    "c_current_addr_sk",
    "c_last_name",
    "c_customer_id",
    "c_last_review_date_sk",
    "c_birth_month",
    "c_birth_country",
    "c_birth_year",
    "c_birth_day",
    "c_email_address",
    "c_first_shipto_date_sk",
)
_CUSTOMER_TEXT = {
    "c_salutation",
    "c_preferred_cust_flag",
    "c_login",
    "c_first_name",
    "c_last_name",
    "c_customer_id",
    "c_birth_country",
    "c_email_address",
}
CUSTOMER = _struct(*[(c, S if c in _CUSTOMER_TEXT else L) for c in CUSTOMER_COLUMNS])
CUSTOMER_SNAPSHOT = _struct(
    *[(c, S if c in _CUSTOMER_TEXT else L) for c in CUSTOMER_COLUMNS],
    ("start_date", TS),
    ("end_date", TS),
)

# The columns the customer dimension takes from each joined
# table, in the order of the source's select list.
ADDRESS_COLUMNS = (
    "ca_street_name",
    "ca_suite_number",
    "ca_state",
    "ca_location_type",
    "ca_country",
    "ca_address_id",
    "ca_county",
    "ca_street_number",
    "ca_zip",
    "ca_city",
    "ca_gmt_offset",
)
DEMOGRAPHICS_COLUMNS = (
    "cd_dep_employed_count",
    "cd_dep_count",
    "cd_credit_rating",
    "cd_education_status",
    "cd_purchase_estimate",
    "cd_marital_status",
    "cd_dep_college_count",
    "cd_gender",
)
HOUSEHOLD_COLUMNS = (
    "hd_buy_potential",
    "hd_dep_count",
    "hd_vehicle_count",
    "hd_income_band_sk",
)
INCOME_BAND_COLUMNS = ("ib_lower_bound", "ib_upper_bound")

CUSTOMER_DIM_COLUMNS = (
    CUSTOMER_COLUMNS
    + ADDRESS_COLUMNS
    + DEMOGRAPHICS_COLUMNS
    + HOUSEHOLD_COLUMNS
    + INCOME_BAND_COLUMNS
    + ("start_date", "end_date")
)
