"""Table contracts and the fixed values the warehouse must reproduce.

Column names are snake_case versions of the landing CSV headers; the
``CSV_HEADERS`` map keeps the original header text for CSV I/O.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values (must equal the source system's for identical results)
# --------------------------------------------------------------------------

# Landing CSV headers, in file order, and our column names for them.
CSV_HEADERS = {
    "Order ID": "order_id",
    "Product": "product",
    "Quantity Ordered": "quantity_ordered",
    "Price Each": "price_each",
    "Order Date": "order_date",
    "Purchase Address": "purchase_address",
}

# Validation reasons, in evaluation order. The first four "out of range" /
# "Invalid Order Date" reasons are ours: the source aborts the whole load on
# those rows instead of rejecting them.
REASON_ORDER_ID = "Invalid Order ID (non-numeric)"
REASON_ORDER_ID_RANGE = "Order ID out of range"
REASON_PRODUCT_NULL = "Product is NULL"
REASON_QTY_FORMAT = "Invalid Quantity Ordered"
REASON_QTY_RANGE = "Quantity out of range"
REASON_QTY_NOT_POSITIVE = "Quantity Ordered is not positive"
REASON_PRICE_FORMAT = "Invalid Price Each format"
REASON_PRICE_RANGE = "Price Each out of range"
REASON_PRICE_NOT_POSITIVE = "Price Each is not positive"
REASON_DATE_NULL = "Order Date is NULL"
REASON_DATE_INVALID = "Invalid Order Date"
REASON_DATE_FUTURE = "Order Date is in the future"
REASON_ADDRESS_NULL = "Purchase Address is NULL"
REASON_UNKNOWN = "Unknown validation error"
# Opt-in length rule (ours): "<CSV header> is too long".
REASON_TOO_LONG = "{} is too long"
# Landing column widths of the source (VARCHAR(n)), for the opt-in length rule.
LANDING_WIDTHS = {"order_id": 20, "product": 100, "quantity_ordered": 20, "price_each": 20,
                  "order_date": 20, "purchase_address": 200}

# Patterns (Java regex; \A..\z so a trailing newline never matches).
DIGITS_RE = r"\A\d+\z"
PRICE_RE = r"\A\d+(\.\d{1,2})?\z"
ORDER_TS_RE = r"\A(\d{1,2})/(\d{1,2})/(\d{2}|\d{4}) (\d{1,2}):(\d{2})\z"
# Two-digit years below this pivot are 20xx, the rest 19xx.
YEAR_PIVOT = 70

# Product category rules, first match wins: (pattern on UPPER(product), id, name).
CATEGORY_RULES = (
    ("MONITOR", "CAT-00001", "MONITOR"),
    ("BATTERIES|BATTERY", "CAT-00002", "BATTERY"),
    ("HEADPHONES", "CAT-00003", "HEADPHONES"),
    ("TV", "CAT-00004", "TV"),
    ("DRYER|WASHING", "CAT-00005", "APPLIANCES"),
    ("PHONE", "CAT-00006", "PHONE"),
    ("LAPTOP", "CAT-00007", "LAPTOP"),
    ("CABLE", "CAT-00008", "ACCESSORIES"),
)
CATEGORY_DEFAULT = ("CAT-00009", "OTHERS")

# Id formats.
PRODUCT_ID_PREFIX = "PROD-"
ID_COUNTER_WIDTH = 5
LOCATION_TYPES = {3: "State", 2: "Postal Code", 1: "City", 0: "Street"}
OPEN_END = "9999-12-31"

# --------------------------------------------------------------------------
# Schemas
# --------------------------------------------------------------------------

LANDING_COLUMNS = list(CSV_HEADERS.values())

CSV_SCHEMA = T.StructType([T.StructField(h, T.StringType()) for h in CSV_HEADERS])

LANDING_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in LANDING_COLUMNS]
    + [T.StructField("updated_at", T.TimestampType())]
)

PRICE_TYPE = T.DecimalType(18, 2)
# Any 64-bit quantity times any price fits, so one odd sale never ends a run.
FACT_PRICE_TYPE = T.DecimalType(38, 2)
CUBE_SUM_TYPE = T.DecimalType(38, 2)

CLEAN_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("product", T.StringType()),
    T.StructField("quantity_ordered", T.LongType()),
    T.StructField("price_each", PRICE_TYPE),
    T.StructField("order_date", T.TimestampType()),
    T.StructField("purchase_address", T.StringType()),
    T.StructField("updated_at", T.TimestampType()),
])

ERROR_SCHEMA = T.StructType(
    [T.StructField("error_id", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in LANDING_COLUMNS]
    + [
        T.StructField("error_reason", T.StringType()),
        T.StructField("logged_at", T.TimestampType()),
        T.StructField("executed_time", T.TimestampType()),
    ]
)

TIME_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in
     ("time_combined_id", "time_id", "time_name", "time_parent", "time_lvl", "timebranch")]
    + [T.StructField("day_date", T.DateType())]
)

LOCATION_SCHEMA = T.StructType([
    T.StructField("address_id", T.StringType()),
    T.StructField("address_name", T.StringType()),
    T.StructField("address_type", T.StringType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("level", T.IntegerType()),
])

PRODUCT_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("price_each", PRICE_TYPE),
    T.StructField("start_date", T.TimestampType()),
    T.StructField("end_date", T.TimestampType()),
    T.StructField("curr_status", T.BooleanType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("category_name", T.StringType()),
])

FACT_COLUMNS = [
    "order_id", "quantity", "total_price", "product_surrogate_id", "product",
    "time_id", "address_id", "product_start_date", "product_end_date",
    "product_current_status", "product_parent_id", "product_category",
    "time_name", "time_parent", "time_level", "time_branch",
    "address_name", "address_type", "parent_id", "address_level",
]

CUBE_COLUMNS = ["product_surrogate_id", "address_id", "time_id", "total_price_sum"]
