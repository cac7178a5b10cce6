"""Schemas, keys and fixed values of the retail data model.

Three layers: raw (as delivered), staging (cleaned, loosely typed), star
(strictly typed). Every layer has an explicit StructType; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as the source system defines them)
# ---------------------------------------------------------------------------

# Column names, including the source's spelling "lenght".
PRODUCT_NUMERIC_COLUMNS = [
    "product_name_lenght", "product_description_lenght", "product_photos_qty",
    "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
]
PRODUCT_DIMENSION_COLUMNS = [
    "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
]
ORDER_TIMESTAMP_COLUMNS = [
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
]
# Text layout of timestamps in the raw files.
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"
TIMESTAMP_REGEX = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
# Width of a zip-code prefix after zero filling.
ZIP_WIDTH = 5
# Category used when a product has none.
UNKNOWN_CATEGORY = "unknown"
# Text tokens that a CSV reader with pandas defaults reads as missing.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
# VARCHAR(n) bounds of the star tables: (table, column, n).
VARCHAR_BOUNDS = [
    ("dim_customers", "customer_id", 50),
    ("dim_customers", "customer_unique_id", 50),
    ("dim_customers", "customer_city", 100),
    ("dim_customers", "customer_state", 10),
    ("dim_products", "product_id", 50),
    ("dim_products", "product_category_name", 100),
    ("fact_orders", "order_id", 50),
    ("fact_orders", "order_status", 50),
]
# Money types: exact staging decimal wide enough to add before rounding,
# and the rounded star type NUMERIC(12,2).
STAGE_DECIMAL = T.DecimalType(20, 6)
MONEY = T.DecimalType(12, 2)

# ---------------------------------------------------------------------------
# Keys
# ---------------------------------------------------------------------------

KEYS = {
    "customers": ["customer_id"],
    "orders": ["order_id"],
    "products": ["product_id"],
    "order_items": ["order_id", "order_item_id"],
}
ORDER_COLUMN = "_ord"   # file order: lowest value of a key is its first row

# ---------------------------------------------------------------------------
# Raw layer
# ---------------------------------------------------------------------------

RAW_CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_unique_id", T.StringType()),
    T.StructField("customer_zip_code_prefix", T.LongType()),
    T.StructField("customer_city", T.StringType()),
    T.StructField("customer_state", T.StringType()),
])
RAW_ORDERS = T.StructType(
    [T.StructField(c, T.StringType()) for c in ["order_id", "customer_id", "order_status"]]
    + [T.StructField(c, T.StringType()) for c in ORDER_TIMESTAMP_COLUMNS]
)
RAW_PRODUCTS = T.StructType(
    [T.StructField("product_id", T.StringType()),
     T.StructField("product_category_name", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in PRODUCT_NUMERIC_COLUMNS[:3]]
    + [T.StructField(c, T.IntegerType()) for c in PRODUCT_DIMENSION_COLUMNS]
)
RAW_ORDER_ITEMS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("order_item_id", T.IntegerType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("seller_id", T.StringType()),
    T.StructField("shipping_limit_date", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("freight_value", T.DoubleType()),
])
RAW_SCHEMAS = {
    "customers": RAW_CUSTOMERS,
    "orders": RAW_ORDERS,
    "products": RAW_PRODUCTS,
    "order_items": RAW_ORDER_ITEMS,
}

# ---------------------------------------------------------------------------
# Staging layer (column lists in load order)
# ---------------------------------------------------------------------------

STAGE_COLUMNS = {
    "customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix",
                  "customer_city", "customer_state"],
    "orders": ["order_id", "customer_id", "order_status"] + ORDER_TIMESTAMP_COLUMNS,
    "products": ["product_id", "product_category_name"] + PRODUCT_NUMERIC_COLUMNS,
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id",
                    "shipping_limit_date", "price", "freight_value", "revenue"],
}
STAGE_TABLES = {
    "customers": "stg_customers",
    "orders": "stg_orders",
    "products": "stg_products",
    "order_items": "stg_order_revenue",
}

# ---------------------------------------------------------------------------
# Star layer
# ---------------------------------------------------------------------------

DIM_CUSTOMER_ATTRS = ["customer_unique_id", "customer_zip_code_prefix",
                      "customer_city", "customer_state"]
DIM_PRODUCT_ATTRS = ["product_category_name"] + PRODUCT_NUMERIC_COLUMNS
FACT_KEYS = ["order_id", "order_item_id"]
FACT_COLUMNS = [
    "order_id", "order_item_id", "customer_key", "product_key", "date_key",
    "order_status", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
    "revenue", "price", "freight",
]
STAR_TABLES = ["dim_customers", "dim_products", "dim_date", "fact_orders"]
# Columns declared NOT NULL, and the keys declared unique, by table.
NOT_NULL = {
    "dim_customers": ["customer_key", "customer_id"],
    "dim_products": ["product_key", "product_id"],
    "dim_date": ["date_key"],
    "fact_orders": ["order_id", "order_item_id", "customer_key", "product_key", "date_key"],
}
UNIQUE = {
    "dim_customers": [["customer_key"], ["customer_id"]],
    "dim_products": [["product_key"], ["product_id"]],
    "dim_date": [["date_key"]],
    "fact_orders": [FACT_KEYS],
}


def _struct(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(c, k) for c, k in kinds.items()])


_DATE_PARTS = ["year", "quarter", "month", "day", "day_of_week"]
STAR_SCHEMAS = {
    "dim_customers": _struct(
        customer_key=T.LongType(), customer_id=T.StringType(), customer_unique_id=T.StringType(),
        customer_zip_code_prefix=T.IntegerType(), customer_city=T.StringType(), customer_state=T.StringType()),
    "dim_products": _struct(
        product_key=T.LongType(), product_id=T.StringType(), product_category_name=T.StringType(),
        **{c: T.IntegerType() for c in PRODUCT_NUMERIC_COLUMNS}),
    "dim_date": _struct(date_key=T.DateType(), **{c: T.IntegerType() for c in _DATE_PARTS}),
    "fact_orders": _struct(
        order_id=T.StringType(), order_item_id=T.IntegerType(), customer_key=T.LongType(), product_key=T.LongType(),
        date_key=T.DateType(), order_status=T.StringType(),
        **{c: T.TimestampNTZType() for c in FACT_COLUMNS[6:10]}, revenue=MONEY, price=MONEY, freight=MONEY),
    "fact_rejects": _struct(order_id=T.StringType(), order_item_id=T.IntegerType(), reject_reason=T.StringType()),
}
