"""Cleaning jobs (C1-C5): de-duplicate first, then normalise and filter.

Order matters and follows the source: de-duplication comes before the
filters, so a key whose first row is invalid is dropped even if a later
copy would pass. Only timestamps are parsed before it: each row's own values
decide them, and a timestamp is less to shuffle than its text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as fx
from ..schemas import (KEYS, ORDER_TIMESTAMP_COLUMNS, PRODUCT_NUMERIC_COLUMNS,
                       STAGE_COLUMNS, UNKNOWN_CATEGORY, ZIP_WIDTH)
from .dedup import keep_first
from .filters import delivery_timeline_ok, non_negative_money, positive_dimensions


def null_nans(df: DataFrame) -> DataFrame:
    """P9 on every floating column, at entry."""
    return df.select([
        fx.nan_to_null(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def parse_order_timestamps(orders: DataFrame) -> DataFrame:
    """P4 on the five order timestamps."""
    return orders.select([
        fx.parse_timestamp(F.col(c)).alias(c) if c in ORDER_TIMESTAMP_COLUMNS else F.col(c)
        for c in orders.columns
    ])


def repair_product_numbers(products: DataFrame) -> DataFrame:
    """P5 on the seven numeric product columns."""
    return products.select([
        fx.repair_decimal_comma(F.col(c)).alias(c) if c in PRODUCT_NUMERIC_COLUMNS else F.col(c)
        for c in products.columns
    ])


def clean_customers(raw: DataFrame) -> DataFrame:
    """D1, strip + title-case the city, zero-fill the zip prefix."""
    d = keep_first(raw, KEYS["customers"])
    return d.select(
        "customer_id", "customer_unique_id",
        fx.zero_fill(F.col("customer_zip_code_prefix"), ZIP_WIDTH).alias("customer_zip_code_prefix"),
        fx.title_case(fx.strip_blanks(F.col("customer_city"))).alias("customer_city"),
        "customer_state",
    )


def clean_orders(raw: DataFrame) -> DataFrame:
    """D1, parse timestamps, drop deliveries before purchase."""
    d = keep_first(parse_order_timestamps(raw), KEYS["orders"])
    return d.where(delivery_timeline_ok()).select(*STAGE_COLUMNS["orders"])


def clean_products(raw: DataFrame) -> DataFrame:
    """D1, positive dimensions, category default, decimal-comma repair.

    Numbers are repaired before the dimension filter; on inputs the source
    accepts (numeric dimensions) the result is the same.
    """
    d = repair_product_numbers(null_nans(keep_first(raw, KEYS["products"])))
    d = d.where(positive_dimensions())
    return d.select(
        "product_id",
        fx.fill_default(F.col("product_category_name"), UNKNOWN_CATEGORY).alias("product_category_name"),
        *PRODUCT_NUMERIC_COLUMNS,
    )


def clean_order_items(raw: DataFrame) -> DataFrame:
    """C4: D2, non-negative money, parse the shipping limit, exact revenue."""
    parsed = raw.withColumn("shipping_limit_date", fx.parse_timestamp(F.col("shipping_limit_date")))
    d = null_nans(keep_first(parsed, KEYS["order_items"])).where(non_negative_money())
    price = fx.to_stage_decimal(F.col("price"))
    freight = fx.to_stage_decimal(F.col("freight_value"))
    return d.select(
        "order_id", F.col("order_item_id").cast("int").alias("order_item_id"),
        "product_id", "seller_id",
        "shipping_limit_date",
        price.alias("price"), freight.alias("freight_value"),
        fx.exact_revenue(price, freight).alias("revenue"),
    )


CLEANERS = {
    "customers": clean_customers,
    "orders": clean_orders,
    "products": clean_products,
    "order_items": clean_order_items,
}
