"""Row filters of the cleaning steps.

Each is a plain predicate, so Catalyst can push it through projections and
into the scan. Comparisons with NULL are false and drop the row, as the
source's pandas comparisons with NaN do (NaN itself is nulled first).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import PRODUCT_DIMENSION_COLUMNS


def delivery_timeline_ok(delivered: str = "order_delivered_customer_date",
                         purchased: str = "order_purchase_timestamp") -> Column:
    """keep undelivered orders and those delivered at or after purchase.
    A delivered order without a purchase time is dropped."""
    return F.col(delivered).isNull() | (F.col(delivered) >= F.col(purchased))


def positive_dimensions(columns: list[str] = PRODUCT_DIMENSION_COLUMNS) -> Column:
    """every physical dimension strictly positive; null drops."""
    cond = F.lit(True)
    for c in columns:
        cond = cond & (F.col(c) > 0)
    return F.coalesce(cond, F.lit(False))


def non_negative_money(price: str = "price", freight: str = "freight_value") -> Column:
    """price >= 0 and freight >= 0; null drops."""
    return F.coalesce((F.col(price) >= 0) & (F.col(freight) >= 0), F.lit(False))


def filter_delivery_timeline(orders: DataFrame) -> DataFrame:
    return orders.where(delivery_timeline_ok())


def filter_product_dims(products: DataFrame) -> DataFrame:
    return products.where(positive_dimensions())


def filter_money(items: DataFrame) -> DataFrame:
    return items.where(non_negative_money())
