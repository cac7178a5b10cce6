"""Star schema builds (K6-K9) and the fact joins.

Join order is chosen for scale: orders (one row per order) are joined to the
customer dimension first, and the items to the product dimension while they
have their few own columns; the join of both on ``order_id`` is the last, so
the wide fact rows are not shuffled by a look-up. No side is force-broadcast:
AQE turns a join into a broadcast join only when the measured size of a side is
under ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and keeps the
sort-merge join otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fx
from ..schemas import (DIM_CUSTOMER_ATTRS, DIM_PRODUCT_ATTRS, FACT_COLUMNS,
                       PRODUCT_NUMERIC_COLUMNS)
from .keys import assign_surrogate_keys


def dim_customer_rows(stg_customers: DataFrame) -> DataFrame:
    """K6 without keys: project staging, zip text -> INT."""
    return stg_customers.select(
        "customer_id", "customer_unique_id",
        fx.text_to_int(F.col("customer_zip_code_prefix")).alias("customer_zip_code_prefix"),
        "customer_city", "customer_state",
    )


def dim_product_rows(stg_products: DataFrame) -> DataFrame:
    """K7 without keys: NUMERIC -> INT with half-away rounding.

    The source's ``SELECT DISTINCT`` runs over rows already unique on
    product_id (D1), so it is a no-op; it is left out to save a shuffle.
    """
    return stg_products.select(
        "product_id", "product_category_name",
        *[fx.numeric_to_int(F.col(c)).alias(c) for c in PRODUCT_NUMERIC_COLUMNS],
    )


def build_dim_customers(stg_customers: DataFrame) -> DataFrame:
    """K6: dim_customers with dense surrogate keys (first load)."""
    return assign_surrogate_keys(dim_customer_rows(stg_customers), "customer_id", "customer_key") \
        .select("customer_key", "customer_id", *DIM_CUSTOMER_ATTRS)


def build_dim_products(stg_products: DataFrame) -> DataFrame:
    """K7: dim_products with dense surrogate keys (first load)."""
    return assign_surrogate_keys(dim_product_rows(stg_products), "product_id", "product_key") \
        .select("product_key", "product_id", *DIM_PRODUCT_ATTRS)


def build_dim_date(stg_orders: DataFrame) -> DataFrame:
    """K8: one row per purchase day that occurs (D4 + P14-P16, F4).

    The DISTINCT runs on the single date column, so the shuffle carries one
    small value per map-side group.
    """
    days = (stg_orders.where(F.col("order_purchase_timestamp").isNotNull())
            .select(fx.date_key(F.col("order_purchase_timestamp")).alias("date_key"))
            .distinct())
    parts = fx.date_parts(F.col("date_key"))
    return days.select("date_key", *[v.alias(k) for k, v in parts.items()])


def orders_with_customers(stg_orders: DataFrame, dim_customers: DataFrame,
                          how: str = "inner") -> DataFrame:
    """J2 at order grain: customer key look-up before the item join."""
    return stg_orders.join(dim_customers.select("customer_id", "customer_key"),
                           "customer_id", how)


def items_with_products(items: DataFrame, dim_products: DataFrame, how: str = "inner") -> DataFrame:
    """J3 at item grain, before the order join: the columns of a fact that come
    from the item, with the product key in place of its id."""
    return items.select("order_id", "order_item_id", "product_id", "price", "freight_value") \
        .join(dim_products.select("product_id", "product_key"), "product_id", how).drop("product_id")


def join_items_orders(items: DataFrame, orders: DataFrame, how: str = "inner") -> DataFrame:
    """Items x orders on order_id, many-to-one."""
    return items.join(orders, "order_id", how)


def fact_projection(joined: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """K9 output columns (P8, P13, P14, P18, P19), plus ``extra`` ones."""
    return joined.select(
        "order_id",
        F.col("order_item_id").cast("int").alias("order_item_id"),
        F.col("customer_key").cast("long").alias("customer_key"),
        F.col("product_key").cast("long").alias("product_key"),
        fx.date_key(F.col("order_purchase_timestamp")).alias("date_key"),
        "order_status", "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date",
        fx.to_money(F.col("price") + F.col("freight_value")).alias("revenue"),
        fx.to_money(F.col("price")).alias("price"),
        fx.to_money(F.col("freight_value")).alias("freight"),
        *extra,
    )


def build_fact_orders(stg_items: DataFrame, stg_orders: DataFrame,
                      dim_customers: DataFrame, dim_products: DataFrame) -> DataFrame:
    """K9: one fact row per order item whose order, customer, product and
    purchase date exist. Revenue is the exact sum rounded once (P8)."""
    orders = orders_with_customers(
        stg_orders.where(F.col("order_purchase_timestamp").isNotNull()), dim_customers)
    joined = join_items_orders(items_with_products(stg_items, dim_products), orders)
    return fact_projection(joined).select(*FACT_COLUMNS)


def resolve_items(stg_items: DataFrame, stg_orders: DataFrame,
                  dim_customers: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Every item with all fact columns and a ``reject_reason`` (Q6): the
    first missing parent among order, customer, product and purchase date,
    or null for a fact row. Left joins, in the same order as the fact build;
    a caller that needs only keys and reasons gets the unused columns pruned
    out of the joins by Catalyst."""
    orders = orders_with_customers(stg_orders.withColumn("_has_order", F.lit(True)), dim_customers, "left")
    joined = join_items_orders(items_with_products(stg_items, dim_products, "left"), orders, "left")
    reason = (F.when(F.col("_has_order").isNull(), F.lit("no_order"))
              .when(F.col("customer_key").isNull(), F.lit("no_customer"))
              .when(F.col("product_key").isNull(), F.lit("no_product"))
              .when(F.col("order_purchase_timestamp").isNull(), F.lit("no_date")))
    # Money is cast for fact rows only: a rejected item never reaches the
    # NUMERIC(12,2) columns, so it cannot fail the load on overflow.
    joined = joined.withColumn("reject_reason", reason) \
        .withColumn("price", F.when(F.col("reject_reason").isNull(), F.col("price"))) \
        .withColumn("freight_value", F.when(F.col("reject_reason").isNull(), F.col("freight_value")))
    return fact_projection(joined, ("reject_reason",))


def reject_facts(stg_items: DataFrame, stg_orders: DataFrame,
                 dim_customers: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Q6: items that cannot become facts, with the reason."""
    return resolve_items(stg_items, stg_orders, dim_customers, dim_products) \
        .where(F.col("reject_reason").isNotNull()) \
        .select("order_id", "order_item_id", "reject_reason")
