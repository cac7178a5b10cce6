"""Raw retail tables derived from the driver's TPC-H-style tables.

The driver tables are clean, so these views plant one defect for every
cleaning rule (see FIXTURES.md). They are ordinary lazy Spark plans over the
Parquet scans: their size grows with the input tables, and every operator
downstream runs over all of their rows.

The duplicate copies are made with a two-element ``explode`` (a generator in
the scan stage) rather than a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .tables import read_table

RAW_CUSTOMERS_SQL = """
SELECT concat('C', cast(c_custkey AS string)) AS customer_id,
       concat('U', cast(c_custkey - (CASE WHEN c_custkey % 20 = 19 THEN 1 ELSE 0 END) AS string)) AS customer_unique_id,
       CASE WHEN c_custkey % 4 = 0 THEN 1000 + c_custkey % 9000
            ELSE 10000 + (c_custkey * 7919) % 90000 END AS customer_zip_code_prefix,
       concat('  ', lower(n_name),
              CASE WHEN c_custkey % 3 = 0 THEN ' d''oeste' WHEN c_custkey % 3 = 1 THEN ' mogi-mirim' ELSE '' END,
              ' ') AS customer_city,
       CASE WHEN rep = 1 THEN 'ZZ' ELSE upper(substr(n_name, 1, 2)) END AS customer_state,
       rep AS _ord
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
LATERAL VIEW explode(array(0, 1)) r AS rep
WHERE rep = 0 OR c_custkey % 50 = 0
"""

RAW_ORDERS_SQL = """
SELECT concat('O', cast(o_orderkey AS string)) AS order_id,
       CASE WHEN o_orderkey % 2000 = 17 THEN 'C-missing' ELSE concat('C', cast(o_custkey AS string)) END AS customer_id,
       CASE WHEN rep = 1 THEN 'superseded' WHEN o_orderkey % 100 = 7 THEN 'canceled'
            WHEN o_orderstatus = 'O' THEN 'shipped'
            WHEN o_orderstatus = 'P' AND o_orderkey % 5 = 0 THEN 'processing'
            ELSE 'delivered' END AS order_status,
       CASE WHEN o_orderkey % 1500 IN (13, 14) THEN NULL
            ELSE cast(o_orderdate + INTERVAL '1' HOUR * (o_orderkey % 24) AS string) END AS order_purchase_timestamp,
       CASE WHEN o_orderkey % 600 = 7 THEN NULL
            ELSE cast(o_orderdate + INTERVAL '1' HOUR * (o_orderkey % 48 + 24) AS string) END AS order_approved_at,
       CASE WHEN o_orderkey % 41 = 0 THEN 'not-a-date'
            ELSE cast(o_orderdate + INTERVAL '1' DAY * (o_orderkey % 5 + 2) AS string) END AS order_delivered_carrier_date,
       CASE WHEN o_orderkey % 100 = 7 OR o_orderkey % 1500 = 13 THEN NULL
            WHEN o_orderkey % 60 = 11 THEN cast(o_orderdate - INTERVAL '1' DAY * 2 AS string)
            ELSE cast(o_orderdate + INTERVAL '1' DAY * (o_orderkey % 25 + 3) AS string) END AS order_delivered_customer_date,
       cast(o_orderdate + INTERVAL '1' DAY * 20 AS string) AS order_estimated_delivery_date,
       rep AS _ord
FROM {orders}
LATERAL VIEW explode(array(0, 1)) r AS rep
WHERE rep = 0 OR o_orderkey % 90 = 0
"""

RAW_PRODUCTS_SQL = """
SELECT concat('P', cast(p_partkey AS string)) AS product_id,
       CASE WHEN rep = 1 THEN 'superseded' WHEN p_partkey % 54 = 0 THEN NULL ELSE lower(p_type) END AS product_category_name,
       CASE WHEN p_partkey % 54 = 0 THEN NULL ELSE cast(length(p_name) AS string) END AS product_name_lenght,
       CASE WHEN p_partkey % 54 = 0 THEN NULL ELSE concat(cast(length(p_name) * 40 AS string), ',5') END AS product_description_lenght,
       CASE WHEN p_partkey % 54 = 0 THEN NULL ELSE cast(p_partkey % 7 + 1 AS string) END AS product_photos_qty,
       CASE WHEN p_partkey % 700 = 0 THEN NULL WHEN p_partkey % 500 = 3 AND rep = 0 THEN 0 ELSE p_size * 100 END AS product_weight_g,
       CASE WHEN p_partkey % 700 = 0 THEN NULL ELSE p_size + 5 END AS product_length_cm,
       CASE WHEN p_partkey % 700 = 0 THEN NULL WHEN p_partkey % 400 = 9 THEN -1 ELSE p_size + 2 END AS product_height_cm,
       CASE WHEN p_partkey % 700 = 0 THEN NULL ELSE p_size + 3 END AS product_width_cm,
       rep AS _ord
FROM {part}
LATERAL VIEW explode(array(0, 1)) r AS rep
WHERE rep = 0 OR p_partkey % 80 = 0 OR p_partkey % 500 = 3
"""

RAW_ORDER_ITEMS_SQL = """
SELECT concat('O', cast(l_orderkey AS string)) AS order_id, l_linenumber AS order_item_id,
       concat('P', cast(l_partkey AS string)) AS product_id, concat('S', cast(l_suppkey AS string)) AS seller_id,
       CASE WHEN l_partkey % 97 = 0 THEN 'not-a-date' ELSE cast(l_shipdate AS string) END AS shipping_limit_date,
       CASE WHEN l_partkey % 199 = 0 THEN -l_extendedprice
            WHEN l_partkey % 13 = 0 THEN l_extendedprice * 10 ELSE l_extendedprice END AS price,
       l_quantity + CASE WHEN l_suppkey % 17 = 0 THEN 500 ELSE 0 END AS freight_value,
       struct(l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate) AS _ord
FROM {lineitem}
"""
# The file order of the items is the order of the five columns that the view
# shows; rows that tie on them are equal in the view. The order column is a
# struct of them, so no numbering (and no shuffle) is needed to have it.


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_CUSTOMERS_SQL,
                     customer=read_table(spark, sf_dir, "customer"),
                     nation=read_table(spark, sf_dir, "nation"))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_ORDERS_SQL, orders=read_table(spark, sf_dir, "orders"))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_PRODUCTS_SQL, part=read_table(spark, sf_dir, "part"))


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_ORDER_ITEMS_SQL, lineitem=read_table(spark, sf_dir, "lineitem"))


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four raw tables, keyed like ``schemas.KEYS``."""
    return {
        "customers": raw_customers(spark, sf_dir),
        "orders": raw_orders(spark, sf_dir),
        "products": raw_products(spark, sf_dir),
        "order_items": raw_order_items(spark, sf_dir),
    }
