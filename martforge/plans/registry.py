"""The query registry: one entry per operator of the inventory.

Each entry maps a name to a Spark callable ``(spark, sf_dir) -> DataFrame``
and, where the operator is expressible in SQL, the DuckDB oracle body
(prefixed with the shared definitions of ``oracle.py``). Column names and
types agree between the two sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import functions as fx
from ..operators import clean as cl
from ..operators import dedup, filters, keys, maintain, outliers, quality, sketches, star
from ..schemas import (KEYS, MISSING_TOKENS, ORDER_TIMESTAMP_COLUMNS, PRODUCT_NUMERIC_COLUMNS,
                       RAW_CUSTOMERS, STAGE_COLUMNS, STAGE_TABLES, VARCHAR_BOUNDS)
from ..session import materialize, new_work_dir
from ..sources import csv as csv_io
from ..sources.staging import load_staging, load_staging_observed
from ..sources.star_tables import StarTables
from . import oracle
from .batches import TwoBatches
from .context import Layers, LazyTables
from .oracle import PRODUCT_NUM, TS, _comma, _dec, _title_strip, _zfill
from .jobs import load, rebuild_star, run

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle_body: str | None = None):
    def deco(fn: Callable[[Layers], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Layers(spark, sf_dir))
        if oracle_body is not None:
            ORACLE[name] = oracle.sql(oracle_body)
        return fn
    return deco


def _union_all(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


RAW_COLS = {
    "customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
                  "customer_state"],
    "orders": STAGE_COLUMNS["orders"],
    "products": ["product_id", "product_category_name"] + PRODUCT_NUMERIC_COLUMNS,
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
                    "price", "freight_value"],
}
RAW_VIEW = {k: f"raw_{k}" for k in RAW_COLS}
CLEAN_VIEW = {k: f"clean_{k}_v" for k in RAW_COLS}

# ==================================================== S1-S5 sources, sinks
@register("csv_roundtrip", "SELECT customer_id, customer_unique_id, customer_zip_code_prefix, "
          + ", ".join(f"CASE WHEN {c} IN ({', '.join(chr(39) + t + chr(39) for t in MISSING_TOKENS)}) THEN NULL ELSE {c} END AS {c}"
                      for c in ["customer_city", "customer_state"])
          + " FROM dedup_customers_v")
def _csv_roundtrip(L: Layers) -> DataFrame:
    """S2 then S1: raw customers written as CSV in file order, read back with
    an explicit schema and a file-order column, then de-duplicated keep-first.
    Padding blanks, apostrophes and the ZZ copies must survive the trip; the
    missing-value tokens become NULL on reading, as with pandas defaults (so
    the state code 'NA' is read as missing)."""
    path = new_work_dir(L.spark, "csv") + "/raw_customers"
    csv_io.write_csv(L.raw["customers"].orderBy("_ord", "customer_id").drop("_ord"), path)
    back = csv_io.read_csv(L.spark, path, RAW_CUSTOMERS)
    return dedup.keep_first(back, KEYS["customers"])


@register("stage_customers", "SELECT * FROM clean_customers_v")
def _stage_customers(L: Layers) -> DataFrame:
    return load_staging(L.spark, {"customers": L.clean["customers"]})["customers"]


@register("stage_orders", "SELECT * FROM clean_orders_v")
def _stage_orders(L: Layers) -> DataFrame:
    return load_staging(L.spark, {"orders": L.clean["orders"]})["orders"]


@register("stage_products", "SELECT * FROM clean_products_v")
def _stage_products(L: Layers) -> DataFrame:
    return load_staging(L.spark, {"products": L.clean["products"]})["products"]


@register("stage_order_revenue", "SELECT * FROM clean_order_items_v")
def _stage_order_revenue(L: Layers) -> DataFrame:
    return load_staging(L.spark, {"order_items": L.clean["order_items"]})["order_items"]


@register("stage_insert_ignore", """
SELECT * FROM b1_customers_v
UNION ALL
SELECT * FROM b2_customers_v b WHERE NOT EXISTS (SELECT 1 FROM b1_customers_v a WHERE a.customer_id = b.customer_id)
-- the batch holds every row twice; the second copy has another city""")
def _stage_insert_ignore(L: Layers) -> DataFrame:
    tb = TwoBatches(L)
    batch = tb.batch2["customers"].withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))) \
        .withColumn("customer_city", F.when(F.col("_copy") == 1, F.lit("later copy")).otherwise(F.col("customer_city")))
    return maintain.insert_ignore(tb.batch1["customers"], batch, KEYS["customers"], ["_copy"])


_STAR_COUNT_SQL = _union_all([f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}_v"
                              for t in ["dim_customers", "dim_products", "dim_date", "fact_orders"]])


@register("star_row_counts", _STAR_COUNT_SQL)
def _star_row_counts(L: Layers) -> DataFrame:
    return quality.row_counts(_written_star(L))


# ======================================================= P1-P19 projections
@register("clean_city", f"SELECT customer_id, _ord, {_title_strip('customer_city')} AS customer_city FROM raw_customers")
def _clean_city(L: Layers) -> DataFrame:
    r = L.raw["customers"]
    return r.select("customer_id", "_ord", fx.title_case(fx.strip_blanks(F.col("customer_city"))).alias("customer_city"))


@register("clean_zip", f"SELECT customer_id, _ord, {_zfill('CAST(customer_zip_code_prefix AS VARCHAR)')} AS customer_zip_code_prefix FROM raw_customers")
def _clean_zip(L: Layers) -> DataFrame:
    r = L.raw["customers"]
    return r.select("customer_id", "_ord", fx.zero_fill(F.col("customer_zip_code_prefix"), 5).alias("customer_zip_code_prefix"))


@register("parse_timestamps", "SELECT order_id, _ord, "
          + ", ".join(f"try_strptime({c}, {TS}) AS {c}" for c in ORDER_TIMESTAMP_COLUMNS) + " FROM raw_orders")
def _parse_timestamps(L: Layers) -> DataFrame:
    r = L.raw["orders"]
    return r.select("order_id", "_ord", *[fx.parse_timestamp(F.col(c)).alias(c) for c in ORDER_TIMESTAMP_COLUMNS])


@register("repair_decimal_comma", "SELECT product_id, _ord, "
          + ", ".join(f"{_comma(c)} AS {c}" for c in PRODUCT_NUM) + " FROM raw_products")
def _repair_decimal_comma(L: Layers) -> DataFrame:
    return cl.repair_product_numbers(L.raw["products"]).select("product_id", "_ord", *PRODUCT_NUMERIC_COLUMNS)


@register("fill_category", "SELECT product_id, _ord, coalesce(product_category_name, 'unknown') AS product_category_name FROM raw_products")
def _fill_category(L: Layers) -> DataFrame:
    r = L.raw["products"]
    return r.select("product_id", "_ord", fx.fill_default(F.col("product_category_name"), "unknown").alias("product_category_name"))


@register("item_revenue", f"SELECT order_id, order_item_id, CAST({_dec('price')} + {_dec('freight_value')} AS DECIMAL(20,6)) AS revenue FROM raw_order_items")
def _item_revenue(L: Layers) -> DataFrame:
    r = cl.null_nans(L.raw["order_items"])
    return r.select("order_id", "order_item_id",
                    fx.exact_revenue(fx.to_stage_decimal(F.col("price")),
                                     fx.to_stage_decimal(F.col("freight_value"))).alias("revenue"))


@register("nan_to_null", """SELECT order_id, order_item_id,
  CASE WHEN l_partkey % 53 = 0 THEN NULL ELSE price END AS price,
  CASE WHEN l_partkey % 59 = 0 THEN NULL ELSE freight_value END AS freight_value
FROM (SELECT *, CAST(substr(product_id, 2) AS BIGINT) AS l_partkey FROM raw_order_items)""")
def _nan_to_null(L: Layers) -> DataFrame:
    """Some products' money is NaN, as a CSV reader leaves it."""
    number = F.substring("product_id", 2, 20).cast("long")
    planted = L.raw["order_items"] \
        .withColumn("price", F.when(number % 53 == 0, F.lit(float("nan"))).otherwise(F.col("price"))) \
        .withColumn("freight_value", F.when(number % 59 == 0, F.lit(float("nan"))).otherwise(F.col("freight_value")))
    return cl.null_nans(planted).select("order_id", "order_item_id", "price", "freight_value")


@register("normalise_missing", "SELECT * REPLACE (CASE WHEN CAST(substr(order_id, 2) AS BIGINT) % 5 = 0 THEN NULL "
          "ELSE order_status END AS order_status) FROM raw_orders")
def _normalise_missing(L: Layers) -> DataFrame:
    """Every fifth order has one of the tokens as its status."""
    number = F.substring("order_id", 2, 20).cast("long")
    tokens = F.array(*[F.lit(t) for t in MISSING_TOKENS])
    token = F.element_at(tokens, (F.floor(number / 5) % len(MISSING_TOKENS) + 1).cast("int"))
    planted = L.raw["orders"].withColumn("order_status", F.when(number % 5 == 0, token).otherwise(F.col("order_status")))
    return fx.normalise_missing(planted)


# ============================================================ F1-F3 filters
@register("filter_delivery_timeline", "SELECT * FROM (SELECT order_id, customer_id, order_status, "
          + ", ".join(f"try_strptime({c}, {TS}) AS {c}" for c in ORDER_TIMESTAMP_COLUMNS)
          + ", _ord FROM raw_orders) WHERE order_delivered_customer_date IS NULL OR order_delivered_customer_date >= order_purchase_timestamp")
def _filter_delivery_timeline(L: Layers) -> DataFrame:
    return filters.filter_delivery_timeline(cl.parse_order_timestamps(L.raw["orders"]))


@register("filter_product_dims", "SELECT * FROM raw_products WHERE product_weight_g > 0 AND product_length_cm > 0 AND product_height_cm > 0 AND product_width_cm > 0")
def _filter_product_dims(L: Layers) -> DataFrame:
    return filters.filter_product_dims(cl.null_nans(L.raw["products"]))


@register("filter_money", "SELECT * EXCLUDE (_ord) FROM raw_order_items WHERE price >= 0 AND freight_value >= 0")
def _filter_money(L: Layers) -> DataFrame:
    return filters.filter_money(cl.null_nans(L.raw["order_items"].drop("_ord")))


# ======================================================= D1-D2 de-duplication
for _name in ["customers", "orders", "products", "order_items"]:
    def _make(name):
        @register(f"dedup_{name}", f"SELECT * FROM dedup_{name}_v")
        def _q(L: Layers) -> DataFrame:
            return dedup.keep_first(L.raw[name], KEYS[name])
        return _q
    _make(_name)


# ================================================================ J1-J5 joins
@register("join_items_orders", """
SELECT oi.order_id, oi.order_item_id, oi.product_id, o.customer_id, o.order_status, o.order_purchase_timestamp,
       oi.price, oi.freight_value
FROM clean_order_items_v oi JOIN clean_orders_v o ON oi.order_id = o.order_id""")
def _join_items_orders(L: Layers) -> DataFrame:
    c = L.clean
    items = c["order_items"].select("order_id", "order_item_id", "product_id", "price", "freight_value")
    orders = c["orders"].select("order_id", "customer_id", "order_status", "order_purchase_timestamp")
    return star.join_items_orders(items, orders)


def _written_star(L: Layers) -> dict[str, DataFrame]:
    """The four star tables, written for the query that asks: its checks read
    them in several passes, and what they cost does not depend on earlier queries."""
    return rebuild_star(L.staged, new_work_dir(L.spark, "checked/star"))


def _broken_star(L: Layers) -> dict[str, DataFrame]:
    """The written star with defects planted in the facts by item number and
    product key: unknown parents, negative revenue, missing and repeated
    order ids, overlong status."""
    st = dict(_written_star(L))
    p, i = F.col("product_key"), F.col("order_item_id")
    st["fact_orders"] = st["fact_orders"].select(
        F.when((p % 37 == 0) & (i == 2), F.lit(None)).otherwise(F.col("order_id")).alias("order_id"), "order_item_id",
        F.when(p % 41 == 0, -F.col("customer_key")).when(p % 43 == 0, F.lit(None)).otherwise(F.col("customer_key")).alias("customer_key"),
        F.when(i == 7, p + 100000000).otherwise(p).alias("product_key"),
        F.when(p % 47 == 0, F.date_sub("date_key", 36525)).otherwise(F.col("date_key")).alias("date_key"),
        F.when(i == 5, F.repeat("order_status", 20)).otherwise(F.col("order_status")).alias("order_status"),
        "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
        F.when(p % 31 == 0, -F.col("revenue")).otherwise(F.col("revenue")).cast("decimal(12,2)").alias("revenue"), "price", "freight")
    return st


@register("orphan_facts", _union_all([
    f"SELECT '{t}' AS parent_table, count(*) AS n_orphans FROM broken_fact_v f "
    f"WHERE NOT EXISTS (SELECT 1 FROM {t}_v d WHERE d.{k} = f.{k})"
    for t, k in [("dim_customers", "customer_key"), ("dim_products", "product_key"), ("dim_date", "date_key")]]))
def _orphan_facts(L: Layers) -> DataFrame:
    """Over a fact table with planted orphans (see ``_broken_star``)."""
    st = _broken_star(L)
    return quality.orphan_counts(st["fact_orders"], {
        "dim_customers": (st["dim_customers"], "customer_key"),
        "dim_products": (st["dim_products"], "product_key"),
        "dim_date": (st["dim_date"], "date_key")})


@register("fact_delete_matching", """
SELECT * FROM fact_orders_v f
WHERE EXISTS (SELECT 1 FROM b1_items_v b WHERE b.order_id = f.order_id AND b.order_item_id = f.order_item_id)""")
def _fact_delete_matching(L: Layers) -> DataFrame:
    return maintain.fact_rows_in_batch(L.fact_orders, TwoBatches(L).batch1["order_items"])


# ========================================================= A1-A15 aggregates
def _nulls_sql(view: str, table: str, cols: list[str]) -> str:
    return _union_all([
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS n_rows, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) * 100.0 / CAST(count(*) AS DOUBLE) AS pct_null FROM {view}"
        for c in cols])


@register("profile_nulls", _union_all(
    [_nulls_sql(RAW_VIEW[k], RAW_VIEW[k], RAW_COLS[k]) for k in RAW_COLS]
    + [_nulls_sql(CLEAN_VIEW[k], STAGE_TABLES[k], STAGE_COLUMNS[k]) for k in RAW_COLS]))
def _profile_nulls(L: Layers) -> DataFrame:
    frames = [quality.profile_nulls(L.raw[k], RAW_VIEW[k]) for k in RAW_COLS]
    frames += [quality.profile_nulls(L.clean[k], STAGE_TABLES[k]) for k in RAW_COLS]
    return quality._union(frames)


@register("profile_duplicate_keys", _union_all([
    f"SELECT '{RAW_VIEW[k]}' AS table_name, '{','.join(KEYS[k])}' AS key_columns, CAST(sum(c) AS BIGINT) AS n_rows, "
    f"count(*) AS n_keys, CAST(sum(c - 1) AS BIGINT) AS n_duplicate_rows "
    f"FROM (SELECT count(*) AS c FROM {RAW_VIEW[k]} GROUP BY {', '.join(KEYS[k])})" for k in RAW_COLS]))
def _profile_duplicate_keys(L: Layers) -> DataFrame:
    return quality._union([quality.profile_duplicate_keys(L.raw[k], RAW_VIEW[k], KEYS[k]) for k in RAW_COLS])


@register("profile_duplicate_rows", _union_all([
    f"SELECT '{RAW_VIEW[k]}' AS table_name, CAST(sum(c) AS BIGINT) AS n_rows, count(*) AS n_distinct_rows, "
    f"CAST(sum(c - 1) AS BIGINT) AS n_duplicate_rows "
    f"FROM (SELECT count(*) AS c FROM {RAW_VIEW[k]} GROUP BY ALL_COLS)".replace("ALL_COLS", ", ".join(RAW_COLS[k]))
    for k in RAW_COLS]))
def _profile_duplicate_rows(L: Layers) -> DataFrame:
    return quality._union([quality.profile_duplicate_rows(L.raw[k], RAW_VIEW[k]) for k in RAW_COLS])


@register("count_unique_customers", "SELECT count(*) AS n_rows, count(DISTINCT customer_id) AS n_ids, "
          "count(DISTINCT customer_unique_id) AS n_unique_ids FROM raw_customers")
def _count_unique_customers(L: Layers) -> DataFrame:
    return quality.count_unique(L.raw["customers"], "customer_id", "customer_unique_id")


@register("status_distribution", "SELECT order_status, count(*) AS n_orders FROM clean_orders_v GROUP BY order_status")
def _status_distribution(L: Layers) -> DataFrame:
    return quality.status_distribution(L.clean["orders"])


@register("order_profiles", """
SELECT CASE grouping_id(order_status, status_length, purchase_year) WHEN 3 THEN 'order_status' WHEN 5 THEN 'status_length'
            WHEN 6 THEN 'purchase_year' ELSE 'all' END AS grouping_name,
       coalesce(order_status, status_length, purchase_year) AS grouping_value, count(*) AS n_orders, """
          + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in ORDER_TIMESTAMP_COLUMNS) + """
FROM (SELECT *, CAST(length(order_status) AS VARCHAR) AS status_length,
             CAST(year(order_purchase_timestamp) AS VARCHAR) AS purchase_year FROM clean_orders_v)
GROUP BY GROUPING SETS ((), (order_status), (status_length), (purchase_year))""")
def _order_profiles(L: Layers) -> DataFrame:
    return quality.order_profiles(L.clean["orders"])


@register("distinct_sketches", """
SELECT 'customer_id' AS column_name, count(DISTINCT customer_id) AS n_exact, true AS within_bound
FROM (SELECT * FROM b1_customers_v UNION ALL SELECT * FROM b2_customers_v)
UNION ALL
SELECT 'customer_unique_id', count(DISTINCT customer_unique_id), true
FROM (SELECT * FROM b1_customers_v UNION ALL SELECT * FROM b2_customers_v)""")
def _distinct_sketches(L: Layers) -> DataFrame:
    """HLL sketches kept for two overlapping batches and merged, against the
    exact distinct counts of their union."""
    tb, columns = TwoBatches(L), ["customer_id", "customer_unique_id"]
    batches = {"1": tb.batch1["customers"], "2": tb.batch2["customers"]}
    kept = materialize(quality._union([sketches.batch_sketches(df, b, distinct=columns) for b, df in batches.items()]), "sketches")
    rows = quality._union([df.select(*columns) for df in batches.values()])
    exact = quality._union([rows.groupBy(c).agg(F.count(F.lit(1))).agg(F.count(c).alias("n_exact"))
                            .select(F.lit(c).alias("column_name"), "n_exact") for c in columns])
    bound = F.ceil(F.lit(sketches.DISTINCT_ERROR) * F.col("n_exact"))
    return exact.join(sketches.merged_distinct(kept), "column_name") \
        .select("column_name", "n_exact", (F.abs(F.col("n_distinct") - F.col("n_exact")) <= bound).alias("within_bound"))


_PROBS = [0.25, 0.5, 0.75]


@register("quantile_sketches", _union_all([
    f"SELECT '{c}' AS column_name, CAST({p} AS DOUBLE) AS prob, count({c}) AS n_values, true AS within_bound FROM clean_order_items_v"
    for c in ["price", "freight_value"] for p in _PROBS]))
def _quantile_sketches(L: Layers) -> DataFrame:
    """KLL sketches kept for four disjoint batches of items and merged; the rank
    of each sketched quartile among all items, counted exactly, must be within
    the stated bound (ties: the wanted rank lies between those below and up to it)."""
    items, columns = L.staged_items, ["price", "freight_value"]
    number = F.substring("order_id", 2, 20).cast("long") % 4
    kept = materialize(quality._union([sketches.batch_sketches(items.where(number == b), str(b), ranks=columns) for b in range(4)]), "sketches")
    merged = materialize(sketches.merged_quantiles(kept, _PROBS).coalesce(1), "quantiles")

    def value(c, i):
        return merged.where(F.col("column_name") == c).select(f"q_{i}").scalar()
    counts = items.agg(*[f(F.col(c).cast("double"), value(c, i)).alias(f"{name}__{c}__{i}")
                         for c in columns for i in range(len(_PROBS))
                         for name, f in (("below", lambda v, q: F.count_if(v < q)), ("upto", lambda v, q: F.count_if(v <= q)))])
    ranks = counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(p).alias("prob"), F.col(f"below__{c}__{i}").alias("below"),
                 F.col(f"upto__{c}__{i}").alias("upto")) for c in columns for i, p in enumerate(_PROBS)])))
    wanted, slack = F.col("prob") * F.col("n_values"), F.lit(sketches.RANK_ERROR) * F.col("n_values") + 1
    return ranks.join(merged.select("column_name", "n_values"), "column_name").select(
        "column_name", "prob", "n_values", ((F.col("below") <= wanted + slack) & (F.col("upto") >= wanted - slack)).alias("within_bound"))


@register("zip_length_distribution", "SELECT CAST(length(CAST(customer_zip_code_prefix AS VARCHAR)) AS INTEGER) AS zip_digits, "
          "count(*) AS n_customers FROM raw_customers GROUP BY 1")
def _zip_length_distribution(L: Layers) -> DataFrame:
    return quality.zip_length_distribution(L.raw["customers"])


@register("order_cardinality", """
SELECT count(*) AS n_orders, CAST(sum(n) AS BIGINT) AS n_items, count(*) FILTER (WHERE n > 1) AS n_orders_multi_item,
       max(n) AS max_items, CAST(sum(n) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS mean_items
FROM (SELECT order_id, count(*) AS n FROM clean_order_items_v GROUP BY order_id)""")
def _order_cardinality(L: Layers) -> DataFrame:
    return quality.order_cardinality(L.clean["order_items"])


@register("product_cardinality", """
SELECT count(*) AS n_products, CAST(sum(i) AS BIGINT) AS n_items,
       count(*) FILTER (WHERE i > 1) AS n_products_multi_item, count(*) FILTER (WHERE o > 1) AS n_products_multi_order,
       max(i) AS max_items, max(o) AS max_orders, CAST(sum(i) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS mean_items
FROM (SELECT product_id, count(*) AS i, count(DISTINCT order_id) AS o FROM clean_order_items_v GROUP BY product_id)""")
def _product_cardinality(L: Layers) -> DataFrame:
    return quality.product_cardinality(L.clean["order_items"])


@register("order_revenue", "SELECT order_id, count(*) AS n_items, CAST(sum(revenue) AS DECIMAL(22,6)) AS revenue "
          "FROM clean_order_items_v GROUP BY order_id")
def _order_revenue(L: Layers) -> DataFrame:
    return quality.order_revenue(L.clean["order_items"])


@register("profile_negatives", "SELECT count(*) AS n_rows, count(*) FILTER (WHERE price < 0) AS n_negative_price, "
          "count(*) FILTER (WHERE freight_value < 0) AS n_negative_freight FROM raw_order_items")
def _profile_negatives(L: Layers) -> DataFrame:
    return quality.profile_negatives(cl.null_nans(L.raw["order_items"]))


@register("profile_weight", "SELECT count(*) AS n_rows, count(*) FILTER (WHERE product_weight_g <= 0) AS n_non_positive_weight, "
          "count(*) FILTER (WHERE product_weight_g IS NULL) AS n_null_weight FROM raw_products")
def _profile_weight(L: Layers) -> DataFrame:
    return quality.profile_weight(L.raw["products"])


@register("profile_timeline", """
SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE order_delivered_customer_date IS NOT NULL AND order_purchase_timestamp IS NOT NULL) AS n_with_both,
       count(*) FILTER (WHERE order_delivered_customer_date < order_purchase_timestamp) AS n_delivered_before_purchase
FROM parsed_orders_v""")
def _profile_timeline(L: Layers) -> DataFrame:
    return quality.profile_timeline(cl.parse_order_timestamps(L.raw["orders"]))


@register("missing_delivery_by_status", """
SELECT order_status, count(*) AS n_orders, count(*) FILTER (WHERE order_approved_at IS NULL) AS n_null_approved,
       count(*) FILTER (WHERE order_delivered_carrier_date IS NULL) AS n_null_carrier,
       count(*) FILTER (WHERE order_delivered_customer_date IS NULL) AS n_null_delivered
FROM clean_orders_v GROUP BY order_status""")
def _missing_delivery_by_status(L: Layers) -> DataFrame:
    return quality.missing_delivery_by_status(L.clean["orders"])


_MONEY_COLS = ["price", "freight_value"]


@register("iqr_outliers", _union_all([
    f"SELECT '{c}' AS column_name, (SELECT q1 FROM iqr_{c}_v) AS q1, (SELECT q3 FROM iqr_{c}_v) AS q3, "
    f"(SELECT lower_bound FROM iqr_{c}_v) AS lower_bound, (SELECT upper_bound FROM iqr_{c}_v) AS upper_bound, "
    f"count(*) FILTER (WHERE CAST({c} AS DOUBLE) < (SELECT lower_bound FROM iqr_{c}_v)) AS n_below, "
    f"count(*) FILTER (WHERE CAST({c} AS DOUBLE) > (SELECT upper_bound FROM iqr_{c}_v)) AS n_above, "
    f"count(*) FILTER (WHERE CAST({c} AS DOUBLE) < (SELECT lower_bound FROM iqr_{c}_v) "
    f"OR CAST({c} AS DOUBLE) > (SELECT upper_bound FROM iqr_{c}_v)) AS n_outliers "
    f"FROM clean_order_items_v" for c in _MONEY_COLS]))
def _iqr_outliers(L: Layers) -> DataFrame:
    return outliers.iqr_outliers(L.staged_items, _MONEY_COLS)


@register("iqr_filter", """
SELECT i.* FROM clean_order_items_v i
WHERE CAST(i.price AS DOUBLE) BETWEEN (SELECT lower_bound FROM iqr_price_v) AND (SELECT upper_bound FROM iqr_price_v)
  AND CAST(i.freight_value AS DOUBLE) BETWEEN (SELECT lower_bound FROM iqr_freight_value_v) AND (SELECT upper_bound FROM iqr_freight_value_v)""")
def _iqr_filter(L: Layers) -> DataFrame:
    return outliers.iqr_filter(L.staged_items, _MONEY_COLS)


@register("iqr_cap", """
SELECT i.* REPLACE (
  least(greatest(CAST(i.price AS DOUBLE), (SELECT lower_bound FROM iqr_price_v)), (SELECT upper_bound FROM iqr_price_v)) AS price,
  least(greatest(CAST(i.freight_value AS DOUBLE), (SELECT lower_bound FROM iqr_freight_value_v)), (SELECT upper_bound FROM iqr_freight_value_v)) AS freight_value)
FROM clean_order_items_v i""")
def _iqr_cap(L: Layers) -> DataFrame:
    return outliers.iqr_cap(L.staged_items, _MONEY_COLS)


# ====================================================== K1-K9 keys and star
@register("assign_surrogate_keys", "SELECT row_number() OVER (ORDER BY order_id) AS order_key, order_id FROM clean_orders_v")
def _assign_surrogate_keys(L: Layers) -> DataFrame:
    return keys.assign_surrogate_keys(L.clean["orders"].select("order_id"), "order_id", "order_key")


@register("upsert_customers", "SELECT * FROM dim2c_v")
def _upsert_customers(L: Layers) -> DataFrame:
    return TwoBatches(L).dim_customers_2


@register("upsert_products", "SELECT * FROM dim2p_v")
def _upsert_products(L: Layers) -> DataFrame:
    return TwoBatches(L).dim_products_2


@register("insert_new_dates", """
SELECT * FROM dim_date1_v
UNION ALL
SELECT * FROM dim_date2_v d WHERE NOT EXISTS (SELECT 1 FROM dim_date1_v o WHERE o.date_key = d.date_key)""")
def _insert_new_dates(L: Layers) -> DataFrame:
    return TwoBatches(L).dim_date_2


@register("fact_refresh", """
SELECT * FROM fact1_v f
WHERE NOT EXISTS (SELECT 1 FROM b2_items_v b WHERE b.order_id = f.order_id AND b.order_item_id = f.order_item_id)
UNION ALL
SELECT * FROM fact2_new_v""")
def _fact_refresh(L: Layers) -> DataFrame:
    return TwoBatches(L).fact_2


def _streamed_tables(L: Layers) -> StarTables:
    """Both load batches published to a landing folder and applied by the
    incremental maintenance stream (foreachBatch into the star tables)."""
    from ..streaming.incremental import publish_batch, run_maintenance
    tb = TwoBatches(L)
    landing = new_work_dir(L.spark, "landing")
    publish_batch(L.spark, landing, 1, dict(tb.batch1.items()))
    publish_batch(L.spark, landing, 2, dict(tb.batch2.items()))
    return run_maintenance(L.spark, landing, new_work_dir(L.spark, "star"),
                           new_work_dir(L.spark, "stream-checkpoint"))


@register("stream_fact_refresh", """
SELECT * FROM fact1_v f
WHERE NOT EXISTS (SELECT 1 FROM b2_items_v b WHERE b.order_id = f.order_id AND b.order_item_id = f.order_item_id)
UNION ALL
SELECT * FROM fact2_new_v""")
def _stream_fact_refresh(L: Layers) -> DataFrame:
    return _streamed_tables(L).table("fact_orders")


@register("stream_dim_customers", "SELECT * FROM dim2c_v")
def _stream_dim_customers(L: Layers) -> DataFrame:
    return _streamed_tables(L).table("dim_customers")


@register("load_metrics", _union_all(
    [f"SELECT '{STAGE_TABLES[k]}' AS table_name, 'n_rows' AS metric, count(*) AS n FROM {CLEAN_VIEW[k]}" for k in RAW_COLS]
    + [f"SELECT '{t}', 'n_rows', count(*) FROM {t}_v" for t in ["dim_customers", "dim_products", "dim_date", "fact_orders"]]
    + ["SELECT 'fact_rejects', 'n_rows', count(*) FROM resolved_items_v WHERE reject_reason IS NOT NULL",
       "SELECT 'fact_orders', 'negative_revenue', count(*) FILTER (WHERE revenue < 0) FROM fact_orders_v",
       "SELECT 'fact_orders', 'null_order_id', count(*) FILTER (WHERE order_id IS NULL) FROM fact_orders_v"]))
def _load_metrics(L: Layers) -> DataFrame:
    """Row counts and single-table checks of a first load as its writes saw
    them (``DataFrame.observe``): no table is scanned for them."""
    staged = load_staging_observed(L.spark, dict(L.clean.items()))
    seen = StarTables(L.spark, new_work_dir(L.spark, "star")).apply({k: df for k, (df, _) in staged.items()})
    rows = [(STAGE_TABLES[k], "n_rows", m["n_rows"]) for k, (_, m) in staged.items()]
    rows += [(t, m, n) for t in seen for m, n in seen[t].items() if m != "parts"]
    return L.spark.createDataFrame([(t, m, int(n or 0)) for t, m, n in rows], "table_name string, metric string, n bigint")


def _staged_when_read(batch: dict[str, DataFrame]) -> LazyTables:
    return LazyTables({k: (lambda k=k, df=df: load_staging(df.sparkSession, {k: df})[k]) for k, df in batch.items()})


def _refused(L: Layers, table: str, column: str, value: Callable, message: str) -> DataFrame:
    """A second load with one defect must fail and leave the facts as they were.
    Each table is staged when its load first reads it; the load reads it several times."""
    tb, tables = TwoBatches(L), StarTables(L.spark, new_work_dir(L.spark, "star"))
    tables.apply(_staged_when_read(tb.batch1))
    bad = _staged_when_read(tb.batch2)
    first = bad[table].agg(F.min(KEYS[table][0])).scalar()
    bad[table] = bad[table].unionByName(bad[table].where(F.col(KEYS[table][0]) == first).withColumn(column, value(F.col(column))))
    try:
        tables.apply(bad)
    except Exception as error:
        if message not in str(error):
            raise
        return tables.table("fact_orders")
    raise AssertionError(f"the load accepted a defect in {table}.{column}")


@register("refused_duplicate_key", "SELECT * FROM fact1_v")
def _refused_duplicate_key(L: Layers) -> DataFrame:
    """A customer that occurs twice in a batch."""
    return _refused(L, "customers", "customer_city", lambda c: F.concat(c, F.lit(" again")), "occurs more than once")


@register("refused_long_value", "SELECT * FROM fact1_v")
def _refused_long_value(L: Layers) -> DataFrame:
    """A state of more than 10 characters."""
    return _refused(L, "customers", "customer_state", lambda c: F.lit("a state that is too long"), "is longer than 10")


@register("dim_customers", "SELECT * FROM dim_customers_v")
def _dim_customers(L: Layers) -> DataFrame:
    return L.dim_customers


@register("dim_products", "SELECT * FROM dim_products_v")
def _dim_products(L: Layers) -> DataFrame:
    return L.dim_products


@register("dim_date", "SELECT * FROM dim_date_v")
def _dim_date(L: Layers) -> DataFrame:
    return L.dim_date


@register("fact_orders", "SELECT * FROM fact_orders_v")
def _fact_orders(L: Layers) -> DataFrame:
    return L.fact_orders


@register("rebuild_star", _STAR_COUNT_SQL)
def _rebuild_star(L: Layers) -> DataFrame:
    return quality.row_counts(rebuild_star(L.staged, new_work_dir(L.spark, "star")))


# ===================================================== Q1-Q8 quality checks
def _audit_sql(facts: str) -> str:
    """The five checks by definition: fact keys without a parent (counted per
    key, then weighed), and two conditions on the rows; the verdict sums them."""
    parents = [("orphan_customer", "customer_key", "dim_customers_v"), ("orphan_product", "product_key", "dim_products_v"),
               ("orphan_date", "date_key", "dim_date_v")]
    orphans = " UNION ALL ".join(
        f"SELECT '{name}', (SELECT coalesce(sum(n), 0) FROM (SELECT {key} AS k, count(*) AS n FROM facts GROUP BY ALL) "
        f"WHERE NOT coalesce(k IN (SELECT {key} FROM {parent}), false))" for name, key, parent in parents)
    return f"""
SELECT check_name, CAST(v AS BIGINT) AS n_violations, v = 0 AS passed FROM (
  WITH facts AS (SELECT * FROM {facts}),
  checks(check_name, v) AS (
    {orphans}
    UNION ALL SELECT unnest(['negative_revenue', 'null_order_id']),
                     unnest([count(CASE WHEN revenue < 0 THEN 1 END), count(*) - count(order_id)]) FROM facts)
  SELECT check_name, v FROM checks UNION ALL SELECT 'all_checks', sum(v) FROM checks)"""


@register("audit_star", _audit_sql("fact_orders_v"))
def _audit_star(L: Layers) -> DataFrame:
    return quality.audit_star(_written_star(L))


@register("audit_broken_star", _audit_sql("broken_fact_v"))
def _audit_broken_star(L: Layers) -> DataFrame:
    """The same checks where each of them must find something."""
    return quality.audit_star(_broken_star(L))


_UNIQUE_TABLES = [
    ("stg_customers", "clean_customers_v", ["customer_id"]),
    ("stg_orders", "clean_orders_v", ["order_id"]),
    ("stg_products", "clean_products_v", ["product_id"]),
    ("stg_order_revenue", "clean_order_items_v", ["order_id", "order_item_id"]),
    ("dim_customers", "dim_customers_v", ["customer_key"]),
    ("dim_customers", "dim_customers_v", ["customer_id"]),
    ("dim_products", "dim_products_v", ["product_key"]),
    ("dim_products", "dim_products_v", ["product_id"]),
    ("dim_date", "dim_date_v", ["date_key"]),
    ("fact_orders", "broken_fact_v", ["order_id", "order_item_id"]),
]


@register("check_unique_keys", _union_all([
    f"SELECT '{t}' AS table_name, '{','.join(k)}' AS key_columns, CAST(coalesce(sum(c), 0) AS BIGINT) AS n_rows, "
    f"count(*) AS n_keys, count(*) FILTER (WHERE c > 1) AS n_duplicate_keys "
    f"FROM (SELECT count(*) AS c FROM {v} GROUP BY {', '.join(k)})" for t, v, k in _UNIQUE_TABLES]))
def _check_unique_keys(L: Layers) -> DataFrame:
    """Staged and star tables; the facts hold planted duplicates (null ids)."""
    frames = {STAGE_TABLES[k]: v for k, v in L.staged.items()}
    frames.update(_broken_star(L))
    out = [quality.check_unique_keys({t: (frames[t], k)}) for t, _, k in _UNIQUE_TABLES]
    return quality._union(out)


@register("check_lengths", _union_all([
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, {n} AS max_allowed, CAST(max(length({c})) AS INTEGER) AS max_length, "
    f"count(*) FILTER (WHERE length({c}) > {n}) AS n_over FROM {'broken_fact_v' if t == 'fact_orders' else t + '_v'}" for t, c, n in VARCHAR_BOUNDS]))
def _check_lengths(L: Layers) -> DataFrame:
    return quality.check_lengths(_broken_star(L))


_EDGES = [("stg_customers", "clean_customers_v", "customer_id", "stg_orders", "clean_orders_v", "customer_id"),
          ("stg_orders", "clean_orders_v", "order_id", "stg_order_revenue", "clean_order_items_v", "order_id"),
          ("stg_products", "clean_products_v", "product_id", "stg_order_revenue", "clean_order_items_v", "product_id")]


@register("check_relationships", _union_all([f"""
SELECT '{pt}' AS parent_table, '{ct}' AS child_table, '{ck}' AS key_column,
       CAST(coalesce(sum(pn), 0) AS BIGINT) AS n_parent_rows, count(pn) AS n_parent_keys,
       count(*) FILTER (WHERE pn > 1) AS n_duplicate_parent_keys,
       CAST(coalesce(sum(cn), 0) AS BIGINT) AS n_child_rows,
       CAST(coalesce(sum(CASE WHEN pn IS NULL THEN cn END), 0) AS BIGINT) AS n_orphan_children,
       count(*) FILTER (WHERE cn IS NULL) AS n_childless_parents
FROM (SELECT {pk} AS k, count(*) AS pn FROM {pv} GROUP BY {pk}) p
FULL OUTER JOIN (SELECT {ck} AS k, count(*) AS cn FROM {cv} GROUP BY {ck}) c ON p.k = c.k"""
    for pt, pv, pk, ct, cv, ck in _EDGES]))
def _check_relationships(L: Layers) -> DataFrame:
    names = {"stg_customers": "customers", "stg_orders": "orders", "stg_products": "products",
             "stg_order_revenue": "order_items"}
    return quality._union([
        quality.check_relationship(L.clean[names[pt]], L.clean[names[ct]], pk, ck, pt, ct)
        for pt, _, pk, ct, _, ck in _EDGES])


@register("reject_facts", "SELECT * FROM resolved_items_v WHERE reject_reason IS NOT NULL")
def _reject_facts(L: Layers) -> DataFrame:
    c = L.clean
    dim_c, dim_p = L.both_dims()
    return star.reject_facts(c["order_items"], c["orders"], dim_c, dim_p)


# ========================================================== C1-C7 composites
@register("clean_customers", "SELECT * FROM clean_customers_v")
def _clean_customers(L: Layers) -> DataFrame:
    return L.clean["customers"]


@register("clean_orders", "SELECT * FROM clean_orders_v")
def _clean_orders(L: Layers) -> DataFrame:
    return L.clean["orders"]


@register("clean_products", "SELECT * FROM clean_products_v")
def _clean_products(L: Layers) -> DataFrame:
    return L.clean["products"]


@register("clean_order_items", "SELECT * FROM clean_order_items_v")
def _clean_order_items(L: Layers) -> DataFrame:
    return L.clean["order_items"]


_SUMMARY_SQL = _union_all(
    [f"SELECT 'stage' AS step, '{STAGE_TABLES[k]}' AS table_name, count(*) AS n_rows FROM {CLEAN_VIEW[k]}" for k in RAW_COLS]
    + [f"SELECT 'star', '{t}', count(*) FROM {t}_v" for t in ["dim_customers", "dim_products", "dim_date", "fact_orders"]]
    + ["SELECT 'reject', 'fact_rejects', count(*) FROM resolved_items_v WHERE reject_reason IS NOT NULL",
       "SELECT 'audit', check_name, n_violations FROM (" + _audit_sql("fact_orders_v") + ")"])


@register("end_to_end_summary", _SUMMARY_SQL)
def _end_to_end_summary(L: Layers) -> DataFrame:
    return run(L.spark, L.sf_dir)


@register("rerun_dim_customers", "SELECT * FROM dim2c_v")
def _rerun_dim_customers(L: Layers) -> DataFrame:
    """The job run twice on one output: keys of the first run stay."""
    return _rerun(L).table("dim_customers")


@register("rerun_facts", """
SELECT * FROM fact1_v f
WHERE NOT EXISTS (SELECT 1 FROM b2_items_v b WHERE b.order_id = f.order_id AND b.order_item_id = f.order_item_id)
UNION ALL
SELECT * FROM fact2_new_v""")
def _rerun_facts(L: Layers) -> DataFrame:
    return _rerun(L).table("fact_orders")


def _rerun(L: Layers) -> StarTables:
    tb, root = TwoBatches(L), new_work_dir(L.spark, "run")
    for batch in (tb.batch1, tb.batch2):
        load(L.spark, batch, root)
    return StarTables(L.spark, f"{root}/star")


@register("csv_orders", "SELECT * FROM clean_orders_v")
def _csv_orders(L: Layers) -> DataFrame:
    """Cleaned orders written as CSV, read back and cleaned again: timestamps
    and missing values survive the trip."""
    path = new_work_dir(L.spark, "csv") + "/orders"
    csv_io.write_csv(L.clean["orders"], path)
    return cl.clean_orders(csv_io.read_csv(L.spark, path, csv_io.csv_schemas()["orders"]))


@register("csv_order_items", """
SELECT * FROM clean_order_items_v WHERE CAST(substr(product_id, 2) AS BIGINT) % 29 <> 0""")
def _csv_order_items(L: Layers) -> DataFrame:
    """Raw items through a CSV with its columns in reverse order and missing
    tokens among the numbers: those prices are missing, so the rows are
    filtered like any row without a price."""
    path = new_work_dir(L.spark, "csv") + "/items"
    number = F.substring("product_id", 2, 20).cast("long")
    raw = L.raw["order_items"].withColumn("price", F.when(number % 29 == 0, F.lit("NA")).otherwise(F.col("price").cast("string")))
    rank = Window.partitionBy("order_id", "order_item_id").orderBy("_ord")
    # One row an item, the first in file order, so that the files' order does not matter.
    raw = raw.withColumn("_n", F.row_number().over(rank)).filter("_n = 1").drop("_n", "_ord")
    csv_io.write_csv(raw.select(*reversed(raw.columns)), path)
    return cl.clean_order_items(csv_io.read_csv(L.spark, path, csv_io.csv_schemas()["order_items"]))


# Columns in the order of the file, and by which numbers of a key a row lacks
# its last one, two, ... columns.
_SHORT = {
    "customers": (RAW_COLS["customers"], "customer_id", {7: 1, 11: 2}),
    "orders": (RAW_COLS["orders"], "order_id", {9: 1, 14: 2, 25: 4}),
    "products": (RAW_COLS["products"], "product_id", {13: 1}),
    "order_items": (["order_id", "order_item_id", "product_id", "price", "freight_value", "seller_id", "shipping_limit_date"],
                    "product_id", {17: 1, 19: 2, 23: 3}),
}


def _cut(table: str, column: str) -> str:
    """SQL: whether a row's line ends before ``column``."""
    columns, key, cuts = _SHORT[table]
    behind = len(columns) - columns.index(column)
    number = f"CAST(substr({key}, 2) AS BIGINT)"
    # The largest cut that applies is the row's.
    return " OR ".join([f"{number} % {m} = 0" for m, n in cuts.items() if n >= behind] or ["false"])


def _short_view(table: str, view: str, columns: list[str]) -> str:
    parts = ", ".join(f"CASE WHEN {_cut(table, c)} THEN NULL ELSE {c} END AS {c}" for c in columns)
    return f"(SELECT * REPLACE ({parts}) FROM {view})"


def _short_csv(L: Layers, table: str) -> str:
    """The raw table (first row of every key) as CSV files in which some lines
    lack their last fields; every file has the header."""
    columns, key, cuts = _SHORT[table]
    raw = dedup.keep_first(L.raw[table], KEYS[table])
    options = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "escape": '"'}
    number = F.substring(key, 2, 20).cast("long")
    line = F.to_csv(F.struct(*columns), options)
    for m, n in sorted(cuts.items(), key=lambda x: x[1]):
        line = F.when(number % m == 0, F.to_csv(F.struct(*columns[:-n]), options)).otherwise(line)
    path = new_work_dir(L.spark, "csv") + f"/short_{table}"
    raw.select(line.alias(",".join(columns))).write.option("header", "true").option("sep", "\x01").option("quote", "\x00") \
        .option("escapeQuotes", "false").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    return path


_TOKENS = ", ".join(f"'{t}'" for t in MISSING_TOKENS)
_SHORT_SQL = {
    "customers": f"SELECT * REPLACE (CASE WHEN customer_state IN ({_TOKENS}) THEN NULL ELSE customer_state END AS customer_state) FROM "
                 + _short_view("customers", "clean_customers_v", ["customer_city", "customer_state"]),
    "orders": "SELECT * FROM (SELECT order_id, customer_id, order_status, "
              + ", ".join(f"try_strptime({c}, {TS}) AS {c}" for c in ORDER_TIMESTAMP_COLUMNS) + " FROM "
              + _short_view("orders", "dedup_orders_v", ORDER_TIMESTAMP_COLUMNS[1:])
              + ") WHERE order_delivered_customer_date IS NULL OR order_delivered_customer_date >= order_purchase_timestamp",
    "products": f"SELECT * FROM clean_products_v WHERE NOT ({_cut('products', 'product_width_cm')})",
    "order_items": "SELECT * FROM " + _short_view("order_items", "clean_order_items_v", ["seller_id", "shipping_limit_date"])
                   + f" WHERE NOT ({_cut('order_items', 'freight_value')})",
}

for _name in _SHORT:
    def _make_short(name):
        @register(f"csv_short_{name}", _SHORT_SQL[name])
        def _q(L: Layers) -> DataFrame:
            """Lines with missing trailing fields are read as rows with nulls."""
            return cl.CLEANERS[name](csv_io.read_csv(L.spark, _short_csv(L, name), csv_io.csv_schemas()[name]))
        return _q
    _make_short(_name)


@register("csv_malformed_rows", _union_all([
    f"SELECT '{k}' AS table_name, {len(cols)} - n AS n_fields, {len(cols)} AS expected_fields, count(*) AS n_rows "
    f"FROM (SELECT CASE " + " ".join(f"WHEN CAST(substr({key}, 2) AS BIGINT) % {m} = 0 THEN {n}"
                                     for m, n in sorted(cuts.items(), key=lambda x: -x[1]))
    + f" ELSE 0 END AS n FROM dedup_{k}_v) WHERE n > 0 GROUP BY n" for k, (cols, key, cuts) in _SHORT.items()]))
def _csv_malformed_rows(L: Layers) -> DataFrame:
    """The quarantine report of the same files: lines by table and number of fields."""
    return quality._union([
        csv_io.malformed_rows(L.spark, _short_csv(L, k)).groupBy("n_fields", "expected_fields").agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(k).alias("table_name"), "n_fields", "expected_fields", "n_rows") for k in _SHORT])
