"""Data-quality profiles (A1-A14) and integrity checks.

Every profile of one table is a single aggregate pass (all counters in one
``agg``), and grouped profiles use two-level aggregation rather than
``count(DISTINCT ...)`` over wide inputs, so each shuffle carries partial
aggregates, never raw rows of a hot group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ORDER_TIMESTAMP_COLUMNS, VARCHAR_BOUNDS


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _ratio(num: Column, den: Column, scale: float = 1.0) -> Column:
    """Floating ratio computed the same way in every engine (plain IEEE ops)."""
    return num.cast("double") * F.lit(scale) / den.cast("double")


# -------------------------------------------------------------- A1, S5
def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) for each table; one global count per table."""
    return _union([df.agg(F.count(F.lit(1)).alias("n_rows"))
                   .select(F.lit(name).alias("table_name"), "n_rows")
                   for name, df in tables.items()])


# -------------------------------------------------------------- A2
def profile_nulls(df: DataFrame, table_name: str) -> DataFrame:
    """Missing count and percent of rows for every column, one pass."""
    cols = [c for c in df.columns if c != "_ord"]
    one = df.agg(F.count(F.lit(1)).alias("n_rows"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = one.unpivot(["n_rows"], cols, "column_name", "n_null")
    return long.select(F.lit(table_name).alias("table_name"), "column_name", "n_rows", "n_null",
                       _ratio(F.col("n_null"), F.col("n_rows"), 100.0).alias("pct_null"))


# -------------------------------------------------------------- A3
def profile_duplicate_keys(df: DataFrame, table_name: str, keys: list[str]) -> DataFrame:
    """Rows beyond the first per key; null keys count as equal."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(F.sum("_c").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"),
                 F.sum(F.col("_c") - 1).alias("n_duplicate_rows")) \
        .select(F.lit(table_name).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"),
                "n_rows", "n_keys", "n_duplicate_rows")


# -------------------------------------------------------------- A4
def profile_duplicate_rows(df: DataFrame, table_name: str) -> DataFrame:
    """Rows beyond the first that equal it in every column (NULLs equal).

    One grouping by all columns: copies collapse in the map tasks, so a row
    crosses the shuffle once per task that holds it.
    """
    cols = [c for c in df.columns if c != "_ord"]
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
    return groups.agg(F.coalesce(F.sum("_c"), F.lit(0)).cast("long").alias("n_rows"),
                      F.count(F.lit(1)).alias("n_distinct_rows")) \
        .select(F.lit(table_name).alias("table_name"), "n_rows", "n_distinct_rows",
                (F.col("n_rows") - F.col("n_distinct_rows")).alias("n_duplicate_rows"))


# -------------------------------------------------------------- A5
def count_unique(df: DataFrame, key: str, person_key: str) -> DataFrame:
    """Rows, distinct ``key`` and distinct ``person_key`` (exact, nulls not
    counted). Each column is grouped on its own with partial aggregation; two
    distinct counts in one aggregate would multiply every row before the shuffle."""
    ids = df.groupBy(key).agg(F.count(F.lit(1)).alias("_c")) \
        .agg(F.coalesce(F.sum("_c"), F.lit(0)).cast("long").alias("n_rows"), F.count(key).alias("n_ids"))
    persons = df.groupBy(person_key).agg(F.count(F.lit(1))).agg(F.count(person_key))
    return ids.withColumn("n_unique_ids", persons.scalar())


# -------------------------------------------------------------- A6, A14
def status_distribution(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_status").agg(F.count(F.lit(1)).alias("n_orders"))


def missing_delivery_by_status(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.count_if(F.col("order_approved_at").isNull()).alias("n_null_approved"),
        F.count_if(F.col("order_delivered_carrier_date").isNull()).alias("n_null_carrier"),
        F.count_if(F.col("order_delivered_customer_date").isNull()).alias("n_null_delivered"),
    )


# -------------------------------------------------------------- A7
def zip_length_distribution(customers: DataFrame) -> DataFrame:
    digits = F.length(F.col("customer_zip_code_prefix").cast("string")).cast("int")
    return customers.groupBy(digits.alias("zip_digits")).agg(F.count(F.lit(1)).alias("n_customers"))


# -------------------------------------------------------------- A2, A6, A7, A14 at once
ORDER_GROUPINGS = {"all": [], "order_status": ["order_status"], "status_length": ["status_length"],
                   "purchase_year": ["purchase_year"]}


def order_profiles(orders: DataFrame) -> DataFrame:
    """All grouped profiles of the orders in one pass and one shuffle: per
    grouping (none, status, length of the status, year of purchase) and value the
    number of orders and of missing dates. Partial aggregation leaves a few rows
    a task, whatever the number of orders."""
    rows = orders.select("order_status", F.length("order_status").alias("status_length"),
                         F.year("order_purchase_timestamp").alias("purchase_year"),
                         *[F.col(c).isNull().cast("int").alias(f"null_{c}") for c in ORDER_TIMESTAMP_COLUMNS])
    columns = [c for c in ORDER_GROUPINGS if c != "all"]
    grouped = rows.groupingSets([list(map(F.col, g)) for g in ORDER_GROUPINGS.values()], *map(F.col, columns))
    out = grouped.agg(F.grouping_id().alias("_g"), F.count(F.lit(1)).alias("n_orders"),
                      *[F.sum(f"null_{c}").alias(f"null_{c}") for c in ORDER_TIMESTAMP_COLUMNS])
    # The grouping id has a bit for every column that is not grouped by, the first column in the highest bit.
    ids = {sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in g): name for name, g in ORDER_GROUPINGS.items()}
    name, value = F.lit("all"), F.lit(None).cast("string")
    for i, n in ids.items():
        if n != "all":
            name = F.when(F.col("_g") == i, F.lit(n)).otherwise(name)
            value = F.when(F.col("_g") == i, F.col(n).cast("string")).otherwise(value)
    return out.select(name.alias("grouping_name"), value.alias("grouping_value"), "n_orders",
                      *[F.coalesce(F.col(f"null_{c}"), F.lit(0)).cast("long").alias(f"null_{c}") for c in ORDER_TIMESTAMP_COLUMNS])


# -------------------------------------------------------------- A8, A9
def order_cardinality(items: DataFrame) -> DataFrame:
    """Items per order: orders with items, with more than one, max, mean."""
    per = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("_n").alias("n_items"),
        F.count_if(F.col("_n") > 1).alias("n_orders_multi_item"),
        F.max("_n").alias("max_items"),
    ).withColumn("mean_items", _ratio(F.col("n_items"), F.col("n_orders")))


def product_cardinality(items: DataFrame) -> DataFrame:
    """Repetition of products, counted both as items and as distinct orders."""
    per_pair = items.groupBy("product_id", "order_id").agg(F.count(F.lit(1)).alias("_i"))
    per = per_pair.groupBy("product_id").agg(F.sum("_i").alias("_items"), F.count(F.lit(1)).alias("_orders"))
    return per.agg(
        F.count(F.lit(1)).alias("n_products"), F.sum("_items").alias("n_items"),
        F.count_if(F.col("_items") > 1).alias("n_products_multi_item"),
        F.count_if(F.col("_orders") > 1).alias("n_products_multi_order"),
        F.max("_items").alias("max_items"), F.max("_orders").alias("max_orders"),
    ).withColumn("mean_items", _ratio(F.col("n_items"), F.col("n_products")))


# -------------------------------------------------------------- A10
def order_revenue(items: DataFrame) -> DataFrame:
    """Exact revenue (price + freight) per order."""
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum("revenue").cast("decimal(22,6)").alias("revenue"))


# -------------------------------------------------------------- A11-A13
def profile_negatives(items: DataFrame) -> DataFrame:
    return items.agg(F.count(F.lit(1)).alias("n_rows"),
                     F.count_if(F.col("price") < 0).alias("n_negative_price"),
                     F.count_if(F.col("freight_value") < 0).alias("n_negative_freight"))


def profile_weight(products: DataFrame) -> DataFrame:
    return products.agg(F.count(F.lit(1)).alias("n_rows"),
                        F.count_if(F.col("product_weight_g") <= 0).alias("n_non_positive_weight"),
                        F.count_if(F.col("product_weight_g").isNull()).alias("n_null_weight"))


def profile_timeline(orders: DataFrame) -> DataFrame:
    d, p = F.col("order_delivered_customer_date"), F.col("order_purchase_timestamp")
    return orders.agg(F.count(F.lit(1)).alias("n_rows"),
                      F.count_if(d.isNotNull() & p.isNotNull()).alias("n_with_both"),
                      F.count_if(d < p).alias("n_delivered_before_purchase"))


# -------------------------------------------------------------- J4, Q1-Q4
def orphan_counts(fact: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(parent_table, n_orphans): facts whose key has no parent row.

    The fact keys are counted first (partial aggregation in the scan stage,
    one column read), so each anti-join shuffles one row per distinct key,
    not one per fact row. A null key never matches and counts as an orphan.
    """
    return _union([
        fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        .join(dim.select(key), key, "left_anti")
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n_orphans"))
        .select(F.lit(name).alias("parent_table"), "n_orphans")
        for name, (dim, key) in dims.items()
    ])


AUDIT_PARENTS = {"orphan_customer": ("dim_customers", "customer_key"),
                 "orphan_product": ("dim_products", "product_key"),
                 "orphan_date": ("dim_date", "date_key")}


# The single-table checks: conditions counted over the facts, by a scan or by the
# tasks that write them.
FACT_CHECKS = {"negative_revenue": lambda: F.count_if(F.col("revenue") < 0),
               "null_order_id": lambda: F.count_if(F.col("order_id").isNull())}


def audit_star(star: dict[str, DataFrame], observed: dict[str, int] | None = None) -> DataFrame:
    """The five post-load checks and the verdict.

    Orphan checks use the pre-aggregated anti-joins of ``orphan_counts``;
    the two single-table checks are one aggregate over two fact columns, or
    what the load ``observed`` while it wrote the facts (then no scan).
    The verdict row ``all_checks`` passes only if every count is zero; a
    failure is reported, never raised.
    """
    fact = star["fact_orders"]
    orphans = orphan_counts(fact, {check: (star[t], k) for check, (t, k) in AUDIT_PARENTS.items()}) \
        .select(F.col("parent_table").alias("check_name"), F.col("n_orphans").alias("n_violations"))
    if observed is None:
        single = fact.agg(*[condition().alias(c) for c, condition in FACT_CHECKS.items()]) \
            .unpivot([], list(FACT_CHECKS), "check_name", "n_violations")
    else:
        single = fact.sparkSession.createDataFrame([(c, int(observed[c] or 0)) for c in FACT_CHECKS],
                                                   "check_name string, n_violations bigint")
    checks = orphans.unionByName(single)
    total = checks.agg(F.sum("n_violations").cast("long").alias("n_violations")) \
        .select(F.lit("all_checks").alias("check_name"), "n_violations")
    return checks.unionByName(total).withColumn("passed", F.col("n_violations") == 0)


# -------------------------------------------------------------- Q5
def check_unique_keys(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """(table_name, key_columns, n_rows, n_keys, n_duplicate_keys)."""
    return _union([
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
        .agg(F.sum("_c").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"),
             F.count_if(F.col("_c") > 1).alias("n_duplicate_keys"))
        .select(F.lit(name).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"),
                F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"), "n_keys", "n_duplicate_keys")
        for name, (df, keys) in tables.items()
    ])


# -------------------------------------------------------------- Q7
def check_lengths(star: dict[str, DataFrame]) -> DataFrame:
    """VARCHAR(n) bounds: longest value and values over the bound. One
    aggregate a table, whose single row is then split by column."""
    out = []
    for table in dict.fromkeys(t for t, _, _ in VARCHAR_BOUNDS):
        bounds = [(c, n) for t, c, n in VARCHAR_BOUNDS if t == table]
        one = star[table].agg(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.lit(n).alias("max_allowed"),
                     F.max(F.length(c)).cast("int").alias("max_length"), F.count_if(F.length(c) > n).alias("n_over"))
            for c, n in bounds]).alias("checks"))
        out.append(one.select(F.lit(table).alias("table_name"), F.inline("checks")))
    return _union(out)


# -------------------------------------------------------------- Q8
def check_relationship(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str,
                       parent_name: str, child_name: str) -> DataFrame:
    """Parent-key uniqueness and coverage in both directions for one edge."""
    p = parent.groupBy(F.col(parent_key).alias("_k")).agg(F.count(F.lit(1)).alias("_pn"))
    c = child.groupBy(F.col(child_key).alias("_k")).agg(F.count(F.lit(1)).alias("_cn"))
    j = p.join(c, "_k", "full_outer")
    return j.agg(
        F.coalesce(F.sum("_pn"), F.lit(0)).cast("long").alias("n_parent_rows"),
        F.count_if(F.col("_pn").isNotNull()).alias("n_parent_keys"),
        F.count_if(F.col("_pn") > 1).alias("n_duplicate_parent_keys"),
        F.coalesce(F.sum("_cn"), F.lit(0)).cast("long").alias("n_child_rows"),
        F.coalesce(F.sum(F.when(F.col("_pn").isNull(), F.col("_cn"))), F.lit(0)).cast("long")
        .alias("n_orphan_children"),
        F.count_if(F.col("_cn").isNull()).alias("n_childless_parents"),
    ).select(F.lit(parent_name).alias("parent_table"), F.lit(child_name).alias("child_table"),
             F.lit(child_key).alias("key_column"), "*")
