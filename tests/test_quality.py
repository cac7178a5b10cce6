"""Checks, profiles and pipeline invariants."""

from pyspark.sql import functions as F

from martforge.operators import quality
from martforge.plans.context import Layers
from martforge.plans.jobs import run
from tests.conftest import SF_SMALL


def test_check_lengths_flags_long_city(spark):
    city = "x" * 101
    dim_c = spark.createDataFrame([(1, "C1", "U1", 1, city, "SP")],
                                  "customer_key long, customer_id string, customer_unique_id string, "
                                  "customer_zip_code_prefix int, customer_city string, customer_state string")
    dim_p = spark.createDataFrame([(1, "P1", "cat")], "product_key long, product_id string, product_category_name string")
    fact = spark.createDataFrame([("O1", "delivered")], "order_id string, order_status string")
    out = {(r.table_name, r.column_name): r for r in
           quality.check_lengths({"dim_customers": dim_c, "dim_products": dim_p, "fact_orders": fact}).collect()}
    assert out[("dim_customers", "customer_city")].n_over == 1
    assert out[("dim_customers", "customer_city")].max_length == 101
    assert out[("dim_customers", "customer_id")].n_over == 0


def test_audit_detects_orphans_and_negative_revenue(spark):
    fact = spark.createDataFrame([("O1", 1, 1, None, -1.0), (None, 2, 9, None, 5.0)],
                                 "order_id string, customer_key long, product_key long, date_key date, revenue double")
    dims = {"dim_customers": spark.createDataFrame([(1,)], "customer_key long"),
            "dim_products": spark.createDataFrame([(1,)], "product_key long"),
            "dim_date": spark.createDataFrame([], "date_key date")}
    out = {r.check_name: (r.n_violations, r.passed) for r in quality.audit_star({**dims, "fact_orders": fact}).collect()}
    assert out == {"orphan_customer": (1, False), "orphan_product": (1, False), "orphan_date": (2, False),
                   "negative_revenue": (1, False), "null_order_id": (1, False), "all_checks": (6, False)}


def test_pipeline_invariants(spark):
    summary = {(r.step, r.table_name): r.n_rows for r in run(spark, SF_SMALL).collect()}
    # Expected figures of FIXTURES.md at sf0.001.
    assert summary[("stage", "stg_customers")] == 150
    assert summary[("stage", "stg_orders")] == 1474
    assert summary[("stage", "stg_products")] == 197
    assert summary[("stage", "stg_order_revenue")] == 4547
    assert summary[("star", "dim_date")] == 1080
    assert summary[("star", "fact_orders")] == 4405
    assert summary[("reject", "fact_rejects")] == 142
    assert summary[("stage", "stg_order_revenue")] == summary[("star", "fact_orders")] + summary[("reject", "fact_rejects")]
    assert summary[("audit", "all_checks")] == 0


def test_fact_revenue_equals_order_revenue(spark):
    L = Layers(spark, SF_SMALL)
    fact = L.fact_orders
    total = fact.agg(F.sum("revenue")).collect()[0][0]
    assert str(total) == "384402872.02"
    facts_items = L.clean["order_items"].join(fact.select("order_id", "order_item_id"), ["order_id", "order_item_id"], "left_semi")
    per_order = quality.order_revenue(facts_items).agg(F.sum("revenue")).collect()[0][0]
    assert per_order == total


def test_reject_reasons(spark):
    from martforge.operators.star import reject_facts
    L = Layers(spark, SF_SMALL)
    c = L.clean
    got = {r.reject_reason: r["count"] for r in
           reject_facts(c["order_items"], c["orders"], L.dim_customers, L.dim_products)
           .groupBy("reject_reason").count().collect()}
    assert got == {"no_order": 73, "no_customer": 3, "no_product": 63, "no_date": 3}


def test_command_line_runs_the_load():
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-m", "martforge", "--tables", SF_SMALL, "--master", "local[2]"],
                         cwd=root, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "fact_orders" in out.stdout and "4405" in out.stdout


def test_sketches_merge_within_their_bounds(spark):
    import numpy as np

    from martforge.operators import sketches
    from martforge.session import materialize
    rng = np.random.default_rng(4)
    values = rng.lognormal(size=30_000)
    df = spark.createDataFrame([(int(v * 1000) % 5000, float(v), i % 3) for i, v in enumerate(values)], "k int, v double, b int") \
        .withColumn("v", F.when(F.col("k") != 17, F.col("v")))
    kept = materialize(sketches.batch_sketches(df.where("b = 0"), "0", ["k"], ["v"]).unionByName(
        sketches.batch_sketches(df.where("b > 0"), "1", ["k"], ["v"])).unionByName(
        sketches.batch_sketches(df.where("false"), "2", ["k"], ["v"])), "t")
    exact = df.select("k").distinct().count()
    got = {r.column_name: r.n_distinct for r in sketches.merged_distinct(kept).collect()}
    assert set(got) == {"k"} and abs(got["k"] - exact) <= sketches.DISTINCT_ERROR * exact + 1
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    row = sketches.merged_quantiles(kept, probs).collect()
    assert [r.column_name for r in row] == ["v"]
    known = np.sort([r.v for r in df.where("v IS NOT NULL").collect()])
    assert row[0].n_values == len(known)
    for i, p in enumerate(probs):
        assert abs(np.searchsorted(known, row[0][f"q_{i}"]) / len(known) - p) <= sketches.RANK_ERROR


def test_order_profiles_take_one_shuffle(spark):
    from martforge.operators.quality import order_profiles
    orders = spark.createDataFrame([("O1", None, None), ("O2", "shipped", None)], "order_id string, order_status string, t string")
    for c in ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
              "order_delivered_customer_date", "order_estimated_delivery_date"]:
        orders = orders.withColumn(c, F.lit(None).cast("timestamp_ntz"))
    out = order_profiles(orders)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    got = sorted(map(str, out.select("grouping_name", "grouping_value", "n_orders", "null_order_approved_at").collect()))
    assert len(got) == 6  # all; two statuses; two lengths; one year (none)
    assert order_profiles(orders.limit(0)).count() == 0


def test_distinct_counts_do_not_expand_rows(spark):
    from martforge.operators.quality import count_unique
    df = spark.createDataFrame([("a", "x"), ("a", None), (None, "x"), ("b", "y")], "k string, p string")
    out = count_unique(df, "k", "p")
    assert tuple(out.first()) == (4, 2, 2)
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    assert tuple(count_unique(df.limit(0), "k", "p").first()) == (0, 0, 0)
