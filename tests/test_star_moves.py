"""What the star loads move: narrow look-ups, one grouping of keys, staged tables read many times."""

import pytest
from pyspark.sql import functions as F

from martforge.operators import star
from martforge.plans import registry
from martforge.schemas import STAGE_COLUMNS
from martforge.session import new_work_dir
from martforge.sources.star_tables import MONTH, STATUS, StarTables


def staged_rows(spark, customers=("C1", "C2")):
    day = "timestamp_ntz'2020-01-15 10:00:00'"
    orders = spark.sql(f"SELECT 'O' || id order_id, 'C' || (id % 2 + 1) customer_id, 'delivered' order_status, "
                       + ", ".join(f"{day} {c}" for c in STAGE_COLUMNS["orders"][3:]) + " FROM range(1, 5)")
    items = spark.sql(f"SELECT 'O' || id order_id, 1 order_item_id, 'P1' product_id, 'S1' seller_id, {day} shipping_limit_date, "
                      "cast(2 as decimal(20,6)) price, cast(1 as decimal(20,6)) freight_value, cast(3 as decimal(20,6)) revenue FROM range(1, 6)")
    products = spark.createDataFrame([("P1", "x", *[1.0] * 7)], ", ".join(
        f"{c} {'string' if i < 2 else 'double'}" for i, c in enumerate(STAGE_COLUMNS["products"])))
    people = spark.createDataFrame([(c, "U", "01234", "city", "SP") for c in customers],
                                   ", ".join(f"{c} string" for c in STAGE_COLUMNS["customers"]))
    return {"customers": people, "orders": orders, "products": products, "order_items": items}


@pytest.mark.parametrize("build", [star.build_fact_orders, star.resolve_items])
def test_products_are_looked_up_before_the_items_are_wide(spark, build):
    s = staged_rows(spark)
    dim_c = spark.createDataFrame([("C1", 1), ("C2", 2)], "customer_id string, customer_key long")
    dim_p = spark.createDataFrame([("P1", 1)], "product_id string, product_key long")
    facts = build(s["order_items"], s["orders"], dim_c, dim_p)
    joins = [x for x in facts._jdf.queryExecution().analyzed().toString().splitlines() if "Join " in x]
    assert "order_id" in joins[0] and any("product_id" in j for j in joins[1:])
    assert facts.where("product_key = 1 AND revenue = 3").count() == 4


def test_a_repeated_customer_stops_the_load_before_its_items_are_resolved(spark):
    import os
    tables = StarTables(spark, new_work_dir(spark, "test"), 2)
    with pytest.raises(Exception, match=r"dim_customers: key \(customer_id\) occurs more than once: C1"):
        tables.apply(staged_rows(spark, ("C1", "C1", "C2")))
    assert os.path.exists(f"{tables.root.removeprefix('file:')}/staged/dim_customers")
    assert not os.path.exists(f"{tables.root.removeprefix('file:')}/staged/items")
    assert tables.table("fact_orders").count() == 0


def test_one_grouping_finds_replaced_facts_and_repeated_ones(spark):
    items = spark.createDataFrame([("O1", 1, "fact"), ("O2", 1, "no_order"), ("O2", 1, "no_order"), ("O3", 1, "fact"), (None, 1, "no_order")],
                                  f"order_id string, order_item_id int, {STATUS} string")
    old = spark.createDataFrame([("O1", 1, 202001), ("O2", 1, 202002), ("O4", 1, 202003)], f"order_id string, order_item_id int, {MONTH} int")
    found = StarTables._replaced(items, old)
    assert sorted(map(tuple, found.collect())) == [("O1", 1, 202001), ("O2", 1, 202002)]
    twice = items.unionByName(items.where("order_id = 'O3'"))
    with pytest.raises(Exception, match=r"fact_orders: key \(order_id, order_item_id\) occurs more than once: O3, 1"):
        StarTables._replaced(twice, old).collect()


def test_a_refused_load_reads_staged_tables(spark):
    batch = {k: df.where(F.rand(1) >= 0) for k, df in staged_rows(spark).items()}
    staged = registry._staged_when_read(batch)
    assert not dict.keys(staged)  # nothing is written for a table that is not read
    assert staged["order_items"] is staged["order_items"] and staged["order_items"].inputFiles()
    assert list(dict.keys(staged)) == ["order_items"]
    assert sorted(staged["order_items"].columns) == sorted(batch["order_items"].columns)


def test_each_check_writes_the_star_it_reads(spark, monkeypatch):
    from martforge.plans.context import Layers
    roots = []
    monkeypatch.setattr(registry, "rebuild_star", lambda staged, root: roots.append(root) or {"fact_orders": staged})
    for _ in range(2):
        layers = Layers(spark, "/no/folder")
        layers.__dict__["staged"] = {}
        registry._written_star(layers)
    assert len(set(roots)) == 2


def test_facts_are_dealt_out_by_month_once(spark):
    """Staged facts are plain files; the table alone is written by month."""
    import os
    root = new_work_dir(spark, "test")

    class Stopped(StarTables):
        def publish(self):
            raise KeyboardInterrupt
    with pytest.raises(KeyboardInterrupt):
        Stopped(spark, root, 2).apply(staged_rows(spark))
    staged = f"{root.removeprefix('file:')}/staged"
    assert not [f for t in ("items", "kept") for f in os.listdir(f"{staged}/{t}") if "=" in f]
    tables = StarTables(spark, root, 2)
    tables.recover()
    assert tables.table("fact_orders").count() == 4 and os.listdir(f"{root.removeprefix('file:')}/fact_orders").count(f"{MONTH}=202001") == 1
    tables.apply(staged_rows(spark))
    assert tables.table("fact_orders").count() == 4 and tables._read("fact_rejects").count() == 1
