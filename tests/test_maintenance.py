"""Incremental maintenance: upsert, insert-ignore, fact refresh, idempotence."""

import pytest
from pyspark.sql import functions as F

from martforge.operators import maintain
from martforge.operators.star import build_dim_customers
from martforge.plans.batches import TwoBatches
from martforge.plans.context import Layers
from tests.conftest import SF_SMALL


def test_upsert_matched_null_overwrites_and_keys_stay(spark):
    dim = spark.createDataFrame([(1, "a", "SP"), (2, "b", "RJ"), (3, "c", "MG")],
                                "key long, id string, state string")
    batch = spark.createDataFrame([("b", None), ("c", "XX"), ("d", "PR"), ("e", "BA")],
                                  "id string, state string")
    out = {r.id: (r.key, r.state) for r in maintain.upsert_dimension(dim, batch, "id", "key", ["state"]).collect()}
    assert out == {"a": (1, "SP"), "b": (2, None), "c": (3, "XX"), "d": (4, "PR"), "e": (5, "BA")}


def test_upsert_is_idempotent(spark):
    dim = spark.createDataFrame([(1, "a", "SP")], "key long, id string, state string")
    batch = spark.createDataFrame([("a", "RJ"), ("b", "MG")], "id string, state string")
    once = maintain.upsert_dimension(dim, batch, "id", "key", ["state"])
    twice = maintain.upsert_dimension(once, batch, "id", "key", ["state"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_insert_ignore_first_row_wins(spark):
    existing = spark.createDataFrame([("a", 1)], "k string, v int")
    batch = spark.createDataFrame([("a", 9, 0), ("b", 2, 1), ("b", 3, 0)], "k string, v int, _ord int")
    out = sorted(map(tuple, maintain.insert_ignore(existing, batch, ["k"], ["_ord"]).collect()))
    assert out == [("a", 1), ("b", 3)]


def test_refresh_deletes_resent_items_that_no_longer_join(spark):
    cols = "order_id string, order_item_id int, v int"
    fact = spark.createDataFrame([("O1", 1, 10), ("O1", 2, 20), ("O2", 1, 30)], cols)
    batch_items = spark.createDataFrame([("O1", 1), ("O1", 2)], "order_id string, order_item_id int")
    new_facts = spark.createDataFrame([("O1", 1, 11)], cols)  # O1/2 no longer joins
    out = sorted(map(tuple, maintain.refresh_facts(fact, batch_items, new_facts).collect()))
    assert out == [("O1", 1, 11), ("O2", 1, 30)]


def test_two_batch_load(spark):
    tb = TwoBatches(Layers(spark, SF_SMALL))
    d1 = {r.customer_id: r.customer_key for r in tb.dim_customers_1.collect()}
    d2 = {r.customer_id: r.customer_key for r in tb.dim_customers_2.collect()}
    assert all(d2[k] == v for k, v in d1.items())                    # old keys kept
    new = [v for k, v in d2.items() if k not in d1]
    assert len(set(d2.values())) == len(d2) and min(new) > max(d1.values())
    f1, f2 = tb.fact_1, tb.fact_2
    sent = tb.batch2["order_items"].select("order_id", "order_item_id")
    stay = f1.join(sent, ["order_id", "order_item_id"], "left_anti").count()
    assert 0 < stay < f1.count()                                      # facts absent from the batch stay
    gone = f1.join(sent, ["order_id", "order_item_id"], "left_semi") \
        .join(f2, ["order_id", "order_item_id"], "left_anti").count()
    assert gone > 0                                                   # re-sent items of vanished orders go
    left_out = {r.customer_id for r in tb.batch1["customers"].join(tb.batch2["customers"], "customer_id", "left_anti").collect()}
    assert left_out and left_out <= set(d2)                           # dimensions never shrink
    dup = f2.groupBy("order_id", "order_item_id").count().where("count > 1").count()
    assert dup == 0


def test_third_batch_drops_facts_of_invalidated_orders(spark):
    L = Layers(spark, SF_SMALL)
    clean = L.clean
    fact = L.fact_orders
    some = clean["orders"].select("order_id").orderBy("order_id").limit(5)
    orders3 = clean["orders"].join(some, "order_id", "left_anti")     # these orders vanish
    items3 = clean["order_items"].join(some, "order_id", "left_semi")  # but their items are re-sent
    from martforge.operators.star import build_fact_orders
    new = build_fact_orders(items3, orders3, L.dim_customers, L.dim_products)
    out = maintain.refresh_facts(fact, items3, new)
    gone = out.join(some, "order_id", "left_semi").count()
    assert gone == 0
    assert out.count() == fact.count() - fact.join(some, "order_id", "left_semi").count()


def test_rebuild_gives_equal_dimension(spark):
    L = Layers(spark, SF_SMALL)
    a = build_dim_customers(L.clean["customers"])
    b = build_dim_customers(L.clean["customers"])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.agg(F.min("customer_key"), F.max("customer_key")).collect()[0][:] == (1, a.count())


def small_tables(spark, buckets=4):
    from martforge.session import new_work_dir
    from martforge.sources.star_tables import StarTables
    tb = TwoBatches(Layers(spark, SF_SMALL))
    tables = StarTables(spark, new_work_dir(spark, "test-star"), buckets)
    tables.apply(tb.batch1)
    return tables, tb.batch2


def contents(tables):
    return {t: sorted(map(str, df.collect())) for t, df in tables.tables().items()}


def empty_batch(batch, **tables):
    return {k: tables.get(k, df.limit(0)) for k, df in batch.items()}


def test_an_emptied_month_loses_its_partition_rows(spark):
    from martforge.session import new_work_dir
    from martforge.sources.star_tables import StarTables
    c = Layers(spark, SF_SMALL).clean
    tables = StarTables(spark, new_work_dir(spark, "test-star"), 2)
    tables.apply(dict(c.items()))
    before = tables.table("fact_orders")
    month = before.select(F.date_format("date_key", "yyyyMM").alias("m")).groupBy("m").count() \
        .orderBy(F.desc("count"), "m").first()["m"]
    gone = before.where(F.date_format("date_key", "yyyyMM") == month).select("order_id").distinct()
    gone = spark.createDataFrame(gone.collect(), gone.schema)  # freeze before the files change
    n_before = before.count()
    n_gone = before.join(gone, "order_id", "left_semi").count()
    # The items of the month are sent again while their orders disappear.
    batch = empty_batch(c, order_items=c["order_items"].join(gone, "order_id", "left_semi"))
    tables.apply(batch)
    after = tables.table("fact_orders")
    assert after.where(F.date_format("date_key", "yyyyMM") == month).count() == 0
    assert after.count() == n_before - n_gone
    tables.apply(batch)  # again: nothing changes
    assert tables.table("fact_orders").count() == n_before - n_gone


def test_a_batch_applied_twice_changes_nothing(spark):
    tables, batch2 = small_tables(spark)
    first = contents(tables)
    tables.apply(batch2)
    second = contents(tables)
    assert second != first and tables.table("fact_rejects").count() > 0
    tables.apply(batch2)
    assert contents(tables) == second


@pytest.mark.parametrize("cut_off", ["staged", "one table replaced"])
def test_a_load_that_was_cut_off_is_finished_by_the_next(spark, monkeypatch, cut_off):
    """The driver dies after staging, or while partitions are being replaced."""
    import shutil

    from martforge.sources.star_tables import StarTables
    tables, batch2 = small_tables(spark)
    whole, _ = small_tables(spark)
    whole.apply(batch2)
    want = contents(whole)

    class Died(Exception):
        pass

    def die(self):
        if cut_off == "one table replaced":  # a replaced partition is lost half-way
            self._replace("dim_customers", self._read("dim_customers", "staged/"), {"n": F.count(F.lit(1))})
            shutil.rmtree(sorted(glob.glob(f"{self.root.removeprefix('file://')}/fact_orders/purchase_month=*"))[3])
        raise Died
    import glob
    with monkeypatch.context() as m:
        m.setattr(StarTables, "publish", die)
        with pytest.raises(Died):
            tables.apply(batch2)
    again = StarTables(spark, tables.root, 4)
    if cut_off == "staged":
        again.recover()
        assert contents(again) == want
    again.apply(batch2)
    got = contents(again)
    if cut_off == "staged":
        assert got == want
    else:  # months that the batch does not touch are not in its staged content
        assert got["dim_customers"] == want["dim_customers"] and set(want["fact_orders"]) >= set(got["fact_orders"])


def test_an_unreadable_table_is_not_an_empty_one(spark):
    import glob
    tables, batch2 = small_tables(spark)
    part = glob.glob(tables.root.removeprefix("file://") + "/dim_date/part-*")[0]
    with open(part, "wb") as f:
        f.write(b"not parquet")
    with pytest.raises(Exception):
        tables.apply(batch2)


def test_a_batch_of_one_key_reads_and_writes_one_bucket(spark):
    import glob
    import os
    tables, batch2 = small_tables(spark, buckets=8)
    root = tables.root.removeprefix("file://")

    def files():
        return {p: os.path.getmtime(p) for p in glob.glob(f"{root}/dim_customers/key_bucket=*/*.parquet")}
    before = files()
    assert len({os.path.dirname(p) for p in before}) == 8
    one = batch2["customers"].orderBy("customer_id").limit(1).withColumn("customer_state", F.lit("QQ"))
    after, changed, buckets = tables._stage_dimension(
        "dim_customers", star_rows(one), "customer_id", "customer_key",
        ["customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"])
    assert len(buckets) == 1
    read = tables._read("dim_customers").where(F.col("key_bucket").isin(buckets))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and f"key_bucket#" in plan.split("PartitionFilters")[1]
    assert {f.split("key_bucket=")[1].split("/")[0] for f in changed.inputFiles()} == {str(buckets[0])}
    tables.apply(empty_batch(batch2, customers=one))
    kept = {p for p in before if f"key_bucket={buckets[0]}/" not in p}
    assert {p: t for p, t in files().items() if p in kept} == {p: before[p] for p in kept}
    assert tables.table("dim_customers").where("customer_state = 'QQ'").count() == 1


def star_rows(customers):
    from martforge.operators.star import dim_customer_rows
    return dim_customer_rows(customers)


@pytest.mark.parametrize("defect", ["duplicate item", "duplicate customer", "null key", "long id", "long status"])
def test_a_load_that_breaks_a_constraint_changes_nothing(spark, defect):
    tables, batch2 = small_tables(spark)
    first, bad = contents(tables), dict(batch2.items())
    if defect == "duplicate item":
        item = bad["order_items"].join(bad["orders"].select("order_id"), "order_id", "left_semi").orderBy("order_id").limit(3)
        bad["order_items"] = bad["order_items"].unionByName(item)
    elif defect == "duplicate customer":
        bad["customers"] = bad["customers"].unionByName(bad["customers"].limit(1))
    elif defect == "null key":
        bad["products"] = bad["products"].withColumn("product_id", F.when(F.col("product_id") != "P7", F.col("product_id")))
    elif defect == "long id":
        bad["customers"] = bad["customers"].unionByName(bad["customers"].limit(1).withColumn("customer_id", F.lit("C" * 51)))
    else:
        bad["orders"] = bad["orders"].withColumn("order_status", F.repeat("order_status", 20))
    with pytest.raises(Exception, match="occurs more than once|is null|is longer than 50"):
        tables.apply(bad)
    assert contents(tables) == first
    tables.apply(batch2)  # the repaired batch loads
    assert contents(tables)["fact_orders"] != first["fact_orders"]


def test_observed_counts_are_those_of_a_scan(spark):
    from martforge.plans.jobs import _totals
    tables, batch2 = small_tables(spark)
    seen = tables.apply(batch2)
    total = _totals(tables, seen)
    assert {t: total[t]["n_rows"] for t in total} == {t: df.count() for t, df in tables.tables().items()}
    assert seen["fact_rejects"]["n_rows"] == tables.table("fact_rejects").count()
    none = tables.apply(empty_batch(batch2))
    assert {t: m["n_rows"] or 0 for t, m in none.items()} == dict.fromkeys(none, 0)
    assert _totals(tables, none) == total
