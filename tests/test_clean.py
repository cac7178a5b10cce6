"""De-duplication and cleaning jobs on hand-made raw frames."""

from decimal import Decimal

from martforge.operators import clean as cl
from martforge.operators.dedup import keep_first
from martforge.schemas import RAW_CUSTOMERS, RAW_ORDER_ITEMS, RAW_ORDERS, RAW_PRODUCTS


def with_ord(spark, rows, schema):
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    return spark.createDataFrame(rows, f"{fields}, _ord int")


def test_keep_first_null_keys_count_as_equal(spark):
    df = spark.createDataFrame([(None, "a", 2), (None, "b", 1), ("k", "c", 5), ("k", "d", 3)],
                               "k string, v string, _ord int")
    got = sorted((r.k or "", r.v) for r in keep_first(df, ["k"]).collect())
    assert got == [("", "b"), ("k", "d")]


def test_keep_first_on_hot_key_keeps_one_row(spark):
    # A third of all rows share one key; the result still holds one row for it.
    rows = [("hot", i) for i in range(3000)] + [(f"k{i}", i) for i in range(6000)]
    df = spark.createDataFrame(rows, "k string, _ord int").repartition(8)
    out = keep_first(df, ["k"], drop_order=False)
    assert out.count() == 6001
    assert out.where("k = 'hot'").collect()[0]._ord == 0


def test_customers_clean(spark):
    raw = with_ord(spark, [
        ("C1", "U1", 1234, "  sao paulo ", "SP", 0),
        ("C1", "U1", 1234, "other", "ZZ", 1),
        ("C2", "U2", 123456, "\td'oeste\n", "MG", 0),
        ("C3", "U3", None, None, "RJ", 0),
    ], RAW_CUSTOMERS)
    got = {r.customer_id: r for r in cl.clean_customers(raw).collect()}
    assert got["C1"].customer_city == "Sao Paulo" and got["C1"].customer_state == "SP"
    assert got["C1"].customer_zip_code_prefix == "01234"
    assert got["C2"].customer_city == "D'Oeste" and got["C2"].customer_zip_code_prefix == "123456"
    assert got["C3"].customer_zip_code_prefix is None and got["C3"].customer_city is None


def test_orders_dedup_before_timeline_filter(spark):
    ts = ["2017-10-02 10:00:00", None, None, "2017-10-01 00:00:00", "2017-10-20 00:00:00"]
    raw = with_ord(spark, [
        ("O1", "C1", "delivered", *ts, 0),                                       # delivered before purchase
        ("O1", "C1", "delivered", "2017-10-02 10:00:00", None, None, "2017-10-05 00:00:00", None, 1),
        ("O2", "C1", "shipped", "2017-10-02 10:00:00", None, "not-a-date", None, None, 0),
        ("O3", "C1", "delivered", None, None, None, "2017-10-05 00:00:00", None, 0),  # no purchase time
    ], RAW_ORDERS)
    got = {r.order_id: r for r in cl.clean_orders(raw).collect()}
    # The first O1 row fails the filter, so O1 is lost although its copy would pass.
    assert set(got) == {"O2"}
    assert got["O2"].order_delivered_carrier_date is None


def test_products_first_row_invalid_loses_key(spark):
    raw = with_ord(spark, [
        ("P1", None, "10", "400,5", "1", 0, 10, 10, 10, 0),
        ("P1", "x", "10", "400,5", "1", 100, 10, 10, 10, 1),
        ("P2", None, "12", "480,5", "2", 200, 10, -1, 10, 0),
        ("P3", None, "12", "480,5", "2", None, 10, 10, 10, 0),
        ("P4", None, "12", "480,5", "2", 300, 10, 10, 10, 0),
    ], RAW_PRODUCTS)
    got = cl.clean_products(raw).collect()
    assert [r.product_id for r in got] == ["P4"]
    assert got[0].product_category_name == "unknown"
    assert got[0].product_description_lenght == Decimal("480.5")


def test_order_items_money_filter_and_exact_revenue(spark):
    raw = with_ord(spark, [
        ("O1", 1, "P1", "S1", "2017-10-02 10:00:00", 0.1, 0.2, 0),
        ("O1", 1, "P1", "S1", "2017-10-02 10:00:00", 99.0, 0.2, 1),
        ("O1", 2, "P1", "S1", "bad", -1.0, 0.2, 0),
        ("O1", 3, "P1", "S1", "bad", float("nan"), 0.2, 0),
    ], RAW_ORDER_ITEMS)
    got = cl.clean_order_items(raw).collect()
    assert len(got) == 1
    assert got[0].revenue == Decimal("0.3")  # exact, not 0.30000000000000004
    assert got[0].price == Decimal("0.1")


def test_product_distinct_is_a_no_op_after_dedup(spark):
    """The source's SELECT DISTINCT on the product dimension is dropped
    because de-duplication already makes product_id unique."""
    from martforge.operators.star import dim_product_rows
    from martforge.plans.context import Layers
    from tests.conftest import SF_SMALL
    rows = dim_product_rows(Layers(spark, SF_SMALL).clean["products"])
    assert rows.count() == rows.distinct().count() == rows.select("product_id").distinct().count()


def test_rejected_item_with_huge_price_does_not_fail_the_load(spark):
    from martforge.operators.star import resolve_items
    items = spark.createDataFrame(
        [("O9", 1, "P1", Decimal("99999999999999"), Decimal("1")), ("O1", 1, "P1", Decimal("5"), Decimal("1"))],
        "order_id string, order_item_id int, product_id string, price decimal(20,6), freight_value decimal(20,6)")
    orders = spark.createDataFrame(
        [("O1", "C1", "delivered", None, None, None, None, None)],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
        "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
        "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz")
    dim_c = spark.createDataFrame([(1, "C1")], "customer_key long, customer_id string")
    dim_p = spark.createDataFrame([(1, "P1")], "product_key long, product_id string")
    got = {r.order_id: r.reject_reason for r in resolve_items(items, orders, dim_c, dim_p).collect()}
    assert got == {"O9": "no_order", "O1": "no_date"}


def test_nan_weight_is_dropped(spark):
    raw = spark.createDataFrame(
        [("P1", "a", "1", "2", "3", float("nan"), 1.0, 1.0, 1.0, 0),
         ("P2", "b", "1", "2", "3", 5.0, 1.0, 1.0, 1.0, 0)],
        "product_id string, product_category_name string, product_name_lenght string, "
        "product_description_lenght string, product_photos_qty string, product_weight_g double, "
        "product_length_cm double, product_height_cm double, product_width_cm double, _ord int")
    assert [r.product_id for r in cl.clean_products(raw).collect()] == ["P2"]


def test_zip_padded_in_staging_but_int_in_dimension(spark):
    from martforge.operators.star import build_dim_customers
    raw = with_ord(spark, [("C1", "U1", 1234, "x", "SP", 0)], RAW_CUSTOMERS)
    staged = cl.clean_customers(raw)
    assert staged.collect()[0].customer_zip_code_prefix == "01234"
    assert build_dim_customers(staged).collect()[0].customer_zip_code_prefix == 1234
