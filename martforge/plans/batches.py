"""The two-batch load used to exercise incremental maintenance.

Both batches are derived from the cleaned tables (so they grow with the
input): batch 1 holds customers whose number is not a multiple of 3, orders
and items of even order numbers and all products. Batch 2 holds most of
everything, with changed attributes -- customer_state / product_category_name
set to NULL where the number ends in 0 and to 'XX' where it ends in 5. It
leaves out some customers, products, orders and items, and re-sends items
whose order it does not hold.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import maintain, star
from ..schemas import DIM_CUSTOMER_ATTRS, DIM_PRODUCT_ATTRS
from ..session import run_concurrently
from .context import Layers


def key_number(c: str) -> Column:
    """The number inside a natural key such as ``C123``."""
    return F.substring(F.col(c), 2, 1 << 20).try_cast("int")


def _changed(col: str, key: str) -> Column:
    k = key_number(key) % 10
    return F.when(k == 0, F.lit(None).cast("string")).when(k == 5, F.lit("XX")).otherwise(F.col(col))


class TwoBatches:
    def __init__(self, layers: Layers):
        self.L = layers

    @cached_property
    def batch1(self) -> dict[str, DataFrame]:
        c = self.L.clean
        return {
            "customers": c["customers"].where(key_number("customer_id") % 3 != 0),
            "orders": c["orders"].where(key_number("order_id") % 2 == 0),
            "products": c["products"],
            "order_items": c["order_items"].where(key_number("order_id") % 2 == 0),
        }

    @cached_property
    def batch2(self) -> dict[str, DataFrame]:
        c = self.L.clean
        return {
            "customers": c["customers"].where(key_number("customer_id") % 7 != 3)
            .withColumn("customer_state", _changed("customer_state", "customer_id")),
            "orders": c["orders"].where(key_number("order_id") % 13 != 2),
            "products": c["products"].where(key_number("product_id") % 11 != 5).withColumn(
                "product_category_name", _changed("product_category_name", "product_id")),
            "order_items": c["order_items"].where(key_number("order_id") % 5 != 1),
        }

    # state after batch 1 ------------------------------------------------
    @cached_property
    def dim_customers_1(self) -> DataFrame:
        return star.build_dim_customers(self.batch1["customers"])

    @cached_property
    def dim_products_1(self) -> DataFrame:
        return star.build_dim_products(self.batch1["products"])

    @cached_property
    def dim_date_1(self) -> DataFrame:
        return star.build_dim_date(self.batch1["orders"])

    def _both(self, suffix: str) -> None:
        names = [f"dim_customers_{suffix}", f"dim_products_{suffix}"]
        if not any(n in self.__dict__ for n in names):
            cls = type(self)
            self.__dict__.update(run_concurrently({n: (lambda n=n: cls.__dict__[n].func(self)) for n in names}))

    @cached_property
    def fact_1(self) -> DataFrame:
        b = self.batch1
        self._both("1")
        return star.build_fact_orders(b["order_items"], b["orders"], self.dim_customers_1, self.dim_products_1)

    # state after batch 2 ------------------------------------------------
    @cached_property
    def dim_customers_2(self) -> DataFrame:
        rows = star.dim_customer_rows(self.batch2["customers"])
        return maintain.upsert_dimension(self.dim_customers_1, rows, "customer_id", "customer_key",
                                         DIM_CUSTOMER_ATTRS)

    @cached_property
    def dim_products_2(self) -> DataFrame:
        rows = star.dim_product_rows(self.batch2["products"])
        return maintain.upsert_dimension(self.dim_products_1, rows, "product_id", "product_key",
                                         DIM_PRODUCT_ATTRS)

    @cached_property
    def dim_date_2(self) -> DataFrame:
        return maintain.insert_if_absent(self.dim_date_1, star.build_dim_date(self.batch2["orders"]),
                                         ["date_key"])

    @cached_property
    def fact_2(self) -> DataFrame:
        b = self.batch2
        fact_1 = self.fact_1
        self._both("2")
        new = star.build_fact_orders(b["order_items"], b["orders"], self.dim_customers_2, self.dim_products_2)
        return maintain.refresh_facts(fact_1, b["order_items"], new)
