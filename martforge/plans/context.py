"""Lazily built layers of one pipeline run over one input folder.

Each property is a DataFrame plan; nothing executes until a sink or an
action asks for it. The eager steps are the written rank tables inside
surrogate-key assignment (they freeze the keys before facts look them up)
and the staged tables that multi-pass operators read.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import clean as cl
from ..operators import star
from ..session import materialize, run_concurrently
from ..sources import fixtures
from ..sources.staging import load_staging


class LazyTables(dict):
    """A name -> DataFrame mapping whose plans are built on first access."""

    def __init__(self, builders):
        super().__init__()
        self._builders = builders

    def __missing__(self, key):
        df = self[key] = self._builders[key]()
        return df

    def keys(self):
        return self._builders.keys()

    def items(self):
        return [(k, self[k]) for k in self._builders]

    def values(self):
        return [self[k] for k in self._builders]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self):
        return len(self._builders)


class Layers:
    """Layers of one run. The raw tables are the fixture views over the
    driver tables in ``sf_dir``, or any four raw DataFrames passed as
    ``raw_tables`` (e.g. from the CSV source)."""

    def __init__(self, spark: SparkSession, sf_dir: str | None = None,
                 raw_tables: dict[str, DataFrame] | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        if raw_tables is not None:
            self.__dict__["raw"] = LazyTables({k: (lambda v=v: v) for k, v in raw_tables.items()})

    # raw -----------------------------------------------------------------
    @cached_property
    def raw(self) -> "LazyTables":
        builders = {"customers": fixtures.raw_customers, "orders": fixtures.raw_orders,
                    "products": fixtures.raw_products, "order_items": fixtures.raw_order_items}
        return LazyTables({k: (lambda b=b: b(self.spark, self.sf_dir)) for k, b in builders.items()})

    # staging (cleaned) ----------------------------------------------------
    @cached_property
    def clean(self) -> "LazyTables":
        return LazyTables({k: (lambda k=k: cl.CLEANERS[k](self.raw[k])) for k in cl.CLEANERS})

    # star -----------------------------------------------------------------
    @cached_property
    def dim_customers(self) -> DataFrame:
        return star.build_dim_customers(self.clean["customers"])

    @cached_property
    def dim_products(self) -> DataFrame:
        return star.build_dim_products(self.clean["products"])

    @cached_property
    def dim_date(self) -> DataFrame:
        return star.build_dim_date(self.clean["orders"])

    def both_dims(self) -> tuple[DataFrame, DataFrame]:
        """Customer and product dimensions; when both are still to be built,
        their key assignments run as concurrent jobs."""
        if "dim_customers" not in self.__dict__ and "dim_products" not in self.__dict__:
            built = run_concurrently({
                "dim_customers": lambda: star.build_dim_customers(self.clean["customers"]),
                "dim_products": lambda: star.build_dim_products(self.clean["products"])})
            self.__dict__.update(built)
        return self.dim_customers, self.dim_products

    @cached_property
    def fact_orders(self) -> DataFrame:
        dim_c, dim_p = self.both_dims()
        return star.build_fact_orders(self.clean["order_items"], self.clean["orders"], dim_c, dim_p)

    @cached_property
    def star(self) -> dict[str, DataFrame]:
        self.both_dims()
        return {"dim_customers": self.dim_customers, "dim_products": self.dim_products,
                "dim_date": self.dim_date, "fact_orders": self.fact_orders}

    # written ---------------------------------------------------------------
    @cached_property
    def staged_items(self) -> DataFrame:
        """The cleaned items written once as a staging table, for operators
        that read them in several passes (quartiles, then counts)."""
        return materialize(self.clean["order_items"], "stg_order_revenue")

    @cached_property
    def staged(self) -> dict[str, DataFrame]:
        """S3: the cleaned tables written as staging tables."""
        return load_staging(self.spark, self.clean)
