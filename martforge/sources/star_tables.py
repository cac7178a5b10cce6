"""The star as plain partitioned Parquet tables, maintained batch by batch.

Layout under ``root``::

    dim_customers/key_bucket=<n>/      by a hash of the natural key
    dim_products/key_bucket=<n>/
    dim_date/                          appended to
    fact_orders/purchase_month=<yyyymm>/
    fact_rejects/                      items of the last batch that did not become facts
    key_sequence/<dimension>/          largest surrogate key given out, one row a batch
    staged/                            the new content of what a batch changes, until it is published

A batch (K2-K4) touches some partitions: the buckets of its customers and
products, the months of its facts, and the months that hold old rows of its
keys (a purchase date may have moved). The new content of these is written under
``staged`` with all constraints checked (Q5-Q7); then Spark's dynamic partition
overwrite replaces them in the tables. A batch that breaks a constraint fails
before any table is changed.

Applying a batch twice gives the same tables: an upsert, an insert of absent
days and a delete-and-insert by key change nothing when repeated. So a stream
needs no more than its checkpoint to resume, and a job that was cut off is run
again. If it was cut off while partitions were being replaced, the staged content
is complete and is published again first, as replaced partitions cannot be computed
a second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import maintain, star
from ..operators.constraints import check_unique, enforce_rows, repeated
from ..operators.quality import FACT_CHECKS
from ..schemas import DIM_CUSTOMER_ATTRS, DIM_PRODUCT_ATTRS, FACT_COLUMNS, FACT_KEYS, STAR_SCHEMAS, STAR_TABLES
from ..session import run_concurrently
from .staging import write_observed, write_table

MONTH, BUCKET, STATUS = "purchase_month", "key_bucket", "load_status"
DIM_KEYS = ("dim_customers", "dim_products")
PARTITION = {"dim_customers": BUCKET, "dim_products": BUCKET, "fact_orders": MONTH}
SEQUENCE = "last_key bigint"
TOUCHED = "table_name string, part int"
DIM_BUCKETS = 32


def month_of(c: str = "date_key") -> Column:
    return (F.year(F.col(c)) * 100 + F.month(F.col(c))).cast("int")


class StarTables:
    def __init__(self, spark: SparkSession, root: str, dim_buckets: int = DIM_BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.dim_buckets = dim_buckets  # part of the layout: the same for every batch

    # ------------------------------------------------------------------ read
    def _schema(self, table: str) -> T.StructType:
        part = [T.StructField(PARTITION[table], T.IntegerType())] if table in PARTITION else []
        return T.StructType([*STAR_SCHEMAS[table].fields, *part])

    def _read(self, table: str, folder: str = "") -> DataFrame:
        return self.spark.read.schema(self._schema(table)).parquet(f"{self.root}/{folder}{table}")

    def table(self, name: str) -> DataFrame:
        return self._read(name).select(*STAR_SCHEMAS[name].names)

    def tables(self) -> dict[str, DataFrame]:
        return {t: self.table(t) for t in STAR_TABLES}

    def untouched(self, name: str, parts: list[int]) -> DataFrame:
        """The rows of a partitioned table in other partitions than ``parts``."""
        return self._read(name).where(~F.col(PARTITION[name]).isin(parts))

    def create(self) -> None:
        """CREATE IF NOT EXISTS: tables that are not there become empty ones. A
        table that is there but cannot be read stays an error of its reader."""
        schemas = {t: self._schema(t) for t in STAR_SCHEMAS} | {f"key_sequence/{t}": SEQUENCE for t in DIM_KEYS}
        for t, schema in schemas.items():
            writer = self.spark.createDataFrame([], schema).write.mode("ignore")
            (writer.partitionBy(PARTITION[t]) if t in PARTITION else writer).parquet(f"{self.root}/{t}")

    # ----------------------------------------------------------------- write
    def apply(self, staged: dict[str, DataFrame]) -> dict:
        """K2-K4 for one staged batch (the first one fills empty tables). Returns
        what the writes observed, see ``publish``."""
        self.create()
        self.recover()
        dims = run_concurrently({
            "dim_customers": lambda: self._stage_dimension(
                "dim_customers", star.dim_customer_rows(staged["customers"]), "customer_id", "customer_key", DIM_CUSTOMER_ATTRS),
            "dim_products": lambda: self._stage_dimension(
                "dim_products", star.dim_product_rows(staged["products"]), "product_id", "product_key", DIM_PRODUCT_ATTRS),
            "dim_date": lambda: write_table(
                enforce_rows(star.build_dim_date(staged["orders"]), "dim_date"), f"{self.root}/staged/dim_date")})
        (customers, new_customers, c_buckets), (products, new_products, p_buckets) = dims["dim_customers"], dims["dim_products"]
        # Before the facts look the keys up: a batch with a repeated key stops here.
        check_unique({"dim_customers": new_customers, "dim_products": new_products})
        months = self._stage_facts(staged, customers, products)
        # Written last: the staged content is complete.
        parts = {"dim_customers": c_buckets, "dim_products": p_buckets, "fact_orders": months}
        write_table(self.spark.createDataFrame([(t, p) for t in parts for p in parts[t]], TOUCHED).coalesce(1), self._touched())
        return self.publish()

    def _stage_dimension(self, table: str, rows: DataFrame, natural_key: str, key: str,
                         attrs: list[str]) -> tuple[DataFrame, DataFrame, list[int]]:
        """K2 for the buckets that hold a key of the batch: (the dimension after
        the batch, its changed buckets, their numbers)."""
        bucket = F.pmod(F.xxhash64(natural_key), F.lit(self.dim_buckets)).cast("int")
        touched = sorted(r[0] for r in rows.select(bucket.alias("b")).distinct().collect())
        current = self._read(table)
        sequence = f"{self.root}/key_sequence/{table}"
        last = self.spark.read.schema(SEQUENCE).parquet(sequence).agg(F.coalesce(F.max("last_key"), F.lit(0))).first()[0]
        after = maintain.upsert_dimension(current.where(F.col(BUCKET).isin(touched)).drop(BUCKET), rows, natural_key, key,
                                          attrs, start_after=F.lit(last))
        after = enforce_rows(after, table).withColumn(BUCKET, bucket).hint("rebalance", BUCKET)
        changed, seen = write_observed(after, f"{self.root}/staged/{table}", {"last_key": F.max(key)}, [BUCKET])
        if (seen["last_key"] or 0) > last:  # before the keys are published; a batch that fails leaves a gap
            self.spark.createDataFrame([(seen["last_key"],)], SEQUENCE).coalesce(1).write.mode("append").parquet(sequence)
        return current.where(~F.col(BUCKET).isin(touched)).unionByName(changed), changed, touched

    def _stage_facts(self, staged: dict[str, DataFrame], customers: DataFrame, products: DataFrame) -> list[int]:
        """K4: resolve every item once (Q6), and for each month that the batch
        touches write its new facts and the old ones that stay."""
        resolved = star.resolve_items(staged["order_items"], staged["orders"], customers, products) \
            .withColumn(STATUS, F.coalesce(F.col("reject_reason"), F.lit("fact"))).withColumn(MONTH, month_of())
        resolved = enforce_rows(resolved, "fact_orders", where=F.col(STATUS) == "fact")
        # Staged as the joins leave them: rows are dealt out and sorted by month once, when they are published.
        items, new = write_observed(resolved, f"{self.root}/staged/items", {
            "months": F.collect_set(F.when(F.col(STATUS) == "fact", F.col(MONTH)))})
        current = self._read("fact_orders")
        replaced, seen = write_observed(self._replaced(items, current), f"{self.root}/staged/replaced",
                                        {"months": F.collect_set(MONTH)})  # one number a calendar month
        months = sorted({*(seen["months"] or []), *(new["months"] or [])})
        stay = current.where(F.col(MONTH).isin(months)).join(replaced.select(*FACT_KEYS), FACT_KEYS, "left_anti")
        write_table(stay, f"{self.root}/staged/kept")
        return months

    @staticmethod
    def _replaced(items: DataFrame, current: DataFrame) -> DataFrame:
        """Key and month of the old facts whose key is in the batch. Fails if two
        new facts have one key (Q5). Both come from one grouping of the keys, which
        are the only columns it moves."""
        batch = items.select(*FACT_KEYS, (F.col(STATUS) == "fact").cast("int").alias("_new"), F.lit(None).cast("int").alias(MONTH))
        old = current.select(*FACT_KEYS, F.lit(None).cast("int").alias("_new"), F.col(MONTH))
        keys = batch.unionByName(old).groupBy(*FACT_KEYS).agg(
            F.sum("_new").alias("_new"), F.max(MONTH).alias(MONTH))  # _new: null if not in the batch, 0 if rejected
        found = F.when(F.col("_new") > 1, repeated("fact_orders", FACT_KEYS).cast("int")).otherwise(F.col(MONTH))
        return keys.where("_new IS NOT NULL").select(*FACT_KEYS, found.alias(MONTH)).where(F.col(MONTH).isNotNull())

    def _touched(self) -> str:
        return f"{self.root}/staged/touched"

    def _files(self, path: str):
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), folder, jvm

    def recover(self) -> None:
        """Publish what a batch that was cut off had staged completely."""
        fs, folder, jvm = self._files(self._touched())
        if fs.exists(jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")):
            self.publish()

    def publish(self) -> dict:
        """Replace the touched partitions by the staged ones. Returns, by table,
        the touched partitions and what the write observed of their new rows."""
        touched = self.spark.read.schema(TOUCHED).parquet(self._touched()).collect()
        parts = {t: [r["part"] for r in touched if r["table_name"] == t] for t in PARTITION}
        kinds = T.StructType([*STAR_SCHEMAS["fact_orders"].fields, T.StructField("reject_reason", T.StringType()),
                              T.StructField(STATUS, T.StringType()), T.StructField(MONTH, T.IntegerType())])
        items = self.spark.read.schema(kinds).parquet(f"{self.root}/staged/items")
        kept = self.spark.read.schema(self._schema("fact_orders")).parquet(f"{self.root}/staged/kept")
        facts = items.where(F.col(STATUS) == "fact").select(*FACT_COLUMNS, MONTH).unionByName(kept.select(*FACT_COLUMNS, MONTH))
        rows = {"n_rows": F.count(F.lit(1))}
        seen = run_concurrently({
            "dim_customers": lambda: self._replace("dim_customers", self._read("dim_customers", "staged/"), rows),
            "dim_products": lambda: self._replace("dim_products", self._read("dim_products", "staged/"), rows),
            "dim_date": lambda: self._insert_days(),
            "fact_orders": lambda: self._replace(
                "fact_orders", facts.hint("rebalance", MONTH), {**rows, **{c: condition() for c, condition in FACT_CHECKS.items()}}, parts["fact_orders"]),
            "fact_rejects": lambda: write_observed(
                items.where(F.col(STATUS) != "fact").select("order_id", "order_item_id", "reject_reason"),
                f"{self.root}/fact_rejects", rows)[1]})
        fs, folder, _ = self._files(self._touched())
        fs.delete(folder, True)  # first: what is left of the others is no complete batch
        fs.delete(folder.getParent(), True)
        return {t: {**seen[t], "parts": parts.get(t, [])} for t in seen}

    def _replace(self, table: str, rows: DataFrame, metrics: dict, parts: list[int] | None = None) -> dict:
        """Overwrite the partitions that ``rows`` hold, and empty those of
        ``parts`` that they do not (a month whose last facts are gone)."""
        column, path = PARTITION[table], f"{self.root}/{table}"
        held = {**metrics, "held": F.collect_set(column)} if parts else metrics  # at most one value a touched partition
        seen = write_observed(rows, path, held, [column], dynamic=True)[1]
        for part in set(parts or []) - set(seen.pop("held", None) or []):
            self.spark.createDataFrame([], STAR_SCHEMAS[table]).write.mode("overwrite").parquet(f"{path}/{column}={part}")
        return seen

    def _insert_days(self) -> dict:
        """K3: days that are not there yet are appended."""
        current = self._read("dim_date")
        days = self._read("dim_date", "staged/").join(current.select("date_key"), "date_key", "left_anti")
        return write_observed(days.select(*STAR_SCHEMAS["dim_date"].names).coalesce(1), f"{self.root}/dim_date",
                              {"n_rows": F.count(F.lit(1))}, mode="append")[1]
