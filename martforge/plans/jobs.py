"""Composite jobs: star rebuild (C6, K5) and the end-to-end run.

Materialisation points: staging, dimensions (their keys must be frozen
before facts look them up), facts. Each is written to a fresh versioned
folder under the shared checkpoint root; only counts and the audit verdict
reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality, star
from ..schemas import FACT_COLUMNS, STAGE_TABLES, STAR_TABLES
from ..session import new_work_dir, run_concurrently
from ..sources.csv import write_csv
from ..sources.staging import load_staging_observed, write_table
from ..sources.star_tables import PARTITION, StarTables
from .context import Layers


FACT_STATUS = "load_status"
MONTH = "purchase_month"


def load_star(staged: dict[str, DataFrame], root: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Drop-and-create all four star tables from staging.

    Dimensions are written first (their keys are frozen before any fact
    looks them up). Facts and rejects come out of one pass over the items:
    every item is resolved with left joins and written once, partitioned by
    ``load_status`` ('fact' or the reject reason); the fact table is the
    'fact' partition and the rejects are the others, so the item table is
    shuffled once, not once per output. Inside, the facts are partitioned by
    purchase month, so readers filtering on dates prune whole folders.
    """
    dims = run_concurrently({
        "dim_customers": lambda: write_table(star.build_dim_customers(staged["customers"]), f"{root}/dim_customers"),
        "dim_products": lambda: write_table(star.build_dim_products(staged["products"]), f"{root}/dim_products"),
        "dim_date": lambda: write_table(star.build_dim_date(staged["orders"]), f"{root}/dim_date"),
    })
    dim_c, dim_p, dim_d = dims["dim_customers"], dims["dim_products"], dims["dim_date"]
    resolved = star.resolve_items(staged["order_items"], staged["orders"], dim_c, dim_p) \
        .withColumn(FACT_STATUS, F.coalesce(F.col("reject_reason"), F.lit("fact"))) \
        .withColumn(MONTH, (F.year("date_key") * 100 + F.month("date_key")).cast("int"))
    # REBALANCE on (status, month): each task writes few folders, and AQE
    # splits a month that is larger than a task. No range bounds are drawn,
    # so the joins run once.
    items = write_table(resolved.hint("rebalance", FACT_STATUS, MONTH),
                        f"{root}/fact_items", partition_by=[FACT_STATUS, MONTH])
    fact = items.where(F.col(FACT_STATUS) == "fact").select(*FACT_COLUMNS)
    rejects = items.where(F.col(FACT_STATUS) != "fact").select("order_id", "order_item_id", "reject_reason")
    built = {"dim_customers": dim_c, "dim_products": dim_p, "dim_date": dim_d, "fact_orders": fact}
    return built, rejects


def rebuild_star(staged: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    return load_star(staged, root)[0]


def run(spark: SparkSession, sf_dir: str | None = None, root: str | None = None,
        raw_tables: dict[str, DataFrame] | None = None, csv_out: str | None = None) -> DataFrame:
    """Clean, stage, load the star, split off rejects, audit.

    Input: the fixture views over ``sf_dir`` or four raw DataFrames
    (``raw_tables``). Output tables go under ``root`` (default: a fresh
    folder under ``spark.checkpoint.dir``); ``csv_out`` also writes the cleaned
    tables as CSV. The star is kept in ``StarTables``: a first run fills them, a
    later run on the same root upserts the dimensions (existing keys stay),
    adds new days, and replaces the facts of the items it holds. Returns
    (step, table_name, n_rows): row counts of every written table and, for step
    ``audit``, the number of violations of each check.
    """
    root = root or new_work_dir(spark, "run")
    return load(spark, Layers(spark, sf_dir, raw_tables).clean, root, csv_out)


def load(spark: SparkSession, clean: dict[str, DataFrame], root: str, csv_out: str | None = None) -> DataFrame:
    """The part of ``run`` after cleaning. Counts and single-table checks of
    what is written come from the writes; only partitions that this load did not
    touch are counted."""
    observed = load_staging_observed(spark, clean, f"{root}/staging")
    staged = {name: table for name, (table, _) in observed.items()}
    if csv_out:
        for name, df in staged.items():
            write_csv(df, f"{csv_out.rstrip('/')}/{name}.csv")
    tables = StarTables(spark, f"{root}/star")
    seen = tables.apply(staged)
    total = _totals(tables, seen)
    rows = [("stage", STAGE_TABLES[k], observed[k][1]["n_rows"]) for k in staged]
    rows += [("star", t, total[t]["n_rows"]) for t in STAR_TABLES]
    rows += [("reject", "fact_rejects", seen["fact_rejects"]["n_rows"])]
    summary = spark.createDataFrame([(s, t, int(n or 0)) for s, t, n in rows], "step string, table_name string, n_rows bigint")
    audit = quality.audit_star(tables.tables(), total["fact_orders"]).select(
        F.lit("audit").alias("step"), F.col("check_name").alias("table_name"),
        F.col("n_violations").alias("n_rows"))
    return summary.unionByName(audit)


def _totals(tables: StarTables, seen: dict) -> dict[str, dict[str, int]]:
    """Per star table its rows, and for the facts the single-table checks: what
    the load observed plus the partitions that it left alone."""
    n_rows = F.count(F.lit(1)).alias("n_rows")
    checks = [c().alias(n) for n, c in quality.FACT_CHECKS.items()]
    plans = {t: tables.untouched(t, seen[t]["parts"]).agg(n_rows, *(checks if t == "fact_orders" else [])) for t in PARTITION}
    plans["dim_date"] = tables.table("dim_date").agg(n_rows)   # at most one row a calendar day
    rest = run_concurrently({t: (lambda t=t: plans[t].first().asDict()) for t in plans})
    return {t: {c: (n or 0) + ((seen[t].get(c) or 0) if t in PARTITION else 0) for c, n in rest[t].items()} for t in STAR_TABLES}
