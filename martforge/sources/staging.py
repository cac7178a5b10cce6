"""Staging loads (S3): full refresh of the chosen columns into Parquet.

Every load writes a fresh versioned folder under the shared checkpoint
root and reads it back, which is also where the lineage of the cleaning
plans is cut: later steps start from the written files, and a lost executor
recomputes from them, not from the raw inputs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import STAGE_COLUMNS, STAGE_TABLES
from ..session import new_work_dir, run_concurrently


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, dynamic: bool = False,
                mode: str = "overwrite") -> DataFrame:
    """Write and read back. ``dynamic`` replaces only the partitions that ``df``
    holds; else the whole table is replaced."""
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    # Known schema: no footer-inference job. Partition columns come last.
    schema = df.schema
    if partition_by:
        from pyspark.sql.types import StructType
        schema = StructType([f for f in schema.fields if f.name not in partition_by]
                            + [schema[c] for c in partition_by])
    return df.sparkSession.read.schema(schema).parquet(path)


def write_observed(df: DataFrame, path: str, metrics: dict[str, Column], partition_by: list[str] | None = None,
                   dynamic: bool = False, mode: str = "overwrite") -> tuple[DataFrame, dict]:
    """``write_table`` that also returns aggregates of the rows, collected by the
    writing tasks themselves: checks and counts of a load need no second scan."""
    observation = Observation(uuid.uuid4().hex)
    seen = df.observe(observation, F.count(F.lit(1)).alias("_rows"), *[m.alias(name) for name, m in metrics.items()])
    table = write_table(seen, path, partition_by, dynamic, mode)
    found = observation.get
    return table, {name: found.get(name) for name in metrics}


def load_staging(spark: SparkSession, clean: dict[str, DataFrame],
                 root: str | None = None) -> dict[str, DataFrame]:
    """Write the four cleaned tables as stg_* and return the staged frames."""
    return {name: table for name, (table, _) in load_staging_observed(spark, clean, root).items()}


def load_staging_observed(spark: SparkSession, clean: dict[str, DataFrame],
                          root: str | None = None) -> dict[str, tuple[DataFrame, dict]]:
    """The staged frames and, of each, its number of rows as the write saw it."""
    root = root or new_work_dir(spark, "staging")
    return run_concurrently({
        name: (lambda name=name, df=df: write_observed(df.select(*STAGE_COLUMNS[name]), f"{root}/{STAGE_TABLES[name]}",
                                                       {"n_rows": F.count(F.lit(1))}))
        for name, df in clean.items()})
