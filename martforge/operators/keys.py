"""Surrogate keys (K1) and exact global ranks without a single-task sort.

``Window.orderBy`` without a partition moves the whole table into one task.
Instead the rows are range-partitioned on the ordering key and sorted inside
each partition; every row gets its partition number and its position in
the partition; the result is written as a Parquet table in the shared
checkpoint folder (range bounds are sampled, so a recomputation could draw
other bounds; the written copy freezes them and stays columnar for the
readers). A frame with one row per partition (and group) then yields each
partition's offset by a prefix sum; its size is bounded by the partition
count times the group count, not by the data, and AQE broadcasts it where it
is small. Offset + position is the exact rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def _num_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_global_rank(df: DataFrame, order_cols: list[str], rank_col: str,
                     weight: Column | None = None, group_cols: list[str] | None = None,
                     num_partitions: int | None = None) -> DataFrame:
    """Add ``rank_col``: 1-based position of each row in ``order_cols`` order,
    counted separately inside each group of ``group_cols`` (a small number of
    groups, e.g. one per profiled column).

    With ``weight`` the column is instead the running total of ``weight``
    up to and including the row (a weighted rank, used for quantiles).
    Ties in ``order_cols`` are broken by the position inside the partition.
    The input is written first: drawing the range bounds reads it a second
    time, and must not compute it a second time.
    """
    groups = list(group_cols or [])
    n = num_partitions or _num_partitions(df)
    w = weight if weight is not None else F.lit(1).cast("long")
    keys = [*groups, *order_cols]
    ranged = (
        materialize(df.withColumn("_w", w.cast("long")), "rank-input")
        .repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    if weight is None:
        ranged = materialize(ranged, "ranked")
        sizes = ranged.groupBy("_part", *groups).agg(F.count(F.lit(1)).alias("_n"),
                                                     F.min("_pos").alias("_first"))
        local = F.col("_pos") - F.col("_first") + 1
    else:
        # Running weight inside each range partition (and group); the window
        # is keyed by the partition number, so one task handles one range.
        in_part = Window.partitionBy("_part", *groups).orderBy("_pos").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        ranged = materialize(ranged.withColumn("_cum", F.sum("_w").over(in_part)), "ranked")
        sizes = ranged.groupBy("_part", *groups).agg(F.sum("_w").alias("_n"))
        local = F.col("_cum")
    # One row per (partition, group): the prefix sum over it is tiny by construction.
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))) \
        .select("_part", *groups, "_offset", *(["_first"] if weight is None else []))
    out = ranged.join(offsets, ["_part", *groups])
    return out.withColumn(rank_col, (F.col("_offset") + local).cast("long")).drop(
        "_part", "_pos", "_offset", "_first", "_w", "_cum", "_n")


def assign_surrogate_keys(new_rows: DataFrame, natural_key: str, key_col: str,
                          start_after: Column | None = None) -> DataFrame:
    """K1: give every row (unique on ``natural_key``) a unique positive key.

    On a first load keys are dense, 1..n in natural-key order. New keys of a
    later load start after ``start_after`` (the current maximum, a scalar
    subquery), so existing keys never move. Only the natural key is ranked and
    written; the other columns are joined to it.
    """
    ranked = with_global_rank(new_rows.select(F.col(natural_key).alias("_natural")), ["_natural"], "_key")
    key = F.col("_key") if start_after is None else F.col("_key") + F.coalesce(start_after, F.lit(0)).cast("long")
    others = [c for c in new_rows.columns if c != key_col]
    return new_rows.join(ranked, F.col(natural_key).eqNullSafe(F.col("_natural"))).select(key.alias(key_col), *others)
