"""Distinct counts and quartiles from sketches that are kept per batch.

A batch leaves one row of sketches per column: an HLL sketch for distinct
values, a KLL sketch for ranks. Figures over any set of batches come from
merging their rows (a few kilobytes each), never from the data again. Distinct
sketches may be of batches that share rows; rank sketches are of disjoint ones.

Error bounds: a distinct count lies within ``DISTINCT_ERROR`` of the exact one
(three standard errors of 1.04 / sqrt(2^12)); a quantile's true rank lies within
``RANK_ERROR`` of the wanted one (KLL with k = 200, 99 % of the time).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_BUCKETS = 12
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LG_BUCKETS / 2)
KLL_K = 200
RANK_ERROR = 0.0165


def _by_column(df: DataFrame, columns: list[str], parts: dict[str, "callable"]) -> DataFrame:
    """One aggregate over the data, then one row per column."""
    one = df.agg(*[f(F.col(c)).alias(f"{name}__{c}") for c in columns for name, f in parts.items()])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{name}__{c}").alias(name) for name in parts]) for c in columns])))


def batch_sketches(df: DataFrame, batch: str, distinct: list[str] = (), ranks: list[str] = ()) -> DataFrame:
    """(batch, column_name, n_values, distinct_sketch, rank_sketch) of one batch.
    Nulls are in no sketch; the data are read once for all columns."""
    columns = list(dict.fromkeys([*distinct, *ranks]))

    def hll(c: Column) -> Column:
        return F.hll_sketch_agg(c, F.lit(LG_BUCKETS))

    def kll(c: Column) -> Column:
        return F.kll_sketch_agg_double(c.cast("double"), F.lit(KLL_K))
    frames = [_by_column(df, [c], {"n_values": F.count, **({"distinct_sketch": hll} if c in distinct else {}),
                                   **({"rank_sketch": kll} if c in ranks else {})}) for c in columns]
    out = None
    for f in frames:
        for name in ("distinct_sketch", "rank_sketch"):
            if name not in f.columns:
                f = f.withColumn(name, F.lit(None).cast("binary"))
        f = f.select(F.lit(batch).alias("batch"), "column_name", "n_values", "distinct_sketch", "rank_sketch")
        out = f if out is None else out.unionByName(f)
    return out


def merged_distinct(sketches: DataFrame) -> DataFrame:
    """(column_name, n_distinct) over all batches of ``sketches``."""
    return sketches.where(F.col("distinct_sketch").isNotNull()).groupBy("column_name") \
        .agg(F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("n_distinct"))


def merged_quantiles(sketches: DataFrame, probs: list[float]) -> DataFrame:
    """(column_name, n_values, q_0, q_1, ...) over all batches of ``sketches``;
    a column without values has no row."""
    merged = sketches.where(F.col("rank_sketch").isNotNull() & (F.col("n_values") > 0)).groupBy("column_name") \
        .agg(F.sum("n_values").alias("n_values"), F.kll_merge_agg_double("rank_sketch").alias("s"))
    return merged.select("column_name", "n_values", *[
        F.kll_sketch_get_quantile_double("s", F.lit(float(p))).alias(f"q_{i}") for i, p in enumerate(probs)])
