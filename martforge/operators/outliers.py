"""Exact quartiles, IQR outlier count (A15), IQR filter (O1) and capping (O2).

Spark's exact ``percentile`` keeps every distinct value of the column in one
final task, which does not survive a 100 TB column. Here the quantiles of
several columns are found in one pass with bounded work per task:

1. the columns are stacked as (column_name, value) rows and counted with
   ``groupBy(column_name, value)`` -- partial aggregation in every map task,
   so a value repeated a billion times crosses the shuffle once per task;
2. the (column, value, count) rows are range-partitioned and a running count
   is taken inside each range partition (``keys.with_global_rank`` with a
   weight and the column as group), then shifted by per-partition offsets;
3. per column, the values at ranks floor(p*(n-1)) and ceil(p*(n-1)) are two
   ``min`` aggregates; linear interpolation between them is the continuous
   quantile.

The bounds are written once as a tiny table and used through scalar
subqueries, which Spark evaluates once and inlines as literals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .keys import with_global_rank


def exact_quantiles(df: DataFrame, columns: list[str] | str, probs: list[float]) -> DataFrame:
    """One row per column: ``column_name`` and ``q_<i>`` for each probability
    (continuous, linearly interpolated). NULLs are ignored."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in cols
    ])).alias("_s")).select("_s.column_name", "_s.v").where(F.col("v").isNotNull())
    counts = stacked.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("_c"))
    ranked = with_global_rank(counts, ["v"], "_rank", weight=F.col("_c"), group_cols=["column_name"])
    # n per column (one row per column) for the rank thresholds.
    totals = ranked.groupBy("column_name").agg(F.max("_rank").alias("_n"))
    with_n = ranked.join(F.broadcast(totals), "column_name")
    picks, finals = [], []
    for i, p in enumerate(probs):
        pos = (F.col("_n") - 1).cast("double") * F.lit(float(p))
        lo, hi = F.floor(pos), F.ceil(pos)
        picks += [F.min(F.when(F.col("_rank") >= lo + 1, F.col("v"))).alias(f"_lo{i}"),
                  F.min(F.when(F.col("_rank") >= hi + 1, F.col("v"))).alias(f"_hi{i}"),
                  F.first(pos - lo).alias(f"_d{i}")]
        finals.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_d{i}"))
                      .alias(f"q_{i}"))
    return with_n.groupBy("column_name").agg(*picks).select("column_name", *finals)


def approx_quantiles(df: DataFrame, columns: list[str] | str, probs: list[float],
                     accuracy: int = 10000) -> DataFrame:
    """One-pass alternative: ``percentile_approx`` keeps a bounded sketch per
    column (relative rank error 1/accuracy) and returns observed values."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    one = df.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, accuracy).alias(c) for c in cols])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 *[F.col(c)[i].alias(f"q_{i}") for i in range(len(probs))]) for c in cols])).alias("_q")
    ).select("_q.*")


def iqr_bounds(df: DataFrame, columns: list[str] | str, k: float = 1.5, exact: bool = True) -> DataFrame:
    """Per column: q1, q3, lower_bound = q1 - k*IQR, upper_bound = q3 + k*IQR.
    ``exact=False`` uses the one-pass sketch instead of exact ranks."""
    quantiles = exact_quantiles if exact else approx_quantiles
    q = quantiles(df, columns, [0.25, 0.75]).select(
        "column_name", F.col("q_0").alias("q1"), F.col("q_1").alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return q.select("column_name", "q1", "q3", (F.col("q1") - F.lit(k) * iqr).alias("lower_bound"),
                    (F.col("q3") + F.lit(k) * iqr).alias("upper_bound"))


def _frozen_bounds(df: DataFrame, columns: list[str], k: float, exact: bool = True) -> DataFrame:
    return materialize(iqr_bounds(df, columns, k, exact).coalesce(1), "iqr_bounds")


def _scalar(bounds: DataFrame, column: str, field: str):
    return bounds.where(F.col("column_name") == column).select(field).scalar()


def iqr_outliers(df: DataFrame, columns: list[str], k: float = 1.5, exact: bool = True) -> DataFrame:
    """Per column, quartiles, bounds and how many values fall outside.
    The counts for all columns are one aggregate over the data."""
    b = _frozen_bounds(df, columns, k, exact)
    counts = []
    for c in columns:
        v = F.col(c).cast("double")
        counts += [F.count_if(v < _scalar(b, c, "lower_bound")).alias(f"below__{c}"),
                   F.count_if(v > _scalar(b, c, "upper_bound")).alias(f"above__{c}")]
    one = df.agg(*counts)
    long = one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"below__{c}").alias("n_below"),
                 F.col(f"above__{c}").alias("n_above")) for c in columns])).alias("_r")).select("_r.*")
    return long.join(F.broadcast(b), "column_name").select(  # b: one row per column
        "column_name", "q1", "q3", "lower_bound", "upper_bound", "n_below", "n_above",
        (F.col("n_below") + F.col("n_above")).alias("n_outliers"))


def iqr_filter(df: DataFrame, columns: list[str], k: float = 1.5, exact: bool = True) -> DataFrame:
    """O1: keep rows whose every listed column lies inside its IQR bounds."""
    b = _frozen_bounds(df, columns, k, exact)
    cond = F.lit(True)
    for c in columns:
        v = F.col(c).cast("double")
        cond = cond & (v >= _scalar(b, c, "lower_bound")) & (v <= _scalar(b, c, "upper_bound"))
    return df.where(cond)


def iqr_cap(df: DataFrame, columns: list[str], k: float = 1.5, exact: bool = True) -> DataFrame:
    """O2: clamp each listed column (as double) into its IQR bounds."""
    b = _frozen_bounds(df, columns, k, exact)
    return df.select([
        F.least(F.greatest(F.col(c).cast("double"), _scalar(b, c, "lower_bound")),
                _scalar(b, c, "upper_bound")).alias(c) if c in columns else F.col(c)
        for c in df.columns])
