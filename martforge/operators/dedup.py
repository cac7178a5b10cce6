"""Keep-first de-duplication.

``dropDuplicates`` keeps an arbitrary row; the source keeps the first row of
each key in file order. ``row_number() == 1`` over the key, ordered by the
file-order column, is planned by Spark as a WindowGroupLimit in two phases:
a partial limit in every map task before the shuffle and a final one after.
A hot key therefore crosses the shuffle as at most one row per map task, no
matter how many copies it has. Null keys form one group, as in pandas.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import ORDER_COLUMN


def keep_first(df: DataFrame, keys: list[str], order_by: list[str] | None = None,
               drop_order: bool = True) -> DataFrame:
    order_cols = order_by or [ORDER_COLUMN]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order_cols])
    out = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    if drop_order:
        out = out.drop(*[c for c in order_cols if c == ORDER_COLUMN])
    return out
