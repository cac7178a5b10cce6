"""Constraints that hold on write (Q5-Q7 as guards, not as reports).

The guards are part of the writing plan: a row that breaks NOT NULL or a
VARCHAR bound, or a key that occurs twice, fails the job with a message that
names table, column and value, before anything of the table is published.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import NOT_NULL, UNIQUE, VARCHAR_BOUNDS


def _broken_row(table: str) -> Column:
    """The message of the first broken row constraint, or null."""
    checks = [F.when(F.col(c).isNull(), F.lit(f"{table}.{c} is null")) for c in NOT_NULL.get(table, [])]
    checks += [F.when(F.length(c) > n, F.concat(F.lit(f"{table}.{c} is longer than {n}: "), F.col(c)))
               for t, c, n in VARCHAR_BOUNDS if t == table]
    return F.coalesce(*checks, F.lit(None).cast("string"))


def enforce_rows(df: DataFrame, table: str, where: Column | None = None) -> DataFrame:
    """NOT NULL and VARCHAR(n) of every row (or of those ``where``), checked where
    the row is written. The check is part of a key column, which no reader of the
    plan can leave out of the table."""
    anchor = NOT_NULL[table][-1]
    broken = _broken_row(table) if where is None else F.when(where, _broken_row(table))
    guarded = F.when(F.col("_broken").isNull(), F.col(anchor)) \
        .otherwise(F.raise_error(F.col("_broken")).cast(df.schema[anchor].dataType))
    return df.withColumn("_broken", broken).withColumn(anchor, guarded).drop("_broken")


def repeated(table: str, keys: list[str]) -> Column:
    """Fails with the key of the row it is evaluated for."""
    text = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    return F.raise_error(F.concat(F.lit(f"{table}: key ({', '.join(keys)}) occurs more than once: "), text))


def repeated_keys(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """A plan that fails if two rows have equal ``keys`` and else has no rows.
    Keys are counted with partial aggregation: a hot key is one row a map task."""
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return twice.select(repeated(table, keys).cast("string").alias("_broken"))


def check_unique(tables: dict[str, DataFrame]) -> None:
    """Fail if a key of UNIQUE occurs twice in a table. One job over all tables;
    each grouping reads its key columns only."""
    found = [repeated_keys(df, t, k) for t, df in tables.items() for k in UNIQUE[t]]
    reduce(lambda a, b: a.unionByName(b), found).write.format("noop").mode("overwrite").save()
