"""Incremental maintenance of the star (K2-K4, J5) and insert-ignore.

All maintenance steps are pure functions ``(old table, batch) -> new table``;
writers put the result in a new folder, so re-running a batch is idempotent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import FACT_KEYS
from .dedup import keep_first
from .keys import assign_surrogate_keys


def insert_ignore(existing: DataFrame, batch: DataFrame, keys: list[str],
                  order_by: list[str] | None = None) -> DataFrame:
    """``INSERT ... ON CONFLICT DO NOTHING``.

    Inside the batch the first row of a key wins (keep-first on
    ``order_by``; without an order any one of them); rows whose key already
    exists are skipped.
    """
    b = keep_first(batch, keys, order_by) if order_by else batch.dropDuplicates(keys)
    fresh = b.join(existing.select(*keys), keys, "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def upsert_dimension(dim: DataFrame, batch: DataFrame, natural_key: str, key_col: str,
                     attrs: list[str], start_after: Column | None = None) -> DataFrame:
    """K2: ``ON CONFLICT (natural key) DO UPDATE`` -- slowly changing type 1.

    Existing rows: a left join of the dimension with the batch; a matched
    row takes every attribute from the batch (a NULL in the batch
    overwrites, so the match flag is tested, not the value); unmatched rows
    stay (dimensions never shrink). New rows: the batch anti-joined with the
    dimension's key column only, numbered after ``start_after`` or else the
    current maximum key. With ``start_after`` the dimension may be any part of
    the whole that holds all rows of the batch's keys.
    The batch must be unique on the natural key (the staging load ensures it).
    """
    b = batch.select(natural_key, *[F.col(a).alias(f"_new_{a}") for a in attrs]).withColumn("_hit", F.lit(True))
    existing = dim.select(key_col, natural_key, *attrs).join(b, natural_key, "left").select(
        key_col, natural_key,
        *[F.when(F.col("_hit"), F.col(f"_new_{a}")).otherwise(F.col(a)).alias(a) for a in attrs])
    fresh = batch.select(natural_key, *attrs).join(dim.select(natural_key), natural_key, "left_anti")
    keyed = assign_surrogate_keys(fresh, natural_key, key_col,
                                  start_after=dim.select(F.max(key_col)).scalar() if start_after is None else start_after)
    return existing.unionByName(keyed.select(*existing.columns))


def insert_if_absent(table: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """K3: ``ON CONFLICT DO NOTHING`` for a table without surrogate keys."""
    return table.unionByName(batch.join(table.select(*keys), keys, "left_anti").select(*table.columns))


def fact_rows_in_batch(fact: DataFrame, batch_items: DataFrame) -> DataFrame:
    """Fact rows whose (order_id, order_item_id) is in the batch (semi-join)."""
    return fact.join(batch_items.select(*FACT_KEYS), FACT_KEYS, "left_semi")


def refresh_facts(fact: DataFrame, batch_items: DataFrame, new_facts: DataFrame) -> DataFrame:
    """K4: delete the fact rows whose key is in the batch, insert the batch.

    The delete uses the staging keys and the insert uses the joins, so a
    re-sent item whose order or product no longer joins disappears; facts
    absent from the batch stay.
    """
    kept = fact.join(batch_items.select(*FACT_KEYS), FACT_KEYS, "left_anti")
    return kept.unionByName(new_facts.select(*fact.columns))
