"""Timestamp parsing and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import TIMESTAMP_REGEX


def parse_timestamp(c: Column) -> Column:
    """Lenient text -> TIMESTAMP_NTZ (P4): unparsable text becomes null.

    The layout is fixed (``yyyy-MM-dd HH:mm:ss``); text of another shape is
    null, and so is a well-shaped but impossible date. ``try_cast`` to
    ``timestamp_ntz`` is zone-free, so the session time zone never shifts a
    wall-clock value.
    """
    return F.when(c.rlike(TIMESTAMP_REGEX), c.try_cast("timestamp_ntz"))


def date_key(ts: Column) -> Column:
    """Timestamp -> DATE, dropping the time of day."""
    return F.to_date(ts)


def date_parts(d: Column) -> dict[str, Column]:
    """Calendar parts of a DATE as INT (P15, P16). Sunday is 0."""
    return {
        "year": F.year(d).cast("int"),
        "quarter": F.quarter(d).cast("int"),
        "month": F.month(d).cast("int"),
        "day": F.dayofmonth(d).cast("int"),
        # Spark numbers Sunday as 1.
        "day_of_week": (F.dayofweek(d) - 1).cast("int"),
    }
