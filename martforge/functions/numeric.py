"""Numeric casts and money arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MONEY, STAGE_DECIMAL


def nan_to_null(c: Column) -> Column:
    """NaN -> NULL for floating columns (P9). Spark orders NaN above every
    number, so ``NaN > 0`` would pass a filter that pandas rejects."""
    return F.when(~F.isnan(c), c)


def repair_decimal_comma(c: Column) -> Column:
    """Text with a decimal comma -> exact decimal (P5); null stays null.

    The cast is strict (ANSI): text that is not a number fails the job, as
    the source's float conversion does.
    """
    return F.regexp_replace(c.cast("string"), ",", ".").cast(STAGE_DECIMAL)


def to_stage_decimal(c: Column) -> Column:
    """Floating money -> exact staging decimal, once, at entry."""
    return c.cast(STAGE_DECIMAL)


def exact_revenue(price: Column, freight: Column) -> Column:
    """price + freight on exact decimals (P7); no floating-point drift."""
    return (price + freight).cast(STAGE_DECIMAL)


def to_money(c: Column) -> Column:
    """Round half-up to NUMERIC(12,2) (P8, P13); overflow raises under ANSI."""
    return c.cast(MONEY)


def numeric_to_int(c: Column) -> Column:
    """NUMERIC -> INT rounding half away from zero.

    A bare cast truncates 2.5 to 2; ``round`` on a decimal is HALF_UP.
    """
    return F.round(c).cast("int")


def text_to_int(c: Column) -> Column:
    """TEXT -> INT (P11); raises on bad text under ANSI, as the database does."""
    return c.cast("int")
