"""Missing-value handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import MISSING_TOKENS


def fill_default(c: Column, value) -> Column:
    """Null -> a default value."""
    return F.coalesce(c, F.lit(value))


def normalise_missing(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Turn the missing-value tokens of a pandas-default CSV reader into
    NULL on every string column (P10). The CSV reader's ``nullValue``
    option covers only one token."""
    string_cols = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    targets = [c for c in (columns or df.columns) if c in string_cols]
    return df.select([
        F.when(~F.col(c).isin(MISSING_TOKENS), F.col(c)).alias(c) if c in targets else F.col(c)
        for c in df.columns
    ])
