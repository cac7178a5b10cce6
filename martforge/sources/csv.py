"""CSV source (S1) and sink.

The source reads every column as text and binds columns by header name, so
the order of the columns in a file does not matter; files of one folder must
agree. Missing-value tokens become NULL (P10), also in numeric columns, and
only then are the values cast to the wanted types; a value that is no number
is an error, and an integer may be written as an integral decimal ("1234.0").

A row with fewer fields than the header has NULL in the missing ones. A row
with more is an error that shows it; with ``long_rows="skip"`` it is left out,
and ``malformed_rows`` returns such rows for a quarantine table.

A file-order column can be attached: (file path, block start, row id taken in
the scan stage). Inside one file split the row id grows in file order, so the
column orders rows exactly as they stand in the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nulls import normalise_missing
from ..schemas import ORDER_COLUMN, TIMESTAMP_PATTERN

_FORMAT = {"header": "true", "encoding": "UTF-8", "quote": '"', "escape": '"',
           "sep": ","}
_RAW = "_malformed_line"
# A quoted field: the quotes stand at its ends, quotes inside are doubled.
_QUOTED = r'(?<![^,])"(?:[^"]|"")*"(?![^,])'


def _strict_cast(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.StringType):
        return F.col(field.name)
    text = F.col(field.name)
    value = text.try_cast(field.dataType)
    if isinstance(field.dataType, T.IntegralType):
        exact = text.try_cast("decimal(38,10)")
        value = F.coalesce(value, F.when(exact == F.floor(exact), exact.try_cast(field.dataType)))
    wrong = F.raise_error(F.concat(F.lit(f"column {field.name}: not a {field.dataType.simpleString()}: "), text))
    return F.when(text.isNotNull() & value.isNull(), wrong.cast(field.dataType)) \
        .otherwise(value).alias(field.name)


def _lines(spark: SparkSession, path: str, multi_line: bool) -> tuple[DataFrame, Column, int]:
    """The rows of a CSV as text with ``_RAW`` (the line, if its number of
    fields is not that of the header), that number, and the header's."""
    # Without all columns the parser cannot tell that a line has too few or too many.
    reader = spark.read.options(**_FORMAT).option("multiLine", str(multi_line).lower()).option("columnPruning", "false")
    header = reader.csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, _RAW]])
    rows = reader.schema(schema).option("enforceSchema", "false").option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", _RAW).csv(path)
    # Always true: Spark does not read the malformed lines alone (as for a count).
    rows = rows.where(F.length(F.concat_ws("", F.col(f"`{header[0]}`"))) >= 0)
    bare = F.regexp_replace(F.col(_RAW), _QUOTED, "")
    return rows, F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1, len(header)


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             with_file_order: bool = True, multi_line: bool = False, long_rows: str = "error") -> DataFrame:
    """The columns of ``schema`` from the CSV file or folder at ``path``.
    ``multi_line`` allows line breaks inside quotes; such files are not split.
    ``long_rows``: "error" or "skip", see above."""
    if long_rows not in ("error", "skip"):
        raise ValueError(f"long_rows is {long_rows!r}, not 'error' or 'skip'")
    rows, fields, expected = _lines(spark, path, multi_line)
    too_long = F.col(_RAW).isNotNull() & (fields > expected)
    message = F.concat(F.lit(f"row with more than the {expected} fields of the header: "), F.col(_RAW))
    fine = F.lit(False) if long_rows == "skip" else F.raise_error(message).cast("boolean")
    rows = rows.where(F.when(too_long, fine).otherwise(F.lit(True)))
    order = [F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row")).alias(ORDER_COLUMN)] if with_file_order else []
    text = normalise_missing(rows.select(*[F.col(f"`{f.name}`") for f in schema.fields], *order))
    return text.select(*[_strict_cast(f) for f in schema.fields], *([ORDER_COLUMN] if with_file_order else []))


def malformed_rows(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """(file, n_fields, expected_fields, line) of every row whose number of
    fields is not that of the header: short rows, which are read, and long ones,
    which are not."""
    rows, fields, expected = _lines(spark, path, multi_line)
    return rows.where(F.col(_RAW).isNotNull()).select(
        F.col("_metadata.file_path").alias("file"), fields.cast("int").alias("n_fields"),
        F.lit(expected).alias("expected_fields"), F.col(_RAW).alias("line"))


def write_csv(df: DataFrame, path: str) -> str:
    """Header, no index column, timestamps in the layout that the cleaner
    reads; blanks inside values are kept as they are (Spark's CSV writer trims
    them unless told not to)."""
    (df.write.mode("overwrite").options(**_FORMAT)
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .option("timestampNTZFormat", TIMESTAMP_PATTERN).option("timestampFormat", TIMESTAMP_PATTERN)
     .csv(path))
    return path


# Raw CSV schemas: product numbers are read as text so that a decimal comma
# (or a float written as "225.0") is repaired by the cleaner, not rejected.
def csv_schemas() -> dict[str, T.StructType]:
    from ..schemas import PRODUCT_NUMERIC_COLUMNS, RAW_SCHEMAS
    products = T.StructType([T.StructField("product_id", T.StringType()),
                             T.StructField("product_category_name", T.StringType())]
                            + [T.StructField(c, T.StringType()) for c in PRODUCT_NUMERIC_COLUMNS])
    return {**RAW_SCHEMAS, "products": products}


def read_raw_tables(spark: SparkSession, raw_dir: str,
                    files: dict[str, str] | None = None, multi_line: bool = False,
                    long_rows: str = "error") -> dict[str, DataFrame]:
    """The four raw tables from CSV files (``customers.csv``, ``orders.csv``,
    ``products.csv``, ``order_items.csv`` unless ``files`` names others),
    each with its file-order column."""
    names = {k: f"{k}.csv" for k in ("customers", "orders", "products", "order_items")} | (files or {})
    schemas = csv_schemas()
    return {k: read_csv(spark, f"{raw_dir.rstrip('/')}/{f}", schemas[k], multi_line=multi_line, long_rows=long_rows)
            for k, f in names.items()}
