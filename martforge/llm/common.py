"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, new_work_dir

__all__ = ["table", "materialize", "new_work_dir", "binary_view", "null_mask", "ranged_running_sum", "arrow_map", "share_code",
           "shuffle_partitions", "text_or_empty", "packed", "split_by_keys", "unused_name", "with_fields"]

#: The word separators of the package: blank and the ASCII controls 9-13.
SPACE_CHARS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

#: Bits by which rows are told apart before they are moved (``split_by_keys``).
KEY_BITS = 1 << 26


_SHARED: set[str] = set()


def share_code(spark: SparkSession) -> None:
    """Let the Python workers of this application import the package, however
    the driver found it: Spark ships it to every executor, once."""
    context = spark.sparkContext
    if context.applicationId in _SHARED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="code-"), "martforge_code.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in sorted(os.walk(package)):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(target)
    _SHARED.add(context.applicationId)


def arrow_map(df: DataFrame, function: Callable, schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with the package importable in the workers."""
    share_code(df.sparkSession)
    return df.mapInArrow(function, schema)


def packed(rows: DataFrame, **derived: Column) -> DataFrame:
    """The caller's rows as one column ``_row`` beside derived ones, so that no
    column of theirs can clash with a name used here; ``_row.*`` unpacks them."""
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row")
    return rows.select(whole, *[column.alias(name) for name, column in derived.items()])


def split_by_keys(rows: DataFrame, columns: list[str], keys: DataFrame, key_columns: list[str],
                  bits: int = KEY_BITS) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``columns`` are surely not among ``keys``, the others), so that
    a join with the keys need not move the first. Every key sets one of ``bits``
    bits by its hash; the words of that bit array, at most ``bits`` / 64 narrow
    rows however many keys there are, are broadcast. The others hold every row
    of a key and, by chance, some more: an exact join has to decide."""
    def spot(names):
        return F.pmod(F.xxhash64(*names), F.lit(bits).cast("long"))
    at = keys.select(spot(key_columns).alias("_at"))
    words = at.groupBy(F.shiftright("_at", 6).alias("_word")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(_at & 63 AS int))")).alias("_bits"))
    words = materialize(words, "key-bits")
    marked = rows.withColumn("_at", spot(columns)).withColumn("_word_at", F.shiftright("_at", 6)) \
        .join(F.broadcast(words), F.col("_word_at") == F.col("_word"), "left") \
        .withColumn("_hit", F.expr("coalesce(shiftright(_bits, cast(_at & 63 AS int)) & 1L, 0L) = 1"))
    return tuple(marked.where(side).select(*rows.columns) for side in (~F.col("_hit"), F.col("_hit")))


def unused_name(rows: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column has it in any case."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_fields(schema: T.StructType, **kinds: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, *(T.StructField(n, k) for n, k in kinds.items())])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan of one input table (schema from its footers)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(column: str = "text") -> Column:
    """The text column with null read as the empty string."""
    return F.coalesce(F.col(column), F.lit(""))


def binary_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow column without copying:
    row ``i`` is ``bytes[offsets[i]:offsets[i + 1]]``; nulls are empty."""
    kind = column.type
    if pa.types.is_large_string(kind) or pa.types.is_large_binary(kind):
        width = np.int64
    else:
        width = np.int32
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=width, count=column.offset + len(column) + 1) if len(column) \
        else np.zeros(1, dtype=width)
    offsets = offsets[column.offset:].astype(np.int64) if len(column) else offsets.astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def null_mask(column: pa.Array) -> np.ndarray:
    return column.is_null().to_numpy(zero_copy_only=False)


def ranged_running_sum(df: DataFrame, order: list[str], value: str, group: str | None = None) -> DataFrame:
    """Running total of ``value`` (long) in ``order``, restarting per ``group``
    (which must be the first order column), without a single-task window.

    Rows are range-partitioned and sorted; every task adds its part number
    and its own running total; the written copy freezes the sampled bounds.
    One row per (part, group) then gives the offset of each part: at most
    parts + groups rows. Rows that are equal on every order column may share
    a hot value, so an arbitrary tie-breaker is part of the range key; such
    rows must be interchangeable for the caller.

    Adds ``running``: the total up to and including the row.
    """
    spark = df.sparkSession
    keyed = df.withColumn("_tie", F.monotonically_increasing_id())
    ranged = keyed.repartitionByRange(shuffle_partitions(spark), *order, "_tie") \
        .sortWithinPartitions(*order, "_tie").drop("_tie")
    schema = with_fields(ranged.schema, _part=T.IntegerType(), _cum=T.LongType())
    local = materialize(arrow_map(ranged, _local_running(value, group), schema), "running")
    by = ["_part"] + ([group] if group else [])
    sums = local.groupBy(*by).agg(F.max("_cum").alias("_sum"))
    before = (Window.partitionBy(group) if group else Window.partitionBy()).orderBy("_part") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*by, F.coalesce(F.sum("_sum").over(before), F.lit(0)).cast("long").alias("_before"))
    return local.join(offsets, by).withColumn("running", F.col("_cum") + F.col("_before")) \
        .drop("_part", "_cum", "_before")


def _local_running(value: str, group: str | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, carry = object(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            v = batch.column(value).to_numpy(zero_copy_only=False).astype(np.int64)
            total = np.cumsum(v)
            if group is None:
                total += carry
            else:
                g = batch.column(group).to_pylist()
                starts = [i for i in range(len(g)) if i == 0 or g[i] != g[i - 1]]
                base = np.zeros(len(g), np.int64)
                for i in starts:
                    base[i:] = (-carry if g[0] == last else 0) if i == 0 else total[i - 1]
                total = total - base
                last = g[-1]
            carry = int(total[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(v), part, np.int32)), pa.array(total)],
                names=[*batch.schema.names, "_part", "_cum"])
    return run
