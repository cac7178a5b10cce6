"""Exact deduplication by content-defined chunk recipes.

Each text is cut where a rolling hash of the last 16 bytes matches a mask, so
equal passages give equal chunks wherever they stand. A document becomes a
*recipe*: the ordered list of its chunk identifiers. Only recipes (16 bytes a
chunk) are compared between documents; long texts are not moved for it.

A chunk identifier is a 128-bit fingerprint that has been *verified*: the
bytes of every fingerprint that occurs more than once are exchanged once per
task and compared. Should two different chunks ever share a fingerprint,
their recipes hold the chunk bytes instead, so the comparison stays exact.

Defined results: a null text counts as empty; a null doc_id sorts below all
others; of rows that repeat both text and doc_id exactly one stays; texts of
any length are chunked whole; an empty table gives no rows; other columns of the
input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, binary_view, materialize, packed, split_by_keys, text_or_empty

CHUNK_BITS = 12          # a cut at every 2**12 bytes on average
MAX_CHUNK = 1 << 16      # a longer chunk is cut at multiples of this size
WINDOW = 16              # bytes of the rolling hash
HELD_BYTES = 32 << 20    # chunk bytes that a task remembers for its own repeats
_SLICE = 1 << 22

# One fixed random number per byte value, from a rule (splitmix64 of the byte).
_STEP = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_MIX = (_STEP ^ (_STEP >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
GEAR = ((_MIX ^ (_MIX >> np.uint64(27))) >> np.uint64(32)).astype(np.uint32)


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """Hash of the 16 bytes that end at each position: sum of gear[b] << age."""
    h = GEAR[data]
    for width in (1, 2, 4, 8):
        h[width:] += h[:-width] << np.uint32(width)
    return h


def cut_points(data: np.ndarray, offsets: np.ndarray, chunk_bits: int = CHUNK_BITS,
               max_chunk: int = MAX_CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """Chunk boundaries of all documents of a buffer.

    Returns (edges, counts): ``edges`` are absolute start positions of the
    chunks, with the end of the buffer last; ``counts`` the chunks of each
    document. A cut depends on the document's own bytes only: none is made
    within its first 16 bytes.
    """
    mask = np.uint32(((1 << chunk_bits) - 1) << (32 - chunk_bits))
    lo, hi = int(offsets[0]), int(offsets[-1])
    found = []
    for at in range(lo, hi, _SLICE):
        start = max(lo, at - WINDOW)
        h = rolling_hash(data[start:min(hi, at + _SLICE)])
        hits = np.flatnonzero((h & mask) == 0) + start + 1
        found.append(hits[hits > at])
    hits = np.concatenate(found) if found else np.zeros(0, np.int64)
    owner = np.searchsorted(offsets, hits, side="right") - 1
    inside = hits - offsets[np.minimum(owner, len(offsets) - 1)] > WINDOW
    hits = hits[inside & (hits < hi)]
    starts = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], hits]))
    sizes = np.diff(np.append(starts, hi))
    pieces = np.maximum(1, -(-sizes // max_chunk))
    if len(starts) and pieces.max() > 1:
        first = np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = np.repeat(starts, pieces) + (np.arange(pieces.sum()) - first) * max_chunk
    ends = np.searchsorted(starts, offsets)
    return np.append(starts, hi).astype(np.int64), np.diff(ends)


def fingerprint(chunk: bytes) -> bytes:
    return xxhash.xxh3_128_digest(chunk)


def _chunker(names: list[str], clash: frozenset, fingerprint_of: Callable) -> Callable:
    def recipes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = binary_view(batch.column("text"))
            edges, counts = cut_points(data, offsets)
            prints, sums, at = [], [], 0
            for i, n in enumerate(counts.tolist()):
                own = []
                for k in range(at, at + n):
                    chunk = data[edges[k]:edges[k + 1]].tobytes()
                    p = fingerprint_of(chunk)
                    own.append(p + b"\x01" + chunk if p in clash else p + b"\x00")
                at += n
                prints.append(own)
                sums.append(hashlib.sha256(data[offsets[i]:offsets[i + 1]]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(prints, pa.list_(pa.binary())), pa.array(sums, pa.string())],
                names=names)
    return recipes


def _contents(fingerprint_of: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = binary_view(batch.column("text"))
            edges, _ = cut_points(data, offsets)
            prints, chunks = [], []
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                chunk = data[a:b].tobytes()
                p = fingerprint_of(chunk)
                if held.get(p) == chunk:
                    continue
                if size + len(chunk) > HELD_BYTES:
                    held, size = {}, 0
                if p not in held:
                    held[p] = chunk
                    size += len(chunk)
                prints.append(p)
                chunks.append(chunk)
            for i in range(0, len(prints), 2000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prints[i:i + 2000], pa.binary()), pa.array(chunks[i:i + 2000], pa.binary())],
                    names=["print", "chunk"])
    return run


def chunk_recipes(docs: DataFrame, fingerprint_of: Callable = fingerprint) -> DataFrame:
    """Write one row per document: doc_id, rid (a frozen row number), recipe
    (array of verified chunk identifiers), text_sha256."""
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def write(clash: frozenset) -> DataFrame:
        rows = arrow_map(texts, _chunker(["doc_id", "recipe", "text_sha256"], clash, fingerprint_of),
                         f"doc_id {kind}, recipe array<binary>, text_sha256 string")
        return materialize(rows.withColumn("rid", F.monotonically_increasing_id()), "recipes")

    recipes = write(frozenset())
    repeated = recipes.select(F.explode("recipe").alias("print")) \
        .groupBy("print").agg(F.count(F.lit(1)).alias("n")).filter("n > 1") \
        .select(F.expr("substring(print, 1, length(print) - 1)").alias("print"))
    contents = arrow_map(texts, _contents(fingerprint_of), "print binary, chunk binary") \
        .join(repeated, "print", "left_semi").groupBy("print", "chunk").agg(F.lit(1).alias("one"))
    # Fingerprints of different chunks: none is expected of 128 bits.
    clash = [bytes(r[0]) for r in contents.groupBy("print").agg(F.count(F.lit(1)).alias("n"))
             .filter("n > 1").select("print").collect()]
    return write(frozenset(clash)) if clash else recipes


def exact_dedup(docs: DataFrame, fingerprint_of: Callable = fingerprint) -> DataFrame:
    """One row per document of ``docs``: doc_id, keep_id (largest doc_id of the
    equal texts), group_size, kept, text_sha256, n_chunks."""
    recipes = chunk_recipes(docs, fingerprint_of)
    groups = recipes.groupBy("recipe").agg(F.max(F.struct("doc_id", "rid")).alias("_keep"),
                                           F.count(F.lit(1)).alias("_size")) \
        .filter("_size > 1")
    # Written, so that both sides of the join are plain exchanges that Spark
    # can split where a recipe is hot, or broadcast where the groups are few.
    groups = materialize(groups, "copy-groups")
    joined = recipes.join(groups, "recipe", "left")
    alone = F.col("_size").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("_keep.doc_id")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("_keep.rid") == F.col("rid"))).alias("kept"),
        "text_sha256",
        F.size("recipe").alias("n_chunks"))


def keep_exact_unique(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that exact deduplication keeps, all columns. Texts are
    moved only for the rows that may have to go (``split_by_keys``)."""
    decided = materialize(exact_dedup(docs), "exact-decisions")
    dropped = decided.groupBy(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sum")) \
        .agg(F.count(F.lit(1)).alias("_rows"), F.max(F.col("kept").cast("int")).alias("_kept")) \
        .filter("_rows > 1 or _kept = 0")
    # Written first, so that Spark knows their size: few are broadcast.
    dropped = materialize(dropped, "dropped-copies")
    keyed = packed(docs, _doc=F.col("doc_id"), _own=F.sha2(text_or_empty(), 256))
    on = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_sum"))
    others, found = split_by_keys(keyed, ["_doc", "_own"], dropped, ["_id", "_sum"])
    rows = others.unionByName(found.join(dropped.select("_id", "_sum"), on, "left_anti"))
    # Rows that repeat both doc_id and text: one of them stays.
    repeated = materialize(dropped.filter("_rows > 1 and _kept = 1").select("_id", "_sum"), "repeated-rows")
    if not repeated.isEmpty():
        rows = rows.unionByName(found.join(repeated, on, "left_semi").dropDuplicates(["_doc", "_own"]))
    return rows.select("_row.*")
