"""SimHash near-duplicates with covering locality-sensitive hashing.

Fingerprints within ``radius`` bits are found without a miss: every bit
position gets a non-zero vector of F_2^(radius+1), and table ``v`` (one for
each non-zero vector) keeps the bits whose vector has inner product 1 with
``v``. Any ``radius`` positions span less than the space, so some ``v`` is
orthogonal to all of them: the masks of that table hide every differing bit
and the pair meets in one bucket.

Inside a bucket no pairs are formed. Two fingerprints at distance 2 or less
have a common neighbour at distance 1 or less from both, which differs from
them in hidden bits only. So each member of a shared bucket votes for itself
and its one-bit variants over the hidden bits, and all voters of one variant
(65 at most) are linked to the smallest of them: groups of any size stay
linear, and every link is checked by bit distance. Connected components of
these links come from distributed min-label rounds.

Defined results: a null or wordless text has fingerprint zero and is linked
like any other; rows with a null doc_id take part and count as larger than
every doc_id; repeated rows each get their row; texts of any length and groups of
any size are taken whole; an empty table gives no rows; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, binary_view, materialize, packed, text_or_empty

BITS = 64
SEED = 42
_BLOCK = 1 << 16  # hashes whose bits are counted at once


def shingle_hashes(raw: bytes, shingle: int) -> list[int]:
    """XXH64 of each run of ``shingle`` words of the lower-cased bytes; of the
    whole sequence if it is shorter; none without words."""
    words = raw.lower().split()
    n = len(words)
    if not n:
        return []
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if n <= shingle:
        return [digest(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n - shingle + 1].tolist()
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())]


def simhash_of(hashes: list[int]) -> int:
    """Bit i is 1 if it is set in over half of the hashes."""
    if not hashes:
        return 0
    h = np.array(hashes, dtype=np.uint64)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(h), _BLOCK):
        block = h[at:at + _BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(h), bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprinter(shingle: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = binary_view(batch.column("text"))
            out = np.fromiter(
                (simhash_of(shingle_hashes(data[a:b].tobytes(), shingle))
                 for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out.view(np.int64))],
                                             names=["doc_id", "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, fp (the 64 bits as a long) of every whole text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    return arrow_map(rows, _fingerprinter(shingle), f"doc_id {kind}, fp bigint")


def covering_masks(radius: int) -> list[int]:
    """The kept bits of each table, as unsigned 64-bit masks."""
    vectors = (1 << (radius + 1)) - 1
    of_bit = [1 + i % vectors for i in range(BITS)]
    return [sum(1 << i for i in range(BITS) if bin(of_bit[i] & v).count("1") % 2) for v in range(1, vectors + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def link_fingerprints(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Links (a, b) between the distinct values of ``prints.fp`` whose
    components are those of all pairs within ``radius`` (0, 1 or 2) bits."""
    if radius not in (0, 1, 2):
        raise ValueError("radius must be 0, 1 or 2")
    tables = F.array(*[
        F.struct(F.lit(v).alias("v"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("key"))
        for v, mask in enumerate(covering_masks(radius))])
    placed = prints.select("fp", F.explode(tables).alias("t")).select("fp", "t.v", "t.key")
    shared = placed.groupBy("v", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("v", "key")
    met = placed.join(shared, ["v", "key"], "left_semi")
    hidden = [[1 << i for i in range(BITS) if not mask >> i & 1] for mask in covering_masks(radius)]
    flips = F.element_at(F.array(*[F.array(*[F.lit(_signed(x)) for x in [0, *own]]) for own in hidden]),
                         F.col("v") + 1)
    votes = met.select("fp", F.explode(flips).alias("flip")) \
        .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("at"))
    if radius < 2:  # one voter of each pair is the other fingerprint itself
        centre = votes.join(prints.select(F.col("fp").alias("at")), "at", "left_semi")
        return centre.filter("fp != at").select(F.least("fp", "at").alias("a"), F.greatest("fp", "at").alias("b")) \
            .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).distinct()
    balls = votes.groupBy("at").agg(F.collect_set("fp").alias("ball")).filter(F.size("ball") > 1)
    links = balls.select(F.array_min("ball").alias("a"), F.explode("ball").alias("b")).filter("a != b")
    return links.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).distinct()


def components(links: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches.

    Rounds of star contraction: every node joins its neighbours to the
    smallest neighbour (larger ones first, then smaller ones), which halves
    path lengths, until no link changes. Each round is written to the shared
    folder; minima are map-side aggregates, so a hub is not one task.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("w")).distinct(), "links")
    before = None
    for _ in range(max_rounds):
        both = edges.select("u", "w").unionByName(edges.select(F.col("w").alias("u"), F.col("u").alias("w")))
        low = both.groupBy("u").agg(F.least(F.min("w"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("w > u").select(F.col("w").alias("u"), F.col("m").alias("w"))
        tops = low.filter("m < u").select("u", F.col("m").alias("w"))
        large = large.unionByName(tops).filter("u != w").distinct()
        small_low = large.groupBy("u").agg(F.min("w").alias("m"))
        small = large.join(small_low, "u")
        small = small.select(F.col("w").alias("u"), F.col("m").alias("w")).filter("u != w") \
            .unionByName(small_low.select("u", F.col("m").alias("w"))).distinct()
        edges = materialize(small, "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "w").cast("long"))).first()
        if tuple(now) == before:
            return edges.groupBy("u").agg(F.min("w").alias("root")).select(F.col("u").alias("node"), "root") \
                .unionByName(edges.select(F.col("w").alias("node"), F.col("w").alias("root")).distinct())
        before = tuple(now)
    raise RuntimeError("components did not settle")


def simhash_groups(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id
    (smallest doc_id of the component), rid (a frozen row number), fp and root
    (the component's smallest fingerprint, as longs)."""
    prints = materialize(fingerprints(docs, shingle).withColumn("rid", F.monotonically_increasing_id()),
                         "fingerprints")
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"),
                                                 F.count(F.lit(1)).alias("copies")), "fingerprint-nodes")
    roots = components(link_fingerprints(nodes, radius))
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left") \
        .select("fp", "first_id", "copies", F.coalesce("root", "fp").alias("root"))
    placed = materialize(placed, "fingerprint-roots")
    heads = placed.filter("root != fp").select("root").distinct()
    # Components of one fingerprint need no exchange of their members.
    heads = placed.join(heads, "root", "left_semi").groupBy("root").agg(F.min("first_id").alias("component_first"))
    labels = placed.join(heads, "root", "left").select(
        "fp", F.when(F.col("component_first").isNull(), F.col("first_id"))
        .otherwise(F.col("component_first")).alias("component_id"),
        "copies", "root", F.col("component_first").isNotNull().alias("linked"))
    labels = labels.filter("copies > 1 or linked")
    out = prints.join(labels, "fp", "left")
    return out.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.coalesce("component_id", "doc_id").alias("component_id"), "rid", "fp", F.coalesce("root", "fp").alias("root"))


def keep_first_of_groups(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row of each near-duplicate group of ``docs`` (that of its smallest
    doc_id), all columns. Of rows of one group that repeat this doc_id, the one
    with the smallest text stays; other rows of that doc_id belong to groups
    of their own or are dropped with theirs."""
    groups = materialize(simhash_groups(docs, shingle, radius), "simhash-groups")
    special = groups.groupBy(F.col("doc_id").alias("_id")).agg(
        F.count(F.lit(1)).alias("_rows"), F.sum((F.col("doc_id").eqNullSafe(F.col("component_id"))).cast("int")).alias("_heads")) \
        .filter("_rows > 1 or _heads = 0 or _id is null")
    # Only dropped and repeated doc_ids are joined; the rest passes. They are
    # written first, so that Spark knows their size: few are broadcast and the
    # texts stay where they are.
    special = materialize(special, "special-ids")
    keyed = packed(docs, _doc=F.col("doc_id"))
    on = F.col("_doc").eqNullSafe(F.col("_id"))
    single = keyed.join(special.select("_id"), on, "left_anti")
    repeated = materialize(special.filter("_heads > 0").select("_id"), "repeated-ids")
    again = packed(docs, _doc=F.col("doc_id"), _own_text=text_or_empty()).join(repeated, on, "left_semi")
    heads = groups.filter("doc_id <=> component_id").join(repeated, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    return single.select("_row").unionByName(_one_of_repeated_ids(again, heads, shingle)).select("_row.*")


def _one_of_repeated_ids(rows: DataFrame, heads: DataFrame, shingle: int) -> DataFrame:
    """The kept ones among the packed rows whose doc_id is repeated or null."""
    kind = rows.schema["_doc"].dataType.simpleString()
    texts = rows.select(F.col("_doc").alias("doc_id"), F.col("_own_text").alias("text")).distinct()
    printed = arrow_map(texts, _fingerprinter_with_text(shingle), f"_id {kind}, _text string, _fp bigint")
    heads = heads.select(F.col("fp").alias("_print"), F.col("doc_id").alias("_own"), F.col("root").alias("_root")).distinct()
    heads = printed.join(heads, (F.col("_fp") == F.col("_print")) & F.col("_id").eqNullSafe(F.col("_own")))
    first = heads.groupBy("_id", "_root").agg(F.min("_text").alias("_text")).select("_id", "_text")
    return rows.join(first, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_own_text") == F.col("_text")), "left_semi") \
        .dropDuplicates(["_doc", "_own_text"]).select("_row")


def _fingerprinter_with_text(shingle: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = _fingerprinter(shingle)
        for batch in batches:
            for out in one([batch]):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), out.column("fp")],
                                                 names=["_id", "_text", "_fp"])
    return run
