"""Phrase collocations by dynamic itemset counting.

The corpus is split into shards that are scanned in a cycle. The scan begins
with single words. As soon as both subphrases of a longer phrase (all its words
but the last, all but the first) have reached the threshold in the shards seen
so far, the phrase is counted too, from the next shard on, until it has seen
every shard once. Lengths are thus counted interleaved: phrases of three words
start while those of two are under way. The scans end when no phrase is left
that has not completed its cycle.

Which phrases have reached the threshold is told to the tasks by a bit array of
fixed size (``filter_bits``, two bits a phrase), one as it is now and one as it
was a full cycle ago. A phrase is counted if both subphrases are in the first
and not both in the second. As bits are only ever added, this holds for exactly
one full cycle of every phrase, whatever the bits of other phrases do: a chance
hit costs a counted phrase more, never a wrong count.

While shards are scanned, phrases go by a number (40 bits of a hash, and the length), so a
step moves two numbers a phrase, sorted and packed by ranges of numbers, and its
counts are added up a range at a time and written once. Sorted numbers of few bits lie
close together: their differences are what is moved and written, about four bytes a phrase. Of the last
cycle's counts only those of phrases with a high count in some shard are moved and
added up (a second bit array tells which): a sum of ``threshold`` over the shards has one of threshold / shards or more.
Two phrases with one number could only make it reach the threshold too early. A
last scan counts the phrases themselves whose numbers reached it, so that all
results are exact counts of texts; these move sorted and compressed, a range of
numbers at a time, too.

On Spark: texts are split once into blocks (a dictionary of words and their
codes) in a table partitioned by shard; counting works on arrays of codes, block
by block. A block sends one count a phrase, so a phrase that is everywhere is one
entry a block; the ranges are of hashes and as many as shuffle partitions. The driver receives the bits newly set (at
most ``filter_bits`` / 64 rows a step). All steps are written tables in the shared
folder.

Defined results: a null text has no words, a null language is "und"; rows are
counted as they are, so repeated rows count each time; phrases never cross
pieces, rows or languages; texts of any length are split whole; an empty table
gives an empty result; ids and other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, materialize, new_work_dir, ranged_running_sum, shuffle_partitions

LONGEST = 4
SHARDS = 4
FILTER_BITS = 1 << 26          # 8 MB
BLOCK_BYTES = 4 << 20          # text in a block; a longer text is a block of its own
PIECE_ENDS = r"[.,;:!?\x0A-\x0D]+"
BREAK = -1                     # code between two pieces
BLOCKS = "lang string, words array<string>, hashes binary, codes binary, n_words bigint, shard int"
PARTS = "bucket int, part binary"
PHRASE_PARTS = "lang string, bucket int, len int, part binary"
COUNTS = "lang string, phrase string, len int, n bigint"
HASH_BITS = 40                 # of a number: its highest bits
SPOTS = (64 - HASH_BITS, 38)   # where in a number its two places in the bit array begin
_MIX = np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------------ splitting
def _codes(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of the texts and their codes in order, with BREAK
    between pieces and between texts."""
    marked = pc.replace_substring_regex(pc.ascii_lower(texts), PIECE_ENDS, " . ")   # no word holds a full stop any more
    marked = pc.binary_join_element_wise(pc.replace_substring(marked, "\t", " "), pa.scalar("."), " ")
    words = pc.split_pattern(marked, " ").flatten()
    words = words.filter(pc.not_equal(words, "")).dictionary_encode()
    codes, names = words.indices.to_numpy(zero_copy_only=False).astype(np.int32), words.dictionary
    at = pc.index(names, ".").as_py()
    if at >= 0:
        codes = np.where(codes == at, BREAK, codes)
    return names, codes


def _block_maker(shards: int) -> Callable:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId()
        waiting: dict[str, list[pa.Array]] = {}
        held: dict[str, int] = {}

        def flush(lang: str) -> pa.RecordBatch:
            nonlocal made
            texts = pa.concat_arrays(waiting.pop(lang))
            held.pop(lang)
            names, codes = _codes(texts)
            made += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([lang]), pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names),
                 pa.array([_word_hashes(names.to_pylist()).tobytes()], pa.binary()),
                 pa.array([codes.tobytes()], pa.binary()), pa.array([int((codes != BREAK).sum())]),
                 pa.array([made % shards], pa.int32())],
                names=["lang", "words", "hashes", "codes", "n_words", "shard"])

        for batch in batches:
            langs = batch.column("lang")
            for lang in pc.unique(langs).to_pylist():
                texts = batch.column("text").filter(pc.equal(langs, lang))
                start = 0
                ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
                base = held.get(lang, 0)
                while start < len(texts):  # cut where a block is full
                    done = int(ends[start - 1]) if start else 0
                    stop = min(int(np.searchsorted(ends, done + BLOCK_BYTES - base)) + 1, len(texts))
                    waiting.setdefault(lang, []).append(texts.slice(start, stop - start))
                    held[lang] = base = base + int(ends[stop - 1]) - done
                    if base >= BLOCK_BYTES:
                        yield flush(lang)
                        base = 0
                    start = stop
            while sum(held.values()) > 4 * BLOCK_BYTES:  # many languages: the fullest goes
                yield flush(max(held, key=held.get))
        for lang in list(waiting):
            yield flush(lang)
    return make


def word_blocks(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Blocks of coded words by language, in a table partitioned by shard."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col("text"), F.lit("")).alias("text"))
    path = new_work_dir(spark, "intermediate/word-blocks")
    arrow_map(texts, _block_maker(shards), BLOCKS).write.partitionBy("shard").parquet(path)
    return spark.read.schema(BLOCKS).parquet(path)


# ------------------------------------------------------------------- hashing
def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


def _word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w.encode()) for w in words), np.uint64, len(words))


def _seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode(), 1))


def _extended(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase followed by a word."""
    return _mixed(h * np.uint64(3) + word)


def _number(h: np.ndarray, length: int) -> np.ndarray:
    """The number of a phrase: the high bits of its hash, and the length in the last two bits."""
    return (h >> np.uint64(64 - HASH_BITS) << np.uint64(64 - HASH_BITS)) | np.uint64(length - 1)


def _has(bits: np.ndarray, number: np.ndarray, filter_bits: int) -> np.ndarray:
    """Whether both bits of each number are set."""
    mask, found = np.uint64(filter_bits - 1), None
    for at in ((number >> np.uint64(by)) & mask for by in SPOTS):
        hit = (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        found = hit if found is None else found & hit
    return found


def _with_bits(bits: np.ndarray, reached: DataFrame, filter_bits: int) -> np.ndarray:
    """``bits`` with those of the numbers ``reached.id`` added; at most one row a
    word of the array reaches the driver."""
    at = F.explode(F.array(*[F.expr(f"shiftrightunsigned(id, {by}) & {filter_bits - 1}L") for by in SPOTS])).alias("at")
    rows = reached.select(at).select(F.expr("shiftright(at, 6)").alias("word"), F.expr("shiftleft(1L, cast(at & 63 AS int))").alias("bit")) \
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = bits.copy()
    out[rows.column("word").to_numpy()] |= rows.column("bits").to_numpy().view(np.uint64)
    return out


# ------------------------------------------------------------------ counting
def _alive(lang: str, hashes: np.ndarray, codes: np.ndarray, arrays: tuple, filter_bits: int,
           longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Of each length the positions at which a phrase may be counted by the
    first bit array, their numbers, and for every array which of them it lets
    through. A phrase of two words or more is let through if both its subphrases
    are there and its own bits are set; that of ``longest`` words needs no bits."""
    at = np.flatnonzero(codes != BREAK)
    h = _extended(np.full(len(at), _seed(lang)), hashes[codes[at]])
    number = _number(h, 1)
    through = [_has(bits, number, filter_bits) for bits in arrays]
    yield 1, at, number, [np.ones(len(at), bool) for _ in arrays]
    for length in range(2, longest + 1):
        alive = through[0]
        at, h, through = at[alive], h[alive], [t[alive] for t in through]
        if len(at) < 2:
            return
        # Neighbouring positions: the subphrases here and one word on.
        pair = np.flatnonzero(at[1:] == at[:-1] + 1)
        both = [t[pair] & t[pair + 1] for t in through]
        at, h = at[pair], _extended(h[pair], hashes[codes[at[pair] + length - 1]])
        number = _number(h, length)
        yield length, at, number, both
        if length == longest:
            return
        through = [b & _has(bits, number, filter_bits) for b, bits in zip(both, arrays)]


def _block_arrays(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for row in range(batch.num_rows):
            yield (batch, row, batch.column("lang")[row].as_py(), np.frombuffer(batch.column("hashes")[row].as_buffer(), np.uint64),
                   np.frombuffer(batch.column("codes")[row].as_buffer(), np.int32))


def _planes(values: np.ndarray) -> bytes:
    """64-bit numbers, one byte plane after another: small ones compress well."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _unplaned(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _packed_counts(ids: np.ndarray, n: np.ndarray) -> bytes:
    """Ascending numbers (hashes as differences, then lengths) and their counts, compressed."""
    hashes, lengths = ids >> np.uint64(2), (ids & np.uint64(3)).astype(np.uint8)
    raw = _planes(np.diff(hashes, prepend=np.uint64(0))) + lengths.tobytes() + _planes(n)
    return len(ids).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def _unpacked_counts(part: bytes) -> tuple[np.ndarray, np.ndarray]:
    held = int.from_bytes(part[:8], "little")
    raw = memoryview(pa.decompress(part[8:], held * 17, "zstd"))
    hashes = np.cumsum(_unplaned(raw[:held * 8]), dtype=np.uint64)
    lengths = np.frombuffer(raw[held * 8:held * 9], np.uint8).astype(np.uint64)
    return hashes << np.uint64(2) | lengths, _unplaned(raw[held * 9:]).astype(np.int64)


def _count_numbers(now, before, filter_bits: int, longest: int) -> Callable:
    """(number, count) of the phrases of each block that are being counted, in
    order. ``before`` is None in the first cycle: single words are counted then."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = tuple(b.value for b in (now, before) if b is not None)
        for _, _, lang, hashes, codes in _block_arrays(batches):
            found = []
            for length, _, number, through in _alive(lang, hashes, codes, arrays, filter_bits, longest):
                if length == 1:
                    found += [] if before is not None else [number]
                else:
                    found.append(number[through[0] & ~through[1]] if before is not None else number[through[0]])
            ids, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            if len(ids):
                yield pa.RecordBatch.from_arrays([pa.array(ids.view(np.int64)), pa.array(n.astype(np.int64))], names=["id", "n"])
    return run


def _bucket(ids: np.ndarray, buckets: int) -> np.ndarray:
    return (ids >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)


def _by_bucket(count: Callable, buckets: int) -> Callable:
    """What ``count`` yields, packed by bucket, which is a range of numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in count(batches):
            ids, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "n"))
            ids = ids.view(np.uint64)
            edges = np.searchsorted(_bucket(ids, buckets), np.arange(buckets + 1, dtype=np.uint64))
            held = np.flatnonzero(np.diff(edges)).tolist()
            parts = [_packed_counts(ids[edges[b]:edges[b + 1]], n[edges[b]:edges[b + 1]]) for b in held]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(parts, pa.binary())], names=["bucket", "part"])
    return run


def _add_counts(table: pa.Table) -> pa.Table:
    """The parts of a bucket as one, with the counts of a number added up."""
    parts = [_unpacked_counts(p) for p in table.column("part").to_pylist()]
    ids, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(ids)
    ids, n = ids[order], n[order]
    first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    return pa.table([table.column("bucket").slice(0, 1), pa.array([_packed_counts(ids[first], np.add.reduceat(n, first))], pa.binary())],
                    names=["bucket", "part"])


def _unpack(pick: Callable) -> Callable:
    """Rows (id, n) of the packed numbers that ``pick(ids, n)`` lets through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.column("part"):
                ids, n = _unpacked_counts(part.as_py())
                hit = pick(ids, n)
                if hit.any():
                    yield pa.RecordBatch.from_arrays([pa.array(ids[hit].view(np.int64)), pa.array(n[hit])], names=["id", "n"])
    return run


def _with_some(some, filter_bits: int) -> Callable:
    return lambda ids, n: _has(some.value, ids, filter_bits)


def _from_count(high: int) -> Callable:
    return lambda ids, n: n >= high


def _packed_phrases(phrases: pa.Array, n: np.ndarray) -> bytes:
    """Phrases in order of their bytes, one a line (no word holds a line end), and their counts, compressed."""
    order = pc.sort_indices(phrases)
    lines = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(phrases)], pa.int32()), phrases.take(order)), "\n")[0].as_py().encode()
    raw = _planes(n[order.to_numpy()]) + lines
    return len(n).to_bytes(8, "little") + len(raw).to_bytes(8, "little") + pa.Codec("zstd", 3).compress(raw, asbytes=True)


def _unpacked_phrases(part: bytes) -> tuple[pa.Array, np.ndarray]:
    held, size = (int.from_bytes(part[at:at + 8], "little") for at in (0, 8))
    raw = pa.decompress(part[16:], size, "zstd").to_pybytes()
    return pc.split_pattern(pa.array([raw[held * 8:].decode()]), "\n").flatten(), _unplaned(raw[:held * 8]).astype(np.int64)


def _count_phrases(final, filter_bits: int, longest: int, buckets: int) -> Callable:
    """Of each block the phrases whose numbers are in the array and their counts,
    packed by bucket, which is a range of numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = final.value
        for batch, row, lang, hashes, codes in _block_arrays(batches):
            words = batch.column("words")[row].values
            for length, at, number, _ in _alive(lang, hashes, codes, (bits,), filter_bits, longest):
                own = _has(bits, number, filter_bits)
                parts = [words.take(pa.array(codes[at[own] + i])) for i in range(length)]
                phrases = (pc.binary_join_element_wise(*parts, " ") if length > 1 else parts[0]).dictionary_encode()
                code = phrases.indices.to_numpy(zero_copy_only=False)
                n, numbers = np.bincount(code, minlength=len(phrases.dictionary)), np.zeros(len(phrases.dictionary), np.uint64)
                numbers[code] = number[own]
                bucket = _bucket(numbers, buckets)
                order = np.argsort(bucket, kind="stable")
                edges = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
                held = np.flatnonzero(np.diff(edges)).tolist()
                packed = [_packed_phrases(phrases.dictionary.take(pa.array(order[edges[b]:edges[b + 1]])), n[order[edges[b]:edges[b + 1]]])
                          for b in held]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(held), pa.string()), pa.array(held, pa.int32()),
                                                  pa.array([length] * len(held), pa.int32()), pa.array(packed, pa.binary())],
                                                 names=["lang", "bucket", "len", "part"])
    return run


def _add_phrases(threshold: int) -> Callable:
    """The phrases of a bucket that occur ``threshold`` times or more, with their counts added up."""
    def run(table: pa.Table) -> pa.Table:
        phrases, n = zip(*[_unpacked_phrases(p) for p in table.column("part").to_pylist()])
        sums = pa.table({"phrase": pa.concat_arrays(phrases), "n": np.concatenate(n)}).group_by("phrase").aggregate([("n", "sum")])
        sums = sums.filter(pc.greater_equal(sums.column("n_sum"), threshold))
        lang, length = (pa.repeat(table.column(c)[0], len(sums)) for c in ("lang", "len"))
        return pa.table([lang, sums.column("phrase"), length, sums.column("n_sum")], names=["lang", "phrase", "len", "n"])
    return run


def reached_numbers(blocks: DataFrame, threshold: int, longest: int = LONGEST, shards: int = SHARDS,
                    filter_bits: int = FILTER_BITS) -> tuple[list[DataFrame], int]:
    """The interleaved scans: per step the numbers that reached ``threshold`` in
    it (written tables with ``id``), and the number of steps."""
    context, buckets = blocks.sparkSession.sparkContext, shuffle_partitions(blocks.sparkSession)
    history = [np.zeros(filter_bits // 64, np.uint64)]     # the bit array as each step found it
    counts, reached, step = [], [], 0
    high, high_bits = -(-threshold // shards), np.zeros(filter_bits // 64, np.uint64)
    while step < shards or not np.array_equal(history[step], history[step - shards]):
        shared = [context.broadcast(history[step]), context.broadcast(history[step - shards]) if step >= shards else None]
        scanned = blocks.where(F.col("shard") == step % shards).select("lang", "hashes", "codes")
        found = arrow_map(scanned, _by_bucket(_count_numbers(*shared[:2], filter_bits, longest), buckets), PARTS)
        counts.append(materialize(found.groupBy("bucket").applyInArrow(_add_counts, PARTS), "phrase-counts"))
        cycle = counts[max(0, step - shards + 1):]
        # Numbers with a high count in some shard; others that the bits let through
        # by chance cost a row, as the sums are exact.
        high_bits = _with_bits(high_bits, arrow_map(counts[step], _unpack(_from_count(high)), "id bigint, n bigint"), filter_bits)
        some = context.broadcast(high_bits)
        total, new = F.sum("n"), F.coalesce(F.sum(F.when(F.col("now"), F.col("n"))), F.lit(0))
        rows = [arrow_map(c, _unpack(_with_some(some, filter_bits)), "id bigint, n bigint")
                .withColumn("now", F.lit(i == len(cycle))) for i, c in enumerate(cycle, 1)]
        sums = reduce(DataFrame.unionByName, rows).groupBy("id").agg(total.alias("total"), new.alias("new"))
        reached.append(materialize(sums.where((F.col("total") >= threshold) & (F.col("total") - F.col("new") < threshold))
                                   .select("id"), "phrases-reached"))
        shared.append(some)
        for b in shared:
            if b is not None:
                b.destroy()  # the step's tables are written: nothing reads it again
        shorter = reached[step].where(F.col("id").bitwiseAND(F.lit(3)) < longest - 1)
        history.append(_with_bits(history[step], shorter, filter_bits))
        if step >= shards:
            history[step - shards] = None
        step += 1
    return reached, step


def frequent_phrases(blocks: DataFrame, threshold: int, longest: int = LONGEST, shards: int = SHARDS,
                     filter_bits: int = FILTER_BITS) -> DataFrame:
    """(lang, phrase, len, n): every phrase of 1 to ``longest`` words that
    occurs ``threshold`` times or more, with its exact count; a written table."""
    reached, _ = reached_numbers(blocks, threshold, longest, shards, filter_bits)
    numbers = reached[0]
    for part in reached[1:]:
        numbers = numbers.unionByName(part)
    bits = _with_bits(np.zeros(filter_bits // 64, np.uint64), numbers, filter_bits)
    final = blocks.sparkSession.sparkContext.broadcast(bits)
    buckets = shuffle_partitions(blocks.sparkSession)
    found = arrow_map(blocks.select("lang", "words", "hashes", "codes"), _count_phrases(final, filter_bits, longest, buckets), PHRASE_PARTS)
    counted = materialize(found.groupBy("lang", "bucket", "len").applyInArrow(_add_phrases(threshold), COUNTS), "frequent-phrases")
    final.destroy()
    return counted


# ------------------------------------------------------------------- scoring
def _part(start, length):
    return F.array_join(F.slice(F.col("w"), start, length), " ")


def scored_candidates(frequent: DataFrame) -> DataFrame:
    """Candidates of two words and more with their lowest-scoring cut: a, l, r,
    score. Every part of a candidate is at least as frequent, so its count is
    in ``frequent``."""
    counts = frequent.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    cuts = frequent.where("len >= 2").select("lang", "phrase", "len", F.col("n").alias("a"), F.split("phrase", " ").alias("w")) \
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("len") - 1)))
    first = cuts.withColumn("part", _part(F.lit(1), F.col("k"))).withColumn("rest", _part(F.col("k") + 1, F.col("len") - F.col("k"))) \
        .drop("w").join(counts.withColumnRenamed("f", "l"), ["lang", "part"]).drop("part")
    both = first.withColumnRenamed("rest", "part").join(counts.withColumnRenamed("f", "r"), ["lang", "part"])
    score = F.expr("CAST(2000000 AS DECIMAL(10,0)) * CAST(a AS DECIMAL(20,0)) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    lowest = F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r"))
    return both.groupBy("lang", "phrase").agg(F.max("len").alias("len"), F.max("a").alias("a"), lowest.alias("cut")) \
        .select("lang", "phrase", "len", "a", "cut.l", "cut.r", "cut.score")


def without_fragments(candidates: DataFrame, percent: int) -> DataFrame:
    """Candidates that are not mostly a part of one longer candidate."""
    inner = candidates.where("len > 2").select("lang", F.col("a").alias("longer"), "len", F.split("phrase", " ").alias("w")) \
        .withColumn("size", F.explode(F.sequence(F.lit(2), F.col("len") - 1))) \
        .withColumn("start", F.explode(F.sequence(F.lit(1), F.col("len") - F.col("size") + 1))) \
        .select("lang", _part(F.col("start"), F.col("size")).alias("phrase"), "longer")
    most = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    share = F.expr(f"CAST(100 AS DECIMAL(3,0)) * longer >= CAST({percent} AS DECIMAL(3,0)) * a")
    return candidates.join(most, ["lang", "phrase"], "left").where(F.col("longer").isNull() | ~share).drop("longer")


def collocations(docs: DataFrame, threshold: int = 30, top: int = 2000, fragment_percent: int = 80,
                 longest: int = LONGEST, shards: int = SHARDS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """The best collocations of every language: lang, rank, phrase, a, l, r, n,
    score. Ranks come from a range sort, not from one task a language."""
    blocks = word_blocks(docs, shards)
    totals = blocks.groupBy("lang").agg(F.sum("n_words").alias("n"))
    frequent = frequent_phrases(blocks, threshold, longest, shards, filter_bits)
    kept = without_fragments(materialize(scored_candidates(frequent), "candidates"), fragment_percent)
    ordered = kept.select("lang", "phrase", "a", "l", "r", "score", (-F.col("score")).alias("by_score"),
                          (-F.col("a")).alias("by_a"), F.lit(1).cast("bigint").alias("one"))
    ranked = ranged_running_sum(materialize(ordered, "kept"), ["lang", "by_score", "by_a", "phrase"], "one", "lang")
    return ranked.where(F.col("running") <= top).join(totals, "lang") \
        .select("lang", F.col("running").alias("rank"), "phrase", "a", "l", "r", "n", "score")
