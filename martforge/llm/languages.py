"""Language identification by error-correcting output codes.

Every language has a codeword of bits that lie far apart: all splits of the
languages for up to six, the best of seeded random codes beyond. A bit is
predicted by a binary classifier over hashed byte n-grams of the letters of a
text: its weight for an n-gram is the log odds between the languages with the
bit and those without, each language counting alike. The mean weight of a text
is the margin of the bit.

A text goes to the language whose codeword has the least loss, the logistic
loss of every bit weighted by how often its classifier is right for texts of
that language (loss-weighted decoding). The predicted bits may thus be wrong in
places and still be nearest to the right codeword. A prediction is flagged
ambiguous if the two best languages are close, or if more bits are wrong than
the code can correct.

Learning covers all rows with a language that are not held out: n-grams are
counted per language and half of the rows (by a hash of the text), one half's
classifiers are judged on the other half's rows (accuracy and spread of the
margins), and the classifiers in use are of both halves. The driver receives one
row per language, per language and bit, and per bucket: their number does not
depend on the number of documents.

Defined results: a null text or one without a letter is "und" with score 0, as is
every text when no row can be learned from; with one language that is the
prediction, with score 1. Rows with a null language or a null doc_id are predicted,
not learned from; a null doc_id is not held out. Repeated rows, texts of any
length (read whole) and ties (the first language by name) have no special case;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, binary_view, materialize

BUCKETS = 1 << 16
LENGTHS = (2, 3, 4)        # bytes of an n-gram
SMOOTHING = 0.5            # added to every count
EXHAUSTIVE = 6             # languages up to which all splits are used
CODES_TRIED = 200
NEAR = 0.9                 # a score below this is flagged
CELLS = 8 << 20            # numbers a task holds for n-grams at a time
HELD_LANGUAGES = 32        # languages a task counts at a time
UNDETERMINED = "und"
NO_LETTERS = r"[^\pL\pM]+"


def held_out() -> Column:
    """Rows never learned from: crc32(doc_id as text) mod 4 = 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


# ---------------------------------------------------------------------- codes
def codewords(k: int, seed: int = 11) -> np.ndarray:
    """k rows of +1 and -1, no column constant."""
    if k < 2:
        return np.ones((k, 0), np.int8)
    if k <= EXHAUSTIVE:  # every split once: the first language is always +1
        columns = [[1] + [1 if (c >> i) & 1 else -1 for i in range(k - 1)] for c in range(2 ** (k - 1) - 1)]
        return np.array(columns, np.int8).T
    bits = int(np.ceil(10 * np.log2(k)))
    rng, best, best_distance = np.random.default_rng(seed), None, -1
    for _ in range(CODES_TRIED):
        code = rng.choice(np.array([-1, 1], np.int8), (k, bits))
        if (np.abs(code.sum(0, dtype=np.int64)) == k).any():
            continue
        distance = least_distance(code)
        if distance > best_distance:
            best, best_distance = code, distance
    return best


def least_distance(code: np.ndarray) -> int:
    wide = code.astype(np.int64)
    agreeing = wide @ wide.T
    np.fill_diagonal(agreeing, -code.shape[1])
    return int((code.shape[1] - agreeing.max()) // 2)


# ------------------------------------------------------------------- features
def letters_of(texts: pa.Array) -> pa.Array:
    """Lower-case letters with one blank for every run of anything else, and a
    blank at both ends."""
    words = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), NO_LETTERS, " ")
    return pc.binary_join_element_wise("", pc.utf8_trim(words, " "), "", " ")


def has_letter(texts: pa.Array) -> np.ndarray:
    return pc.match_substring_regex(pc.fill_null(texts, ""), r"\pL").to_numpy(zero_copy_only=False)


def gram_buckets(texts: pa.Array, cells: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, row) of every n-gram of the prepared texts, in portions of about
    ``cells`` numbers; an n-gram never crosses rows."""
    data, offsets = binary_view(texts)
    step = max(cells, 1)
    for start in range(int(offsets[0]), int(offsets[-1]), step):
        stop = min(start + step, int(offsets[-1]))
        window = data[start:min(stop + max(LENGTHS) - 1, int(offsets[-1]))].astype(np.uint32)
        row = np.searchsorted(offsets, np.arange(start, stop), side="right") - 1
        room = offsets[row + 1] - np.arange(start, stop)   # bytes left in the row
        h = np.zeros(stop - start, np.uint32)
        for n in range(1, max(LENGTHS) + 1):
            size = min(stop - start, len(window) - n + 1)
            if size <= 0:
                break
            h = h[:size] * np.uint32(0x01000193) + window[n - 1:n - 1 + size] + np.uint32(1)
            if n in LENGTHS:
                fits = room[:size] >= n
                mixed = (h + np.uint32(n)) * np.uint32(0x9E3779B1)
                yield (mixed >> np.uint32(16))[fits].astype(np.int64), row[:size][fits]


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-gram counts by (language, half, bucket); bucket -1 counts the texts."""
    held: dict[tuple[str, int], np.ndarray] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, half), counts in held.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(np.full(len(at), half, np.int32)),
                 pa.array((at - 1).astype(np.int32)), pa.array(counts[at])], names=["lang", "half", "bucket", "n"])
        held.clear()

    for batch in batches:
        halves = batch.column("half").to_numpy(zero_copy_only=False)
        groups = batch.column("lang").dictionary_encode()
        codes = groups.indices.to_numpy(zero_copy_only=False)
        for code, lang in enumerate(groups.dictionary.to_pylist()):
            for half in (0, 1):
                texts = letters_of(batch.column("text").filter(pa.array((codes == code) & (halves == half))))
                if not len(texts):
                    continue
                counts = held.setdefault((lang, half), np.zeros(BUCKETS + 1, np.int64))
                counts[0] += len(texts)
                for bucket, _ in gram_buckets(texts, CELLS):
                    counts[1:] += np.bincount(bucket, minlength=BUCKETS)
                if len(held) > 2 * HELD_LANGUAGES:
                    yield from flush()
    yield from flush()


# ---------------------------------------------------------------------- model
@dataclass
class Model:
    languages: list[str]
    code: np.ndarray                       # language x bit, +1 or -1
    weights: np.ndarray                    # bucket x bit, log odds
    slope: np.ndarray = field(default=None)    # margin to log odds of a bit
    shift: np.ndarray = field(default=None)
    trust: np.ndarray = field(default=None)    # language x bit, rows sum to the number of bits

    def margins(self, texts: pa.Array) -> np.ndarray:
        """Mean weight of the n-grams of every prepared text, by bit."""
        total, number = np.zeros((len(texts), self.weights.shape[1])), np.zeros(len(texts))
        for bucket, row in gram_buckets(texts, CELLS // max(self.weights.shape[1], 1)):
            if not len(row):
                continue
            starts = np.flatnonzero(np.diff(row, prepend=-1))
            total[row[starts]] += np.add.reduceat(self.weights[bucket], starts, axis=0)
            number[row[starts]] += np.diff(np.append(starts, len(row)))
        return total / np.maximum(number, 1)[:, None]

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language, score, ambiguous) of every text by its margins."""
        z = margins * self.slope + self.shift
        loss = np.zeros((len(z), len(self.languages)))
        for j in range(len(self.languages)):
            loss[:, j] = (np.logaddexp(0, -z * self.code[j]) * self.trust[j]).sum(1)
        best = loss.argmin(1)
        likely = np.exp(loss.min(1, keepdims=True) - loss)
        score = 1 / likely.sum(1)
        wrong = (np.sign(z) != self.code[best]).sum(1)
        return best, score, (score < NEAR) | (wrong > (least_distance(self.code) - 1) // 2 if len(self.languages) > 1 else False)


def _log_odds(code: np.ndarray, sizes: np.ndarray) -> Callable:
    """The weights of a bucket from its counts per language."""
    norm = 1.0 / (sizes + SMOOTHING * BUCKETS)
    plus, minus = (code > 0).astype(float), (code < 0).astype(float)
    n_plus, n_minus = np.maximum(plus.sum(0), 1), np.maximum(minus.sum(0), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for counts in batch.column("counts").to_pylist():
                rate = np.full(len(sizes), SMOOTHING)
                for c in counts:
                    rate[c["language"]] += c["n"]
                rate *= norm
                out.append((np.log(rate @ plus / n_plus) - np.log(rate @ minus / n_minus)).tolist())
            yield pa.RecordBatch.from_arrays([batch.column("bucket"), pa.array(out, pa.list_(pa.float64()))],
                                             names=["bucket", "weights"])
    return run


def _classifiers(counts: DataFrame, languages: list[str], code: np.ndarray) -> Model:
    """One classifier a bit from (lang, bucket, n); a row per bucket reaches the driver."""
    spark = counts.sparkSession
    numbers = spark.createDataFrame([(l, i) for i, l in enumerate(languages)], "lang string, language int")
    grams = counts.where("bucket >= 0").join(numbers, "lang")
    sizes = np.zeros(len(languages))
    for language, n in grams.groupBy("language").agg(F.sum("n")).collect():
        sizes[language] = n
    rows = grams.groupBy("bucket", "language").agg(F.sum("n").alias("n")) \
        .groupBy("bucket").agg(F.collect_list(F.struct("language", "n")).alias("counts"))  # at most one per language
    found = arrow_map(rows, _log_odds(code, sizes), "bucket int, weights array<double>").toArrow()
    rest = SMOOTHING / (sizes + SMOOTHING * BUCKETS)  # buckets that no text has
    plus, minus = (code > 0).astype(float), (code < 0).astype(float)
    never = np.log(rest @ plus / np.maximum(plus.sum(0), 1)) - np.log(rest @ minus / np.maximum(minus.sum(0), 1))
    weights = np.tile(never, (BUCKETS, 1))
    if found.num_rows:
        flat = found.column("weights").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        weights[found.column("bucket").to_numpy()] = flat.reshape(found.num_rows, -1)
    return Model(languages, code, weights.astype(np.float32))


def _judge(model: Model) -> Callable:
    """Per language and bit: texts, right ones, and sums of the margins."""
    place = {l: i for i, l in enumerate(model.languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((len(model.languages), model.code.shape[1], 4))
        for batch in batches:
            m = model.margins(letters_of(batch.column("text")))
            of = np.array([place[l] for l in batch.column("lang").to_pylist()], np.int64)
            right = np.sign(m) == model.code[of]
            for i, value in enumerate((np.ones_like(m), right, m, m * m)):
                np.add.at(out[:, :, i], of, value)
        at, bit = np.nonzero(out[:, :, 0])
        cells = out[at, bit]
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(bit.astype(np.int32)), *(pa.array(cells[:, i]) for i in range(4))],
            names=["language", "bit", "n", "right", "total", "squares"])
    return run


def calibrate(model: Model, cells: np.ndarray) -> None:
    """Set slope, shift and trust from the judged margins (language x bit x
    (texts, right, sum, sum of squares)): margins of each side of a bit are
    taken as normal with one spread, languages counting alike."""
    k, bits = model.code.shape
    n = np.maximum(cells[:, :, 0], 1e-9)
    seen = cells[:, :, 0] > 0
    mean, variance = cells[:, :, 2] / n, np.maximum(cells[:, :, 3] / n - (cells[:, :, 2] / n) ** 2, 0)
    model.slope, model.shift = np.full(bits, 4.0), np.zeros(bits)
    for b in range(bits):
        sides = [seen[:, b] & (model.code[:, b] == s) for s in (1, -1)]
        if sides[0].any() and sides[1].any():
            up, down = (mean[s, b].mean() for s in sides)
            spread = np.mean([variance[s, b].mean() + mean[s, b].var() for s in sides]) + 1e-3
            if up > down:
                model.slope[b] = (up - down) / spread
                model.shift[b] = -(up * up - down * down) / (2 * spread)
    right = np.where(seen, (cells[:, :, 1] + 1) / (n + 2), 0.5)
    model.trust = right / right.sum(1, keepdims=True) * bits if bits else right


def learn(docs: DataFrame) -> Model | None:
    """The model of all rows that have a language and are not held out."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.where(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & text.rlike(r"\p{L}")) \
        .select(F.col("lang").cast("string").alias("lang"), F.pmod(F.xxhash64(text), F.lit(2)).cast("int").alias("half"),
                text.alias("text"))
    counts = materialize(arrow_map(rows, _count_grams, "lang string, half int, bucket int, n bigint")
                         .groupBy("lang", "half", "bucket").agg(F.sum("n").alias("n")), "language-grams")
    languages = [r[0] for r in counts.select("lang").distinct().orderBy("lang").collect()]
    if not languages:
        return None
    code = codewords(len(languages))
    model = _classifiers(counts, languages, code)
    cells = np.zeros((*code.shape, 4))
    if code.shape[1]:
        half = _classifiers(counts.where("half = 0"), languages, code)
        judged = arrow_map(rows.where("half = 1").select("lang", "text"), _judge(half),
                           "language int, bit int, n double, right double, total double, squares double")
        for r in judged.groupBy("language", "bit").agg(*[F.sum(c).alias(c) for c in ("n", "right", "total", "squares")]).collect():
            cells[r["language"], r["bit"]] = r["n"], r["right"], r["total"], r["squares"]
    calibrate(model, cells)
    return model


def _predict(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column("text")
            known = has_letter(texts)
            best, score, ambiguous = model.decode(model.margins(letters_of(texts)))
            names = np.array([*model.languages, UNDETERMINED], dtype=object)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"),
                 pa.array(names[np.where(known, best, len(model.languages))].tolist(), pa.string()),
                 pa.array(np.where(known, score, 0.0)), pa.array(~known | ambiguous)],
                names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"])
    return run


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous of every row."""
    model = learn(docs)
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(True).alias("ambiguous"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(rows, _predict(docs.sparkSession.sparkContext.broadcast(model)),
                     f"doc_id {kind}, held_out boolean, lang_pred string, score double, ambiguous boolean")
