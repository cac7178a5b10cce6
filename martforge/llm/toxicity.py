"""Toxicity by a learned lexicon, fuzzy matching and context windows.

The lexicon holds words and word stems whose share of toxic documents is far
above the base rate in a bounded sample of the labelled training rows; its
counts are Spark aggregates. The terms form a trie. A word is looked up by
running the Levenshtein automaton of the word along the trie, so that one
edit in any term still hits; words whose untouched half cannot be that of
any term are passed over first (with one edit, the first or the second half
of a term is intact). Words near a term that clean training rows use (as
"oron" beside "moron") are counted there and are no misspellings. A word may
hold digits and inner symbols ("l0ser", "st*pid"); if it is no term or
misspelling as a whole, its runs of letters are looked up.

Every hit is read in its context: a window of words around it, with quotation
marks and words of reporting, decides whether the term is quoted or used.
Counts of both kinds, the density and the densest window are the features of
a logistic regression fitted on the same sample, each row as it is written and
as if its terms were misspelled. For these rows the harmless near words come
from the other half of the sample, so that the weights know how often a word
that was never counted is near a term by chance.

Score inputs are the text only. Rows with crc32(doc_id as text) mod 3 = 1 are
held out and never read for learning.

Defined results: a null or empty text has no hits and gets the score of a
text without hits; a null doc_id is not held out; without labelled rows of
both kinds the score is 0; repeated rows each get their row, equal texts equal
scores; texts of any length are read whole; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, materialize, text_or_empty, unused_name, with_fields

SAMPLE_ROWS = 16_000      # labelled rows that the lexicon and the weights are fitted on
CANDIDATE_TERMS = 10_000  # strongest terms that the lexicon is chosen from
LEXICON_TERMS = 500       # terms kept at most
MIN_DOCUMENTS = 6         # toxic documents that a term must occur in
MIN_PURITY = 0.9          # share of toxic documents with the term, classes weighed alike
NEARLY = 0.9              # a longer term with this share of a stem's toxic documents replaces it
MIN_GAIN = 25.0           # log-likelihood gain over the base rate, in nats
STEM_LENGTHS = range(3, 9)
FUZZY_LENGTH = 1          # terms of this length and more may hold one edit: all of them
FREQUENT = 0.02           # share of toxic documents that makes a pure term one in any case
WINDOW = 5                # words of context on each side
THRESHOLD = 0.7
KNOWN_WORDS = 300_000     # words without a hit that a worker remembers

WORDS = re.compile(r"[^\W_]+(?:[*@$!#%&+|^~_.-]{1,3}[^\W_]+)*")
LETTERS = re.compile(r"[^\W\d_]+")
# The marks that close a quotation opened by each mark.
CLOSING = {'"': '"', "“": "”", "„": "“”", "”": "”", "«": "»", "»": "«", "‘": "’", "‚": "‘’"}
MARKS = re.compile("[\"“”„«»‘’‚\n]")
REPORTING = frozenset("said says wrote called quote quoted term word words reads titled "
                      "dit écrit mot sagte schrieb wort dijo escribió palabra".split())


def held_out() -> Column:
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(crc % 3 == 1, F.lit(False))


@dataclass
class Trie:
    """Lexicon terms; ``stem`` nodes accept every continuation."""
    terms: list[tuple[str, bool]]
    root: dict = field(init=False)

    def __post_init__(self):
        self.root = {}
        for term, stem in self.terms:
            node = self.root
            for c in term:
                node = node.setdefault(c, {})
            node["stem" if stem else "end"] = term
        self.words = {t for t, stem in self.terms if not stem}
        self.stems = {t for t, stem in self.terms if stem}
        self.stem_lengths = sorted({len(t) for t in self.stems})
        long = [t for t, _ in self.terms if len(t) >= FUZZY_LENGTH]
        self.firsts = {t[:len(t) // 2] for t in long}
        self.lasts = {t[len(t) // 2:] for t, stem in self.terms if len(t) >= FUZZY_LENGTH and not stem}
        # The second half of a stem may stand anywhere near its place.
        self.middles = {(len(t) // 2, t[len(t) // 2:]) for t, stem in self.terms if len(t) >= FUZZY_LENGTH and stem}
        self.longest = max((len(t) for t, _ in self.terms), default=0)
        self.first_lengths = sorted({len(x) for x in self.firsts})
        self.last_lengths = sorted({len(x) for x in self.lasts})
        self.middle_spots = sorted({(at, len(x)) for at, x in self.middles})

    def exact(self, word: str) -> bool:
        return word in self.words or any(word[:n] in self.stems for n in self.stem_lengths)

    def may_match(self, word: str) -> bool:
        """Whether half of some term is intact in the word."""
        return any(word[:n] in self.firsts for n in self.first_lengths) \
            or any(word[-n:] in self.lasts for n in self.last_lengths) \
            or any((at, word[at + d:at + d + n]) in self.middles for at, n in self.middle_spots for d in (-1, 0, 1))

    def fuzzy(self, word: str) -> bool:
        """A term of FUZZY_LENGTH or more within one edit: the automaton's
        state, the row of edit distances cut at 2, walks down the trie. Only
        the three cells about the diagonal can be below 2."""
        word = word[:self.longest + 2]  # what follows can only continue a stem
        size, far = len(word), 2
        stack = [(self.root, far, 0, 1 if size else far, 0)]
        while stack:
            # Distances of word[:depth - 1], word[:depth], word[:depth + 1].
            node, left, mid, right, depth = stack.pop()
            if depth >= FUZZY_LENGTH:
                if "stem" in node and min(left, mid, right) <= 1:
                    return True
                if "end" in node and -1 <= size - depth <= 1 and (left, mid, right)[size - depth + 1] <= 1:
                    return True
            for c, child in node.items():
                if len(c) != 1:
                    continue
                a = min(mid + 1, left + (word[depth - 1] != c) if 0 < depth <= size else far, far)
                b = min(a + 1, right + 1, mid + (word[depth] != c), far) if depth < size else far
                d = min(b + 1, right + (word[depth + 1] != c), far) if depth + 1 < size else far
                if a <= 1 or b <= 1 or d <= 1:
                    stack.append((child, a, b, d, depth + 1))
        return False

    def look_up(self, word: str) -> int:
        """2 for a term, 1 for a misspelled one, 0 otherwise."""
        if self.exact(word):
            return 2
        return int(len(word) >= FUZZY_LENGTH - 1 and self.may_match(word) and self.fuzzy(word))


def words_of(text: str) -> set[str]:
    """The distinct words of the lower-cased text and the runs of letters of
    those that hold digits or symbols; numbers are no words."""
    found = set()
    for word in set(WORDS.findall(text)):
        parts = [word] if word.isalpha() else LETTERS.findall(word)
        if parts:
            found.add(word)
            found.update(parts)
    return found


def stems_of(word: str) -> list[str]:
    return [word[:n] for n in STEM_LENGTHS if n < len(word)] if word.isalpha() else []


def quotations(text: str) -> tuple[list[tuple[int, int]], list[int]]:
    """(disjoint quotations as (first mark, last mark), all quotation marks).

    A mark closes the quotation of its own kind that was opened last in its
    line, or else opens one. ‘ and ’ within a word are apostrophes, and ’ is a
    quotation mark only where it closes one.
    """
    spans, marks, opened = [], [], {}
    for m in MARKS.finditer(text):
        at, mark = m.start(), m.group()
        if mark == "\n":
            opened = {}
            continue
        before, after = text[at - 1:at].isalnum(), text[at + 1:at + 2].isalnum()
        if mark in "‘’" and before and after:
            continue
        start = max((p for o, p in opened.items() if mark in CLOSING[o]), default=None)
        if start is not None:
            spans.append((start, at))
            opened = {o: p for o, p in opened.items() if p < start}
        elif mark in CLOSING and not (mark in "”»" and (before or not after)):
            opened.setdefault(mark, at)
        if start is not None or mark != "’":
            marks.append(at)
    merged = []
    for a, b in sorted(spans):
        if merged and a < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged, marks


def hit_contexts(text: str, hits: dict[str, int]) -> list[tuple[int, int, bool]]:
    """(word number, kind, quoted) of every hit of the lower-cased text.

    A hit counts as quoted if it stands in a quotation of its line, or a word
    of reporting is in its window next to a quotation mark.
    """
    found, spots = [], []
    spans, marks = quotations(text)
    for m in WORDS.finditer(text):
        word = m.group()
        if word.isalpha() or word in hits:
            spots.append((m.start(), m.end(), word))
        else:
            spots += [(m.start() + x.start(), m.start() + x.end(), x.group()) for x in LETTERS.finditer(word)]
    for i, (start, end, word) in enumerate(spots):
        kind = hits.get(word, 0)
        if not kind:
            continue
        span = bisect_left(spans, (start,)) - 1
        inside = span >= 0 and end <= spans[span][1]
        a, b = spots[max(0, i - WINDOW)][0], spots[min(len(spots) - 1, i + WINDOW)][1]
        near = any(w[2] in REPORTING for w in spots[max(0, i - WINDOW):i + WINDOW + 1])
        found.append((i, kind, inside or near and bisect_left(marks, a) < bisect_left(marks, b)))
    return found


FEATURES = 7


def features_of(contexts: list[tuple[int, int, bool]], n_words: int) -> list[float]:
    used = [i for i, kind, quoted in contexts if kind == 2 and not quoted]
    fuzzy = [i for i, kind, quoted in contexts if kind == 1 and not quoted]
    quoted = sum(1 for c in contexts if c[2])
    both = sorted(used + fuzzy)
    densest, j = 0, 0
    for i, at in enumerate(both):
        while at - both[j] > 2 * WINDOW:
            j += 1
        densest = max(densest, i - j + 1)
    return [1.0, float(bool(used)), math.log1p(len(used)), math.log1p(len(fuzzy)), math.log1p(quoted),
            math.log1p(1000.0 * len(both) / max(n_words, 20)), math.log1p(densest)]


class Scorer:
    """The lexicon, weights and harmless near words, with a worker's memory of
    words without a hit."""

    def __init__(self, terms: list[tuple[str, bool]], weights: list[float] | None, near: list[str] = ()):
        self.trie, self.weights, self.near, self.harmless = Trie(terms), weights, frozenset(near), set()

    def kind(self, word: str) -> int:
        """What the word is by itself: 2 a term, 1 a misspelled one, 0 neither."""
        if word in self.harmless:
            return 0
        kind = self.trie.look_up(word)
        if kind == 1 and word in self.near:
            kind = 0
        if not kind:
            if len(self.harmless) >= KNOWN_WORDS:
                self.harmless.clear()
            self.harmless.add(word)
        return kind

    def hits(self, words: set[str]) -> dict[str, int]:
        """Kinds of the words and runs of letters that hit. A word with digits
        or symbols hits as a whole, unless a run of its letters is a term."""
        hits = {}
        for word in words:
            if word.isalpha():
                kind = self.kind(word)
                if kind:
                    hits[word] = kind
                continue
            parts = {x: k for x in LETTERS.findall(word) if (k := self.kind(x))}
            whole = self.kind(word) if LETTERS.search(word) else 0
            if whole and (whole == 2 or 2 not in parts.values()):
                hits[word] = whole
            else:
                hits.update(parts)
        return hits

    def contexts(self, text: str) -> tuple[list[tuple[int, int, bool]], int]:
        """Hits with their contexts and the number of words of the text."""
        low = text.lower()
        words = WORDS.findall(low)
        hits = self.hits(set(words))
        return hit_contexts(low, hits) if hits else [], len(words)

    def features(self, text: str) -> list[float]:
        return features_of(*self.contexts(text))

    def score(self, text: str) -> float:
        if self.weights is None:
            return 0.0
        z = sum(w * x for w, x in zip(self.weights, self.features(text)))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def out():
        terms = list(counts[0].keys() | counts[1].keys())
        for at in range(0, len(terms), 20_000):
            part = terms[at:at + 20_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([t[:-1] for t in part], pa.string()), pa.array([t[-1] == "*" for t in part]),
                 pa.array([counts[1][t] for t in part], pa.int64()), pa.array([counts[0][t] for t in part], pa.int64())],
                names=["term", "stem", "toxic", "clean"])
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            terms = set()
            for word in words_of(text.lower()):
                terms.add(word + " ")
                terms.update(stem + "*" for stem in stems_of(word))
            counts[toxic].update(terms)
        if len(counts[0]) + len(counts[1]) > 400_000:
            yield from out()
            counts = (Counter(), Counter())
    yield from out()


def _terms_in(index: dict[tuple[str, bool], int]) -> Callable:
    """The numbers of the candidate terms in each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                found = set()
                for word in words_of(text.lower()):
                    found.add(index.get((word, False)))
                    found.update(index.get((stem, True)) for stem in stems_of(word))
                rows.append(sorted(found - {None}))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32()))], names=["found"])
    return run


def choose_terms(rows: list[tuple[str, bool, int, int]], documents: list[list[int]]) -> list[tuple[str, bool]]:
    """Terms (rows of term, stem, toxic, clean documents) chosen one by one:
    the one that explains most toxic ``documents`` (lists of row numbers) that
    no chosen term explains, weighed by purity. A stem gives way to a longer
    term with nearly as many documents, so stems are as specific as the
    documents allow."""
    where: list[set] = [set() for _ in rows]
    for d, found in enumerate(documents):
        for r in found:
            where[r].add(d)
    below: dict[str, list[int]] = {}
    for r, (term, *_) in enumerate(rows):
        for n in range(min(STEM_LENGTHS), len(term) + 1):
            below.setdefault(term[:n], []).append(r)
    open_docs, chosen = set(range(len(documents))), []

    def specific(r: int) -> int:
        """The longest term with nearly all documents of a stem."""
        enough = NEARLY * len(where[r])
        longer = [x for x in below[rows[r][0]] if len(where[x]) >= enough] if rows[r][1] else []
        return max(longer, key=lambda x: (len(rows[x][0]), not rows[x][1], rows[x][0]), default=r)

    purity = [(t / (t + c)) ** 8 for _, _, t, c in rows]
    left = set(range(len(rows)))
    while left and len(chosen) < LEXICON_TERMS:
        gains = {r: len(where[r] & open_docs) for r in left}
        left = {r for r in left if gains[r] >= MIN_DOCUMENTS / 2}
        if not left:
            break
        best = max(left, key=lambda r: (gains[r] * purity[r], -len(rows[r][0]), rows[r][0], rows[r][1]))
        best = specific(best)
        chosen.append(rows[best][:2])
        open_docs -= where[best]
        left.discard(best)
    # Terms that only occur beside chosen ones are terms as well if they are frequent.
    often = max(MIN_DOCUMENTS + 2, FREQUENT * len(documents))
    for r in sorted(range(len(rows)), key=lambda r: (-len(where[r]) * purity[r], rows[r][0], rows[r][1])):
        if len(where[r]) >= often and purity[r] >= 0.9 and len(chosen) < LEXICON_TERMS:
            stems = {t for t, stem in chosen if stem}
            term, stem = rows[specific(r)][:2]
            # Neither below a chosen stem nor above a chosen term.
            if not any(term[:n] in stems for n in range(1, len(term) + 1)) \
                    and not (stem and any(t.startswith(term) for t, _ in chosen)):
                chosen.append((term, stem))
    stems = {t for t, stem in chosen if stem}
    return [(t, stem) for t, stem in dict.fromkeys(chosen)
            if not any(t[:n] in stems for n in range(1, len(t) + (not stem)))]


def fit_weights(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 50) -> list[float]:
    """Logistic regression by Newton steps with an L2 penalty (not on the bias)."""
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [penalty] * (x.shape[1] - 1))
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge @ w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(len(w)), grad)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def _near_counts(terms: list[tuple[str, bool]]) -> Callable:
    """Documents of each word that is near a term, by half of the sample."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, counts = Scorer(terms, None), Counter()
        for batch in batches:
            for text, toxic, half in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "half"))):
                counts.update((w, half, toxic) for w in words_of(text.lower()) if scorer.kind(w) == 1)
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([counts[k] * k[2] for k in keys], pa.int64()),
             pa.array([counts[k] * (1 - k[2]) for k in keys], pa.int64())], names=["word", "half", "toxic", "clean"])
    return run


def harmless_near(counts: list[tuple[str, int, int]], n1: int, n0: int) -> list[str]:
    """The words of ``counts`` (word, toxic, clean documents) that are near a
    term but too common in clean documents to be its misspelling."""
    return sorted(w for w, t, c in counts if c and (t <= c or t / n1 < MIN_PURITY * (t / n1 + c / n0)))


def _feature_rows(terms: list[tuple[str, bool]], near: list[list[str]]) -> Callable:
    """Features of each row as written and with its terms misspelled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers = [Scorer(terms, None, words) for words in near]
        for batch in batches:
            rows, tags = [], []
            for text, toxic, half in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "half"))):
                contexts, n_words = scorers[1 - half].contexts(text)
                rows += [features_of(contexts, n_words), features_of([(i, 1, q) for i, _, q in contexts], n_words)]
                tags += [toxic, toxic]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), pa.array(tags, pa.int32())],
                                             names=["x", "toxic"])
    return run


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """text and toxic (int) of at most ``rows`` labelled rows that are not
    held out, the same ones in every run."""
    picked = labels.filter(~held_out() & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()) \
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")) \
        .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(rows)
    # The limit bounds the broadcast side.
    rows = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(picked), "doc_id")
    # Copies would make every word of theirs a term.
    return rows.groupBy("text").agg(F.max("toxic").alias("toxic"))


def learn(docs: DataFrame, labels: DataFrame,
          rows: int = SAMPLE_ROWS) -> tuple[list[tuple[str, bool]], list[float] | None, list[str]]:
    """(terms, weights, harmless near words): the model, bounded by the sample."""
    sample = training_rows(docs, labels, rows) \
        .withColumn("half", (F.crc32(F.col("text").cast("binary")) % 2).cast("int"))
    sample = materialize(sample, "toxicity-sample")
    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return [], None, []
    counts = arrow_map(sample, _term_counts, "term string, stem boolean, toxic bigint, clean bigint") \
        .groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    both = F.col("toxic") + F.col("clean")
    purity = F.col("toxic") / both
    gain = F.col("toxic") * F.log(purity * F.lit((n1 + n0) / n1)) \
        + F.when(F.col("clean") > 0, F.col("clean") * F.log((1 - purity) * F.lit((n1 + n0) / n0))).otherwise(0.0)
    # Purity against equal class sizes, so that it does not hang on the sample's base rate.
    balanced = F.col("toxic") / n1 / (F.col("toxic") / n1 + F.col("clean") / n0)
    strong = counts.filter((F.col("toxic") >= MIN_DOCUMENTS) & (balanced >= MIN_PURITY) & (purity >= 0.5)) \
        .filter((gain >= min(MIN_GAIN, 0.04 * n1 * math.log((n1 + n0) / n1)))
                | ((F.col("clean") == 0) & (F.col("toxic") >= 10))) \
        .orderBy(F.desc(F.col("toxic") * F.pow(purity, F.lit(4.0))), "term", "stem").limit(CANDIDATE_TERMS)
    candidates = [tuple(r) for r in strong.select("term", "stem", "toxic", "clean").collect()]
    index = {r[:2]: i for i, r in enumerate(candidates)}
    found = arrow_map(sample.filter("toxic = 1").select("text"), _terms_in(index), "found array<int>").collect()
    terms = choose_terms(candidates, [r["found"] for r in found])
    by_half = arrow_map(sample, _near_counts(terms), "word string, half int, toxic bigint, clean bigint") \
        .groupBy("word").agg(*(F.sum(F.when(F.col("half") == h, F.col(c)).otherwise(0)).alias(f"{c}{h}")
                               for h in (0, 1) for c in ("toxic", "clean"))) \
        .filter("clean0 + clean1 > 0").collect()
    near = harmless_near([(r["word"], r["toxic0"] + r["toxic1"], r["clean0"] + r["clean1"]) for r in by_half], n1, n0)
    halves = [harmless_near([(r["word"], r[f"toxic{h}"], r[f"clean{h}"]) for r in by_half], n1, n0) for h in (0, 1)]
    rows = arrow_map(sample, _feature_rows(terms, halves), "x array<double>, toxic int").collect()
    x, y = np.array([r["x"] for r in rows]), np.array([r["toxic"] for r in rows], dtype=float)
    order = np.lexsort([*x.T, y])  # sums do not hang on the order of the rows
    return terms, fit_weights(x[order], y[order]), near


def _scorer(name: str, terms, weights, near) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(terms, weights, near)
        for batch in batches:
            scores = [scorer.score(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())],
                                             names=[*batch.schema.names, name])
    return run


def with_scores(docs: DataFrame, model: tuple, name: str = "_score") -> DataFrame:
    """``docs`` with the score added under ``name``, which no column may have."""
    return arrow_map(docs, _scorer(name, *model), with_fields(docs.schema, **{name: T.DoubleType()}))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored = with_scores(docs.select("doc_id", "text"), learn(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), F.col("_score").alias("score"),
                         (F.col("_score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns."""
    name = unused_name(docs, "_score")
    return with_scores(docs, learn(docs, labels), name).filter(F.col(name) < threshold).drop(name)
