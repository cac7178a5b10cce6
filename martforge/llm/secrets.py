"""Secret scans: fixed patterns and a linear-chain conditional random field.

Base spans come from three patterns (assignments, access keys, long hex). The
random field tags every piece of a word as beginning, inside or outside a
secret, from its own shape, the pieces around it, the shapes of its word and of
the words around it and features of the file, decoded by Viterbi. Words are
split into pieces at signs and changes of case or digits; ordinary words are
one piece.
It is trained on a bounded sample of documents whose base spans give the
tags, each as it is written and with other wording: a value of another layout
without any key word, and something harmless in its place. So it learns what
values and their places look like, and adds the secrets whose wording the patterns
do not know.

Words and pieces are reduced to classes (their shape features); a worker
remembers those of a word. Emission scores are table look-ups by class for the
word, the piece and their neighbours. What a piece can add to a path at most is
known from its scores; where no range of pieces can make up for not being
outside, all are outside, and Viterbi runs over the rest only, many ranges at
once. The tags are those of Viterbi over whole documents.

Defined results: a null text is empty and has no span; spans are in code
points, end exclusive; rows with a null doc_id and repeated rows each get
their row; texts of any length are tagged whole; of equally good tag sequences
the one that begins a secret first is taken; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, arrow_map, binary_view, materialize, text_or_empty

# Fixed patterns; the length of a match is checked after it is found.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_RUN = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 8, 16, 32
KINDS = ("assign", "access", "hex")
ADDED = "crf"

CANDIDATES = 20_000        # documents that the texts without base spans are drawn from
SAMPLE_DOCUMENTS = 600      # documents of each sort (with and without base spans) to train on
CONTEXT = 12               # words kept on each side of a span in training
NEGATIVE_WORDS = 60        # words of a training window without spans
WINDOW_PIECES = 96         # pieces of a training window at most
EPOCHS, RATE, PENALTY = 100, 0.1, 1e-3
B, I, O = 0, 1, 2
SLICE_BYTES = 6 << 20
KNOWN_WORDS = 300_000
KNOWN_PIECES = 4_000_000

_WORD = re.compile(WORD)
_KEYWORDS = re.compile(rb"passw|secret|token|api_?key|credential|private|auth|bearer|akia|pwd", re.I)
# Ordinary words: letters (bytes of other scripts included), at most one stop.
_PLAIN = re.compile(rb"[A-Z\x80-\xff]?[a-z\x80-\xff]{0,23}[.,;!?]?")
_PIECE = re.compile(rb"[A-Z\x80-\xff]?[a-z\x80-\xff]+|[A-Z]+|[0-9]+|([^A-Za-z0-9\x80-\xff])\1*")
_TRIM = "\"'`()[]{}<>,;:!?"
_TRIM_BYTES = _TRIM.encode()
_SIGNS = (b"0123456789", bytes(range(97, 123)), bytes(range(65, 91)))
_CHANGE = re.compile(rb"[0-9][A-Za-z]|[A-Za-z][0-9]|[a-z][A-Z]")
_PADDING = re.compile(r"(?:={1,2}(?=$|[\s\"'`)\]},;]))?")   # of base 64, behind a value


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base spans, sorted."""
    low = text.lower()
    spans = []
    if any(k in low for k in ("passw", "secret", "token", "api")):
        # lower() may change lengths; the pattern itself reads the text
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    # Runs are maximal, so the long ones are found directly.
    spans += [(m.start(), 2, m.end()) for m in HEX_RUN.finditer(text)]
    return sorted(spans)


def is_plain(word: bytes) -> bool:
    return _PLAIN.fullmatch(word) is not None and not _KEYWORDS.search(word)


def word_features(word: bytes) -> tuple[str, ...]:
    """The class of a word: its shape and, for marked words, what they say."""
    if is_plain(word):
        return ("plain",)
    core = word.strip(_TRIM_BYTES)
    size = len(core)
    digits, lower, upper = (size - len(core.translate(None, signs)) for signs in _SIGNS)
    other = size - digits - lower - upper
    out = [f"size{min(size.bit_length(), 8)}"]
    if _KEYWORDS.search(word):
        out.append("keyword")
    if word in (b"=", b":", b":=", b"=>"):
        out.append("assign-sign")
    elif word[-1:] in (b"=", b":"):
        out.append("ends-in-sign")
    if word[:1] in (b'"', b"'", b"`"):
        out.append("opens-quote")
    if word[-1:] in (b'"', b"'", b"`"):
        out.append("ends-quote")
    if size:
        out.append("digits-" + ("none" if not digits else "all" if digits == size else
                                "few" if 4 * digits < size else "many"))
        kinds = (digits > 0) + (lower > 0) + (upper > 0)
        out.append(f"kinds{kinds}" + ("-symbols" if other else ""))
        if size >= 16 and not other and kinds >= 2:
            out.append("long-mixed")
        if size >= 24 and re.fullmatch(rb"[0-9a-f]+", core):
            out.append("long-hex")
        if size >= 12:
            seen = np.bincount(np.frombuffer(core, np.uint8))
            p = seen[seen > 0] / size
            out.append(f"entropy{min(5, int(-(p * np.log2(p)).sum()))}")
        if b"@" in core or b"://" in core:
            out.append("address")
        if re.fullmatch(rb"[\d.,:/()+-]+", core):
            out.append("number")
    return tuple(out)


def file_bucket(share: float) -> int:
    """Bucket of the share of words that are not plain."""
    return 0 if share == 0 else 1 if share < 0.01 else 2 if share < 0.1 else 3 if share < 0.5 else 4


def pieces(word: bytes) -> list[tuple[int, int]]:
    """(start, end) of the pieces of a word, in bytes; an ordinary word is one."""
    if is_plain(word):
        return [(0, len(word))]
    return [m.span() for m in _PIECE.finditer(word)]


def _random_looking(part: bytes) -> bool:
    """Whether letters and digits are mixed as in no word or number."""
    if len(part) < 10:
        return False
    digits, lower, upper = (len(part) - len(part.translate(None, signs)) for signs in _SIGNS)
    return bool(digits and (upper or lower)) and len(_CHANGE.findall(part)) >= 3


def piece_features(word: bytes) -> list[tuple[str, ...]]:
    """The class of each piece of a word: what it is, its place in its segment
    (words are segmented at assignment signs, signs at the edges are apart), and
    whether the segment looks random."""
    if is_plain(word):
        return [("p-plain",)]
    spots = [m.span() for m in _PIECE.finditer(word)]
    core = word.strip(_TRIM_BYTES + b"=")
    begin = word.index(core) if core else 0
    stop = begin + len(core)
    signs = [i for i, (a, _) in enumerate(spots) if word[a:a + 1] in (b"=", b":") and a < stop]
    segments: dict[tuple[int, int], tuple[int, int, str]] = {}
    out = []
    for i, (a, b) in enumerate(spots):
        part = word[a:b]
        kind = "digits" if part[:1].isdigit() else "upper" if part.isupper() else "letters" if part[:1].isalpha() or part[0] > 127 \
            else "sign" + part[:1].decode()
        found = ["p-" + kind, f"p-size{min((b - a).bit_length(), 5)}"]
        if a < begin or b > stop or i in signs:
            found.append("p-edge")
        else:
            left = next((spots[j][1] for j in reversed(signs) if j < i), begin) if signs else begin
            right = next((spots[j][0] for j in signs if j > i), stop) if signs else stop
            if (left, right) not in segments:
                segment = word[left:right].strip(_TRIM_BYTES)
                low = word.index(segment, left) if segment else left
                segments[left, right] = low, low + len(segment), "random" if _random_looking(segment) else "ordinary"
            low, high, looks = segments[left, right]
            place = "only" if a <= low and b >= high else "first" if a <= low else "last" if b >= high else "middle"
            found += [f"p-{looks}", f"p-{looks}-{place}"]
        if signs and any(j < i for j in signs):
            found.append("p-after-sign")
        if signs and any(j > i for j in signs):
            found.append("p-before-sign")
        if _KEYWORDS.search(part):
            found.append("p-keyword")
        out.append(tuple(found))
    return out


WORD_ROLES = ((0, 0), (1, 1), (2, 2), (3, -1), (4, -2))    # role and distance of the word that plays it
PIECE_ROLES = ((5, 0), (6, 1), (7, 2), (8, -1))            # the same of the piece
ROLES = ("own", "before", "before2", "after", "after2", "piece", "piece-before", "piece-before2", "piece-after")


class Field:
    """Weights of the random field: (feature, tag) by role, and transitions."""

    def __init__(self, features: list[str], weights: np.ndarray, bias: np.ndarray, file: np.ndarray, moves: np.ndarray):
        self.number = {f: i for i, f in enumerate(features)}
        self.features, self.weights, self.bias, self.file, self.moves = features, weights, bias, file, moves

    def class_scores(self, features: tuple[str, ...]) -> np.ndarray:
        """(role, tag) scores of a word class."""
        known = [self.number[f] for f in features if f in self.number]
        return self.weights[:, known].sum(axis=1) if known else np.zeros((len(ROLES), 3))

    def state(self) -> tuple:
        return self.features, self.weights, self.bias, self.file, self.moves


@dataclass
class Pieces:
    """The pieces of concatenated documents: classes by word and by piece, and
    where words and documents begin."""
    shapes: np.ndarray      # class of each word
    parts: np.ndarray       # class of each piece
    word: np.ndarray        # word of each piece
    starts: np.ndarray      # by document: first word, number of words
    lengths: np.ndarray
    first: np.ndarray       # by document: first piece, number of pieces
    sizes: np.ndarray
    buckets: np.ndarray     # file bucket of each document

    def scores(self, at: np.ndarray, tables: np.ndarray, field: Field) -> np.ndarray:
        """(piece, tag) scores of the pieces ``at``; ``tables`` is (class, role,
        tag). Neighbours outside the document give nothing."""
        doc = np.searchsorted(self.first, at, side="right") - 1
        out = field.bias + field.file[self.buckets[doc]]
        for roles, here, classes, low, n in ((WORD_ROLES, self.word[at], self.shapes, self.starts[doc], self.lengths[doc]),
                                             (PIECE_ROLES, at, self.parts, self.first[doc], self.sizes[doc])):
            for role, shift in roles:
                spot = here - shift
                ok = np.flatnonzero((spot >= low) & (spot < low + n))
                out[ok] += tables[classes[spot[ok]], role]
        return out


def best_gain(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The most that a piece can add to a path by not being outside, whatever
    its neighbours are."""
    begin = scores[:, B] + moves[:, B].max()
    inside = scores[:, I] + max(moves[B, I], moves[I, I])
    return np.maximum(begin, inside) - scores[:, O] - moves[O, O]


def possible_runs(gain: np.ndarray, leave: float, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of the runs of pieces that some secret of the best path may
    cover. A secret over a range of pieces can add no more than the sum of their
    gains and ``leave``; if that is below 0, being outside is better. So a piece
    of no range with a sum of -leave or more is outside for certain."""
    wall = np.zeros(len(gain) + len(first))        # a wall before each document keeps ranges inside
    place = np.arange(len(gain)) + np.repeat(np.arange(len(first)), sizes) + 1
    wall[place] = gain
    limit = -1e4 - leave
    wall[first + np.arange(len(first))] = limit

    def ending(x: np.ndarray) -> np.ndarray:       # best sum of a range that ends at each place
        total = np.cumsum(x)
        return total - np.minimum.accumulate(np.concatenate([[0.0], total[:-1]]))
    best = ending(wall) + ending(wall[::-1])[::-1] - wall
    inside = (best[place] >= -leave - 1e-6).astype(np.int8)
    edge = np.flatnonzero(np.diff(inside, prepend=0, append=0))
    cuts = first[(first > 0) & (sizes > 0)]
    cuts = cuts[(inside[cuts] & inside[cuts - 1]) == 1]   # runs of neighbouring documents
    begin, end = np.sort(np.concatenate([edge[::2], cuts])), np.sort(np.concatenate([edge[1::2], cuts]))
    return begin, end


def decode(rows: Pieces, quiet: np.ndarray, tables: np.ndarray, field: Field, plain: int) -> np.ndarray:
    """The best tags of all rows. ``quiet`` words are plain ones among plain
    ones, whose scores are all alike; ``plain`` is a piece of one of them or -1.
    Viterbi runs over the pieces that may be in a secret, with one piece outside
    on each side: the result is that over whole documents."""
    tags = np.full(len(rows.parts), O, np.int8)
    loud = np.flatnonzero(~quiet[rows.word])
    gain = np.zeros(len(tags))
    if plain >= 0:
        doc = np.searchsorted(rows.first, plain, side="right") - 1
        alike = rows.scores(np.array([plain]), tables, field) - field.file[rows.buckets[doc]] + field.file
        gain = np.repeat(best_gain(alike, field.moves)[rows.buckets], rows.sizes)
    scores = rows.scores(loud, tables, field)
    gain[loud] = best_gain(scores, field.moves)
    # Nothing comes before the first piece of a document, which is never quiet.
    opening = np.isin(loud, rows.first)
    gain[loud[opening]] = scores[opening, B] - scores[opening, O]
    leave = max(0.0, *(field.moves[[B, I], O] - field.moves[O, O]))
    begin, end = possible_runs(gain, leave, rows.first, rows.sizes)
    if not len(begin):
        return tags
    doc = np.searchsorted(rows.first, begin, side="right") - 1
    low, high = np.maximum(begin - 1, rows.first[doc]), np.minimum(end + 1, rows.first[doc] + rows.sizes[doc])
    n = high - low
    starts = np.cumsum(n) - n
    at = np.arange(int(n.sum())) + np.repeat(low - starts, n)
    found = rows.scores(at, tables, field)
    out = np.ones(len(at), bool)
    out[:] = (at < np.repeat(begin, n)) | (at >= np.repeat(end, n))
    found[out] = FORBIDDEN, FORBIDDEN, 0.0
    inner = viterbi(found, field.moves, starts, n)
    tags[at[~out]] = inner[~out]
    return tags


def viterbi(scores: np.ndarray, moves: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Best tags of all documents at once: step t advances every document that
    has a word t. A document cannot begin inside a secret."""
    tags = np.full(len(scores), O, np.int8)
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    if not len(order):
        return tags
    begin, size = starts[order], lengths[order]
    longest = int(size[0])
    alive = np.searchsorted(-size, -np.arange(longest), side="left")  # documents with a word t
    back = np.zeros((len(scores), 3), np.int8)
    best = scores[begin].copy()
    best[:, I] = -1e9
    last = best.copy()
    for t in range(1, longest):
        k = alive[t]
        at = begin[:k] + t
        step = best[:k, :, None] + moves  # from, to
        back[at] = step.argmax(axis=1)
        best = step.max(axis=1) + scores[at]
        last[:k] = best
    now = last.argmax(axis=1).astype(np.int8)
    tags[begin + size - 1] = now
    for t in range(longest - 1, 0, -1):
        k = alive[t]
        now[:k] = back[begin[:k] + t, now[:k]]
        tags[begin[:k] + t - 1] = now[:k]
    return tags


FORBIDDEN = -1e4  # a secret cannot begin inside


def train(windows: list[tuple[list[tuple[tuple[str, ...], ...]], list[int], int]]) -> Field:
    """Maximum likelihood with an L2 penalty, gradients by forward-backward
    over all windows (for each piece its class in every role, tags, file
    bucket) at once. Without a
    window nothing is known, and every word is outside."""
    if not windows:
        return Field([], np.zeros((len(ROLES), 0, 3)), np.array([0.0, 0.0, 9.0]), np.zeros((5, 3)),
                     np.where(np.arange(9).reshape(3, 3) == 3 * O + I, FORBIDDEN, 0.0))
    features = sorted({f for parts, _, _ in windows for roles in parts for c in roles for f in c})
    number = {f: i for i, f in enumerate(features)}
    classes = sorted({c for parts, _, _ in windows for roles in parts for c in roles if c})
    index = {c: i for i, c in enumerate(classes)}
    member = np.zeros((len(classes), len(features)))
    for c, i in index.items():
        member[i, [number[f] for f in c]] = 1.0
    s, t = len(windows), max((len(w[0]) for w in windows), default=1)
    shifted = [np.full((s, t), -1) for _ in ROLES]
    tag = np.full((s, t), O)
    for i, (parts, tags, _) in enumerate(windows):
        for role in range(len(ROLES)):
            shifted[role][i, :len(parts)] = [index.get(roles[role], -1) for roles in parts]
        tag[i, :len(tags)] = tags
    mask = np.arange(t) < np.array([len(w[0]) for w in windows])[:, None]
    bucket = np.array([w[2] for w in windows])
    params = [np.zeros((len(ROLES), len(features), 3)), np.zeros(3), np.zeros((5, 3)), np.zeros((3, 3))]
    allowed = np.ones((3, 3))
    allowed[O, I] = 0.0
    truth = np.eye(3)[tag] * mask[..., None]
    pair_truth = np.einsum("stf,stg->fg", truth[:, :-1] * mask[:, 1:, None], truth[:, 1:])
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for epoch in range(1, EPOCHS + 1):
        weights, bias, file, moves = params
        scores = np.zeros((s, t, 3)) + bias + file[bucket][:, None, :]
        for role in range(len(ROLES)):
            table = np.vstack([member @ weights[role], np.zeros((1, 3))])
            scores += table[shifted[role]]  # -1, no word, is the last row
        step = np.where(allowed > 0, moves, FORBIDDEN)
        forward, backward = np.zeros((s, t, 3)), np.zeros((s, t, 3))
        forward[:, 0] = scores[:, 0] + np.array([0.0, FORBIDDEN, 0.0])
        for j in range(1, t):
            new = _log_sum(forward[:, j - 1, :, None] + step, 1) + scores[:, j]
            forward[:, j] = np.where(mask[:, j, None], new, forward[:, j - 1])
        total = _log_sum(forward[:, -1], 1)
        for j in range(t - 2, -1, -1):
            new = _log_sum(step[None] + (scores[:, j + 1] + backward[:, j + 1])[:, None, :], 2)
            backward[:, j] = np.where(mask[:, j + 1, None], new, backward[:, j + 1])
        chance = np.exp(forward + backward - total[:, None, None]) * mask[..., None]
        error = (chance - truth) / s
        pairs = np.zeros((3, 3))
        for j in range(1, t):
            p = np.exp(forward[:, j - 1, :, None] + step + (scores[:, j] + backward[:, j])[:, None, :]
                       - total[:, None, None]) * mask[:, j, None, None]
            pairs += p.sum(axis=0)
        grads = [np.zeros_like(weights), error.sum(axis=(0, 1)), np.zeros_like(file), (pairs - pair_truth) / s * allowed]
        for role in range(len(ROLES)):
            spots = shifted[role].ravel() + 1
            per_class = np.stack([np.bincount(spots, error[..., k].ravel(), len(classes) + 1) for k in range(3)], axis=1)
            grads[0][role] = member.T @ per_class[1:]
        grads[2] += np.eye(5)[bucket].T @ error.sum(axis=1)
        for p, g, m, v in zip(params, grads, first, second):
            g += PENALTY * p
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= RATE * (m / (1 - 0.9 ** epoch)) / (np.sqrt(v / (1 - 0.999 ** epoch)) + 1e-8)
    weights, bias, file, moves = params
    return Field(features, weights, bias, file, np.where(allowed > 0, moves, FORBIDDEN))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def secret_values(text: str) -> list[tuple[int, int]]:
    """(start, end) of the values of the base spans, sorted."""
    values = [(m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LENGTH]
    return sorted({*values, *((a, b) for a, kind, b in base_spans(text) if kind)})


def training_window(text: str, seed: int, values: list[tuple[int, int]] | None = None,
                    at: int | None = None) -> tuple[list[bytes], list[int], int]:
    """Words, tags of their pieces and file bucket of one window of a text:
    around its first value (or ``at``), or else at a place given by ``seed``."""
    spots = [(m.start(), m.end(), m.group().encode()) for m in _WORD.finditer(text)]
    shares = sum(word_features(w) != ("plain",) for _, _, w in spots) / max(1, len(spots))
    values = secret_values(text) if values is None else values
    marked = next((i for i, (a, b, _) in enumerate(spots) if any(a < v[1] and v[0] < b for v in values)), None)
    if at is not None:
        marked = next((i for i, (_, b, _) in enumerate(spots) if b > at), None)
    if marked is not None:
        a, b = max(0, marked - CONTEXT), marked + CONTEXT + 1
    else:
        a = seed % max(1, len(spots) - NEGATIVE_WORDS)
        odd = [i for i, (_, _, w) in enumerate(spots) if word_features(w) != ("plain",)]
        if odd and seed % 2:  # half of them around a word that is not plain
            a = max(0, odd[seed % len(odd)] - NEGATIVE_WORDS // 2)
        b = a + NEGATIVE_WORDS
    tags, last = [], None
    for start, _, word in spots[a:b]:
        for x, y in pieces(word):
            x, y = start + len(word[:x].decode()), start + len(word[:y].decode())
            own = next((v for v in values if x < v[1] and v[0] < y), None)
            tags.append(O if own is None else I if own == last else B)
            last = own
    return [w for _, _, w in spots[a:b]], tags, file_bucket(shares)


_MIXED = "abcdefghijkmnopqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ0123456789"


def drawn_secret(draw: random.Random) -> str:
    """A value in one of the usual layouts of keys and tokens."""
    def run(signs: str, low: int, high: int) -> str:
        return "".join(draw.choices(signs, k=draw.randint(low, high)))
    prefix = run("abcdefghijklmnopqrstuvwxyz", 2, 5)
    return draw.choice([
        lambda: run("0123456789abcdef", 24, 64), lambda: run("0123456789ABCDEF", 24, 64), lambda: run(_MIXED, 16, 48),
        lambda: run(_MIXED + "+/", 24, 60) + draw.choice(["", "=", "=="]), lambda: f"{prefix}_{run(_MIXED, 16, 40)}",
        lambda: f"{prefix}_{draw.choice(['live', 'test', 'prod'])}_{run(_MIXED, 16, 32)}",
        lambda: f"{prefix}-{run('0123456789', 9, 13)}-{run('0123456789', 9, 13)}-{run(_MIXED, 20, 32)}",
        lambda: f"{run(_MIXED + '_-', 20, 40)}.{run(_MIXED + '_-', 30, 80)}.{run(_MIXED + '_-', 30, 50)}",
        lambda: run(_MIXED + "!#%^&*+-_", 12, 24)])()


def drawn_harmless(draw: random.Random, words: list[str]) -> str:
    """Something that is no plain word and no secret."""
    def number(n: int) -> str:
        return "".join(draw.choices("0123456789", k=n))
    def word() -> str:
        return draw.choice(words)
    return draw.choice([
        lambda: number(draw.randint(1, 16)), lambda: f"{number(draw.randint(1, 3))}.{number(2)}",
        lambda: f"20{number(2)}-{draw.randint(1, 12):02d}-{draw.randint(1, 28):02d}", lambda: f"+{number(2)} {number(3)} {number(7)}",
        lambda: f"https://www.{word()}.com/{word()}/{word()}-{number(4)}", lambda: f"{word()}.{word()}@{word()}.org",
        lambda: f"/usr/{word()}/{word()}/{word()}.txt", lambda: f"{word()}_{word()}_{word()}", lambda: f"{word()}{word().title()}{word().title()}",
        lambda: f"v{draw.randint(0, 9)}.{draw.randint(0, 20)}.{draw.randint(0, 9)}", lambda: f"#{number(6)}", lambda: f"{word()}{draw.choice(['***', '$$$', '%%%', '&&&', '!!!'])}",
        lambda: f"{word()}-{word()}-{word()}", lambda: f"({word()})", lambda: f"{word().upper()}-{number(4)}", lambda: f"| {word()} | {number(3)} |"])()


def redrawn_windows(text: str, seed: int) -> list[tuple[list[bytes], list[int], int]]:
    """The surroundings of a text's first value with other wording: secrets of
    other layouts without any key word, and harmless things in the same places,
    so that the field learns what values and their places look like."""
    values = secret_values(text)
    words = [m.group() for m in re.finditer(r"[a-z]{2,12}", text[:20_000])][:400] or ["value"]
    draw = random.Random(seed)
    if values:
        a, b = values[0]
        key = next((m.start() for m in ASSIGN.finditer(text) if m.start(2) == a), a)
    else:
        spots = [m.span() for m in _WORD.finditer(text)] or [(0, 0)]
        key, b = spots[seed % len(spots)]
    out = []
    for secret in (True, False):
        name = draw.choice([draw.choice(words), f"{draw.choice(words)}_{draw.choice(words)}", draw.choice(words).upper(), ""])
        sign = draw.choice([" = ", "=", ": ", " ", ":", " => "]) if name else ""
        quote = draw.choice(["", "", '"', "'"])
        new = drawn_secret(draw) if secret else drawn_harmless(draw, words)
        start = key + len(name) + len(sign) + len(quote)
        changed = f"{text[:key]}{name}{sign}{quote}{new}{quote}{text[b:]}"
        out.append(training_window(changed, seed, [(start, start + len(new))] if secret else [], start))
    return out


def roles_of(words: list[bytes], tags: list[int]) -> tuple[list[tuple[tuple[str, ...], ...]], list[int]]:
    """The classes in every role of the pieces of a window, and their tags; at
    most WINDOW_PIECES about the first secret."""
    shapes = [word_features(w) for w in words]
    parts = [(i, c) for i, w in enumerate(words) for c in piece_features(w)]

    def at(items: list, i: int) -> tuple:
        return items[i] if 0 <= i < len(items) else ()
    out = [(*(at(shapes, i - d) for _, d in WORD_ROLES), *((at(parts, j - d) or (0, ()))[1] for _, d in PIECE_ROLES))
           for j, (i, _) in enumerate(parts)]
    first = max(0, next((j for j, x in enumerate(tags) if x != O), 0) - WINDOW_PIECES // 2)
    return out[first:first + WINDOW_PIECES], list(tags)[first:first + WINDOW_PIECES]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, spot in zip(batch.column("text").to_pylist(), batch.column("spot").to_pylist()):
            rows.append(training_window(text, int(spot, 16)))
            rows += redrawn_windows(text, int(spot, 16)) if secret_values(text) else redrawn_windows(text, int(spot, 16))[1:]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.list_(pa.binary())), pa.array([r[1] for r in rows], pa.list_(pa.int32())),
             pa.array([r[2] for r in rows], pa.int32())], names=["words", "tags", "bucket"])


_HINT = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{8}"


def learn(docs: DataFrame, documents: int = SAMPLE_DOCUMENTS, candidates: int = CANDIDATES) -> Field:
    """A field trained on at most ``documents`` texts with base spans, searched
    in all documents, and as many without, drawn from ``candidates`` documents,
    each in the order of a hash: the same ones in every run."""
    rows = docs.filter("doc_id is not null").select("doc_id", text_or_empty().alias("text"))
    low, digest = F.lower("text"), F.md5("text")
    hint = F.lit(False)
    for word in ("passw", "secret", "token", "api"):
        hint = hint | low.contains(word)
    hit = (hint & F.col("text").rlike(_HINT)) | F.col("text").rlike("AKIA[A-Z0-9]{12}") | F.col("text").rlike("[0-9a-f]{32}")
    # The texts are searched once; ids and hashes are all that is exchanged. Copies of a text count once.
    marks = materialize(rows.select("doc_id", digest.alias("digest"), hit.alias("hit")), "secret-marks")
    drawn = marks.select("doc_id").distinct().orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(candidates)
    # The limits bound the broadcast sides.
    without = marks.filter("not hit").join(F.broadcast(drawn), "doc_id", "left_semi")
    chosen = [found.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).orderBy("digest").limit(documents)
              for found in (marks.filter("hit"), without)]
    chosen = materialize(chosen[0].unionByName(chosen[1]), "secret-chosen")
    sample = rows.withColumn("digest", digest).join(F.broadcast(chosen), ["doc_id", "digest"], "left_semi") \
        .dropDuplicates(["digest"]).select("text", F.substring("digest", 1, 8).alias("spot"))
    windows = arrow_map(sample, _windows, "words array<binary>, tags array<int>, bucket int").collect()
    windows = sorted((tuple(bytes(w) for w in r["words"]), tuple(r["tags"]), r["bucket"]) for r in windows if r["words"])
    return train([(*roles_of(words, tags), bucket) for words, tags, bucket in windows])


def outside(a: int, b: int, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The parts of a .. b that no base span (sorted) covers."""
    parts = []
    for start, _, end in base:
        if start >= b:
            break
        if a < start:
            parts.append((a, start))
        a = max(a, end)
    if a < b:
        parts.append((a, b))
    return parts


class Scanner:
    """Finds the spans of slices of texts; remembers the classes of words and
    of their pieces."""

    def __init__(self, state: tuple | None):
        self.field = Field(*state) if state else None
        self.classes: dict[tuple, int] = {}
        self.tables: list[np.ndarray] = []
        self.forget()

    def forget(self) -> None:
        self.words: dict[bytes, int] = {}
        # Entry: class of the word, number of pieces, place of their classes in ``parts``.
        self.entries: dict[tuple, int] = {}
        self.shape, self.count, self.first, self.parts = (array("q") for _ in range(4))
        self.entry_of(b"plain")

    def class_of(self, features: tuple[str, ...]) -> int:
        found = self.classes.get(features)
        if found is None:
            found = self.classes[features] = len(self.classes)
            if self.field is not None:
                self.tables.append(self.field.class_scores(features))
        return found

    def entry_of(self, word: bytes) -> int:
        if self.entries and is_plain(word):
            self.words[word] = 0  # most words: the entry of the plain word
            return 0
        key = (self.class_of(word_features(word)), *map(self.class_of, piece_features(word)))
        found = self.entries.get(key)
        if found is None:
            found = self.entries[key] = len(self.entries)
            self.shape.append(key[0])
            self.count.append(len(key) - 1)
            self.first.append(len(self.parts))
            self.parts.extend(key[1:])
        self.words[word] = found
        return found

    def tagged(self, raws: list[bytes]) -> list[list[tuple[int, int, int, int]]]:
        """(first word, its piece, last word, its piece) of the secrets of each text."""
        if len(self.words) >= KNOWN_WORDS or len(self.parts) >= KNOWN_PIECES:
            self.forget()
        numbers, lengths, get = [], [], self.words.get
        for raw in raws:
            words = raw.split()
            found = list(map(get, words))
            if None in found:
                found = [self.entry_of(w) if c is None else c for w, c in zip(words, found)]
            numbers.append(np.array(found, np.int64))
            lengths.append(len(found))
        out: list[list[tuple[int, int, int, int]]] = [[] for _ in raws]
        lengths = np.array(lengths, np.int64)
        entries = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
        if self.field is None or not len(entries):
            return out
        starts = np.cumsum(lengths) - lengths
        loud = entries != 0  # entry 0 is the plain word
        odd = np.concatenate([[0], np.cumsum(loud)])
        shares = (odd[starts + lengths] - odd[starts]) / np.maximum(1, lengths)
        buckets = np.array([file_bucket(x) for x in shares.tolist()])
        shape, count, first, known = (np.array(x, np.int64) for x in (self.shape, self.count, self.first, self.parts))
        counts = count[entries]
        begins = np.cumsum(counts) - counts
        parts = known[np.repeat(first[entries] - begins, counts) + np.arange(int(counts.sum()))]
        ends = np.concatenate([begins, [len(parts)]])
        word_of = np.repeat(np.arange(len(entries)), counts)
        rows = Pieces(shape[entries], parts, word_of, starts, lengths, ends[starts], ends[starts + lengths] - ends[starts], buckets)
        # Words with another than plain words up to two places away, or the edge of their text.
        near = np.flatnonzero(loud)
        filled = lengths > 0
        edges = np.concatenate([starts[filled], starts[filled] + lengths[filled] - 1])
        quiet = np.ones(len(entries), bool)
        for shift in (-2, -1, 0, 1, 2):
            quiet[np.clip(near + shift, 0, len(entries) - 1)] = False
            if abs(shift) < 2:
                quiet[np.clip(edges + shift, 0, len(entries) - 1)] = False
        calm = np.flatnonzero(quiet)
        tags = decode(rows, quiet, np.array(self.tables), self.field, int(begins[calm[0]]) if len(calm) else -1)
        marked = np.flatnonzero(tags != O)
        words = np.searchsorted(begins, marked, side="right") - 1
        owner = np.searchsorted(starts, words, side="right") - 1
        last = -2
        for i, w, d in zip(marked.tolist(), words.tolist(), owner.tolist()):
            spans, word, piece = out[d], w - int(starts[d]), i - int(begins[w])
            if tags[i] == I and spans and last == i - 1:
                spans[-1] = (*spans[-1][:2], word, piece)
            else:
                spans.append((word, piece, word, piece))
            last = i
        return out

    def spans(self, raws: list[bytes]) -> list[tuple[list, list]]:
        """(base, added) spans of each text; of an added span the parts outside
        the base spans are kept."""
        out = []
        for raw, secrets in zip(raws, self.tagged(raws)):
            text = raw.decode()
            base = base_spans(text)
            added = []
            if secrets:
                spots = [m.span() for m in _WORD.finditer(text)]
                for first, first_piece, last, last_piece in secrets:
                    (a, x), (b, y) = spots[first], spots[last]
                    left, right = text[a:x].encode(), text[b:y].encode()
                    a += len(left[:pieces(left)[first_piece][0]].decode())
                    b += len(right[:pieces(right)[last_piece][1]].decode())
                    while a < b and text[a] in _TRIM:
                        a += 1
                    while a < b and text[b - 1] in _TRIM:
                        b -= 1
                    if a < b:
                        b += len(_PADDING.match(text, b).group())
                    added += [(x, y) for x, y in outside(a, b, base) if text[x:y].strip(_TRIM + "=")]
            out.append((base, added))
        return out


def _scan(state: tuple) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(state)
        for batch in batches:
            data, offsets = binary_view(batch.column("text"))
            at = 0
            while at < batch.num_rows:
                stop = min(batch.num_rows, max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1))
                raws = [data[a:b].tobytes() for a, b in zip(offsets[at:stop].tolist(), offsets[at + 1:stop + 1].tolist())]
                counts, sums, joined = [[], [], []], [], []
                for base, added in scanner.spans(raws):
                    for kind in range(3):
                        counts[kind].append(sum(s[1] == kind for s in base))
                    sums.append(hashlib.sha256(joined_spans(base, []).encode()).hexdigest())
                    joined.append(joined_spans(base, added))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, stop - at), *(pa.array(c, pa.int64()) for c in counts),
                     pa.array(sums, pa.string()), pa.array(joined, pa.string())],
                    names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
                at = stop
    return run


def joined_spans(base: list, added: list) -> str:
    rows = sorted([(a, kind, b) for a, kind, b in base] + [(a, len(KINDS), b) for a, b in added])
    names = (*KINDS, ADDED)
    return ",".join(f"{names[kind]}:{a}:{b}" for a, kind, b in rows)


def find_secrets(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256,
    spans (kind:start:end, the added ones with kind ``crf``)."""
    field = field or learn(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", text_or_empty().alias("text")), _scan(field.state()),
                     f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")
