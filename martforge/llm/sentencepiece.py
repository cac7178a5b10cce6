"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The model file is compiled into a transducer: the normaliser (dummy prefix,
blanks to U+2581), an arc for every piece, and byte fallback arcs for
characters without a piece. Encoding composes it with the input and takes
the shortest path in the tropical semiring.

Unigram models weight an arc with the negative score. Byte-pair models need
the merge order instead: a sequence of pieces is the model's encoding exactly
if every neighbouring pair is (encoding their joined text gives the same two
pieces), so the state is the last piece, a pair arc weighs 0 or infinity, and
one finite path remains. Pair weights are computed on demand and kept.

No piece spans the border from another character to U+2581 (checked at
compilation), so the composed lattice has a cut node there; paths between cut
nodes are solved alone and kept by their text, up to a bound.

Defined results: a null text is encoded as the empty text (no ids); decoding
restores every text except that U+2581 comes back as a blank, the model's own
rule; rows with a null doc_id and repeated rows each get their row; texts of any
length are encoded whole; equal paths are settled as in the public library; an
empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, binary_view, text_or_empty

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
CACHED_PATHS = 400_000   # texts between cut nodes that a worker keeps
CACHED_PAIRS = 1_000_000  # pair weights that a worker keeps
CACHED_LENGTH = 48       # longer ones are not kept
INFINITE = float("inf")
# Piece types of the model format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value
    while at < len(raw):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(kind) or number()
            yield key >> 3, raw[at:at + size]
            at += size


class Transducer:
    """A compiled model: ``encode`` and ``decode`` single texts."""

    def __init__(self, model: bytes):
        self.kind, self.dummy_prefix, byte_fallback = UNIGRAM, True, False
        self.pieces, self.scores, self.types = [], [], []
        for field, value in _fields(model):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.types.append(piece.get(3, NORMAL))
            elif field == 2:
                spec = dict(_fields(value))
                self.kind, byte_fallback = spec.get(3, UNIGRAM), bool(spec.get(35, 0))
            elif field == 3:
                spec = dict(_fields(value))
                self.dummy_prefix = bool(spec.get(3, 1))
                if spec.get(2) or spec.get(4, 1) or not spec.get(5, 1):
                    raise ValueError("only identity normalisers that keep and escape blanks are compiled")
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and byte-pair models are compiled")
        ids = range(len(self.pieces))
        self.arcs = {self.pieces[i]: i for i in ids if self.types[i] in (NORMAL, USER)}
        self.unknown = next((i for i in ids if self.types[i] == UNKNOWN), 0)
        self.byte_ids = {int(self.pieces[i][1:-1], 16): i for i in ids if self.types[i] == BYTE} if byte_fallback else {}
        self.longest = max(map(len, self.arcs), default=1)
        self.prefix, self.reach = 3, {}
        for piece in self.arcs:
            start = piece[:self.prefix]
            self.reach[start] = max(len(piece), self.reach.get(start, 0))
        self.plain = [bytes([int(p[1:-1], 16)]) if t == BYTE else b"" if t in (CONTROL, UNKNOWN)
                      else p.replace(BLANK, " ").encode() for p, t in zip(self.pieces, self.types)]
        self.pairs: dict[tuple[int, int], float] = {}
        self.paths: dict[str, bytes] = {}
        cuts = not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in self.arcs)
        # Line ends without an arc are cut nodes as well.
        ends = "".join(c for c in "\n\t\r" if not any(c in p for p in self.arcs))
        ends = re.escape(ends)
        self.cut = re.compile((f"[{ends}]|" if ends else "") + f"{BLANK}*[^{BLANK}{ends}]+|{BLANK}+", re.S) if cuts else None

    # -- weights

    def merged(self, symbols: list[str]) -> list[str]:
        """Byte-pair merges of a short sequence: best score first, leftmost on ties."""
        while True:
            best, at = -INFINITE, -1
            for i in range(len(symbols) - 1):
                j = self.arcs.get(symbols[i] + symbols[i + 1])
                if j is not None and self.scores[j] > best:
                    best, at = self.scores[j], i
            if at < 0:
                return symbols
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]

    def pair_weight(self, left: int, right: int) -> float:
        """0 if the two pieces stand side by side in the encoding of their
        text; without a left piece (-1), if the piece encodes its own text."""
        key = (left, right)
        weight = self.pairs.get(key)
        if weight is None:
            pieces = [self.pieces[i] for i in key if i >= 0]
            weight = 0.0 if self.merged(list("".join(pieces))) == pieces else INFINITE
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            self.pairs[key] = weight
        return weight

    # -- shortest paths

    def fallback(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode()] if self.byte_ids else [self.unknown]

    def shortest_path(self, text: str) -> list[int]:
        """Ids of the shortest path between two cut nodes."""
        return self.free_path(text) if self.kind == BPE else self.cheapest_path(text)

    def free_path(self, text: str) -> list[int]:
        """Byte-pair models: the path of weight 0, which is the shortest as no
        weight is negative. Depth first, long arcs first. At most one weight-0
        path reaches a node, so a node that failed once is never entered again.
        A character without an arc ends a path and starts the next one."""
        arcs, pairs, n, longest = self.arcs, self.pairs, len(text), self.longest
        reach, prefix = self.reach, self.prefix
        out: list[int] = []
        at, failed = 0, set()
        spans: list[int] = []  # lengths of the arcs of the path since the last fallback
        limit, last = longest, -1
        while at < n:
            # No arc from here is longer than the longest piece with this start.
            stop = at + min(limit, reach.get(text[at:at + prefix], prefix - 1))
            if stop > n:
                stop = n
            while stop > at:
                piece = arcs.get(text[at:stop])
                if piece is not None and stop not in failed:
                    weight = pairs.get((last, piece))
                    if weight is None:
                        weight = self.pair_weight(last, piece)
                    if weight == 0.0:
                        break
                stop -= 1
            if stop > at:
                out.append(piece)
                spans.append(stop - at)
                at, last, limit = stop, piece, longest
            elif text[at] not in arcs:
                out += self.fallback(text[at])
                at, last, limit, spans = at + 1, -1, longest, []
            else:
                if not spans:
                    raise ValueError("no finite path")
                failed.add(at)
                limit = spans.pop()
                at -= limit
                limit -= 1
                out.pop()
                last = out[-1] if spans else -1
        return out

    def cheapest_path(self, text: str) -> list[int]:
        """Unigram models: Viterbi over the nodes, weights add up."""
        n, arcs, scores = len(text), self.arcs, self.scores
        cost, back = [INFINITE] * (n + 1), [(0, -1)] * (n + 1)
        cost[0] = 0.0
        rare = -min(scores, default=0.0) + 10.0
        for end in range(1, n + 1):
            for start in range(end - 1, max(-1, end - 1 - self.longest), -1):
                piece = arcs.get(text[start:end])
                if piece is not None and cost[start] - scores[piece] < cost[end]:
                    cost[end], back[end] = cost[start] - scores[piece], (start, piece)
            if text[end - 1] not in arcs and cost[end - 1] + rare < cost[end]:
                cost[end], back[end] = cost[end - 1] + rare, (end - 1, -1)
        out, at = [], n
        while at:
            start, piece = back[at]
            out.append([piece] if piece >= 0 else self.fallback(text[start:at]))
            at = start
        return [i for ids in reversed(out) for i in ids]

    def encode_bytes(self, text: str) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        if not text:
            return b""
        plain = ((" " if self.dummy_prefix else "") + text).replace(" ", BLANK)
        parts = self.cut.findall(plain) if self.cut else [plain]
        found = list(map(self.paths.get, parts))
        if None in found:
            found = [self.path_bytes(p) if f is None else f for p, f in zip(parts, found)]
        return b"".join(found)

    def path_bytes(self, part: str) -> bytes:
        found = self.paths.get(part)
        if found is None:
            ids = self.shortest_path(part)
            found = struct.pack(f"<{len(ids)}i", *ids)
            if len(part) <= CACHED_LENGTH:
                if len(self.paths) >= CACHED_PATHS:
                    self.paths.clear()
                self.paths[part] = found
        return found

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<i4").tolist()

    def decode_bytes(self, ids: list[int]) -> bytes:
        plain = self.plain
        raw = b"".join([plain[i] for i in ids])
        return raw[1:] if self.dummy_prefix and raw[:1] == b" " else raw

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode(errors="replace")


_COMPILED: dict[bytes, Transducer] = {}


def compiled(model: bytes) -> Transducer:
    """The transducer of a model, compiled once per worker process."""
    key = hashlib.sha256(model).digest()
    if key not in _COMPILED:
        _COMPILED.clear()
        _COMPILED[key] = Transducer(model)
    return _COMPILED[key]


def read_model(path: str = MODEL_PATH) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _encoder(model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = compiled(model.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            # Bounded outputs: a batch of long texts leaves in several pieces.
            data, offsets = binary_view(batch.column("text"))
            at = 0
            while at < batch.num_rows:
                stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + (4 << 20), side="right")) - 1)
                stop = min(stop, batch.num_rows)
                found = [fst.encode_bytes(data[a:b].tobytes().decode())
                         for a, b in zip(offsets[at:stop].tolist(), offsets[at + 1:stop + 1].tolist())]
                counts = np.array([len(x) // 4 for x in found], np.int64)
                flat = pa.array(np.frombuffer(b"".join(found), "<i4"))
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), flat)
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(at, stop - at) for c in batch.columns), ids], names=[*batch.schema.names, "ids"])
                at = stop
    return run


def _decoder(model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = compiled(model.value)
        for batch in batches:
            texts = [None if ids is None else fst.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*batch.schema.names, "decoded"])
    return run


def _schema(df: DataFrame, extra: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), extra])


def encode(rows: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """Add ``ids`` (array of int) to rows with a ``text`` column; null is empty."""
    model = rows.sparkSession.sparkContext.broadcast(read_model(model_path))
    filled = rows.withColumn("text", text_or_empty())
    return arrow_map(filled, _encoder(model), _schema(filled, "ids array<int>"))


def decode(rows: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """Add ``decoded`` (string) to rows with an ``ids`` column."""
    model = rows.sparkSession.sparkContext.broadcast(read_model(model_path))
    return arrow_map(rows, _decoder(model), _schema(rows, "decoded string"))


def _both(model) -> Callable:
    encoder = _encoder(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = compiled(model.value)
        for batch in encoder(batches):
            data, offsets = binary_view(batch.column("text"))
            ids = batch.column("ids")
            flat, bounds = ids.flatten().to_numpy(), ids.offsets.to_numpy()
            sums, same = [], []
            for i in range(batch.num_rows):
                back = fst.decode_bytes(flat[bounds[i]:bounds[i + 1]].tolist())
                text = data[offsets[i]:offsets[i + 1]].tobytes()
                sums.append(hashlib.sha256(back).hexdigest())
                same.append(back == text.replace(BLANK.encode(), b" "))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(bounds).astype(np.int64)), ids,
                 pa.array(sums, pa.string()), pa.array(same)],
                names=["doc_id", "n_tokens", "ids", "decoded_sha256", "round_trip"])
    return run


def tokenised(docs: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """doc_id, n_tokens, ids, decoded_sha256 (of the text decoded from the
    ids) and round_trip (whether it is the input, U+2581 read as a blank)."""
    model = docs.sparkSession.sparkContext.broadcast(read_model(model_path))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    return arrow_map(rows, _both(model), f"doc_id {kind}, n_tokens bigint, ids array<int>, "
                                         "decoded_sha256 string, round_trip boolean")
