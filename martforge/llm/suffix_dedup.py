"""Removal of byte strings that repeat across documents, by a distributed
merge sort of suffixes that is aware of common prefixes.

A byte goes if it is covered by a ``length``-byte string that also starts in a
document with a smaller doc_id. The jobs:

1. *Runs.* Documents are packed into runs of a few megabytes. In every string
   of ``length`` bytes the suffixes with the least hash of their first k bytes
   are its anchors (k is half the length), so equal strings have equal
   anchors. Each run sends the sorted hashes of its anchors, front-coded as
   differences, to buckets.
2. *Distinguishing.* A bucket merges the hashes of all runs and answers, one
   bit a hash: does any other document have it? Suffixes without a partner
   are never exchanged (prefix-doubling string sorting does the same).
3. *Suffix runs.* For the others each run sorts the suffixes (with the bytes
   before them), keeps one entry of equal ones with its smallest doc_id, and
   sends them front-coded: common prefix length and remaining bytes.
4. *Merge.* A bucket combines the sorted runs with a loser tree whose nodes
   keep the common prefix with the last winner: contenders with different
   lengths are decided without looking at bytes, and equal lengths are
   compared from there on. Neighbours that share k bytes form a group, in
   which the smallest doc_id of each ``length``-byte string is found.
5. *Removal.* The answers, one bit mask an entry, go back to the runs, which
   mark the covered bytes.

A hash that occurs in many runs is *hot*: its surroundings may differ in
every document. Its strings are exchanged one by one, keyed by all of their
bytes, so that such a group spreads over the buckets; equal ones are one entry
a run. Runs, buckets and groups are thus bounded, whatever repeats.

Defined results: a null text is empty; a null doc_id counts as larger than
every other; rows with the same doc_id do not remove from one another; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, binary_view, materialize, share_code, shuffle_partitions, text_or_empty

LENGTH = 50
RUN_BYTES = 4 << 20    # text of a run; a longer document is a run of its own
HOT_RUNS = 1024        # runs that share a hash from which it is hot
SLICE = 1 << 17        # bytes hashed at once: their numbers stay in a core's cache
HASH_BITS = 48
SMALL_GROUP = 8        # entries up to which a group is compared by pairs, which is then quicker
NO_ID = np.iinfo(np.int64).max

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def prefix_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash (1 .. 2^48) of the k bytes from each position on, by doubling."""
    n = len(data) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power = data.astype(np.uint64) + np.uint64(1)
    out, done, width, level = None, 0, 1, 0
    while True:
        if k & width:
            piece = power[done:done + n]
            out = piece.copy() if out is None else out * _ODD[level % 6] + piece
            done += width
        if width * 2 > k:
            break
        power = power[:-width] * _ODD[(level + 3) % 6] + power[width:]
        power ^= power >> np.uint64(33)
        width, level = width * 2, level + 1
    return (_mixed(out) >> np.uint64(64 - HASH_BITS)) + np.uint64(1)


def _sliding(values: np.ndarray, width: int, pick: Callable) -> np.ndarray:
    """``pick`` (minimum or maximum) over each window of ``width`` values."""
    out, have = values, 1
    while have * 2 <= width:
        out = pick(out[:-have], out[have:])
        have *= 2
    if have < width:
        rest = width - have
        out = pick(out[:-rest], out[rest:])
    return out


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the anchors of a buffer of documents: every
    ``length``-byte string inside a document has one at least."""
    k = length // 2 + 1
    width = length - k + 1
    lo, hi = int(offsets[0]), int(offsets[-1])
    spots, values = [], []
    for at in range(lo, hi, SLICE):
        stop = min(at + SLICE, hi)
        h = prefix_hashes(data[at:min(stop + length - 1, hi)], k)
        if len(h) < width:
            continue
        least = _sliding(h, width, np.minimum)
        # Strings that leave their document have no anchors.
        first, last = np.searchsorted(offsets, [at, stop], side="right")
        outside = np.zeros(len(least) + 1, np.int32)
        ends = offsets[max(first, 1):last + 1]
        if last < len(offsets):
            ends = offsets[max(first, 1):last + 1]
        begins = np.maximum(ends - length + 1, offsets[max(first, 1) - 1:max(first, 1) - 1 + len(ends)])
        a = np.clip(begins - at, 0, len(least))
        b = np.clip(ends - at, 0, len(least))
        np.add.at(outside, a, 1)
        np.add.at(outside, b, -1)
        least[np.cumsum(outside[:-1]) > 0] = 0
        pad = np.zeros(width - 1, np.uint64)
        # A position is an anchor if some string over it has its hash as least.
        best = _sliding(np.concatenate([pad, least, pad]), width, np.maximum)
        found = np.flatnonzero(best[:len(h)] == h)
        spots.append(found + at)
        values.append(h[found])
    if not spots:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    spots, values = np.concatenate(spots), np.concatenate(values)
    spots, index = np.unique(spots, return_index=True)
    # Least hashes are small; mixed again they spread evenly over the buckets.
    again = (_mixed(values[index] * _ODD[1]) >> np.uint64(64 - HASH_BITS)) + np.uint64(1)
    return spots.astype(np.int64), again


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes - np.uint64(1)) * np.uint64(buckets) >> np.uint64(HASH_BITS)).astype(np.int64)


def packed(raw: bytes, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level, write_content_size=True).compress(raw)


def unpacked(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)


def pack_numbers(values: np.ndarray) -> bytes:
    """Front-coded ascending numbers: differences, one byte plane after another."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)
    return packed(np.ascontiguousarray(steps.T).tobytes())


def unpack_numbers(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(unpacked(raw), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


class Run:
    """The documents of a run with their anchors by hash."""

    def __init__(self, ids: np.ndarray, data: np.ndarray, offsets: np.ndarray, length: int, buckets: int):
        self.ids, self.data, self.offsets, self.length, self.buckets = ids, data, offsets, length, buckets
        spots, values = anchors(data, offsets, length)
        order = np.argsort(values)
        self.spots, values = spots[order], values[order]
        self.owner = np.searchsorted(offsets, self.spots, side="right") - 1
        new = np.append(True, values[1:] != values[:-1]) if len(values) else np.zeros(0, bool)
        self.which = np.cumsum(new) - 1           # number of the hash of each anchor
        self.hashes = values[new]
        firsts = np.flatnonzero(new)
        docs = ids[self.owner]
        self.several = np.minimum.reduceat(docs, firsts) != np.maximum.reduceat(docs, firsts) if len(firsts) \
            else np.zeros(0, bool)
        self.edges = np.searchsorted(bucket_of(self.hashes, buckets), np.arange(buckets + 1))

    def hash_parts(self) -> Iterator[tuple[int, bytes]]:
        """(bucket, front-coded hashes with the mark of several documents)."""
        coded = self.hashes * np.uint64(2) + self.several.astype(np.uint64)
        for b in np.flatnonzero(np.diff(self.edges)).tolist():
            yield b, pack_numbers(coded[self.edges[b]:self.edges[b + 1]])

    def entries(self, answers: list[tuple[int, bytes]]) -> list[Entries]:
        """Suffix entries of the hashes with a partner: [shared, hot]."""
        shared, hot = np.zeros(len(self.hashes), bool), np.zeros(len(self.hashes), bool)
        for b, raw in answers:
            n = int(self.edges[b + 1] - self.edges[b])
            both = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(2, -1), axis=1, count=n).astype(bool)
            shared[self.edges[b]:self.edges[b + 1]], hot[self.edges[b]:self.edges[b + 1]] = both
        back = self.length - self.length // 2 - 1
        plain = np.flatnonzero((shared & ~hot)[self.which]) if len(self.which) else np.zeros(0, np.int64)
        wide = np.flatnonzero((shared & hot)[self.which]) if len(self.which) else np.zeros(0, np.int64)
        first = Entries(self, self.spots[plain], self.owner[plain], back, self.hashes[self.which[plain]])
        # Hot: every string over the anchor on its own.
        spots = (self.spots[wide][:, None] - np.arange(back + 1)).ravel()
        owner = np.repeat(self.owner[wide], back + 1)
        inside = (spots >= self.offsets[owner]) & (spots + self.length <= self.offsets[owner + 1])
        spots, index = np.unique(spots[inside], return_index=True)
        return [first, Entries(self, spots, owner[inside][index], 0, None)]

    def covered(self, answers: list[tuple[int, bytes]], masks: list[tuple[int, int, bytes]]) -> np.ndarray:
        """Whether each byte of the run goes."""
        starts = np.zeros(len(self.data) + 1, bool)
        for kind, entries in enumerate(self.entries(answers)):
            entries.mark(starts, [(b, raw) for k, b, raw in masks if k == kind])
        gone = np.cumsum(starts[:-1], dtype=np.int32)
        gone[self.length:] -= gone[:-self.length].copy()
        return gone > 0


class Entries:
    """Distinct suffixes of a run, sorted by bucket and bytes. A row holds
    ``length`` bytes from the spot on, up to ``back`` bytes before it, and how
    many of both lie in the document."""

    def __init__(self, run: Run, spots: np.ndarray, owner: np.ndarray, back: int, hashes: np.ndarray | None):
        self.run, self.spots, self.back, size = run, spots, back, run.length
        self.docs = run.ids[owner]
        n = len(spots)
        self.after = np.minimum(size, run.offsets[owner + 1] - spots)
        self.before = np.minimum(back, spots - run.offsets[owner])
        wide = np.concatenate([np.zeros(back, np.uint8), run.data, np.zeros(size, np.uint8)])
        rows = np.empty((n, size + back + 2), np.uint8)
        if n:
            view = np.lib.stride_tricks.sliding_window_view(wide, size + back)
            for at in range(0, n, 1 << 16):
                got = view[spots[at:at + (1 << 16)]]
                rows[at:at + (1 << 16), :size] = got[:, back:]
                rows[at:at + (1 << 16), size:size + back] = got[:, :back]
        for short, limit in ((np.flatnonzero(self.after < size), self.after),):
            block = rows[short, :size]
            block[np.arange(size) >= limit[short][:, None]] = 0
            rows[short, :size] = block
        short = np.flatnonzero(self.before < back)
        block = rows[short, size:size + back]
        block[np.arange(back) < back - self.before[short][:, None]] = 0
        rows[short, size:size + back] = block
        rows[:, -2], rows[:, -1] = self.after, self.before + 1
        keys = rows.view(f"S{size + back + 2}").ravel()
        distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        if hashes is None:
            hashes = self._whole_hashes(rows[first, :size])
        else:
            hashes = hashes[first]
        bucket = bucket_of(hashes, run.buckets)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.entry = place[inverse]
        self.rows = rows[first[order]]
        self.least = np.full(len(order), NO_ID, np.int64)
        np.minimum.at(self.least, self.entry, self.docs)
        self.edges = np.searchsorted(bucket[order], np.arange(run.buckets + 1))

    @staticmethod
    def _whole_hashes(rows: np.ndarray) -> np.ndarray:
        factors = _mixed(np.arange(1, rows.shape[1] + 1, dtype=np.uint64) * _ODD[0]) | np.uint64(1)
        out = np.zeros(len(rows), np.uint64)
        for at in range(0, len(rows), 1 << 16):
            out[at:at + (1 << 16)] = (_mixed((rows[at:at + (1 << 16)].astype(np.uint64) + np.uint64(1)) * factors)
                                      ).sum(axis=1, dtype=np.uint64)
        return (_mixed(out) >> np.uint64(64 - HASH_BITS)) + np.uint64(1)

    def parts(self) -> Iterator[tuple[int, bytes]]:
        """(bucket, front-coded sorted run of suffixes)."""
        for b in np.flatnonzero(np.diff(self.edges)).tolist():
            yield b, pack_suffixes(self.rows[self.edges[b]:self.edges[b + 1]],
                                   self.least[self.edges[b]:self.edges[b + 1]], self.run.length, self.back)

    def mark(self, starts: np.ndarray, masks: list[tuple[int, bytes]]) -> None:
        """Mark in ``starts`` the strings that a smaller doc_id has."""
        found = np.zeros(len(self.least), np.uint64)
        for b, raw in masks:
            found[self.edges[b]:self.edges[b + 1]] = np.frombuffer(unpacked(raw), "<u8")
        bits = found[self.entry]
        # Behind the smallest doc_id of an equal entry everything repeats.
        bits[self.docs > self.least[self.entry]] = np.uint64(0xFFFFFFFFFFFFFFFF)
        some = np.flatnonzero(bits)
        bits, spots, before, after = bits[some], self.spots[some], self.before[some], self.after[some]
        for o in range(self.back + 1):
            hit = (bits >> np.uint64(o) & np.uint64(1)).astype(bool) & (o <= before) & (self.run.length - o <= after)
            starts[spots[hit] - o] = True


def pack_suffixes(rows: np.ndarray, least: np.ndarray, length: int, back: int) -> bytes:
    """Front coding: for each row the bytes it shares with the row before, and
    the rest; then the bytes before the spot, the sizes and the doc_ids."""
    n = len(rows)
    right = rows[:, :length]
    common = np.zeros(n, np.uint8)
    if n > 1:
        differ = right[1:] != right[:-1]
        common[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    rest = right[np.arange(length) >= common[:, None]]
    body = b"".join([np.uint32(n).tobytes(), common.tobytes(), rows[:, -2:].tobytes(), least.astype("<i8").tobytes(),
                     np.ascontiguousarray(rows[:, length:length + back]).tobytes(), rest.tobytes()])
    return packed(body)


def unpack_suffixes(raw: bytes, length: int, back: int) -> tuple:
    """(common, sizes, doc_ids, bytes before, rest) of a packed run."""
    body = unpacked(raw)
    n = int(np.frombuffer(body, np.uint32, 1)[0])
    at = 4
    common = body[at:at + n]
    at += n
    sizes = np.frombuffer(body, np.uint8, 2 * n, at).reshape(n, 2)
    at += 2 * n
    least = np.frombuffer(body, "<i8", n, at).tolist()
    at += 8 * n
    lefts = body[at:at + n * back]
    at += n * back
    return common, sizes[:, 0].tolist(), (sizes[:, 1] - 1).tolist(), least, lefts, body[at:]


def run_strings(common: bytes, rest: bytes, length: int) -> Iterator[tuple[bytes, int]]:
    """(string, common prefix with the string before) of a front-coded run."""
    last, at = b"", 0
    for c in common:
        end = at + length - c
        last = last[:c] + rest[at:end]
        at = end
        yield last, c


def merge_runs(runs: list[Iterator[tuple[bytes, int]]]) -> Iterator[tuple[bytes, int, int]]:
    """All strings in order: (string, common prefix with the one before, run).

    A loser tree over the runs. ``known[i]`` is the common prefix of run i's
    string with the last string that beat it; on the winner's path that is
    the last output. Of two contenders the one that shares more with it is
    smaller, and only equal lengths need a look at bytes, from there on.
    """
    k = len(runs)
    now: list[bytes | None] = [None] * k
    known = [0] * k
    tree = [-1] * max(k, 1)

    def play(i: int, node: int) -> int:
        """Climb from ``node``; returns the winner, or -1 if a seat was free."""
        while node:
            j = tree[node]
            if j < 0:
                tree[node] = i
                return -1
            a, b = now[i], now[j]
            if a is None:
                if b is not None:
                    tree[node], i = i, j
            elif b is not None:
                x, y = known[i], known[j]
                if x < y:
                    tree[node], i = i, j
                elif x == y:
                    c, size = x, len(a)
                    while c < size and a[c] == b[c]:
                        c += 1
                    if c == size and i > j or c < size and b[c] < a[c]:
                        known[i] = c
                        tree[node], i = i, j
                    else:
                        known[j] = c
            node >>= 1
        return i
    winner = -1
    for i, run in enumerate(runs):
        now[i], known[i] = next(run, (None, 0))
    for i in range(k):
        top = play(i, (i + k) >> 1)
        if top >= 0:
            winner = top
    while winner >= 0 and now[winner] is not None:
        yield now[winner], known[winner], winner
        now[winner], known[winner] = next(runs[winner], (None, 0))
        winner = play(winner, (winner + k) >> 1) if k > 1 else winner


def _pair_masks(group: list[tuple], length: int) -> Iterator[tuple[int, int, int]]:
    """``group_masks`` by pairs: two entries with L equal bytes before the spot and
    R from it on share the strings that start length - R to L bytes before it."""
    from_bytes = int.from_bytes
    numbers = [(from_bytes(right, "big"), from_bytes(left, "big"), len(left), after, doc)
               for right, left, after, doc, _, _ in group]
    masks = [0] * len(group)
    for i in range(1, len(group)):
        right, left, n_left, after, doc = numbers[i]
        for j in range(i):
            other_right, other_left, other_n, other_after, other_doc = numbers[j]
            if doc == other_doc:
                continue
            x = right ^ other_right
            first = max((x.bit_length() + 7) >> 3, length - after, length - other_after)   # length - R
            x = left ^ other_left
            last = min(n_left, other_n)
            if x:
                last = min(last, ((x & -x).bit_length() - 1) >> 3)
            if first <= last:
                masks[i if doc > other_doc else j] |= (2 << last) - (1 << first)
    for i, mask in enumerate(masks):
        if mask:
            yield group[i][4], group[i][5], mask


def group_masks(group: list[tuple], length: int, back: int) -> Iterator[tuple[int, int, int]]:
    """(run, place, mask) of the entries of a group: bit o is set if the string
    that starts o bytes before the spot occurs with a smaller doc_id."""
    if len(group) < 2:
        return
    least = min(e[3] for e in group)
    if len({(e[0], e[1]) for e in group}) == 1:
        for _, _, _, doc, run, place in group:
            if doc > least:
                yield run, place, (1 << (back + 1)) - 1
        return
    if len(group) <= SMALL_GROUP:
        yield from _pair_masks(group, length)
        return
    masks = [0] * len(group)
    for o in range(back + 1):
        smallest: dict[tuple[bytes, bytes], int] = {}
        keys = []
        for right, left, after, doc, _, _ in group:
            # Strings that leave the document get no key of their own length.
            key = (left[len(left) - o:], right[:length - o]) if o <= len(left) and length - o <= after else None
            keys.append(key)
            if key is not None and doc < smallest.get(key, NO_ID + 1):
                smallest[key] = doc
        for i, key in enumerate(keys):
            if key is not None and smallest[key] < group[i][3]:
                masks[i] |= 1 << o
    for i, mask in enumerate(masks):
        if mask:
            yield group[i][4], group[i][5], mask


def merge_bucket(parts: list[bytes], length: int, back: int, share: int) -> list[np.ndarray]:
    """The masks of every run's entries of a bucket. Strings that share
    ``share`` bytes form a group."""
    opened = [unpack_suffixes(p, length, back) for p in parts]
    masks = [np.zeros(len(o[0]), np.uint64) for o in opened]
    place = [0] * len(parts)
    group: list[tuple] = []
    for string, common, run in merge_runs([run_strings(o[0], o[5], length) for o in opened]):
        if common < share:
            for r, p, mask in group_masks(group, length, back):
                masks[r][p] = mask
            group = []
        _, after, before, least, lefts, _ = opened[run]
        p = place[run]
        place[run] = p + 1
        end = (p + 1) * back
        group.append((string, lefts[end - before[p]:end], after[p], least[p], run, p))
    for r, p, mask in group_masks(group, length, back):
        masks[r][p] = mask
    return masks


# -- the jobs

def _pack_runs(run_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0

        def row():
            raw = packed(b"".join(texts), 3)
            return pa.RecordBatch.from_arrays(
                [pa.array([f"{part}-{made}"]), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([raw], pa.binary())],
                names=["run", "ids", "sizes", "texts"])
        for batch in batches:
            data, offsets = binary_view(batch.column("text"))
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                text = data[offsets[i]:offsets[i + 1]].tobytes()
                if texts and size + len(text) > run_bytes:
                    yield row()
                    made += 1
                    ids, texts, size = [], [], 0
                ids.append(doc)
                texts.append(text)
                size += len(text)
        if texts:
            yield row()
    return run


def _open_run(batch: pa.RecordBatch, i: int, length: int, buckets: int) -> tuple[Run, list]:
    ids = batch.column("ids")[i].as_py()
    sizes = batch.column("sizes")[i].as_py()
    data = np.frombuffer(unpacked(batch.column("texts")[i].as_py()), np.uint8) if sum(sizes) \
        else np.zeros(0, np.uint8)
    offsets = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))]).astype(np.int64)
    numbers = np.array([NO_ID if x is None else x for x in ids], np.int64)
    return Run(numbers, data, offsets, length, buckets), ids


def _hash_runs(length: int, buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                parts = list(_open_run(batch, i, length, buckets)[0].hash_parts())
                name = batch.column("run")[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(parts), pa.string()), pa.array([b for b, _ in parts], pa.int32()),
                     pa.array([p for _, p in parts], pa.binary())], names=["run", "bucket", "part"])
    return run


def _answer_hashes(hot_runs: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        coded = [unpack_numbers(p) for p in table.column("part").to_pylist()]
        flat = np.concatenate(coded)
        hashes, several = flat >> np.uint64(1), (flat & np.uint64(1)).astype(bool)
        _, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        shared = counts > 1
        shared[inverse[several]] = True
        hot = counts >= hot_runs
        out, at = [], 0
        for c in coded:
            own = inverse[at:at + len(c)]
            at += len(c)
            out.append(np.packbits(np.stack([shared[own], hot[own]]), axis=1).tobytes())
        return pa.table([table.column("run"), table.column("bucket"), pa.array(out, pa.binary())],
                        names=["run", "bucket", "answer"])
    return run


def _answers(batch: pa.RecordBatch, i: int) -> list[tuple[int, bytes]]:
    return [(a["bucket"], a["answer"]) for a in batch.column("answers")[i].as_py() or []]


def _suffix_runs(length: int, buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                answers = _answers(batch, i)
                if not answers:
                    continue
                own, _ = _open_run(batch, i, length, buckets)
                parts = [(k, b, p) for k, e in enumerate(own.entries(answers)) for b, p in e.parts()]
                name = batch.column("run")[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(parts), pa.string()), pa.array([k for k, _, _ in parts], pa.int32()),
                     pa.array([b for _, b, _ in parts], pa.int32()), pa.array([p for _, _, p in parts], pa.binary())],
                    names=["run", "kind", "bucket", "part"])
    return run


def _merge_suffixes(length: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        kind = table.column("kind")[0].as_py()
        back = 0 if kind else length - length // 2 - 1
        share = length if kind else length // 2 + 1
        masks = merge_bucket(table.column("part").to_pylist(), length, back, share)
        return pa.table([table.column("run"), table.column("kind"), table.column("bucket"),
                         pa.array([packed(m.astype("<u8").tobytes()) for m in masks], pa.binary())],
                        names=["run", "kind", "bucket", "mask"])
    return run


def _removals(length: int, buckets: int, with_text: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own, ids = _open_run(batch, i, length, buckets)
                masks = [(m["kind"], m["bucket"], m["mask"]) for m in batch.column("masks")[i].as_py() or []]
                answers = _answers(batch, i)
                gone = own.covered(answers, masks) if answers and masks else np.zeros(len(own.data), bool)
                yield removal_rows(ids, own.data, own.offsets, gone, with_text)
    return run


def removal_rows(ids: list, data: np.ndarray, offsets: np.ndarray, gone: np.ndarray, with_text: bool) -> pa.RecordBatch:
    sizes, removed, spans, sums, kept_texts = np.diff(offsets).tolist(), [], [], [], []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        own, text = gone[a:b], data[a:b]
        n = int(own.sum())
        if n:
            edges = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
            spans.append(edges.reshape(-1, 2).tolist())
            text = text[~own]
        else:
            spans.append([])
        removed.append(n)
        raw = text.tobytes()
        sums.append(hashlib.sha256(raw).hexdigest())
        if with_text:
            kept_texts.append(raw)
    columns = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
               pa.array([len(s) for s in spans], pa.int64()), pa.array(sums, pa.string()),
               pa.array(spans, pa.list_(pa.list_(pa.int64())))]
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
    if with_text:
        columns.append(pa.array(kept_texts, pa.binary()))
        names.append("kept")
    return pa.RecordBatch.from_arrays(columns, names=names)


def suffix_dedup(docs: DataFrame, length: int = LENGTH, run_bytes: int = RUN_BYTES, hot_runs: int = HOT_RUNS,
                 with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256,
    spans (removed [start, end) pairs) and, on demand, the kept bytes."""
    if not 8 <= length <= 126:
        raise ValueError("length must be 8 to 126")
    spark = docs.sparkSession
    share_code(spark)
    buckets = min(shuffle_partitions(spark), 1 << 15)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    runs = materialize(arrow_map(rows, _pack_runs(run_bytes), "run string, ids array<bigint>, sizes array<bigint>, "
                                                              "texts binary"), "suffix-text-runs")
    hashes = arrow_map(runs, _hash_runs(length, buckets), "run string, bucket int, part binary")
    answers = hashes.groupBy("bucket").applyInArrow(_answer_hashes(hot_runs), "run string, bucket int, answer binary")
    # Per run at most one answer a bucket.
    answers = materialize(answers.groupBy("run").agg(F.collect_list(F.struct("bucket", "answer")).alias("answers")),
                          "suffix-answers")
    known = runs.join(answers, "run", "left")
    suffixes = arrow_map(known, _suffix_runs(length, buckets), "run string, kind int, bucket int, part binary")
    masks = suffixes.groupBy("kind", "bucket").applyInArrow(
        _merge_suffixes(length), "run string, kind int, bucket int, mask binary")
    masks = materialize(masks.groupBy("run").agg(F.collect_list(F.struct("kind", "bucket", "mask")).alias("masks")),
                        "suffix-masks")
    told = runs.join(answers.join(masks, "run", "left"), "run", "left")
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, " \
             "spans array<array<bigint>>" + (", kept binary" if with_text else "")
    return arrow_map(told, _removals(length, buckets, with_text), schema)
