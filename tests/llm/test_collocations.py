import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from martforge.llm import collocations as C

SCHEMA = "doc_id bigint, text string, lang string, n bigint, phrase string, shard int"


def pieces(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split(r"[.,;:!?\x0A-\x0D]", lower)]


def phrase_counts(rows, longest=4):
    f = Counter()
    for text, lang in rows:
        for w in pieces(text):
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[(lang or "und", tuple(w[i:i + k]))] += 1
    return f


def brute(rows, threshold, top):
    f = phrase_counts(rows)
    cand = {}
    for (lang, p), a in f.items():
        if len(p) >= 2 and a >= threshold:
            score, k, l, r = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                                 for k in range(1, len(p)))
            cand[lang, p] = (score, a, l, r)

    def inside(p, q):
        return len(p) < len(q) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
    out = defaultdict(list)
    for (lang, p), (score, a, l, r) in cand.items():
        if not any(g == lang and inside(p, q) and 100 * b >= 80 * a for (g, q), (_, b, _, _) in cand.items()):
            out[lang].append((-score, -a, " ".join(p).encode(), l, r))
    n = Counter()
    for (lang, p), a in f.items():
        n[lang] += a if len(p) == 1 else 0
    return sorted((lang, i + 1, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0])
                  for lang, xs in out.items() for i, x in enumerate(sorted(xs)[:top]))


def make(spark, rows):
    return spark.createDataFrame([(1, t, g, 2, "x", 3) for t, g in rows], SCHEMA).repartition(5)


def corpus(seed, n=150, words=9):
    rng = random.Random(seed)
    vocabulary = ["New", "york", "é", "日本", "city", "of", "*", "the", "a.b", "x" * 40][:words]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "\t", "  ", ", ", "\n", ". "])
                       for _ in range(rng.randrange(0, 60)))
        rows.append((text, rng.choice(["en", "de", None])))
    return rows + [(None, "en"), ("", None), (" \t. \n", "fr"), ("lonely words here", "it"), (rows[0][0], rows[0][1])]


@pytest.mark.parametrize("bits", [1 << 26, 64])
def test_equals_brute_force(spark, bits):
    """Also with a bit array in which every bit is soon set."""
    rows = corpus(1)
    got = C.collocations(make(spark, rows), threshold=12, top=25, filter_bits=bits)
    assert sorted(map(tuple, got.collect())) == brute(rows, 12, 25)


def test_counts_are_exact_and_interleaved(spark):
    rows = corpus(2, n=300)
    blocks = C.word_blocks(make(spark, rows), 4)
    blocks = C.materialize(blocks.withColumn("shard", C.F.expr("cast(pmod(xxhash64(codes), 4) as int)")), "t")
    got = C.frequent_phrases(blocks, 15)
    want = {(g, " ".join(p)): n for (g, p), n in phrase_counts(rows).items() if n >= 15}
    assert {(r.lang, r.phrase): r.n for r in got.collect()} == want
    _, steps = C.reached_numbers(blocks, 15)
    assert 4 < steps < 16  # lengths one after the other would need four cycles


def test_a_phrase_is_counted_for_exactly_one_cycle():
    """Whatever the bits are: growing random bit arrays."""
    class Shared:
        def __init__(self, value):
            self.value = value
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(12)]
    codes = rng.integers(-1, 12, 4000).astype(np.int32)
    batch = pa.RecordBatch.from_pylist([{"lang": "en", "hashes": C._word_hashes(words).tobytes(), "codes": codes.tobytes()}])
    bits, history = np.zeros(4, np.uint64), []
    for _ in range(16):
        history.append(bits.copy())
        for _ in range(9):
            bits = bits | (np.uint64(1) << rng.integers(0, 64, 4).astype(np.uint64))
    seen, first = Counter(), {}
    for step in range(16):
        before = Shared(history[step - 4]) if step >= 4 else None
        for out in C._count_numbers(Shared(history[step]), before, 256, 4)([batch]):
            for i, n in zip(out.column("id").to_pylist(), out.column("n").to_pylist()):
                assert first.setdefault(i, (step, n))[1] == n and step < first[i][0] + 4
                seen[i] += 1
    assert Counter(n for i, n in seen.items() if i & 3 == 0) == {4: 12}
    # Those that began early enough have been counted four times, in a row.
    assert {seen[i] for i, (step, _) in first.items() if step <= 12} == {4}
    assert {i & 3 for i in seen} == {0, 1, 2, 3}


def test_long_text_many_languages_and_empty_table(spark):
    rows = [("alpha beta gamma " * 120_000, "en")] + [("un deux trois " * 20, f"l{i}") for i in range(40)]
    got = {r.phrase: r for r in C.collocations(make(spark, rows), threshold=30, top=5).where("lang = 'en'").collect()}
    assert got["alpha beta gamma alpha"].a == 119_999 and got["alpha beta gamma alpha"].n == 360_000
    assert C.collocations(make(spark, []), threshold=2).collect() == []


def test_numbers_move_packed_by_range():
    rng = np.random.default_rng(7)
    ids = np.unique(rng.integers(0, 1 << 64, 5000, dtype=np.uint64))
    n = rng.integers(1, 4, len(ids))
    n[0] = (1 << 61) + 1
    again = C._unpacked_counts(C._packed_counts(ids, n))
    assert np.array_equal(again[0], ids) and np.array_equal(again[1], n)
    halves = [pa.RecordBatch.from_arrays([pa.array(ids[k::2].view(np.int64)), pa.array(n[k::2])], names=["id", "n"]) for k in (0, 1)]
    parts = pa.Table.from_batches(C._by_bucket(iter, 7)(halves + halves[:1]))
    assert sorted(set(parts.column("bucket").to_pylist())) == list(range(7)) and len(parts) == 21
    sums = [C._add_counts(parts.filter(C.pc.equal(parts.column("bucket"), b))) for b in range(7)]
    want = n.copy()
    want[::2] *= 2
    found = pa.Table.from_batches(x for t in sums for x in C._unpack(C._from_count(2))(t.to_batches()))
    assert found.column("id").to_numpy().view(np.uint64).tolist() == ids[want >= 2].tolist()  # the ranges follow one another
    assert found.column("n").to_pylist() == want[want >= 2].tolist()


def test_numbers_of_a_block_are_few_bytes():
    """A block of 200,000 phrases moves under 4.5 bytes a phrase in 12 ranges; hashes of 62 bits took more than six."""
    rng = np.random.default_rng(8)
    ids = np.unique(np.concatenate([C._number(rng.integers(0, 1 << 64, 50_000, dtype=np.uint64), k) for k in (1, 2, 3, 4)]))
    n = rng.geometric(0.8, len(ids))
    parts = pa.Table.from_batches(C._by_bucket(iter, 12)([
        pa.RecordBatch.from_arrays([pa.array(ids.view(np.int64)), pa.array(n)], names=["id", "n"])])).column("part").to_pylist()
    assert sum(len(pa.compress(p, "lz4", asbytes=True)) for p in parts) < 4.5 * len(ids)
    again = [np.concatenate(x) for x in zip(*map(C._unpacked_counts, parts))]
    assert np.array_equal(again[0], ids) and np.array_equal(again[1], n)


def test_phrases_of_a_block_move_packed():
    """Sorted and compressed: less than half of their text; the counts of texts, with one number or not, are kept apart."""
    class Shared:
        value = np.full(1, ~np.uint64(0))
    words = sorted({f"wort{i * i % 977}" for i in range(400)} | {"é", "日本"})
    rng = np.random.default_rng(9)
    codes = rng.integers(-1, len(words), 30_000).astype(np.int32)
    batch = pa.RecordBatch.from_pylist([{"lang": "en", "words": words, "hashes": C._word_hashes(words).tobytes(), "codes": codes.tobytes()}])
    parts = pa.Table.from_batches(C._count_phrases(Shared, 64, 2, 3)([batch, batch]))
    want = Counter(words[c] for c in codes if c >= 0) + Counter(f"{words[a]} {words[b]}" for a, b in zip(codes, codes[1:]) if min(a, b) >= 0)
    assert 2 * sum(len(p) for p in parts.column("part").to_pylist()) < 2 * sum(len(p.encode()) for p in want)
    keys = {(r["bucket"], r["len"]) for r in parts.to_pylist()}
    assert keys == {(b, k) for b in range(3) for k in (1, 2)} and len(parts) == 12
    found = [r for b, k in keys for r in C._add_phrases(4)(parts.filter((pc.field("bucket") == b) & (pc.field("len") == k))).to_pylist()]
    assert sorted((r["phrase"], r["n"]) for r in found) == sorted((p, 2 * n) for p, n in want.items() if n >= 2)
    assert all(r["lang"] == "en" and r["len"] == r["phrase"].count(" ") + 1 for r in found)
