import hashlib
import random

import numpy as np
import pytest

from martforge.llm import suffix_dedup as S
from martforge.llm.common import table
from tests.conftest import SF_CHECK

DIGEST = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def brute(rows, length):
    """Digest rows by a table of the smallest doc_id of every string."""
    first = {}
    raws = [(d, (t or "").encode()) for d, t in rows]
    big = float("inf")
    for d, raw in raws:
        d = big if d is None else d
        for p in range(len(raw) - length + 1):
            s = raw[p:p + length]
            if d < first.get(s, (big,))[0] or s not in first:
                first[s] = (d,)
    out = []
    for d, raw in raws:
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if first[raw[p:p + length]][0] < (big if d is None else d):
                gone[p:p + length] = b"\x01" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        out.append((d, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select(DIGEST).collect()), key=repr)


def test_whole_table_against_brute_force(spark):
    docs = table(spark, SF_CHECK, "documents")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], 50)
    assert sum(r[2] for r in want) > 10_000
    assert result(S.suffix_dedup(docs)) == want
    # many small runs, every hash that two runs share hot
    assert result(S.suffix_dedup(docs, run_bytes=100_000, hot_runs=2)) == want


@pytest.mark.parametrize("length", [8, 50])
@pytest.mark.parametrize("hot_runs", [2, 1000])
def test_random_texts(spark, length, hot_runs):
    rng = random.Random(length)
    pieces = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 90))) for _ in range(12)] + ["é🙂" * 20, "\x00" * 60]
    rows = [(rng.choice([None, *range(60)]), "".join(rng.choice(pieces) for _ in range(rng.randint(0, 6)))) for _ in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert result(S.suffix_dedup(docs, length, run_bytes=500, hot_runs=hot_runs)) == brute(rows, length)


def test_edge_rows(spark, documents):
    docs = documents.withColumnRenamed("n_chars", "run")
    rows = [(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 1000]
    from pyspark.sql import functions as F
    small = docs.filter(F.length(F.coalesce("text", F.lit(""))) < 1000)
    assert result(S.suffix_dedup(small)) == brute(rows, 50)
    assert S.suffix_dedup(docs).count() == docs.count()
    assert S.suffix_dedup(docs.limit(0)).count() == 0
    kept = {r.doc_id: bytes(r.kept) for r in S.suffix_dedup(small, with_text=True).collect()}
    assert kept[2] == b"" and kept[1] == rows[0][1].encode()


def test_merge_of_front_coded_runs():
    rng = random.Random(5)
    for k in (1, 2, 3, 7, 16):
        runs = [sorted({bytes(rng.choice(b"ab") for _ in range(10)) for _ in range(rng.randint(0, 40))}) for _ in range(k)]
        coded = []
        for run in runs:
            rows = np.zeros((len(run), 12), np.uint8)
            for i, s in enumerate(run):
                rows[i, :10] = np.frombuffer(s, np.uint8)
            rows[:, -1] = 1
            common, _, _, _, _, rest = S.unpack_suffixes(S.pack_suffixes(rows, np.zeros(len(run), np.int64), 10, 0), 10, 0)
            coded.append(S.run_strings(common, rest, 10))
        out = list(S.merge_runs(coded))
        assert [s for s, _, _ in out] == sorted(s for run in runs for s in run)
        for (a, _, _), (b, common, _) in zip(out, out[1:]):
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), 10)
            assert common == same


def test_equal_strings_have_equal_anchors():
    rng = np.random.default_rng(1)
    for length in (8, 50, 75):
        core = rng.integers(0, 4, length + 20, dtype=np.uint8)
        data = np.concatenate([rng.integers(0, 4, 300, dtype=np.uint8), core, rng.integers(0, 4, 90, dtype=np.uint8), core])
        offsets = np.array([0, 200, 310 + length, len(data)])
        spots, _ = S.anchors(data, offsets, length)
        width = length - length // 2
        for a, b in zip(offsets, offsets[1:]):
            for p in range(a, b - length + 1):
                assert any(p <= s < p + width for s in spots)


def test_pairs_give_the_masks_of_whole_groups(monkeypatch):
    rng, some = random.Random(3), 0
    for _ in range(2000):
        length = rng.choice([8, 12, 50])
        back, share = length - length // 2 - 1, length // 2 + 1
        group = []
        for run in range(rng.randint(2, 8)):
            after = rng.randint(share, length)
            right = (b"a" * share + bytes(rng.choice(b"aaaaab\0") for _ in range(length - share)))[:after].ljust(length, b"\0")
            left = bytes(rng.choice(b"aaaaaab\0") for _ in range(rng.randint(0, back)))
            group.append((right, left, after, rng.randint(1, 4), run, 0))
        with monkeypatch.context() as m:
            m.setattr(S, "SMALL_GROUP", 0)
            whole = list(S.group_masks(group, length, back))
        assert list(S.group_masks(group, length, back)) == whole
        some += bool(whole)
    assert some > 200
