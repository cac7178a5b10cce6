import hashlib

import numpy as np

from martforge.llm import exact_dedup as X
from martforge.llm.common import table
from tests.conftest import SF_CHECK


def expected(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    out = []
    for t, ids in groups.items():
        keep = max((d for d in ids if d is not None), default=None)
        left = True
        for d in sorted(ids, key=lambda d: (d is not None, d or 0), reverse=True):
            out.append((d, keep, len(ids), left, hashlib.sha256(t.encode()).hexdigest()))
            left = False
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.drop("n_chunks").collect()), key=repr)


def test_edge_rows(spark, documents):
    docs = documents.withColumnRenamed("n_chars", "recipe")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(X.exact_dedup(docs)) == expected(rows)
    assert X.exact_dedup(docs.limit(0)).count() == 0
    kept = X.keep_exact_unique(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text or "") for r in kept.collect()), key=repr) == \
        sorted(((d, next(t or "" for e, t in rows if e == d and hashlib.sha256((t or "").encode()).hexdigest() == s))
                for d, _, _, k, s in expected(rows) if k), key=repr)


def test_colliding_fingerprints_are_told_apart(spark):
    def weak(chunk):
        return bytes([len(chunk) % 3])
    docs = table(spark, SF_CHECK, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert result(X.exact_dedup(docs, weak)) == expected(rows) == result(X.exact_dedup(docs))


def test_cuts_depend_on_the_content_only():
    rng = np.random.default_rng(2)
    body = rng.integers(0, 256, 60_000, dtype=np.uint8)
    def chunks(prefix, suffix):
        data = np.concatenate([prefix, body, suffix])
        edges, counts = X.cut_points(data, np.array([0, len(prefix), len(prefix) + len(body), len(data)]))
        at = counts[0]
        return [data[a:b].tobytes() for a, b in zip(edges[at:at + counts[1]], edges[at + 1:])]
    one, two = chunks(body[:0], body[:0]), chunks(body[:777], body[:99])
    assert one == two and len(one) > 5 and b"".join(one) == body.tobytes()
    # an insertion changes the chunks near it only
    moved = np.concatenate([body[:30_000], body[:5], body[30_000:]])
    edges, _ = X.cut_points(moved, np.array([0, len(moved)]))
    parts = {moved[a:b].tobytes() for a, b in zip(edges, edges[1:])}
    assert len(parts - set(one)) <= 3
    same = np.zeros(400_000, np.uint8)
    edges, _ = X.cut_points(same, np.array([0, len(same)]))
    assert np.diff(edges).max() <= X.MAX_CHUNK


def test_rows_of_no_key_are_not_moved(spark):
    from martforge.llm.common import split_by_keys
    rows = spark.createDataFrame([(i % 50 or None, f"t{i}") for i in range(200)], "a int, b string")
    keys = spark.createDataFrame([(None, "t0"), (7, "t7"), (8, "t999")], "x int, y string")
    for bits in (1 << 26, 64):
        others, found = split_by_keys(rows, ["a", "b"], keys, ["x", "y"], bits)
        assert others.columns == found.columns == rows.columns
        assert "hashpartitioning" not in others._jdf.queryExecution().executedPlan().toString()
        one, two = [list(map(tuple, d.collect())) for d in (others, found)]
        assert sorted(one + two, key=repr) == sorted(map(tuple, rows.collect()), key=repr)
        assert {(None, "t0"), (7, "t7")} <= set(two) and (bits == 64 or len(two) == 2)
    assert split_by_keys(rows, ["a", "b"], keys.limit(0), ["x", "y"])[0].count() == 200
