import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from martforge.llm import centroids as C

SCHEMA = "vec_id bigint, embedding array<double>, cluster string, block int, distance int"


def plain(rows, k, rounds, scale=256, seed=2):
    """Every vector compared with every centroid in every round."""
    kept = [(i, [int(np.floor(scale * x)) for x in v]) for i, v in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in order[:k]]

    def assign(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(assign(v)[1], []).append(v)
        cents = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(cents)]
    return sorted((str(i), assign(v)[1], assign(v)[0]) for i, v in kept), cents


def rows_of(df):
    return sorted((str(r[0]), r[1], r[2]) for r in df.collect())


def make(spark, rows):
    return spark.createDataFrame([(i, v, "x", 7, 1) for i, v in rows], SCHEMA)


def grouped(n, dimension, seed, spread=0.02):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dimension))
    return [(i, (centres[i % 12] + spread * rng.normal(size=dimension)).tolist()) for i in range(n)]


def test_equals_plain_rounds_and_rescans_less(spark):
    rows = grouped(1500, 8, 1)
    got, cents, scans = C.cluster_vectors(make(spark, rows), "vec_id", "embedding", k=9, rounds=5, dimension=8)
    want, want_cents = plain(rows, 9, 5)
    assert rows_of(got) == want
    assert cents.tolist() == want_cents
    assert scans[0] == 1500 and scans[-1] < 750  # most vectors stay in their heaps


def test_ties_nulls_repeats_and_odd_rows(spark):
    rows = [(i % 9, [float(i % 3), 0.5]) for i in range(40)] + [(None, [1.0, 0.5]), (50, None), (51, [1.0, None]),
            (52, [float("nan"), 1.0]), (53, [float("inf"), 1.0]), (54, [-0.001, -7.3])]
    got, cents, _ = C.cluster_vectors(make(spark, rows), "vec_id", "embedding", k=7, rounds=3, dimension=2)
    want, want_cents = plain(rows, 7, 3)
    assert rows_of(got) == want and cents.tolist() == want_cents


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.integers(-500_000, 500_000, 4).astype(float).tolist()) for i in range(200)]
    got, cents, _ = C.cluster_vectors(make(spark, rows), "vec_id", "embedding", k=5, rounds=3, dimension=4)
    want, want_cents = plain(rows, 5, 3)
    assert rows_of(got) == want and cents.tolist() == want_cents
    with pytest.raises(Exception, match="beyond 2\\^27"):
        C.clustered(make(spark, [(1, [1e9, 0.0])]), k=1, dimension=2).collect()


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_vectors(spark, n):
    df = make(spark, [(i, [float(i), 1.0]) for i in range(n)])
    out = C.clustered(df, k=5, rounds=2, dimension=2)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert out.count() == n and out.agg(F.coalesce(F.sum("distance"), F.lit(0))).first()[0] == 0


def test_heaps_survive_a_dump():
    rng = np.random.default_rng(0)
    cluster, keys = rng.integers(0, 4, 50), rng.normal(size=50)
    heaps = C.Heaps.load(*C.Heaps.build(cluster, keys, 4).dump())
    assert heaps.assignment(50).tolist() == cluster.tolist()
    rows, old = heaps.expired(np.array([0.0, -9.0, 9.0, 0.5]))
    assert sorted(rows) == [i for i in range(50) if keys[i] <= [0.0, -9.0, 9.0, 0.5][cluster[i]]]
    heaps.push(np.array(old), keys[rows], rows)
    assert heaps.assignment(50).tolist() == cluster.tolist()


def test_vectors_are_not_exchanged_again(spark):
    blocks = C._write_bucketed(spark.range(20).selectExpr("id AS block", "array(id) AS ids", "cast('x' AS binary) AS vectors"), 4)
    state = C.materialize(spark.range(20).selectExpr("id AS block", "array(1) AS sizes"), "t")
    plan = blocks.join(state.hint("shuffle_hash"), "block")
    plan.count()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in text or "BroadcastHashJoin" in text
    assert text.split("Final Plan")[-1].split("Initial Plan")[0].count("Exchange") <= 2
