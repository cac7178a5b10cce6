"""Global ranks, surrogate keys and exact quantiles against brute force."""

import random

import numpy as np
from pyspark.sql import functions as F

from martforge.operators.keys import assign_surrogate_keys, with_global_rank
from martforge.operators.outliers import exact_quantiles, iqr_bounds


def test_global_rank_equals_sorted_position(spark):
    rnd = random.Random(7)
    keys = [f"k{rnd.randrange(10**9):09d}" for _ in range(5000)]
    keys = list(dict.fromkeys(keys))
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(13)
    got = {r.k: r.rank for r in with_global_rank(df, ["k"], "rank").collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(keys))}


def test_weighted_rank_is_running_total(spark):
    rows = [(float(v), c) for v, c in [(3.0, 2), (1.0, 5), (2.0, 1), (10.0, 4)]]
    df = spark.createDataFrame(rows, "v double, c long")
    got = {r.v: r.cum for r in with_global_rank(df, ["v"], "cum", weight=F.col("c")).collect()}
    assert got == {1.0: 5, 2.0: 6, 3.0: 8, 10.0: 12}


def test_surrogate_keys_continue_after_max(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "id string")
    max_key = spark.createDataFrame([(41,)], "m long").select(F.max("m")).scalar()
    got = {r.id: r.key for r in assign_surrogate_keys(df, "id", "key", start_after=max_key).collect()}
    assert got == {"a": 42, "b": 43, "c": 44}


def test_exact_quantiles_match_linear_interpolation(spark):
    rnd = random.Random(3)
    # Heavy duplicates: one value holds a third of all rows.
    vals = [rnd.choice([5.0, rnd.uniform(0, 100)]) if rnd.random() < 0.5 else rnd.uniform(0, 1000)
            for _ in range(3000)]
    vals += [42.0] * 1500
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(7)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    row = exact_quantiles(df, "x", probs).collect()[0]
    expect = np.quantile(np.array(vals), probs, method="linear")
    for i, e in enumerate(expect):
        assert abs(row[f"q_{i}"] - e) <= 1e-9 * max(1.0, abs(e))


def test_iqr_bounds(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 8, 100]], "x double")
    b = iqr_bounds(df, ["x"]).collect()[0]
    assert (b.q1, b.q3) == (3.0, 7.0)
    assert (b.lower_bound, b.upper_bound) == (-3.0, 13.0)


def test_grouped_rank_restarts_per_group(spark):
    rows = [("a", "k3"), ("a", "k1"), ("b", "k2"), ("b", "k0"), ("a", "k2")]
    df = spark.createDataFrame(rows, "g string, k string").repartition(3)
    got = {(r.g, r.k): r.rank for r in with_global_rank(df, ["k"], "rank", group_cols=["g"]).collect()}
    assert got == {("a", "k1"): 1, ("a", "k2"): 2, ("a", "k3"): 3, ("b", "k0"): 1, ("b", "k2"): 2}


def test_quantiles_of_several_columns_in_one_pass(spark):
    rnd = random.Random(11)
    rows = [(rnd.uniform(0, 10), None if i % 7 == 0 else rnd.uniform(-5, 5)) for i in range(2000)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = {r.column_name: (r.q_0, r.q_1) for r in exact_quantiles(df, ["a", "b"], [0.25, 0.75]).collect()}
    for name, idx in (("a", 0), ("b", 1)):
        vals = np.array([r[idx] for r in rows if r[idx] is not None])
        e = np.quantile(vals, [0.25, 0.75], method="linear")
        assert abs(got[name][0] - e[0]) < 1e-9 and abs(got[name][1] - e[1]) < 1e-9


def test_approx_bounds_close_to_exact(spark):
    rnd = random.Random(2)
    df = spark.createDataFrame([(rnd.gauss(100, 15),) for _ in range(5000)], "x double")
    exact = iqr_bounds(df, ["x"]).collect()[0]
    approx = iqr_bounds(df, ["x"], exact=False).collect()[0]
    assert abs(exact.q1 - approx.q1) < 1.0 and abs(exact.q3 - approx.q3) < 1.0
