"""Property tests for the distributed rank and quantile algorithms."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martforge.operators.keys import with_global_rank
from martforge.operators.outliers import exact_quantiles

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


@SETTINGS
@given(st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=300),
       st.integers(min_value=1, max_value=9))
def test_weighted_rank_equals_cumulative_sum(spark, values, parts):
    counts = {}
    for v in values:
        counts[v] = counts.get(v, 0) + 1
    df = spark.createDataFrame([(float(k), c) for k, c in counts.items()], "v double, c long")
    got = {r.v: r.cum for r in with_global_rank(df, ["v"], "cum", weight=F.col("c"),
                                                num_partitions=parts).collect()}
    running, expect = 0, {}
    for k in sorted(counts):
        running += counts[k]
        expect[float(k)] = running
    assert got == expect


@SETTINGS
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=400),
       st.sampled_from([[0.25, 0.75], [0.0, 0.5, 1.0], [0.1, 0.9]]))
def test_exact_quantiles_equal_numpy(spark, values, probs):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    row = exact_quantiles(df, ["x"], probs).collect()[0]
    expect = np.quantile(np.array(values), probs, method="linear")
    for i, e in enumerate(expect):
        assert abs(row[f"q_{i}"] - e) <= 1e-9 * max(1.0, abs(e))
