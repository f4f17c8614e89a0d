"""Property tests: the distributed prefix sum equals a plain window for any
key skew, bucket count and tie pattern."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.rank import dist_cumsum, with_quantile_bucket

rows_strategy = st.lists(
    st.tuples(st.sampled_from([0, 0, 0, 1, 2]),           # skewed keys
              st.integers(min_value=-5, max_value=5),       # many ties in the sort key
              st.integers(min_value=0, max_value=9)),
    min_size=1, max_size=120)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, buckets=st.integers(min_value=1, max_value=9))
def test_dist_cumsum_equals_window(spark, rows, buckets):
    data = [(i, k, float(x), v) for i, (k, x, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, k int, x double, v long")
    b = with_quantile_bucket(df, ["k"], "x", buckets, name="qb")
    got = dist_cumsum(b, ["k"], ["x", "id"], "qb", {"c": "v"})
    w = Window.partitionBy("k").orderBy("x", "id").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.withColumn("e", F.sum("v").over(w))
    bad = got.join(exp, "id").filter(F.col("c") != F.col("e")).count()
    assert bad == 0
    assert got.count() == len(data)


asof_strategy = st.lists(st.tuples(st.sampled_from([0, 0, 1]), st.integers(min_value=0, max_value=12),
                                   st.booleans()), min_size=1, max_size=80)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=asof_strategy, width=st.integers(min_value=1, max_value=5))
def test_asof_next_equals_brute_force(spark, rows, width):
    from tidemark.operators.rank import dist_asof_next
    data = [(i, k, float(x), 1 if t else 0, i if t else None) for i, (k, x, t) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, k int, key double, side int, payload long")
    out = dist_asof_next(df, ["k"], ["key", "side", "id"], F.floor(F.col("key") / width),
                         F.col("side") == 1, ["payload"])
    got = {r["id"]: r["_next_payload"] for r in out.collect()}
    order = sorted(data, key=lambda r: (r[1], r[2], r[3], r[0]))
    for i, r in enumerate(order):
        nxt = next((s[4] for s in order[i:] if s[1] == r[1] and s[3] == 1), None)
        assert got[r[0]] == nxt


vals = st.lists(st.integers(min_value=-6, max_value=6), min_size=1, max_size=40)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ref=vals, g1=vals, g2=vals)
def test_exact_w1_ks_property(spark, ref, g1, g2):
    import numpy as np
    import pytest

    from tidemark.operators import drift as D

    def brute(a, b):
        a, b = np.array(a, float), np.array(b, float)
        z = np.unique(np.concatenate([a, b]))
        fa = np.searchsorted(np.sort(a), z, side="right") / len(a)
        fb = np.searchsorted(np.sort(b), z, side="right") / len(b)
        return float(np.sum(np.abs(fa - fb)[:-1] * np.diff(z))), float(np.max(np.abs(fa - fb)))

    rdf = spark.createDataFrame([("x", float(v) / 2) for v in ref], "column string, value double")
    cdf = spark.createDataFrame([(g, "x", float(v) / 2) for g, vs in ((1, g1), (2, g2)) for v in vs],
                                "g int, column string, value double")
    out = {r["g"]: r for r in D.numeric_drift(rdf, cdf, ["g"], n_buckets=3).collect()}
    for g, vs in ((1, g1), (2, g2)):
        w, ks = brute([v / 2 for v in ref], [v / 2 for v in vs])
        assert out[g]["wasserstein"] == pytest.approx(w, abs=1e-9)
        assert out[g]["ks"] == pytest.approx(ks, abs=1e-12)
