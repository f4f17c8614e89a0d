"""p-values as column expressions against the standard library and direct sums."""

import math

import pytest

from tidemark.functions.stats import chi2_pvalue, erfc, ks_pvalue
from tidemark.operators import drift as D


def chi2_tail(x, k):
    """Direct sums in extended steps (k whole)."""
    y = x / 2
    if k % 2 == 0:
        return sum(math.exp(i * math.log(y) - y - math.lgamma(i + 1)) for i in range(k // 2))
    return math.erfc(math.sqrt(y)) + sum(math.exp((i - 0.5) * math.log(y) - y - math.lgamma(i + 0.5)) for i in range(1, (k - 1) // 2 + 1))


def test_erfc(spark):
    z = [i / 7 for i in range(0, 100)]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in z], "z double").select(erfc("z")).collect()]
    assert all(g == pytest.approx(math.erfc(x), rel=1e-9, abs=1e-300) for g, x in zip(got, z))


def test_chi2(spark):
    rows = [(x, k) for x in (1e-6, 0.3, 1.0, 3.841458820694124, 7.0, 25.0, 200.0, 1400.0) for k in (1, 2, 3, 4, 7, 40, 151, 1500)]
    got = [r[0] for r in spark.createDataFrame(rows, "s double, d long").select(chi2_pvalue("s", "d")).collect()]
    for (x, k), g in zip(rows, got):
        assert g == pytest.approx(min(1.0, chi2_tail(x, k)), rel=1e-8, abs=1e-250), (x, k)
    odd = [(0.0, 3), (-1.0, 3), (None, 3), (float("nan"), 3), (float("inf"), 3), (1.0, 0), (1.0, None)]
    got = [r[0] for r in spark.createDataFrame(odd, "s double, d long").select(chi2_pvalue("s", "d")).collect()]
    assert got[:2] == [1.0, 1.0] and all(math.isnan(g) for g in got[2:])


def test_ks(spark):
    rows = [(d, n, m) for d in (0.0, 1e-4, 0.01, 0.05, 0.2, 0.9) for n, m in ((10, 10), (1000, 33_000), (1_000_000_000, 1000))]
    got = [r[0] for r in spark.createDataFrame(rows, "d double, n long, m long").select(ks_pvalue("d", "n", "m")).collect()]
    for (d, n, m), g in zip(rows, got):
        en = math.sqrt(n * m / (n + m))
        lam = (en + 0.12 + 0.11 / en) * d
        want = 1.0 if lam < 0.1 else min(1.0, max(0.0, sum(2 * (-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 500))))
        assert g == pytest.approx(want, abs=1e-9)


def test_no_python_worker(spark):
    df = spark.createDataFrame([(0.1, 10, 20, 3.0, 2)], "ks double, ref_n long, cur_n long, s double, d long")
    plan = df.select(ks_pvalue("ks", "ref_n", "cur_n"), chi2_pvalue("s", "d"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_homogeneity_is_symmetric_and_counts_unseen(spark):
    a = ["x"] * 30 + ["y"] * 10 + ["only_a"] * 5
    b = ["x"] * 12 + ["y"] * 20 + ["only_b"] * 3

    def stat(ref, cur):
        r = spark.createDataFrame([("c", v) for v in ref], "column string, value string")
        c = spark.createDataFrame([(1, "c", v) for v in cur], "g int, column string, value string")
        return D.categorical_drift(r, c, ["g"]).first()

    one, two = stat(a, b), stat(b, a)
    want = 0.0
    for v in set(a) | set(b):
        for s in (a, b):
            e = len(s) * (a.count(v) + b.count(v)) / (len(a) + len(b))
            want += (s.count(v) - e) ** 2 / e
    assert one.homogeneity == pytest.approx(want) and two.homogeneity == pytest.approx(want)
    assert one.homogeneity_df == two.homogeneity_df == 3
    assert stat(a, a).homogeneity == pytest.approx(0.0, abs=1e-12)


def test_shift_parses_like_the_features(spark):
    """Odd numbers count as 0 before a shift, as everywhere else: the noise alone is left."""
    from pyspark.sql import functions as F

    from tidemark.operators import perturb as X
    df = spark.createDataFrame([(1, "1d"), (2, "NaN"), (3, "0x1p3"), (4, "0"), (5, None)], "id long, c string")
    zero = df.withColumn("c", F.lit("0"))
    one, two = ({r.id: r.v for r in d.select("id", X.shift_numeric("c", 1.0, F.lit(0.5)).alias("v")).collect()} for d in (df, zero))
    assert one == two
