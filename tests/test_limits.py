"""Behaviour at sizes and values where earlier versions switched, refused or drifted."""

import math
import os
import subprocess
import sys

import numpy as np
import pytest

from pyspark.sql import functions as F

from tidemark.functions.columns import lenient_double
from tidemark.operators import drift as D
from tidemark.operators import evaluate as EV
from tidemark.operators import features as FE
from tidemark.operators import profile as PR
from tidemark.operators import registry as REG
from tidemark.operators import validate as V
from tidemark.operators.joins import join_keys

from conftest import ROOT


@pytest.mark.parametrize("n_cols", [3, 70])
def test_correlation_is_pairwise_at_any_width(spark, n_cols):
    rng = np.random.default_rng(n_cols)
    x = rng.normal(size=(400, n_cols)) + 1e6
    x[:, 1] += x[:, 0]
    x[rng.random(x.shape) < 0.1] = np.nan
    rows = [[None if math.isnan(v) else float(v) for v in r] for r in x]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(n_cols))).repartition(3)
    got = {(r["a"], r["b"]): r["corr"] for r in PR.correlation(df, df.columns).collect()}
    assert len(got) == n_cols * n_cols
    for a in range(n_cols):
        for b in range(0, n_cols, 7):
            both = ~np.isnan(x[:, a]) & ~np.isnan(x[:, b])
            want = 1.0 if a == b else np.corrcoef(x[both, a], x[both, b])[0, 1]
            assert got[(f"c{a}", f"c{b}")] == pytest.approx(want, abs=1e-9)


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (None, 4.0)], "a double, b double")
    assert {r["corr"] for r in PR.correlation(df, ["a", "b"]).filter("a <> b").collect()} == {None}


def test_medians_of_many_groups_and_of_ties(spark):
    df = spark.range(60000).select((F.col("id") % 20000).alias("g"), ((F.col("id") * 7919) % 101).cast("double").alias("x"))
    got = {r["g"]: r["median"] for r in PR.score_summary(df, "x", ["g"]).collect()}
    assert len(got) == 20000
    for g in (0, 1, 777, 19999):
        assert got[g] == float(np.median([(i * 7919) % 101 for i in (g, g + 20000, g + 40000)]))
    flags = spark.range(999).select((F.col("id") % 3 > 0).cast("int").alias("x"))
    assert PR.exact_median(flags, "x").first()[0] == 1.0


def test_density_of_a_class_narrower_than_a_bin(spark):
    import duckdb
    rng = np.random.default_rng(3)
    rows = [("narrow", float(x)) for x in np.abs(rng.normal(size=4000))] + [("wide", float(x)) for x in rng.uniform(0, 20000, 300)]
    got = {(r["k"], r["gi"]): r["density"] for r in PR.density(spark.createDataFrame(rows, "k string, v double"), "v", "k", grid_points=50).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (k VARCHAR, v DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    want = con.execute("""WITH s AS (SELECT min(v) AS lo, max(v) AS hi FROM t), c AS (SELECT k, count(*) AS n, stddev_samp(v) * pow(count(*), -0.2) AS h FROM t GROUP BY k),
        g AS (SELECT range AS gi, lo + range * (hi - lo) / 49 AS g FROM range(50), s)
        SELECT k, gi, any_value(h), sum(exp(-0.5 * pow((g - v) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())) FROM t JOIN c USING (k), g GROUP BY k, gi""").fetchall()
    assert len(got) == len(want) == 100
    for k, gi, h, d in want:
        assert abs(got[k, gi] - d) < 0.0152 / h


def test_many_categories(spark):
    df = spark.range(5000).select(F.concat(F.lit("v"), "id").alias("c"))
    assert len(FE.fit_categories(df, ["c"])["c"]) == 5000
    with pytest.raises(ValueError):
        FE.fit_categories(df, ["c"], max_categories=100)


@pytest.mark.parametrize("offset", [0.0, 1e9, 1e12])
@pytest.mark.parametrize("bounded", [False, True])
def test_w1_keeps_its_digits_away_from_zero(spark, offset, bounded):
    rng = np.random.default_rng(1)
    ref, cur = rng.normal(size=500) + offset, rng.normal(size=300) + 0.3 + offset
    long = lambda v, g: spark.createDataFrame([(g, "x", float(t)) for t in v], "g int, column string, value double")
    got = D.numeric_drift(long(ref, 0).drop("g"), long(cur, 1), ["g"], bounded=bounded).first()
    grid = np.sort(np.concatenate((ref, cur)))
    f = np.searchsorted(np.sort(ref), grid[:-1], side="right") / len(ref)
    c = np.searchsorted(np.sort(cur), grid[:-1], side="right") / len(cur)
    want = float(np.sum(np.abs(f - c) * np.diff(grid)))
    assert got["wasserstein"] == pytest.approx(want, rel=1e-9)
    assert got["ks"] == pytest.approx(float(np.abs(f - c).max()), rel=1e-12)


def test_odd_numbers(spark):
    rows = [("NaN",), ("1d",), ("1f",), ("2.5F",), ("0x1p3",), ("",), (" ",), (None,), (" 3.5 ",), ("1e3",), ("x",)]
    got = [r[0] for r in spark.createDataFrame(rows, "c string").select(lenient_double("c")).collect()]
    assert got == [0.0] * 8 + [3.5, 1000.0, 0.0]
    df = spark.createDataFrame([(float("nan"),), (1.0,), (-1.0,), (None,)], "c double")
    errors = [r["errors"] for r in V.check(df, [V.range_rule("c", ge=0), V.required_rule("c", "double")]).collect()]
    assert errors == ["c:range;c:required", "", "c:range", "c:required"]


def test_rows_without_a_score_do_not_move_auc(spark):
    rows = [(1, 0.9), (1, 0.8), (0, 0.1), (0, 0.2)]
    odd = [(0, None), (0, None), (0, float("nan")), (None, 0.5)]
    df = spark.createDataFrame(rows + odd, "y int, p double")
    for bounded in (False, True):
        r = EV.classification_metrics(df, bounded=bounded).first()
        assert r["roc_auc"] == 1.0 and r["n_labelled"] == 4 and r["n_unscored"] == 3
        assert r["tp"] + r["fp"] + r["fn"] + r["tn"] == 4 and r["accuracy"] == 1.0
        assert r["mean_score"] == pytest.approx(0.5)


def test_crowded_scores_are_spread_over_buckets(spark):
    df = spark.range(4000).select((F.col("id") % 2).cast("int").alias("y"), (F.col("id") / 1e6).alias("p"))
    counts = EV.score_counts(df, [], "y", "p", n_buckets=16)
    assert counts.agg(F.max("cum_neg"), F.max("cum_pos")).first() == (2000, 2000)
    from tidemark.operators.rank import with_quantile_bucket
    assert with_quantile_bucket(df, [], "p", 16).groupBy("_bkt").count().agg(F.max("count")).first()[0] < 600


def test_best_trial_and_promotion_ignore_nan(spark):
    t = spark.createDataFrame([("s", "f", 0, "a", float("nan")), ("s", "f", 1, "b", 0.7), ("s", "f", 2, "c", None)], REG.TRIALS_SCHEMA)
    assert REG.best_trial(t).first()["number"] == 1
    assert not REG.should_promote(0.5, float("nan")) and REG.should_promote(float("nan"), 0.5)


def test_registry_raises_on_anything_but_a_missing_table(spark, tmp_path):
    assert REG._read(spark, str(tmp_path / "none"), REG.TRIALS_SCHEMA).count() == 0
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "part-0.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):
        REG._read(spark, str(bad), REG.TRIALS_SCHEMA).count()


def test_join_needs_keys(spark):
    with pytest.raises(ValueError):
        join_keys(spark.range(2), spark.range(2), [])


def test_session_without_checkpoint_setting(tmp_path):
    (tmp_path / "conf").mkdir()
    code = ("from tidemark.session import *\n"
            "from tidemark.session import clear_scratch, scratch_folder\n"
            "from tidemark.operators.materialize import materialize\n"
            "import os\n"
            "s = get_session('local[1]')\n"
            "assert materialize(s.range(3)).count() == 3\n"
            "f = scratch_folder(s)\n"
            "assert os.path.isdir(f)\n"
            "clear_scratch(s)\n"
            "assert not os.path.exists(f)\n"
            "s.stop()\nprint('fine')\n")
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path / "conf"), "PYTHONPATH": ROOT}
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, env=env, timeout=200, cwd=tmp_path)
    assert "fine" in out.stdout, out.stderr[-2000:]
