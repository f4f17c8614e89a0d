"""Operators against brute force on small fixtures, and invariants."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import drift as D
from tidemark.operators import evaluate as EV
from tidemark.operators import perturb as X
from tidemark.operators import registry as REG
from tidemark.operators import split as SP
from tidemark.operators.rank import dist_asof_next, dist_rank, unit_bucket, with_quantile_bucket
from tidemark.plans.fixtures import churn_records, scored_events
from tidemark.sources import sinks as K

from conftest import SF_SMALL


def w1_brute(a, b):
    z = np.sort(np.unique(np.concatenate([a, b])))
    fa = np.searchsorted(np.sort(a), z, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), z, side="right") / len(b)
    return float(np.sum(np.abs(fa - fb)[:-1] * np.diff(z))), float(np.max(np.abs(fa - fb)))


def test_exact_w1_and_ks_vs_brute_force(spark):
    rng = np.random.default_rng(3)
    ref = np.round(rng.normal(10, 3, 400), 1)
    groups = {"g0": np.round(rng.normal(10, 3, 150), 1),      # same distribution
              "g1": np.round(rng.normal(13, 2, 600), 1),      # shifted, large group
              "g2": np.round(rng.uniform(-5, 40, 7), 1),      # outside the reference range
              "g3": np.array([10.0] * 5)}                     # one value
    rdf = spark.createDataFrame([("x", float(v)) for v in ref], "column string, value double")
    cdf = spark.createDataFrame([(g, "x", float(v)) for g, vs in groups.items() for v in vs],
                                "g string, column string, value double")
    out = {r["g"]: r for r in D.numeric_drift(rdf, cdf, ["g"], n_buckets=8).collect()}
    for g, vs in groups.items():
        w, ks = w1_brute(ref, vs)
        assert out[g]["wasserstein"] == pytest.approx(w, rel=1e-9, abs=1e-9)
        assert out[g]["ks"] == pytest.approx(ks, abs=1e-12)
        assert out[g]["drift_score"] == pytest.approx(w / np.std(ref), rel=1e-9)


def test_drift_of_table_against_itself_is_zero(spark):
    s = scored_events(spark, SF_SMALL)
    long = D.to_long(s, [], ["value", "p"])
    cur = D.to_long(s.withColumn("g", F.lit(1)), ["g"], ["value", "p"])
    for r in D.numeric_drift(long, cur, ["g"]).collect():
        assert r["wasserstein"] == pytest.approx(0.0, abs=1e-9) and r["ks"] == pytest.approx(0.0, abs=1e-12)
    cat = D.to_long(s, [], ["event_type"], "string")
    ccat = D.to_long(s.withColumn("g", F.lit(1)), ["g"], ["event_type"], "string")
    for r in D.categorical_drift(cat, ccat, ["g"]).collect():
        assert r["jensen_shannon"] == pytest.approx(0.0, abs=1e-7) and r["chi2"] == pytest.approx(0.0, abs=1e-9)


def test_js_with_unseen_categories(spark):
    rdf = spark.createDataFrame([("c", v) for v in "aaab"], "column string, value string")
    cdf = spark.createDataFrame([(1, "c", v) for v in "bcc"], "g int, column string, value string")
    r = D.categorical_drift(rdf, cdf, ["g"]).first()
    p = np.array([0, 1 / 3, 2 / 3]); q = np.array([0.75, 0.25, 0]); m = (p + q) / 2
    kl = lambda x, y: sum(xi * np.log2(xi / yi) for xi, yi in zip(x, y) if xi > 0)
    assert r["jensen_shannon"] == pytest.approx(np.sqrt(0.5 * kl(p, m) + 0.5 * kl(q, m)), rel=1e-12)
    assert r["unseen_count"] == 2


def auc_brute(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return float(np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg]))


def test_auc_vs_brute_force_with_ties(spark):
    rng = np.random.default_rng(5)
    rows = []
    for g in range(3):
        n = [5, 40, 300][g]
        y = rng.integers(0, 2, n)
        p = np.round(rng.uniform(0, 1, n), 1)  # many ties
        rows += [(g, int(a), float(b)) for a, b in zip(y, p)]
    df = spark.createDataFrame(rows, "g int, y int, p double")
    got = {r["g"]: r["roc_auc"] for r in EV.roc_auc(df, ["g"], n_buckets=4).collect()}
    for g in range(3):
        y = np.array([r[1] for r in rows if r[0] == g]); p = np.array([r[2] for r in rows if r[0] == g])
        exp = auc_brute(y, p) if 0 < y.sum() < len(y) else None
        assert (got[g] is None and exp is None) or got[g] == pytest.approx(exp, rel=1e-12)


def test_dist_rank_equals_row_number(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("k"),
                                  F.rand(7).alias("u"))
    r = dist_rank(df, ["k"], ["u", "id"], unit_bucket("u", 16), "r")
    w = Window.partitionBy("k").orderBy("u", "id")
    bad = r.withColumn("rn", F.row_number().over(w)).filter(F.col("r") != F.col("rn")).count()
    assert bad == 0


def test_quantile_bucket_rank_on_skewed_key(spark):
    # one key holds most rows; ids are sparse and clustered
    df = spark.range(3000).select((F.col("id") * F.col("id")).alias("id"),
                                  F.when(F.col("id") < 2500, 0).otherwise(1).alias("k"))
    b = with_quantile_bucket(df, ["k"], "id", 10, name="b")
    r = dist_rank(b, ["k"], ["id"], "b", "r")
    w = Window.partitionBy("k").orderBy("id")
    assert r.withColumn("rn", F.row_number().over(w)).filter(F.col("r") != F.col("rn")).count() == 0
    sizes = [x["n"] for x in b.groupBy("k", "b").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) <= 2500 / 10 * 1.5


def test_asof_next(spark):
    rows = [(0, float(v), 1, v * 10) for v in (1, 4, 9)] + [(0, float(v), 0, None) for v in (0, 1, 2, 5, 9)]
    df = spark.createDataFrame(rows, "p int, key double, side int, payload long")
    out = dist_asof_next(df, ["p"], ["key", "side"], F.floor(F.col("key") / 3), F.col("side") == 1, ["payload"])
    got = sorted((r["key"], r["_next_payload"]) for r in out.filter("side = 0").collect())
    assert got == [(0.0, 10), (1.0, 10), (2.0, 40), (5.0, 90), (9.0, 90)]


def test_folds_partition_and_balance(spark):
    r = churn_records(spark, SF_SMALL)
    f = SP.stratified_folds(r, "churn")
    assert f.count() == r.count() and f.select("id").distinct().count() == r.count()
    sizes = f.groupBy("churn", "fold").count().groupBy("churn").agg(
        (F.max("count") - F.min("count")).alias("d")).collect()
    assert all(x["d"] <= 1 for x in sizes)


def test_stratified_split_keeps_class_share(spark):
    r = churn_records(spark, SF_SMALL)
    s = SP.stratified_split(r, "churn", 0.2)
    per = s.groupBy("churn").agg(F.count("*").alias("n"),
                                 F.sum((F.col("split") == "reference").cast("int")).alias("k")).collect()
    for x in per:
        assert x["k"] == round(0.2 * x["n"])


def test_scores_in_unit_interval(spark):
    s = scored_events(spark, SF_SMALL)
    assert s.filter((F.col("p") < 0) | (F.col("p") > 1)).count() == 0


def test_zero_intensity_leaves_table_unchanged(spark):
    s = scored_events(spark, SF_SMALL).withColumn("i", F.lit(0.0)).withColumn("w", F.lit(1))
    t = s.select("id", X.shift_numeric("value", 5.0, F.col("i")).alias("value"),
                 X.swap_category("event_type", ["a", "b"], F.col("i")).alias("event_type"),
                 X.flip_binary("w", F.col("i")).alias("w"),
                 X.blank_cells("value", F.col("i"), 0.5).alias("v2"))
    assert t.subtract(s.select("id", "value", "event_type", "w", F.col("value").alias("v2"))).count() == 0


def test_intensity_modes(spark):
    df = spark.range(10).select(F.col("id").cast("int").alias("b"))
    got = df.select("b", X.intensity("b", "gradual", start=2, ramp=4).alias("g"),
                    X.intensity("b", "cycle", start=0, period=4).alias("c"),
                    X.intensity("b", "bogus").alias("z")).orderBy("b").collect()
    assert [r["g"] for r in got] == [0, 0, 0.25, 0.5, 0.75, 1, 1, 1, 1, 1]
    assert [r["c"] for r in got] == [0, 0, 1, 1, 0, 0, 1, 1, 0, 0]
    assert all(r["z"] == 0 for r in got)


def test_replayed_append_is_deduped(spark, tmp_path):
    m = spark.createDataFrame([("s", 0, 1.0), ("s", 1, 2.0)], "data_source string, batch_id int, v double")
    path = str(tmp_path / "mm")
    for _ in range(2):
        K.append_metrics(m.withColumn("written_at", F.current_timestamp()), path, "r1")
    raw = spark.read.parquet(path)
    assert raw.count() == 4
    assert K.latest_per_key(raw).count() == 2


@pytest.mark.parametrize("champ,new,exp", [(None, 0.7, True), (0.7, 0.8, True), (0.8, 0.8, False),
                                           (0.8, 0.7, False)])
def test_promotion_truth_table(champ, new, exp):
    assert REG.should_promote(champ, new) is exp


def test_promotion_history(spark):
    v = spark.createDataFrame([("m", 1, None), ("m", 2, 0.7), ("m", 3, None), ("m", 4, 0.7), ("m", 5, 0.75)],
                              "name string, version int, auc double")
    got = [r["promoted"] for r in REG.promotion_history(v).orderBy("version").collect()]
    assert got == [True, True, False, False, True]


def test_pvalues_known_values(spark):
    from tidemark.functions.stats import chi2_pvalue, ks_pvalue
    df = spark.createDataFrame([(3.841458820694124, 1.0), (5.991464547107979, 2.0), (0.0, 3.0), (30.0, 10.0)],
                               "s double, d double")
    got = [r[0] for r in df.select(chi2_pvalue("s", "d")).collect()]
    assert got[0] == pytest.approx(0.05, abs=1e-9) and got[1] == pytest.approx(0.05, abs=1e-9)
    assert got[2] == 1.0 and got[3] == pytest.approx(0.000855, abs=1e-5)
    k = spark.createDataFrame([(0.0, 100.0, 100.0), (0.5, 100.0, 100.0)], "d double, n double, m double")
    kp = [r[0] for r in k.select(ks_pvalue("d", "n", "m")).collect()]
    assert kp[0] == 1.0 and kp[1] < 1e-9


def test_approx_median_close(spark):
    from tidemark.operators import profile as PR
    s = scored_events(spark, SF_SMALL)
    ex = {x["data_source"]: x["median"] for x in PR.score_summary(s, "p", ["data_source"]).collect()}
    ap = {x["data_source"]: x["median"] for x in PR.score_summary(s, "p", ["data_source"], approx=True).collect()}
    for k in ex:
        assert ap[k] == pytest.approx(ex[k], abs=0.01)


def test_null_keys_are_ranked_not_dropped(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 1.0)], "k string, x double")
    r = dist_rank(df, ["k"], ["x"], unit_bucket(F.col("x") / 4, 4), "r")
    got = sorted((row["k"] or "", row["r"]) for row in r.collect())
    assert got == [("", 1), ("", 2), ("a", 1)]


def test_null_label_rows_kept_in_folds(spark):
    df = spark.range(20).select("id", F.when(F.col("id") < 5, None).otherwise(F.col("id") % 2).alias("y"))
    f = SP.stratified_folds(df, "y", k=5)
    assert f.count() == 20 and f.filter(F.col("y").isNull()).count() == 5


def test_psi_quantile_bins(spark):
    s = scored_events(spark, SF_SMALL)
    long = D.to_long(s, [], ["value"])
    same = D.to_long(s.withColumn("g", F.lit(1)), ["g"], ["value"])
    shifted = D.to_long(s.withColumn("g", F.lit(2)).withColumn("value", F.col("value") + 40), ["g"], ["value"])
    out = {r["g"]: r["psi"] for r in D.psi(long, same.unionByName(shifted), ["g"], binning="quantile").collect()}
    assert out[1] == pytest.approx(0.0, abs=1e-12) and out[2] > 0.5
