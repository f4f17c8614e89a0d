"""Drift on the reference grid: bounds, merging, odd values, streams with late rows."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import grid as GR
from tidemark.session import scratch_path
from tidemark.streaming import drift as SD
from tidemark.streaming import jobs as ST


def exact_w1_ks(r, c):
    z = np.unique(np.concatenate([r, c]))
    fr = np.searchsorted(np.sort(r), z, side="right") / len(r)
    fc = np.searchsorted(np.sort(c), z, side="right") / len(c)
    return float((np.abs(fr - fc)[:-1] * np.diff(z)).sum()), float(np.abs(fr - fc).max())


def exact_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return ((pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean()) if len(pos) and len(neg) else None


def frames(spark, seed):
    rng = np.random.default_rng(seed)
    ref = [(float(v), float(np.round(1 / (1 + math.exp(-v)), 2)), str(rng.integers(0, 4))) for v in np.round(rng.normal(size=700), 2)]
    cur, groups = [], {"same": (0, 1), "shift": (0.5, 1), "wide": (0, 3), "far": (40, 0.1), "one": (0.1, 0)}
    for g, (m, s) in groups.items():
        for i, v in enumerate(np.round(rng.normal(m, s, size=1 if g == "one" else 150), 2)):
            cur.append((g, float(v) if i % 9 else (None if i % 2 else float("nan")), float(1 / (1 + math.exp(-v))), str(rng.integers(0, 5)) if i % 7 else None,
                        int(rng.integers(0, 2)) if g != "far" and i % 5 else None))
    r = spark.createDataFrame(ref, "value double, p double, kind string")
    c = spark.createDataFrame(cur, "g string, value double, p double, kind string, y int")
    return ref, cur, r, c


@pytest.mark.parametrize("points", [1, 4, 16, 256])
def test_bounds_hold_exact_statistics(spark, points):
    ref, cur, r, c = frames(spark, points)
    grid = GR.build_grid(r, ["value", "p"], ["kind"], points)
    counts = GR.slot_counts(GR.slot_rows(c, grid.edges, grid.categorical, ["g"], "y", "p"), ["g"])
    rows = {(x.g, x.column): x for x in GR.numeric_grid_drift(counts, ["g"], grid).collect()}
    assert set(rows) == {(g, k) for g in ("same", "shift", "wide", "far") for k in ("value", "p")} | {("one", "p")}
    for (g, k), x in rows.items():
        i = 0 if k == "value" else 1
        have = np.array([row[1 + i] for row in cur if row[0] == g and row[1 + i] is not None and row[1 + i] == row[1 + i]])
        w1, ks = exact_w1_ks(np.array([row[i] for row in ref]), have)
        assert x.cur_n == len(have)
        assert x.wasserstein - 1e-9 <= w1 <= x.wasserstein + x.wasserstein_error + 1e-9
        assert x.ks - 1e-9 <= ks <= x.ks + x.ks_error + 1e-9
        if k == "p":
            lab = [row for row in cur if row[0] == g and row[4] is not None]
            auc = exact_auc(np.array([row[4] for row in lab]), np.array([row[2] for row in lab]))
            assert (auc is None) == (x.auc_low is None) and (auc is None or x.auc_low - 1e-9 <= auc <= x.auc_high + 1e-9)
        if points == 256 and g != "far":
            assert x.wasserstein_error < 0.05 * np.std([row[i] for row in ref])


def test_counts_of_parts_add_up(spark):
    _, _, r, c = frames(spark, 7)
    grid = GR.build_grid(r, ["value", "p"], ["kind"])
    part = F.pmod(F.xxhash64("value", "kind"), F.lit(3))
    whole = GR.slot_counts(GR.slot_rows(c, grid.edges, grid.categorical, ["g"], "y", "p"), ["g"])
    parts = [GR.slot_counts(GR.slot_rows(c.filter(part == i), grid.edges, grid.categorical, ["g"], "y", "p"), ["g"]) for i in range(3)]
    merged = GR.slot_counts(parts[0].unionAll(parts[1]).unionAll(parts[2]), ["g"])
    a = {tuple(x)[:4]: tuple(x)[4:] for x in whole.collect()}
    b = {tuple(x)[:4]: tuple(x)[4:] for x in merged.collect()}
    assert a.keys() == b.keys() and all(v == pytest.approx(b[k]) for k, v in a.items())


def test_metrics_count_missing_and_labels(spark):
    _, cur, r, c = frames(spark, 3)
    grid = GR.build_grid(r.withColumn("y", F.lit(1)), ["value", "p"], ["kind", "y"])
    counts = GR.slot_counts(GR.slot_rows(c, grid.edges, grid.categorical, ["g"], "y", "p"), ["g"])
    for x in GR.grid_metrics(counts, ["g"], grid, "p", "y").collect():
        rows = [row for row in cur if row[0] == x.g]
        lab = [row for row in rows if row[4] is not None]
        assert (x.n, x.n_labelled) == (len(rows), len(lab))
        missing = sum((row[1] is None or row[1] != row[1]) + (row[3] is None) + (row[4] is None and bool(lab)) for row in rows)
        assert x.share_missing_values == pytest.approx(missing / (len(rows) * (3 + bool(lab))))
        if lab:
            assert x.accuracy == pytest.approx(np.mean([row[4] == (row[2] >= 0.5) for row in lab]))
            assert x.churn_rate == pytest.approx(np.mean([row[4] for row in lab]))
        else:
            assert x.accuracy is None and x.log_loss is None and x.auc_low is None


def test_columns_without_values_and_empty_tables(spark):
    schema = "g string, value double, p double, kind string"
    ref = spark.createDataFrame([("r", None, 0.5, None), ("r", float("nan"), 0.5, None)], schema)
    grid = GR.build_grid(ref, ["value", "p"], ["kind"])
    assert grid.edges == {"value": [], "p": [0.5]}
    cur = spark.createDataFrame([("a", 1.0, 0.5, "x"), ("a", None, 0.7, None)], schema)
    counts = GR.slot_counts(GR.slot_rows(cur, grid.edges, grid.categorical, ["g"]), ["g"])
    rows = GR.numeric_grid_drift(counts, ["g"], grid).collect()
    assert [(x.column, round(x.wasserstein, 12)) for x in rows] == [("p", 0.1)]  # constant reference: distance to its value, std 1
    none = GR.slot_counts(GR.slot_rows(cur.limit(0), grid.edges, grid.categorical, ["g"]), ["g"])
    assert GR.grid_metrics(none, ["g"], grid, "p").collect() == []


def test_few_jobs(spark):
    """A written grid and one aggregate: at most ten jobs for the drift of all groups."""
    _, _, r, c = frames(spark, 5)
    grid = GR.build_grid(r, ["value", "p"], ["kind"])
    sc = spark.sparkContext
    sc.setJobGroup("grid-drift", "count jobs")
    counts = GR.slot_counts(GR.slot_rows(c, grid.edges, (), ["g"], "y", "p"), ["g"])
    GR.numeric_grid_drift(counts, ["g"], grid).write.format("noop").mode("overwrite").save()
    assert len(sc.statusTracker().getJobIdsForGroup("grid-drift")) <= 10
    sc.setJobGroup("other", "")


SCHEMA = "ts timestamp, data_source string, value double, p double, kind string, y int"


def test_stream_windows_equal_batch_and_late_rows_are_dropped(spark):
    rng = random.Random(1)
    start = dt.datetime(2024, 1, 1)
    row = lambda h: (start + dt.timedelta(hours=h), rng.choice("ab"), rng.gauss(0, 1), rng.random(), rng.choice("xyz"), rng.choice([0, 1, None]))
    ref = spark.createDataFrame([row(0) for _ in range(300)], SCHEMA)
    grid = GR.build_grid(ref, ["value", "p"], ["kind"])
    files = [[row(rng.uniform(0, 24)) for _ in range(80)], [row(rng.uniform(20, 60)) for _ in range(80)], [row(80)],
             [row(2), row(70), row(73), row(100)], [row(200)]]  # hours 2 and 70: their windows are closed at hour 79; hour 73 is in time
    src = scratch_path(spark, "late_src")
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        out, ck = f"{src}_counts", f"{src}_ck"
        SD.run_window_drift(ST.file_stream(spark, src, SCHEMA), grid, out, ck)  # each call resumes from the checkpoint
    kept = [r for i, f in enumerate(files) for r in f if not (i == 3 and r[0] < start + dt.timedelta(hours=72))]
    batch = SD.window_counts(spark.createDataFrame(kept, SCHEMA), grid, watermark=None).filter(F.col("window_end") <= F.lit(start + dt.timedelta(hours=192)))
    a = {tuple(x)[:6]: tuple(x)[6:] for x in spark.read.parquet(out).collect()}
    b = {tuple(x)[:6]: tuple(x)[6:] for x in batch.collect()}
    assert a.keys() == b.keys() and all(v == pytest.approx(b[k]) for k, v in a.items())
    m = SD.read_window_metrics(spark, out, grid, target=None)
    assert m.count() == batch.select("window_start", "data_source").distinct().count()
