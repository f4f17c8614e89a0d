"""End-to-end training and scoring on the customer-record format."""

import json
import random

import pytest

from pyspark.sql import functions as F

from tidemark.operators import customer_record as SC
from tidemark.plans import customer as C

HEADER = ["id", "gender"] + [n for n, _ in SC.FIELDS] + ["Churn"]


def _record(rng, i, label=True):
    r = {"id": i, "gender": rng.choice(["Male", "Female"]), "SeniorCitizen": rng.choice([0, 1]),
         "tenure": rng.randint(0, 72), "MonthlyCharges": round(rng.uniform(18, 120), 2)}
    for c, vals in SC.ENUMS.items():
        r[c] = rng.choice(vals)
    r["TotalCharges"] = "" if i % 50 == 0 else round(r["tenure"] * r["MonthlyCharges"], 2)
    if label:
        p = 0.7 if r["Contract"] == "Month-to-month" else 0.15
        r["Churn"] = "Yes" if rng.random() < p else "No"
    return r


def _write(path, rows, label=True):
    cols = HEADER if label else HEADER[:-1]
    with open(path, "w") as f:
        f.write(",".join(cols) + "\n")
        for r in rows:
            f.write(",".join(f'"{r[c]}"' for c in cols) + "\n")


def test_train_and_score(spark, tmp_path):
    rng = random.Random(1)
    train = [_record(rng, i) for i in range(300)]
    train[5]["Contract"] = "month"  # quarantined
    test = [_record(rng, 1000 + i, label=False) for i in range(40)]
    _write(tmp_path / "train.csv", train)
    _write(tmp_path / "test.csv", test, label=False)
    res = C.train(spark, str(tmp_path / "train.csv"), str(tmp_path / "test.csv"), str(tmp_path / "out"),
                  params={"boost": {"maxIter": 5}, "forest": {"numTrees": 5}})
    assert [r["id"] for r in res["quarantine"].collect()] == [5]
    assert res["fold_metrics"].filter("metric = 'auc'").count() == 10
    assert res["ensemble_auc"] > 0.6  # the label depends on the contract
    assert res["version"] == 1 and res["promoted"]
    sub = spark.read.option("header", True).csv(res["submission"])
    assert sub.count() == 40
    recs = C.load_customers(spark, str(tmp_path / "test.csv"), with_label=False)
    preds, bad = C.score(recs, res["models"])
    assert preds.count() == 40 and bad.count() == 0
    assert preds.filter((F.col("churn_probability") < 0) | (F.col("churn_probability") > 1)).count() == 0

    # the same scoring as a stream of JSON record files, one bad record quarantined
    src = tmp_path / "in"
    src.mkdir()
    for j in range(2):
        recs = [{k: v for k, v in _record(rng, 5000 + 10 * j + i, label=False).items() if k != "gender"}
                for i in range(10)]
        for r in recs:
            r["TotalCharges"] = float(r["TotalCharges"] or 0.0)
        if j == 1:
            recs[0]["tenure"] = -3
        (src / f"b{j}.json").write_text("\n".join(json.dumps(r) for r in recs))
    out, bad_out = str(tmp_path / "scores"), str(tmp_path / "bad")
    C.score_stream(spark, str(src), res["models"], out, bad_out, str(tmp_path / "ck"), max_files_per_trigger=1)
    assert spark.read.parquet(out).count() == 19
    assert [r["errors"] for r in spark.read.parquet(bad_out).collect()] == ["tenure:range"]

    # monitoring replay with gradual drift against a stratified reference
    m = C.monitor(spark, str(tmp_path / "train.csv"), str(tmp_path / "test.csv"), res["models"],
                  str(tmp_path / "mm"), "run-1", mode="gradual", batch_size=60, missing_rate=0.2)
    rows = m.orderBy("data_source", "batch_id").collect()
    hold = [r for r in rows if r["data_source"] == "train_holdout"]
    test = [r for r in rows if r["data_source"] == "test"]
    assert len(test) == 1 and test[0]["accuracy"] is None and test[0]["roc_auc"] is None
    assert all(r["accuracy"] is not None for r in hold) and len(hold) >= 3
    # gradual ramp over 5 batches, numbered across pools (labelled pool first)
    assert [r["drift_intensity"] for r in hold] == pytest.approx([min(1.0, (i + 1) / 5) for i in range(len(hold))])
    assert test[0]["drift_intensity"] == pytest.approx(min(1.0, (len(hold) + 1) / 5))
    assert max(r["share_missing_values"] for r in rows) > 0


def test_a_second_run_leaves_the_champion_alone(spark, tmp_path):
    rng = random.Random(2)
    _write(tmp_path / "train.csv", [_record(rng, i) for i in range(400)])
    _write(tmp_path / "test.csv", [_record(rng, 900 + i, label=False) for i in range(20)], label=False)
    noise = [{**_record(rng, i), "Churn": "Yes" if i % 2 else "No"} for i in range(400)]  # labels without a cause
    _write(tmp_path / "noise.csv", noise)
    out, test = str(tmp_path / "out"), str(tmp_path / "test.csv")
    small = {"boost": {"maxIter": 5}, "forest": {"numTrees": 10}}
    recs = C.load_customers(spark, test, with_label=False)

    def champion_scores():
        models, info = C.load_champion(spark, out)
        return info, sorted((r["id"], r["churn_probability"]) for r in C.score(recs, models)[0].collect())

    first = C.train(spark, str(tmp_path / "train.csv"), test, out, params=small, k=2)
    assert first["ensemble_auc"] > 0.6
    info, before = champion_scores()
    assert info["version"] == 1 and info["run_id"] == first["run_id"] and info["uri"].endswith(first["run_id"])
    assert info["features"] == list(first["spec"].columns) and info["families"] == "boost+forest"
    second = C.train(spark, str(tmp_path / "noise.csv"), test, out, k=2, n_trials=1,
                     space={"boost": {"maxIter": ("int", 1, 2)}, "forest": {"numTrees": ("int", 2, 3)}})
    assert second["version"] == 2 and not second["promoted"] and second["uri"] != first["uri"]
    assert set(second["params"]) == {"boost", "forest"}  # the best stored trials
    info, after = champion_scores()
    assert info["version"] == 1 and after == before
    runs = spark.read.parquet(f"{out}/registry/runs")
    assert runs.filter("parent is null").count() == 2 and runs.filter(F.col("parent") == first["run_id"]).count() == 4
    wide = spark.read.option("header", True).csv(f"{first['uri']}/fold_metrics")
    assert wide.count() == 2 and {"boost_f1", "forest_f1"} <= set(wide.columns)
