"""Training plan: churn mart -> frozen features -> stratified folds -> CV fits
of both families -> out-of-fold metrics -> fold-mean ensemble -> registry."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import features as FE
from tidemark.operators import model as M
from tidemark.operators import registry as REG
from tidemark.operators import split as SP
from tidemark.operators.evaluate import TRAINING_EPS, classification_metrics, cv_summary
from tidemark.plans.fixtures import churn_records
from tidemark.session import scratch_path

def training_frame(spark: SparkSession, sf: str):
    """(fitted spec, features + label + fold, written once, a folder per fold)."""
    rec = churn_records(spark, sf)
    spec = FE.MART_SPEC.fit(rec)
    folds = SP.stratified_folds(rec, "churn").select("id", "fold")
    return spec, by_fold(spec.transform(rec).join(folds, "id"))


def by_fold(table: DataFrame) -> DataFrame:
    """Written once, partitioned by fold: each of the ten fits and ten held-out scans reads its folds only."""
    spark = table.sparkSession
    path = scratch_path(spark, "folds")
    table.write.partitionBy("fold").parquet(path)
    return spark.read.schema(table.schema).parquet(path)


def cv_models(spark: SparkSession, sf: str, params: dict | None = None):
    """(spec, training table, the 10 fold models)."""
    spec, table = training_frame(spark, sf)
    return spec, table, M.cv_fit(table, spec.columns, params=params)


def oof_metrics(oof: DataFrame) -> DataFrame:
    """Long fold metrics ``(family, fold, metric, value)`` from OOF scores."""
    m = classification_metrics(oof.withColumnRenamed("label", "y"), ["family", "fold"], "y", "p",
                               eps=TRAINING_EPS)
    return m.select("family", "fold", F.col("roc_auc").alias("auc"), "accuracy", "precision", "recall",
                    "f1", "log_loss") \
            .unpivot(["family", "fold"], ["auc", "accuracy", "precision", "recall", "f1", "log_loss"],
                     "metric", "value")


#: the parameter that counts the trees of a family
TREES = {"boost": "maxIter", "forest": "numTrees"}
#: shares of a trial's longest ensemble that are scored
PREFIXES = (0.25, 0.5, 0.75, 1.0)


def prefix_aucs(table: DataFrame, models: dict, shares: Sequence[float] = PREFIXES) -> dict[int, float]:
    """{number of trees: mean out-of-fold AUC} of one family's fold models at prefixes of their ensembles."""
    longest = min(M.n_trees(m) for m in models.values())
    out = {}
    for k in sorted({max(1, round(s * longest)) for s in shares}):
        cut = {job: M.first_trees(m, k) for job, m in models.items()}
        out[k] = oof_metrics(M.out_of_fold(table, cut)).filter(F.col("metric") == "auc").agg(F.avg("value")).first()[0]
    return out


def search_table(spark: SparkSession, spec, table: DataFrame, family: str, n_trials: int, root: str, study: str = "churn",
                 seed: int = 42, space: dict | None = None, k: int = 5, shares: Sequence[float] = (1.0,)) -> DataFrame:
    """Seeded random search: each trial = a k-fold CV of one family with drawn
    parameters; objective = mean OOF AUC.  With ``shares`` a trial fits its
    drawn number of trees once and also scores those shares of them: the best
    number of trees (ties: the fewest) is what it stores.  Every trial is
    stored when it ends (numbering resumes after stored trials).  Returns the
    trials table."""
    for _ in range(n_trials):
        t = REG.next_trial(spark, root, study, family)
        params = M.draw(seed, family, t, (space or M.SPACE)[family])
        models = M.cv_fit(table, spec.columns, families=[family], params={family: params}, k=k)
        aucs = prefix_aucs(table, models, shares)
        best = max(aucs, key=lambda n: (aucs[n] if aucs[n] is not None else float("-inf"), -n))
        if tuple(shares) != (1.0,):
            params = {**params, TREES[family]: best}
        REG.append_trial(spark, root, study, family, t, json.dumps(params, sort_keys=True), aucs[best])
    return spark.read.schema(REG.TRIALS_SCHEMA).parquet(f"{root}/trials")


def best_params(trials: DataFrame, study: str = "churn") -> dict:
    """{family: parameters} of the best stored trial of each family."""
    return {r["family"]: json.loads(r["params"]) for r in REG.best_trial(trials.filter(F.col("study") == study)).collect()}


def search(spark: SparkSession, sf: str, family: str, n_trials: int, root: str, study: str = "churn", seed: int = 42,
           space: dict | None = None) -> DataFrame:
    """``search_table`` on the churn mart."""
    spec, table = training_frame(spark, sf)
    return search_table(spark, spec, table, family, n_trials, root, study, seed, space)


def log_cv(spark: SparkSession, root: str, run_id: str, spec, table: DataFrame, fold_metrics: DataFrame, params: dict | None,
           tags: dict | None = None) -> None:
    """A parent run (dataset and model parameters, mean and spread of every
    metric) and one child run per family and fold with its metrics."""
    rows = fold_metrics.collect()  # families x folds x metrics
    data = table.agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("rate")).first()
    logged = {"n_rows": data["n"], "n_features": len(spec.columns), "positive_rate": data["rate"]}
    for fam in sorted({r["family"] for r in rows}):
        logged.update({f"{fam}_{k}": v for k, v in {**M.DEFAULT_PARAMS[fam], **((params or {}).get(fam) or {})}.items()})
    summary = {}
    for r in cv_summary(fold_metrics).collect():
        summary[f"{r['family']}_{r['metric']}_mean"] = r["mean"]
        summary[f"{r['family']}_{r['metric']}_std"] = r["std"]
    known = lambda m: {k: v for k, v in m.items() if v is not None}
    runs = [{"run_id": run_id, "params": logged, "metrics": known(summary), "tags": {"stage": "cv", **(tags or {})}}]
    for fam, fold in sorted({(r["family"], r["fold"]) for r in rows}):
        own = {r["metric"]: r["value"] for r in rows if (r["family"], r["fold"]) == (fam, fold)}
        runs.append({"run_id": f"{run_id}/{fam}_{fold}", "params": {"family": fam, "fold": fold}, "metrics": known(own), "tags": {"stage": "fold"}, "parent": run_id})
    REG.log_runs(spark, root, runs)
