"""Run log and model registry as tables.

``runs``, ``run_params``, ``run_metrics``, ``trials``, ``model_versions`` and
``model_aliases`` are append-only parquet tables under one root.  Numbers of
versions and trials are taken by creating a marker file exclusively
(:mod:`tidemark.sources.markers`), so writers that run at the same time get
different ones; promotion is a table rule: promote when there is no champion,
its metric is missing, or the new AUC is strictly greater.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources.markers import append_table, safe_name, take_number

VERSIONS_SCHEMA = "name string, version int, run_id string, uri string, families string, auc double, created_at timestamp"
ALIASES_SCHEMA = "name string, alias string, version int, set_at timestamp"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table, or an empty one if its folder does not exist yet; any other error is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _now() -> _dt.datetime:
    """An instant (with its zone, so that the driver's zone does not matter)."""
    return _dt.datetime.now(_dt.timezone.utc)


def log_runs(spark: SparkSession, root: str, runs: Sequence[dict]) -> None:
    """Runs written together: a file per table.  A run has ``run_id``, ``params``, ``metrics`` and optionally ``tags`` and ``parent``."""
    now = _now()
    rows = [(r["run_id"], r.get("parent"), now, {k: str(v) for k, v in (r.get("tags") or {}).items()}) for r in runs]
    params = [x for r in runs for x in ([(r["run_id"], k, str(v)) for k, v in r["params"].items()] or [(r["run_id"], "", "")])]
    metrics = [x for r in runs for x in ([(r["run_id"], k, float(v)) for k, v in r["metrics"].items()] or [(r["run_id"], "", 0.0)])]
    for name, data, schema in (("runs", rows, "run_id string, parent string, started_at timestamp, tags map<string,string>"),
                               ("run_params", params, "run_id string, key string, value string"), ("run_metrics", metrics, "run_id string, key string, value double")):
        append_table(spark.createDataFrame(data, schema).coalesce(1), f"{root}/{name}")


def log_run(spark: SparkSession, root: str, run_id: str, params: dict, metrics: dict, tags: dict | None = None,
            parent: str | None = None):
    """One run: its row (with the parent run, if it is a fold of one), parameters and metrics."""
    log_runs(spark, root, [{"run_id": run_id, "params": params, "metrics": metrics, "tags": tags, "parent": parent}])


TRIALS_SCHEMA = "study string, family string, number int, params string, value double"


def next_trial(spark: SparkSession, root: str, study: str, family: str) -> int:
    """Number of a new trial, this caller's alone: a resumed study keeps counting; a trial that fails leaves a gap."""
    prev = _read(spark, f"{root}/trials", TRIALS_SCHEMA).filter((F.col("study") == study) & (F.col("family") == family))
    stored = prev.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
    return take_number(spark, f"{root}/trial_numbers/{safe_name(study)}/{safe_name(family)}", stored)


def append_trial(spark: SparkSession, root: str, study: str, family: str, number: int, params: str, value) -> None:
    """Store one trial when it ends, so that a later failure loses none."""
    append_table(spark.createDataFrame([(study, family, number, params, None if value is None else float(value))], TRIALS_SCHEMA).coalesce(1), f"{root}/trials")


def best_trial(trials: DataFrame) -> DataFrame:
    """Best over all stored trials per study/family; ties -> lowest number.  A trial without a value (null, NaN) loses to any other."""
    value = F.coalesce(F.nanvl("value", F.lit(None).cast("double")), F.lit(float("-inf")))
    return trials.groupBy("study", "family").agg(
        F.max_by(F.struct("number", "params", "value"), F.struct(value, -F.col("number"))).alias("b")
    ).select("study", "family", "b.number", "b.params", "b.value")


def register_version(spark: SparkSession, root: str, name: str, run_id: str, uri: str, auc, families: str = "") -> int:
    """Register under the next version number, this caller's alone."""
    versions = _read(spark, f"{root}/model_versions", VERSIONS_SCHEMA)
    stored = versions.filter(F.col("name") == name).agg(F.coalesce(F.max("version") + 1, F.lit(1))).first()[0]
    nxt = take_number(spark, f"{root}/version_numbers/{safe_name(name)}", stored)
    now = _now()
    row = (name, int(nxt), run_id, uri, families, None if auc is None else float(auc), now)
    append_table(spark.createDataFrame([row], VERSIONS_SCHEMA).coalesce(1), f"{root}/model_versions")
    return int(nxt)


def champion(spark: SparkSession, root: str, name: str, alias: str = "champion") -> DataFrame:
    """Current alias target joined to its version row (model information)."""
    aliases = _read(spark, f"{root}/model_aliases", ALIASES_SCHEMA).filter(
        (F.col("name") == name) & (F.col("alias") == alias))
    cur = aliases.groupBy("name", "alias").agg(F.max_by("version", F.struct("set_at", "version")).alias("version"))
    versions = _read(spark, f"{root}/model_versions", VERSIONS_SCHEMA)
    return cur.join(versions, ["name", "version"], "left")


def should_promote(champion_auc, new_auc) -> bool:
    known = lambda v: v is not None and v == v  # noqa: E731  NaN is no metric
    return not known(champion_auc) or (known(new_auc) and new_auc > champion_auc)


def promote_if_better(spark: SparkSession, root: str, name: str, version: int, new_auc,
                      alias: str = "champion") -> bool:
    ch = champion(spark, root, name, alias).select("auc", "version").collect()  # at most one row
    champ_auc = ch[0]["auc"] if ch else None
    if ch and not should_promote(champ_auc, new_auc):
        return False
    now = _now()
    append_table(spark.createDataFrame([(name, alias, int(version), now)], ALIASES_SCHEMA).coalesce(1), f"{root}/model_aliases")
    return True


def promotion_history(versions: DataFrame, metric: str = "auc", order: str = "version") -> DataFrame:
    """Replay the promotion rule over registered versions in order.

    A version is promoted when no earlier version was promoted, or the
    champion's metric is missing, or its metric is strictly greater than the
    champion's.  Promoted metrics are a running maximum, so the champion
    before a version is the max over earlier versions.  The window runs over
    the versions table (one row per training run — small by construction).
    """
    w = Window.partitionBy("name").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    prev_best = F.max(F.col(metric)).over(w)
    prev_cnt = F.count(F.lit(1)).over(w)
    return versions.select(
        "name", order, metric,
        F.coalesce((prev_cnt == 0) | prev_best.isNull() | (F.col(metric) > prev_best), F.lit(False))
        .alias("promoted"))
