"""Per-batch monitoring: one metrics row per ``(data_source, batch_id)``.

All batches are evaluated in one grouped job — drift, missingness and
quality aggregations keyed by the batch, joined on the key — instead of a
loop over batches.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import drift as D
from tidemark.operators.evaluate import classification_metrics
from tidemark.operators.joins import join_keys
from tidemark.operators.materialize import materialize, temporary_tables


@dataclass(frozen=True)
class MonitorSpec:
    numeric: Sequence[str]
    categorical: Sequence[str]
    prediction: str = "p"
    target: str = "y"
    group_by: Sequence[str] = ("data_source", "batch_id")
    ts: str | None = "ts"
    intensity: str | None = None
    bounded: bool = False  # True: groups are batches of a fixed size


EVENTS_SPEC = MonitorSpec(numeric=("value",), categorical=("event_type",), bounded=True)

METRIC_COLUMNS = ["data_source", "batch_id", "ts", "batch_size", "num_drifted_columns",
                  "share_drifted_columns", "prediction_drift", "share_missing_values",
                  "mean_predicted_churn_prob", "churn_rate", "accuracy", "roc_auc", "log_loss",
                  "drift_intensity"]


def reference_profile(reference: DataFrame, spec: MonitorSpec, persist: bool = False) -> D.ReferenceProfile:
    """Numeric counts/stats of features + prediction, shares of categorical
    features + target — built once per monitoring run or stream."""
    num_cols = list(spec.numeric) + [spec.prediction]
    cat_cols = list(spec.categorical) + [spec.target]
    return D.ReferenceProfile.build(D.to_long(reference, [], num_cols),
                                    D.to_long(reference, [], cat_cols, "string"), persist)


def drift_table(reference: DataFrame | None, current: DataFrame, spec: MonitorSpec,
                profile: D.ReferenceProfile | None = None) -> DataFrame:
    """Long drift table ``(group..., column, kind, drift_score, drifted)``."""
    g = list(spec.group_by)
    profile = profile or reference_profile(reference, spec)
    num_cols = list(spec.numeric) + [spec.prediction]
    num = D.numeric_drift(None, D.to_long(current, g, num_cols), g, profile=profile, bounded=spec.bounded)
    cat_cols = list(spec.categorical) + [spec.target]
    cat = D.categorical_drift(None, D.to_long(current, g, cat_cols, "string"), g, profile=profile, bounded=spec.bounded)
    return (num.select(*g, "column", F.lit("numeric").alias("kind"), "drift_score", "drifted")
            .unionByName(cat.select(*g, "column", F.lit("categorical").alias("kind"),
                                    "drift_score", "drifted")))


def batch_metrics(reference: DataFrame | None, current: DataFrame, spec: MonitorSpec = EVENTS_SPEC,
                  profile: D.ReferenceProfile | None = None) -> DataFrame:
    """The metrics row of every batch.

    Label metrics are null for batches without labels.  The target column is
    part of the drift columns of labelled batches only (it has no values in
    the others), and of the missing-share columns likewise.
    """
    g = list(spec.group_by)
    feats = list(spec.numeric) + list(spec.categorical)
    base_cols = len(feats) + 1
    labelled = F.col("_n_labelled") > 0

    drift = drift_table(reference, current, spec, profile)
    dagg = drift.groupBy(*g).agg(
        F.sum(F.col("drifted").cast("int")).alias("num_drifted_columns"),
        F.max(F.when(F.col("column") == spec.prediction, F.col("drift_score"))).alias("prediction_drift"))

    nulls = None
    for c in feats + [spec.prediction]:
        t = F.col(f"`{c}`").isNull().cast("long")
        nulls = t if nulls is None else nulls + t
    basic_aggs = [F.count(F.lit(1)).alias("batch_size"),
                  F.count(F.col(spec.target)).alias("_n_labelled"),
                  F.sum(nulls).alias("_nulls_base"),
                  F.sum(F.col(spec.target).isNull().cast("long")).alias("_nulls_target"),
                  F.avg(F.col(spec.prediction)).alias("mean_predicted_churn_prob")]
    if spec.ts:
        basic_aggs.append(F.max(F.col(spec.ts)).alias("ts"))
    if spec.intensity:
        basic_aggs.append(F.max(F.col(spec.intensity)).alias("drift_intensity"))
    basic = current.groupBy(*g).agg(*basic_aggs)

    q = classification_metrics(current, g, spec.target, spec.prediction, bounded=spec.bounded)
    q = q.select(*g, F.col("positive_rate").alias("churn_rate"), "accuracy", "roc_auc", "log_loss")

    ncols = F.lit(base_cols) + F.when(labelled, 1).otherwise(0)
    out = (join_keys(join_keys(basic, dagg, g, "left"), q, g, "left")
           .withColumn("num_drifted_columns", F.coalesce(F.col("num_drifted_columns"), F.lit(0)).cast("int"))
           .withColumn("share_drifted_columns", F.col("num_drifted_columns") / ncols)
           .withColumn("share_missing_values",
                       (F.col("_nulls_base") + F.when(labelled, F.col("_nulls_target")).otherwise(0))
                       / (F.col("batch_size") * ncols)))
    for c in ("churn_rate", "accuracy", "roc_auc", "log_loss"):
        out = out.withColumn(c, F.when(labelled, F.col(c)))
    if not spec.intensity:
        out = out.withColumn("drift_intensity", F.lit(0.0))
    if not spec.ts:
        out = out.withColumn("ts", F.current_timestamp())
    return out.select(*g, *[c for c in METRIC_COLUMNS if c not in g])


def metrics_per_epoch(spark, root: str, spec: MonitorSpec, profile: D.ReferenceProfile, batch_size: int,
                      written: bool = False):
    """A ``foreachBatch`` function that keeps one metrics row per batch right
    although a batch may arrive in several micro-batches.

    ``root/state/epoch=N`` holds the rows of all batches that are still open
    after epoch N (fewer than ``batch_size`` rows; at most one open batch per
    source in a stream that is in order), ``root/metrics/epoch=N`` the rows of
    the batches that epoch touched, computed over everything they have so
    far.  Both are written over on a replay, which reads the state of the
    epoch before again: the result does not change.  State that no replay can
    need, and the epoch's intermediate tables, are deleted.  ``written`` says
    that micro-batches come as tables (of ``numbered_epochs``): they are read as
    they are, not written again.
    """
    g = list(spec.group_by)

    def per_epoch(df: DataFrame, epoch: int) -> None:
        from tidemark.streaming.jobs import drop_epochs, write_epoch

        with temporary_tables(spark):
            rows = df if written else materialize(df, "micro-batch")
            # rows of the batches still open and of this epoch, counted once; every batch of the epoch is touched
            seen = rows.select(*g, F.lit(True).alias("_new"))
            if epoch > 0:
                before = spark.read.schema(rows.schema).parquet(f"{root}/state/epoch={epoch - 1}")
                seen = seen.unionByName(before.select(*g, F.lit(False).alias("_new")))
            counts = materialize(seen.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"), F.max("_new").alias("_touched")), "batch-counts")
            current = merged = rows
            if epoch > 0:
                current = rows.unionByName(join_keys(before, counts.filter("_touched").select(*g), g, "left_semi"))
                merged = rows.unionByName(before)
            write_epoch(batch_metrics(None, current, spec, profile), f"{root}/metrics", epoch, "epoch")
            still_open = counts.filter(F.col("_n") < batch_size).select(*g)
            write_epoch(join_keys(merged, still_open, g, "left_semi"), f"{root}/state", epoch, "epoch")
        drop_epochs(spark, f"{root}/state", epoch - 1)

    return per_epoch


def stream_metrics_table(spark, root: str, key: Sequence[str] = ("data_source", "batch_id")) -> DataFrame:
    """The latest row of every batch."""
    rows = spark.read.parquet(f"{root}/metrics")
    names = [c for c in rows.columns]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*names), "epoch").alias("r")).select("r.*")
