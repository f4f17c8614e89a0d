"""Queries: the metrics table (append, evolve, dedupe view) and the
dashboard reports over it; CSV/JSON sources, prediction and artifact sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import features as FE
from tidemark.plans import reports as R
from tidemark.plans.catalog import register
from tidemark.plans.fixtures import churn_records, scored_events
from tidemark.plans.queries_eval import fold_metrics
from tidemark.plans.queries_monitoring import q_batch_metrics
from tidemark.operators.materialize import materialize
from tidemark.plans.sql.common import MART, SCORED
from tidemark.plans.sql.evaluation import FOLD_WIDE
from tidemark.plans.sql.monitoring import BATCH_METRICS
from tidemark.session import scratch_path, session_key
from tidemark.sources import json_array as JA
from tidemark.sources import metrics_table as MT
from tidemark.sources import sinks as K
from tidemark.sources.tables import table_state

MM = f"WITH monitoring_metrics AS ({BATCH_METRICS})\n"
T0, T1 = "2024-01-15 00:00:00", "2024-01-31 00:00:00"
WHERE_T = f"ts >= TIMESTAMP '{T0}' AND ts <= TIMESTAMP '{T1}'"


#: (application, state of the events' files) -> metrics table
_WRITTEN: dict[tuple, str] = {}


def metrics_table(spark, sf, start=None, end=None):
    """The metrics table as reports see it: batch metrics appended (once per
    session and state of the events' files) to a parquet table in the shared checkpoint folder, partitioned by day and
    source, read back with schema merging, through the view that keeps one row
    per ``(run_id, data_source, batch_id)`` (replayed appends do not repeat).
    A time window prunes days and rows before repeats are removed: all rows of
    a key have the batch's time."""
    key = (session_key(spark), table_state(spark, sf, "events"))
    if key not in _WRITTEN:
        path = scratch_path(spark, "monitoring_metrics")
        rows = q_batch_metrics(spark, sf).withColumn("written_at", F.current_timestamp()).withColumn("day", F.to_date("ts"))
        K.append_metrics(rows, path, run_id="run-1", partition_by=("day", "data_source"))
        _WRITTEN[key] = path
    path = _WRITTEN[key]
    m = K.read_metrics(spark, path, defaults={"drift_intensity": 0.0})
    if start is not None:
        m = R.time_filter(m.filter(F.col("day").between(F.to_date(F.lit(start)), F.to_date(F.lit(end)))), start, end)
    return K.latest_per_key(m.drop("day"))


@register("metrics_compacted", MM + "SELECT ts, data_source, batch_id, batch_size, roc_auc, num_drifted_columns, drift_intensity, "
          "CASE WHEN batch_id % 2 = 1 THEN 'late' ELSE 'early' END AS note, 1::BIGINT AS n_files FROM monitoring_metrics")
def q_metrics_compacted(spark, sf):
    """Several small appends, one of them a replay and one with a new column; then compaction:
    the same rows, one file for each day and source, read by the schema log."""
    path = scratch_path(spark, "compacted")
    rows = materialize(q_batch_metrics(spark, sf).withColumn("day", F.to_date("ts")), "batch_rows")
    for i, part in enumerate((rows.filter("batch_id % 2 = 0"), rows.filter("batch_id % 2 = 0"), rows.filter("batch_id % 2 = 1").withColumn("note", F.lit("late")))):
        MT.append(part.withColumn("written_at", F.lit(i)), path, "run-1")
    MT.compact(spark, path)
    m = MT.read(spark, path, defaults={"note": "early"})
    files = m.select("day", "data_source", F.input_file_name().alias("f")).groupBy("day", "data_source").agg(F.countDistinct("f").alias("n_files"))
    return m.join(files, ["day", "data_source"]).select("ts", "data_source", "batch_id", "batch_size", "roc_auc", "num_drifted_columns", "drift_intensity", "note", "n_files")


LATEST = ("SELECT {c} FROM monitoring_metrics WHERE {w}{c} IS NOT NULL "
          "ORDER BY ts DESC, data_source DESC, batch_id DESC LIMIT 1")


@register("latest_auc", MM + LATEST.format(c="roc_auc", w="data_source = 'train_holdout' AND "))
def q_latest_auc(spark, sf):
    return R.latest(metrics_table(spark, sf), "roc_auc")


@register("latest_accuracy", MM + LATEST.format(c="accuracy", w="data_source = 'train_holdout' AND "))
def q_latest_acc(spark, sf):
    return R.latest(metrics_table(spark, sf), "accuracy")


@register("latest_drifted", MM + LATEST.format(c="num_drifted_columns", w=""))
def q_latest_drifted(spark, sf):
    return R.latest(metrics_table(spark, sf), "num_drifted_columns", source=None)


@register("total_batches", MM + "SELECT count(*) AS c FROM monitoring_metrics")
def q_total(spark, sf):
    return R.total_batches(metrics_table(spark, sf))


def _series_sql(c):
    return (MM + f"SELECT ts AS time, data_source AS metric, CAST({c} AS DOUBLE) AS value "
            f"FROM monitoring_metrics WHERE {WHERE_T}")


@register("series_drifted", _series_sql("num_drifted_columns"))
def q_series_drifted(spark, sf):
    return R.series(metrics_table(spark, sf, T0, T1), "num_drifted_columns", T0, T1)


@register("series_share", _series_sql("share_drifted_columns"))
def q_series_share(spark, sf):
    return R.series(metrics_table(spark, sf, T0, T1), "share_drifted_columns", T0, T1)


@register("series_pred_drift", _series_sql("prediction_drift"))
def q_series_pred(spark, sf):
    return R.series(metrics_table(spark, sf, T0, T1), "prediction_drift", T0, T1)


@register("series_missing", _series_sql("share_missing_values"))
def q_series_missing(spark, sf):
    return R.series(metrics_table(spark, sf, T0, T1), "share_missing_values", T0, T1)


def _long_sql(pairs, source=None):
    w = f"{WHERE_T}" + (f" AND data_source = '{source}'" if source else "")
    return MM + " UNION ALL ".join(
        f"SELECT ts AS time, '{name}' AS metric, CAST({c} AS DOUBLE) AS value FROM monitoring_metrics WHERE {w}"
        for name, c in pairs)


@register("series_calibration", _long_sql([("mean_predicted", "mean_predicted_churn_prob"),
                                           ("churn_rate", "churn_rate")], "train_holdout"))
def q_series_cal(spark, sf):
    m = metrics_table(spark, sf, T0, T1).withColumnRenamed("mean_predicted_churn_prob", "mean_predicted")
    return R.series_long(m, ["mean_predicted", "churn_rate"], T0, T1, "train_holdout")


@register("series_quality", _long_sql([(c, c) for c in ("accuracy", "roc_auc", "log_loss")], "train_holdout"))
def q_series_quality(spark, sf):
    return R.series_long(metrics_table(spark, sf, T0, T1), ["accuracy", "roc_auc", "log_loss"], T0, T1, "train_holdout")


@register("series_injected", _long_sql([(c, c) for c in ("drift_intensity", "share_drifted_columns")]))
def q_series_injected(spark, sf):
    return R.series_long(metrics_table(spark, sf, T0, T1), ["drift_intensity", "share_drifted_columns"], T0, T1)


@register("recent_batches", MM + "SELECT " + ", ".join(R.RECENT_COLUMNS)
          + " FROM monitoring_metrics ORDER BY ts DESC, data_source DESC, batch_id DESC LIMIT 20")
def q_recent(spark, sf):
    return R.recent(metrics_table(spark, sf), 20)


def _band(c, t1, t2, hib=True):
    if hib:
        return (f"CASE WHEN {c} IS NULL THEN NULL WHEN {c} >= {t2} THEN 'green' "
                f"WHEN {c} >= {t1} THEN 'yellow' ELSE 'red' END")
    return (f"CASE WHEN {c} IS NULL THEN NULL WHEN {c} >= {t2} THEN 'red' "
            f"WHEN {c} >= {t1} THEN 'yellow' ELSE 'green' END")


@register("status_bands", MM + f"SELECT data_source, batch_id, {_band('roc_auc', 0.7, 0.8)} AS auc_status, "
          f"{_band('accuracy', 0.7, 0.8)} AS accuracy_status, "
          f"{_band('num_drifted_columns', 3, 6, False)} AS drifted_status, "
          f"{_band('share_drifted_columns', 0.3, 0.5, False)} AS share_status FROM monitoring_metrics")
def q_status(spark, sf):
    return R.status(metrics_table(spark, sf))


UNPIV = ["share_drifted_columns", "prediction_drift", "share_missing_values", "mean_predicted_churn_prob",
         "churn_rate", "accuracy", "roc_auc", "log_loss"]


@register("unpivot_metrics", MM + " UNION ALL ".join(
    f"SELECT data_source, batch_id, '{c}' AS metric, {c} AS value FROM monitoring_metrics" for c in UNPIV))
def q_unpivot(spark, sf):
    m = metrics_table(spark, sf)
    return m.unpivot(["data_source", "batch_id"], UNPIV, "metric", "value")


KEYED = ["data_source", "batch_id", "num_drifted_columns", "roc_auc", "accuracy", "drift_intensity"]


@register("metrics_dedup", MM + "SELECT 'run-1' AS run_id, " + ", ".join(KEYED) + " FROM monitoring_metrics")
def q_dedup(spark, sf):
    """A replayed append writes every row a second time; the view keeps one
    row per (run_id, data_source, batch_id)."""
    m = metrics_table(spark, sf)
    replay = m.withColumn("written_at", F.col("written_at") + F.expr("INTERVAL 1 SECOND"))
    return K.latest_per_key(m.unionByName(replay)).select("run_id", *KEYED)


@register("metrics_append", MM + " SELECT 'run-1' AS run_id, " + ", ".join(KEYED) + " FROM monitoring_metrics "
          "UNION ALL SELECT 'run-2', " + ", ".join(KEYED) + " FROM monitoring_metrics")
def q_append(spark, sf):
    path = scratch_path(spark, "metrics_append")
    m = metrics_table(spark, sf).drop("run_id")
    K.append_metrics(m, path, "run-1")
    K.append_metrics(m, path, "run-2")
    return spark.read.parquet(path).select("run_id", *KEYED)


@register("evolve_schema", MM + "SELECT " + ", ".join(KEYED) + " FROM monitoring_metrics")
def q_evolve(spark, sf):
    """Files written before ``drift_intensity`` existed read back with its default."""
    path = scratch_path(spark, "metrics_evolve")
    m = metrics_table(spark, sf).drop("run_id")
    K.append_metrics(m.filter(F.col("data_source") == "test").drop("drift_intensity"), path, "run-1")
    K.append_metrics(m.filter(F.col("data_source") == "train_holdout"), path, "run-1")
    return K.read_metrics(spark, path, defaults={"drift_intensity": 0.0}).select(*KEYED)


# ---------------------------------------------------------------- sources / sinks

REC_SCHEMA = ("id long, c_mktsegment string, c_acctbal double, n_orders long, total_spend double, "
              "tenure_days int, urgent string, low string, pending string, churn string")
W_MART = f"WITH {MART}\n"


@register("scan_csv", W_MART + "SELECT * FROM records")
def q_scan_csv(spark, sf):
    path = scratch_path(spark, "records_csv")
    K.write_csv(churn_records(spark, sf), path)
    return K.read_csv(spark, path, REC_SCHEMA)


@register("scan_json", W_MART + "SELECT * FROM records")
def q_scan_json(spark, sf):
    path = scratch_path(spark, "records_json")
    churn_records(spark, sf).write.mode("overwrite").json(path)
    return K.read_json_records(spark, path, REC_SCHEMA)


@register("scan_json_array", W_MART + "SELECT * FROM records")
def q_scan_json_array(spark, sf):
    """One file that holds all records as one array, read by splits."""
    path = scratch_path(spark, "records_array")
    JA.write_json_array(churn_records(spark, sf), path)
    return JA.read_json_array(spark, path, REC_SCHEMA)


@register("submission", f"WITH {SCORED} SELECT id, p AS churn_probability FROM scored")
def q_submission(spark, sf):
    path = scratch_path(spark, "submission")
    s = scored_events(spark, sf).select("id", F.col("p").alias("churn_probability"))
    K.write_predictions(s, path)
    return K.read_csv(spark, path, "id long, churn_probability double")


@register("fold_metrics_wide", FOLD_WIDE)
def q_fold_wide(spark, sf):
    path = scratch_path(spark, "fold_metrics_wide")
    names = ("auc", "accuracy", "log_loss", "f1")
    K.export_fold_metrics(fold_metrics(spark, sf, names), path, ("a", "b"), names)
    return K.read_csv(spark, path, "fold int, " + ", ".join(f"{f}_{m} double" for m in names for f in ("a", "b")))


FEATURE_NAMES = ["c_acctbal", "n_orders", "total_spend", "tenure_days", "urgent", "low", "pending",
                 "avg_spend", "n_flags", "c_mktsegment_BUILDING", "c_mktsegment_FURNITURE",
                 "c_mktsegment_HOUSEHOLD", "c_mktsegment_MACHINERY"]


@register("feature_list", "SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{n}')" for i, n in enumerate(FEATURE_NAMES)) + ") AS t(position, feature)")
def q_feature_list(spark, sf):
    """The ordered feature list of the fitted spec, written as an artifact
    table (one row per feature) and read back."""
    spec = FE.MART_SPEC.fit(churn_records(spark, sf))
    path = scratch_path(spark, "feature_list")
    spark.createDataFrame(list(enumerate(spec.columns)), "position int, feature string") \
        .write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
