"""Reporting queries over the metrics table (dashboard panels).

Latest-value panels use ``max_by(value, struct(ts, ...))`` — a partial
aggregate, the scalable form of ``ORDER BY ts DESC LIMIT 1``.  Long-form
series use one ``unpivot`` (one scan) instead of a ``UNION ALL`` per metric.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import status_band

LABELLED = "train_holdout"
RECENT_COLUMNS = ["ts", "data_source", "batch_id", "batch_size", "drift_intensity", "num_drifted_columns",
                  "share_drifted_columns", "prediction_drift", "share_missing_values",
                  "mean_predicted_churn_prob", "churn_rate", "accuracy", "roc_auc", "log_loss"]


def latest(m: DataFrame, column: str, source: str | None = LABELLED) -> DataFrame:
    d = m if source is None else m.filter(F.col("data_source") == source)
    d = d.filter(F.col(column).isNotNull())
    return d.agg(F.max_by(F.col(column), F.struct("ts", "data_source", "batch_id")).alias(column))


def total_batches(m: DataFrame) -> DataFrame:
    return m.agg(F.count(F.lit(1)).alias("c"))


def time_filter(m: DataFrame, start, end) -> DataFrame:
    return m.filter((F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
                    & (F.col("ts") <= F.lit(end).cast("timestamp_ntz")))


def series(m: DataFrame, column: str, start, end) -> DataFrame:
    """``(time, metric = data_source, value)`` in a time window."""
    return time_filter(m, start, end).select(F.col("ts").alias("time"), F.col("data_source").alias("metric"),
                                             F.col(column).cast("double").alias("value"))


def series_long(m: DataFrame, columns, start, end, source: str | None = None) -> DataFrame:
    """Several metrics as ``(time, metric, value)`` rows from one scan."""
    d = time_filter(m, start, end)
    if source:
        d = d.filter(F.col("data_source") == source)
    d = d.select(F.col("ts").alias("time"), *[F.col(c).cast("double").alias(c) for c in columns])
    return d.unpivot(["time"], list(columns), "metric", "value")


def recent(m: DataFrame, n: int = 20) -> DataFrame:
    """Last n batches (top-k by time: TakeOrderedAndProject)."""
    return m.orderBy(F.col("ts").desc(), F.col("data_source").desc(), F.col("batch_id").desc()) \
            .limit(n).select(*RECENT_COLUMNS)


def status(m: DataFrame) -> DataFrame:
    """Dashboard threshold bands per batch."""
    return m.select(
        "data_source", "batch_id",
        status_band("roc_auc", 0.7, 0.8).alias("auc_status"),
        status_band("accuracy", 0.7, 0.8).alias("accuracy_status"),
        status_band("num_drifted_columns", 3, 6, higher_is_better=False).alias("drifted_status"),
        status_band("share_drifted_columns", 0.3, 0.5, higher_is_better=False).alias("share_status"))
