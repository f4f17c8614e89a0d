"""Sources and sinks: CSV/JSON record sources with explicit schemas, the
prediction sink, wide fold-metric export, the append-only metrics table
with additive schema evolution, and artifacts as one-row-per-item tables.

Paths are supplied by the caller; scratch locations come from the shared
``spark.checkpoint.dir`` (see ``tidemark.session.scratch_path``).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True) -> DataFrame:
    """Header CSV with an explicit schema (no inference pass, stable types).
    Malformed numbers become null (PERMISSIVE) and are handled downstream."""
    return spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").csv(path)


def read_json_records(spark: SparkSession, path: str, schema: StructType | str,
                      multiline: bool = False) -> DataFrame:
    """JSON records: one object per line, or files holding a JSON array
    (``multiline=True``, one array element per row)."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_predictions(df: DataFrame, path: str, id_col: str = "id", score: str = "churn_probability",
                      fmt: str = "csv") -> None:
    """Prediction sink ``(id, score)``; order is not relied on — rows carry the id."""
    out = df.select(id_col, score)
    if fmt == "csv":
        write_csv(out, path)
    else:
        out.write.mode("overwrite").parquet(path)


def fold_metrics_wide(long: DataFrame, families: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """``(family, fold, metric, value)`` -> one row per fold, columns
    ``<family>_<metric>``; pivot values are listed so no extra pass is needed."""
    names = [f"{f}_{m}" for m in metrics for f in families]
    k = long.withColumn("_name", F.concat_ws("_", "family", "metric"))
    return k.groupBy("fold").pivot("_name", names).agg(F.first("value"))


def export_fold_metrics(long: DataFrame, path: str, families: Sequence[str] = ("boost", "forest"),
                        metrics: Sequence[str] = ("auc", "accuracy", "precision", "recall", "f1", "log_loss")) -> None:
    """Write the wide fold metrics of both families as a header CSV."""
    write_csv(fold_metrics_wide(long, families, metrics), path)


def append_metrics(df: DataFrame, path: str, run_id: str, partition_by: Sequence[str] = ("data_source",)) -> None:
    """Append-only metrics table partitioned by source; each row keyed by
    ``(run_id, data_source, batch_id)``.  A replayed write adds rows again;
    readers use :func:`latest_per_key`."""
    (df.withColumn("run_id", F.lit(run_id))
       .write.mode("append").partitionBy(*partition_by).parquet(path))


def append_metrics_jdbc(df: DataFrame, url: str, table: str, run_id: str, properties: dict | None = None) -> None:
    """The same append to a relational table (``id`` and ``ts`` defaults are
    the database's); one connection per task, batched inserts."""
    (df.withColumn("run_id", F.lit(run_id)).write.mode("append")
       .jdbc(url, table, properties=properties or {}))


def read_metrics(spark: SparkSession, path: str, defaults: dict | None = None) -> DataFrame:
    """Read with ``mergeSchema``; columns added later are filled with their
    default in files written before they existed (additive evolution)."""
    df = spark.read.option("mergeSchema", True).parquet(path)
    for c, v in (defaults or {}).items():
        if c in df.columns:
            df = df.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
        else:
            df = df.withColumn(c, F.lit(v))
    return df


def latest_per_key(df: DataFrame, key: Sequence[str] = ("run_id", "data_source", "batch_id"),
                   order: str = "written_at") -> DataFrame:
    """One row per key: the last written (idempotent view over replays)."""
    cols = [c for c in df.columns if c not in key]
    agg = df.groupBy(*key).agg(F.max_by(F.struct(*cols), F.col(order)).alias("_r"))
    return agg.select(*key, "_r.*")
