"""Drift, quality and missingness per event-time window, as a stream.

The state of a window is the slot counts of :mod:`tidemark.operators.grid`: per
source, column and reference bin (or category) a few sums.  It is bounded by
the grid and the categories, merges in any order, and needs no raw rows.  In
append mode a window's counts leave the state, once and for good, when the
watermark passes its end; what is later than that is dropped by the engine.
Metrics are a view over the counts of closed windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.grid import COUNTS, Grid, grid_metrics, slot_rows
from tidemark.streaming.jobs import run_to_files

KEYS = ["window_start", "window_end"]


def window_counts(df: DataFrame, grid: Grid, ts: str = "ts", size: str = "1 day", slide: str | None = None, watermark: str | None = "1 hour",
                  by=("data_source",), y: str = "y", p: str = "p") -> DataFrame:
    """Slot counts per window and source, of a stream (with a watermark) or a table (None)."""
    at = F.col(ts).cast("timestamp") if watermark else F.col(ts)
    d = df.withColumn("_ts", at)
    if watermark:
        d = d.withWatermark("_ts", watermark)
    rows = slot_rows(d, grid.edges, grid.categorical, ["_ts", *by], y, p)
    win = F.window("_ts", size, slide) if slide else F.window("_ts", size)
    counts = rows.groupBy(win.alias("w"), *by, "column", "bin", "value").agg(*[F.sum(c).alias(c) for c in COUNTS])
    return counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "column", "bin", "value", *COUNTS)


def run_window_drift(stream: DataFrame, grid: Grid, out: str, checkpoint: str, once: bool = True, interval: str = "10 seconds", **window):
    """Write the counts of closed windows to ``out`` (exactly once by the sink's log)."""
    return run_to_files(window_counts(stream, grid, **window), out, checkpoint, once=once, interval=interval)


def window_metrics(counts: DataFrame, grid: Grid, by=("data_source",), prediction: str = "p", target: str | None = "y") -> DataFrame:
    """A metrics row per window and source from its counts (:func:`tidemark.operators.grid.grid_metrics`)."""
    return grid_metrics(counts, [*KEYS, *by], grid, prediction, target)


def read_window_metrics(spark: SparkSession, path: str, grid: Grid, **options) -> DataFrame:
    """Metrics of the windows that are closed so far."""
    return window_metrics(spark.read.parquet(path), grid, **options)
