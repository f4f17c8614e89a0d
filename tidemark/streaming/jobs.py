"""Streaming versions of scoring, per-micro-batch monitoring, quarantine and
event-time windows.

Sources are file streams with an explicit schema; sinks are files or
``foreachBatch`` appends, each with a checkpoint folder, so a restarted or
retried query resumes where it stopped.  ``trigger(availableNow=True)``
processes what is there and stops (the one-pass mode); a processing-time
trigger gives the periodic mode.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def _trigger(w, once: bool, interval: str):
    return w.trigger(availableNow=True) if once else w.trigger(processingTime=interval)


def run_to_files(stream: DataFrame, out: str, checkpoint: str, fmt: str = "parquet",
                 once: bool = True, interval: str = "10 seconds"):
    """Stateless transform -> file sink (exactly-once via the sink log)."""
    w = stream.writeStream.format(fmt).option("path", out).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    q = _trigger(w, once, interval).start()
    if once:
        q.awaitTermination()
    return q


def run_foreach_batch(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                      once: bool = True, interval: str = "10 seconds"):
    """Run ``fn(micro_batch_df, batch_id)`` per micro-batch.  A replayed
    micro-batch calls ``fn`` again with the same id; ``fn`` should write the
    rows of an id where a second call replaces them (``write_epoch``)."""
    w = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    q = _trigger(w, once, interval).start()
    if once:
        q.awaitTermination()
    return q


def write_epoch(df: DataFrame, path: str, epoch: int, column: str = "batch") -> None:
    """Write a micro-batch's rows as partition ``column=epoch``; a replay replaces them."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{column}={int(epoch)}")


def drop_epochs(spark: SparkSession, path: str, before: int, column: str = "epoch") -> None:
    """Delete the partitions of epochs below ``before``: a replay repeats the last epoch and reads the one before it."""
    sc = spark.sparkContext
    root = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return
    for f in fs.listStatus(root):
        name, _, number = f.getPath().getName().partition("=")
        if name == column and int(number) < before:
            fs.delete(f.getPath(), True)


def windowed_counts(df: DataFrame, ts: str = "ts", size: str = "1 day", slide: str | None = None,
                    watermark: str | None = "1 hour", by=("data_source",), y: str = "y", p: str = "p") -> DataFrame:
    """Event-time tumbling (or sliding) window metrics per source.

    With a watermark the aggregation can run in append mode: a window is
    emitted once the watermark passes its end; late rows beyond it are
    dropped by the engine (state stays bounded)."""
    if watermark:
        # watermarks need TIMESTAMP; the naive parquet type is kept otherwise
        d = df.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", watermark)
    else:
        d = df.withColumn("_ts", F.col(ts))
    win = F.window("_ts", size, slide) if slide else F.window("_ts", size)
    return (d.groupBy(win.alias("w"), *by)
             .agg(F.count(F.lit(1)).alias("n"), F.avg(p).alias("mean_score"),
                  F.avg(F.col(y).cast("double")).alias("positive_rate"),
                  F.sum(F.col(y)).cast("long").alias("positives"))
             .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by,
                     "n", "mean_score", "positive_rate", "positives"))
