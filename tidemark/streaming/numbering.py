"""Fixed-size batches of rows as they arrive in a stream.

Rows carry no number.  Every micro-batch ranks its rows per source in arrival
order (``order`` within the micro-batch) and adds the source's count of all
earlier rows; ``batch_id`` is that number over the batch size.  The counts are
kept per epoch, ``root/offsets/epoch=N``, and the numbered rows under
``root/numbered/epoch=N``: an epoch reads the counts of the epoch before it and
writes its own over, so a replay gives the same numbers.  Counts of epochs that
no replay can need are deleted.

Ranks are distributed (:mod:`tidemark.operators.rank`): a micro-batch in which one
source holds most rows is split.  A null source is a source of its own; rows
with equal ``order`` values are told apart by a hash of all their columns.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.joins import join_keys
from tidemark.operators.materialize import materialize, temporary_tables
from tidemark.operators.rank import default_bucket_count, dist_rank, with_quantile_bucket
from tidemark.streaming.jobs import drop_epochs, write_epoch


def number_rows(rows: DataFrame, offsets: DataFrame | None, by: Sequence[str] = ("data_source",), order: str = "id", size: int = 1000,
                name: str = "batch_id") -> DataFrame:
    """``rows`` with ``name``; ``offsets`` (by..., n) counts the rows that came before.  ``order`` is numeric."""
    by = list(by)
    b = with_quantile_bucket(rows, by, order, default_bucket_count(rows.sparkSession), name="_ob")
    b = b.withColumn("_ob", F.when(F.col(order).isNull(), -1).otherwise(F.col("_ob"))).withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]))
    ranked = dist_rank(b, by, [order, "_tie"], "_ob", name="_rank")
    if offsets is not None:
        ranked = join_keys(ranked, offsets.select(*by, F.col("n").alias("_seen")), by, "left")
    seen = F.coalesce("_seen", F.lit(0)) if offsets is not None else F.lit(0)
    return ranked.withColumn(name, F.floor((seen + F.col("_rank") - 1) / F.lit(size)).cast("int")).select(*rows.columns, name)


def numbered_epochs(spark: SparkSession, root: str, then: Callable[[DataFrame, int], None] | None = None, by: Sequence[str] = ("data_source",),
                    order: str = "id", size: int = 1000) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that numbers what arrives; ``then`` gets each epoch's numbered rows."""
    by = list(by)

    def per_epoch(df: DataFrame, epoch: int) -> None:
        with temporary_tables(spark):
            rows = materialize(df, "arrivals")
            counts = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
            offsets = None
            if epoch > 0:
                offsets = spark.read.schema(counts.schema).parquet(f"{root}/offsets/epoch={epoch - 1}")
                counts = offsets.unionByName(counts).groupBy(*by).agg(F.sum("n").alias("n"))
            write_epoch(number_rows(rows, offsets, by, order, size), f"{root}/numbered", epoch, "epoch")
            write_epoch(counts.coalesce(1), f"{root}/offsets", epoch, "epoch")  # a row per source
        if then is not None:
            then(spark.read.parquet(f"{root}/numbered/epoch={epoch}"), epoch)
        drop_epochs(spark, f"{root}/offsets", epoch - 1)

    return per_epoch
