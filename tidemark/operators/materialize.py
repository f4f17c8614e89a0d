"""Lineage cuts.

Prefix sums and as-of lookups read their input twice (totals, then rows);
nested, an uncut plan re-expands every upstream scan and shuffle.  At those
boundaries the input is written once as a parquet table under the shared
folder named by ``spark.checkpoint.dir`` and read back: it survives executor
loss, it is computed exactly once (a reliable RDD checkpoint recomputes its
input to write it), and the re-read is a file scan with real size statistics
for the adaptive planner, with column pruning for later stages.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import delete_path, scratch_path

_open = threading.local()


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    for paths in getattr(_open, "scopes", []):
        paths.append(path)
    return spark.read.parquet(path)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Tables materialized inside (by this thread) are deleted at the end; for jobs whose results are written by then."""
    scopes = _open.__dict__.setdefault("scopes", [])
    mine: list[str] = []
    scopes.append(mine)
    try:
        yield
    finally:
        scopes.pop()
        for path in mine:
            delete_path(spark, path)
