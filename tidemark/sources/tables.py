"""Parquet table access for the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one parquet table; column pruning and filters reach the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_state(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    """(path, length, modification time) of the table's files: changes whenever the data does."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
    fs = path.getFileSystem(conf)
    status = fs.getFileStatus(path)
    found = fs.listStatus(path) if status.isDirectory() else [status]
    return tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in found))
