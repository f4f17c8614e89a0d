"""The metrics table: append, additive schema, compaction.

Rows lie in ``path/day=.../data_source=.../``; ``path/_schema/`` holds a numbered
file per version of the table's schema.  An append whose rows bring new columns
takes the next version first (exclusively; a writer that loses the race merges
again), so readers open the newest version instead of merging the footers of
all files.  Columns that a file lacks read as null, or as their default.

Compaction rewrites partitions of several files as one.  The new file is moved
in before the old ones go: a reader in between, or a run that dies there, sees
rows twice, which the view of one row per key (``latest_per_key``) does not show,
and the next compaction mends.  Files that arrive meanwhile are left alone.
"""

from __future__ import annotations

import json
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.sources.markers import _fs, append_table, create_exclusive, data_files, numbers, read_text
from tidemark.sources.sinks import latest_per_key

PARTITIONS = ("day", "data_source")
KEY = ("run_id", "data_source", "batch_id")


def table_schema(spark: SparkSession, path: str) -> StructType | None:
    """The newest version of the schema (None before the first append)."""
    found = numbers(spark, f"{path}/_schema")
    return StructType.fromJson(json.loads(read_text(spark, f"{path}/_schema/{found[-1]:010d}.json"))) if found else None


def merged_schema(old: StructType | None, new: StructType) -> StructType:
    """Columns of both, in order of arrival, all nullable; a column that changes its type is an error."""
    fields = {f.name: f.dataType for f in (old.fields if old else [])}
    for f in new.fields:
        if f.name in fields and fields[f.name] != f.dataType:
            raise ValueError(f"column {f.name} is {fields[f.name].simpleString()}, not {f.dataType.simpleString()}")
        fields.setdefault(f.name, f.dataType)
    return StructType([StructField(n, t, True) for n, t in fields.items()])


def _note_schema(spark: SparkSession, path: str, schema: StructType) -> StructType:
    while True:
        found = numbers(spark, f"{path}/_schema")
        old = table_schema(spark, path)
        new = merged_schema(old, schema)
        if old is not None and new == old:
            return new
        if create_exclusive(spark, f"{path}/_schema/{(found[-1] if found else 0) + 1:010d}.json", json.dumps(new.jsonValue())):
            return new


def append(df: DataFrame, path: str, run_id: str, partition_by: Sequence[str] = PARTITIONS) -> None:
    """Append rows of a run; new columns extend the schema."""
    rows = df.withColumn("run_id", F.lit(run_id))
    _note_schema(df.sparkSession, path, rows.schema)
    append_table(rows, path, partition_by)


def read(spark: SparkSession, path: str, defaults: dict | None = None) -> DataFrame:
    """All rows under the newest schema; ``defaults`` fill columns that older files lack."""
    schema = table_schema(spark, path)
    if schema is None:
        raise FileNotFoundError(f"no metrics table at {path}")
    df = spark.read.schema(schema).parquet(path)
    for c, v in (defaults or {}).items():
        df = df.withColumn(c, F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v))
    return df


def compact(spark: SparkSession, path: str, key: Sequence[str] = KEY, order: str = "written_at", partition_by: Sequence[str] = PARTITIONS,
            max_records: int = 1_000_000) -> int:
    """Rewrite every partition of several files as one (or one per ``max_records`` rows), keeping the last row of each key.

    Returns the number of partitions rewritten.
    """
    many = {d: files for d, files in data_files(spark, path).items() if len(files) > 1}
    if not many:
        return 0
    old = [f for files in many.values() for f in files]
    rows = spark.read.schema(table_schema(spark, path)).option("basePath", path).parquet(*old)
    # the key names the batch; its rows lie in one partition, replays too
    rows = latest_per_key(rows, list(dict.fromkeys([*key, *partition_by])), order)
    append_table(rows.repartition(*partition_by), path, partition_by, max_records)
    fs, _ = _fs(spark, path)
    for f in old:
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f), False)
    return len(many)
