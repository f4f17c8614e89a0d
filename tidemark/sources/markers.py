"""Numbers, small files and appends for writers that run at the same time.

A marker is a file created only if it is not there: ``create`` without
overwriting, which HDFS-like stores do atomically; on a local disk the Java
runtime's exclusive create does it (the local Hadoop file system looks first and
creates then).  Writers that race for a number see one winner; the others take
the next one.  A writer that dies leaves a gap, never a number twice.

Appends are written to a folder of their own beside the table's files (readers
skip names that begin with ``_``) and moved in when they are whole: two Spark
jobs that append to one folder would clear each other's temporary files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_TAKEN = ("FileAlreadyExistsException", "already exists")


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def create_exclusive(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create the file with the text; False if it is there already (its content is left alone)."""
    jvm = spark.sparkContext._jvm
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    data = bytearray(text.encode())
    try:
        if fs.getUri().getScheme() == "file":
            nio = jvm.java.nio.file
            target = nio.Paths.get(p.toUri().getPath(), spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0))
            # written aside first: the link appears at once, with its content, or not at all
            aside = nio.Files.createTempFile(target.getParent(), ".", ".tmp", spark.sparkContext._gateway.new_array(nio.attribute.FileAttribute, 0))
            try:
                nio.Files.write(aside, bytes(data), spark.sparkContext._gateway.new_array(nio.OpenOption, 0))
                nio.Files.createLink(target, aside)
            finally:
                nio.Files.deleteIfExists(aside)
        else:
            out = fs.create(p, False)
            out.write(bytes(data))
            out.close()
    except Py4JJavaError as e:
        if any(t in str(e.java_exception) for t in _TAKEN):
            return False
        raise
    return True


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """The numbers taken in a folder, ascending (empty if it is not there)."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(p)]
    return sorted(int(n.split(".")[0]) for n in names if n.split(".")[0].isdigit())


def take_number(spark: SparkSession, folder: str, least: int = 1, text: Callable[[int], str] | None = None, ending: str = "") -> int:
    """The smallest number from ``least`` that is above all taken ones, taken by this call alone."""
    while True:
        n = max([least - 1, *numbers(spark, folder)]) + 1
        if create_exclusive(spark, f"{folder}/{n:010d}{ending}", text(n) if text else ""):
            return n


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's content."""
    sc = spark.sparkContext
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return sc._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def safe_name(name: str) -> str:
    """A name as one path element."""
    return quote(name, safe="") or "%"


def data_files(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """{folder below ``path``: data files of a Parquet table}, by listing."""
    fs, p = _fs(spark, path)
    root = fs.makeQualified(p).toString()
    out: dict[str, list[str]] = {}
    found = fs.listFiles(p, True)
    while found.hasNext():
        f = found.next().getPath()
        folder = fs.makeQualified(f.getParent()).toString()[len(root):]
        if not f.getName().startswith(("_", ".")) and "/_" not in folder and f.getName().endswith(".parquet"):
            out.setdefault(folder, []).append(f.toString())
    return out


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), max_records: int = 0) -> None:
    """Append ``df`` to the Parquet table at ``path``; file names are unique, so nothing is written over."""
    spark = df.sparkSession
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    staging = f"{path.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", max_records).partitionBy(*partition_by).parquet(staging)
    fs, _ = _fs(spark, path)
    for folder, files in data_files(spark, staging).items():
        fs.mkdirs(jpath(path + folder))
        for f in files:
            if not fs.rename(jpath(f), jpath(f"{path}{folder}/{jpath(f).getName()}")):
                raise OSError(f"could not move {f}")
    fs.delete(jpath(staging), True)
