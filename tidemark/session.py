"""Session helper.

Settings are the ones a cluster job wants: AQE (runtime broadcast of small
sides with a measured size, partition coalescing, skew-join splitting), UTC
session time, Arrow for pandas transfer, no UI server.  Existing settings of a
running session (for example a cluster-provided ``spark.checkpoint.dir``) are
never overridden.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.locality.wait": "0s",
    "spark.driver.memory": "8g",
}


def get_session(master: str | None = None, app: str = "tidemark",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active  # a running (cluster- or caller-configured) session is used as is
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_scratch: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The setting is read, never changed.  Where it is unset, a local session
    (one machine) gets a temporary folder; on a cluster that is an error,
    because other machines would not see such a folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    app = session_key(spark)
    if app not in _local_scratch:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        _local_scratch[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_scratch[app]


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Functions that run on the executors import it; ``addPyFile`` makes that
    work from any working directory and without an installation there.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for top, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def session_key(spark: SparkSession) -> str:
    """Identifies the running application (memo keys for per-run tables)."""
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def scratch_folder(spark: SparkSession) -> str:
    """This application's folder of intermediate tables under the checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tidemark-{session_key(spark)}"


_used: dict[str, SparkSession] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table; the tables go when the application ends."""
    folder = scratch_folder(spark)
    if folder not in _used:
        _used[folder] = spark
        atexit.register(_at_exit, spark)
    return f"{folder}/{name}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder wherever it lies; nothing happens if it is not there."""
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables (results that still read them become invalid)."""
    sc = spark.sparkContext
    if sc._jsc is None:  # already stopped: the folder could only be reached by another session
        return
    folder = scratch_folder(spark)
    delete_path(spark, folder)
    _used.pop(folder, None)


def _at_exit(spark: SparkSession) -> None:
    try:
        clear_scratch(spark)
    except (Py4JError, OSError):
        pass  # the JVM is gone already
