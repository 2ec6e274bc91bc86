"""Shared scratch space for tables that have to be written between steps.

Every folder handed out lies below one folder of the session, which the file
system removes when the driver's JVM ends.  Nothing is removed earlier, because
a returned frame may still read it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_session_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the cluster's ``spark.checkpoint.dir``.

    Only a local session, whose executors all see this machine's disk, may fall
    back to a temporary folder when that setting is missing.
    """
    app = spark.sparkContext.applicationId
    if app not in _session_folders:
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("Set spark.checkpoint.dir to a folder every executor can reach")
            base = tempfile.mkdtemp(prefix="aerolake-")
        _session_folders[app] = _removed_at_exit(spark, f"{base.rstrip('/')}/session-{uuid.uuid4().hex}")
    return f"{_session_folders[app]}/{label}-{uuid.uuid4().hex}"


def _removed_at_exit(spark: SparkSession, folder: str) -> str:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder
