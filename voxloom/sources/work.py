"""Folders for intermediate files that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession


def work_folder(spark: SparkSession) -> str:
    """A new folder, deleted when the process ends, in the shared checkpoint folder; one of our own where none is set and the master is local."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = root or "file://" + tempfile.mkdtemp(prefix="voxloom-")
    folder = f"{root.rstrip('/')}/voxloom/work-{uuid.uuid4().hex}"
    atexit.register(_delete, spark, folder)
    return folder


def _delete(spark: SparkSession, path: str) -> None:
    try:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001  the session may have ended before its files go
        pass
