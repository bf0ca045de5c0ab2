"""Intermediate tables in the cluster's shared checkpoint folder.

Lineage is cut by writing Parquet into the folder named by
``spark.checkpoint.dir`` and reading it again, so a lost executor costs a
re-read and never a recomputation of what came before.  Only where the setting
is absent and the master is local (tests, notebooks) a folder of our own is used; on a
cluster without the setting a call fails, since executors would write to their own disks.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_root: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The shared folder; our own only where the session names none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_root:
        _own_root[app] = "file://" + tempfile.mkdtemp(prefix="voxloom-")
    return _own_root[app]


def delete(spark: SparkSession, path: str) -> None:
    """Remove a path through Hadoop's file system, whatever store it is in."""
    try:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001  the session may have ended before its files go
        pass


class Scratch:
    """Tables that one operator call writes; ``drop`` frees those no longer read."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_root(spark)}/voxloom/{name}-{uuid.uuid4().hex}"
        self.count = 0
        self.paths: dict[int, str] = {}
        atexit.register(delete, spark, self.base)

    def save(self, df: DataFrame, files: int | None = None) -> DataFrame:
        """Write and read again.  ``files`` bounds the files of a table known to be small;
        otherwise small shuffle partitions are joined up to the advisory size, since each
        file costs the store several calls."""
        self.count += 1
        path = f"{self.base}/{self.count}"
        first = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
        before = self.spark.conf.get(first, None)
        self.spark.conf.set(first, "false")
        try:
            (df.coalesce(files) if files else df).write.parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(first)
            else:
                self.spark.conf.set(first, before)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(back)] = path
        back._scratch_path = path
        return back

    def drop(self, table: DataFrame) -> None:
        path = getattr(table, "_scratch_path", None)
        if path:
            delete(self.spark, path)
