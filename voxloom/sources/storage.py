"""Objects of any store that Hadoop's file system reaches: list, look, copy, delete.

Failures raise; nothing is answered with False or an empty list by mistake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import in_channels
from .work import work_folder


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def listing(spark: SparkSession, path: str, suffix: str = "", channels: list[str] | None = None) -> DataFrame:
    """(path, size, modified) of all files below; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(path)
    return found.where(in_channels(F.col("path"), channels)).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def qualified(spark: SparkSession, path: str) -> str:
    """The path as listings write it, without a slash at its end."""
    fs, at = _at(spark, path)
    return fs.makeQualified(at).toString().rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    """S18."""
    fs, at = _at(spark, path)
    return bool(fs.exists(at))


def size(spark: SparkSession, path: str) -> int:
    """Bytes of one object."""
    fs, at = _at(spark, path)
    return int(fs.getFileStatus(at).getLen())


def delete(spark: SparkSession, path: str) -> bool:
    """Whether there was something to delete."""
    fs, at = _at(spark, path)
    return bool(fs.delete(at, True))


def put(spark: SparkSession, path: str, content: bytes) -> None:
    """Write one small object."""
    fs, at = _at(spark, path)
    out = fs.create(at, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def get(spark: SparkSession, path: str) -> bytes:
    """Read one small object."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def to_copy(source: DataFrame, target: DataFrame, source_root: str, target_root: str) -> DataFrame:
    """Files of ``source`` whose path below the root is not in ``target``: (path, size, to).

    Roots are as :func:`qualified` gives them."""
    below = lambda root: F.substring(F.col("path"), F.lit(len(root) + 1), F.length("path"))
    there = target.select(below(target_root).alias("below"))
    new = source.withColumn("below", below(source_root)).join(there, "below", "left_anti")
    return new.select("path", "size", F.concat(F.lit(target_root), "below").alias("to"))


def copy_missing(spark: SparkSession, source_root: str, target_root: str, suffix: str = "", channels: list[str] | None = None, limit: int | None = None, dry_run: bool = False) -> DataFrame:
    """Copy files that the target lacks; returns what was, or with ``dry_run`` would be, copied.

    Spark reads and writes stores itself, so this is for handing files to other programs."""
    source_root, target_root = qualified(spark, source_root), qualified(spark, target_root)
    there = listing(spark, target_root, suffix) if exists(spark, target_root) else spark.createDataFrame([], "path string, size long, modified timestamp")
    plan = to_copy(listing(spark, source_root, suffix, channels), there, source_root, target_root)
    if limit is not None:
        plan = plan.orderBy("path").limit(limit)
    # Written out: what was to copy must not be listed again once it is there.
    kept = work_folder(spark)
    plan.write.parquet(kept)
    plan = spark.read.schema(plan.schema).parquet(kept)
    if not dry_run:
        conf, util = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.FileUtil
        for row in plan.toLocalIterator():
            (a, at), (b, to) = _at(spark, row.path), _at(spark, row.to)
            util.copy(a, at, b, to, False, conf)
    return plan
