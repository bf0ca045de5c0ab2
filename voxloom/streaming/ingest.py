"""Incremental ingest: what arrives in a folder is taken in once.

A file-source stream with ``availableNow`` keeps, in its checkpoint, which files it has
seen; this is the engine's resume for new channels and new recordings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.work import work_folder


def ingest_new(spark: SparkSession, source: str, target: str, checkpoint: str, schema, columns: list[str] | None = None) -> None:
    """Append rows of files that have arrived in ``source`` since the last call to ``target``."""
    arriving = spark.readStream.schema(schema).parquet(source)
    if columns:
        arriving = arriving.select(*columns)
    arriving.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def drained(spark: SparkSession, source: str, columns: list[str]) -> DataFrame:
    """All rows that a stream over ``source`` delivers until now, as a table."""
    schema = spark.read.parquet(source).schema
    base = work_folder(spark)
    # A glob, so that a single file counts as a source of files too.
    ingest_new(spark, source[:-1] + "[" + source[-1] + "]", f"{base}/out", f"{base}/checkpoint", schema, columns)
    return spark.read.parquet(f"{base}/out")
