"""Segment tables: made from rows, read from parts, written, measured."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.pairs import SEGMENT_SCHEMA


def segments_from_rows(spark: SparkSession, rows: Iterable[dict]) -> DataFrame:
    """A segments table of the declared schema; missing fields are null, no codes an empty array."""
    names = SEGMENT_SCHEMA.names
    found = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], SEGMENT_SCHEMA)
    return found.withColumn("codes", F.coalesce("codes", F.array().cast("array<int>")))


def read_parts(spark: SparkSession, root: str) -> DataFrame:
    """All Parquet parts below a folder, one table per recording or many, as one."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(root)


def write_segments(segments: DataFrame, path: str) -> None:
    """One folder for each channel, so that readers of a channel open no other."""
    segments.write.partitionBy("channel").parquet(path)


def recording_metrics(segments: DataFrame) -> DataFrame:
    """Of each recording its segments, seconds, encoded segments, and when that was counted."""
    return segments.groupBy(F.regexp_extract("audio_id", r"(?s)^(.*)_seg_", 1).alias("recording")).agg(
        F.count("*").alias("segments"), F.sum(F.col("duration_sec").cast("double")).alias("seconds"), F.count_if(F.size("codes") > 0).alias("encoded"),
        F.current_timestamp().alias("counted_at"),
    )


def stamped(manifest: DataFrame) -> DataFrame:
    """Manifest rows with the time at which they were added."""
    return manifest.withColumn("added_at", F.current_timestamp())
