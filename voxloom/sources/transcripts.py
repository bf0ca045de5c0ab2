"""Transcript documents to segment rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import file_name, segment_id, text_present, transcript_base

SEGMENT = "struct<text:string,start_ms:double,end_ms:double,speaker_id:string,gender:string,dialect:string,tone:string>"
#: What a missing or null field counts as.
DEFAULTS = {"speaker_id": "UNKNOWN", "gender": "unknown", "dialect": "unknown", "tone": "neutral"}


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """(file, json) of each ``*.json`` under a path of any store that Spark reads."""
    found = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path)
    return found.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("json"))


def parse_transcripts(docs: DataFrame, file_col: str, json_col: str) -> DataFrame:
    """One row for each segment object: recording, idx (its place in the array) and its fields.

    A document is a bare array or an object with ``segments``; others give no rows (F18).
    Null fields count as missing, a deliberate difference from a failing document."""
    body = F.trim(F.col(json_col))
    array = F.when(body.startswith("["), F.from_json(body, f"array<{SEGMENT}>")).otherwise(F.from_json(F.get_json_object(body, "$.segments"), f"array<{SEGMENT}>"))
    rows = docs.select(transcript_base(file_name(F.col(file_col))).alias("recording"), F.posexplode(array).alias("idx", "s")).where("s is not null")
    return rows.select(
        "recording", F.col("idx").cast("long").alias("idx"), segment_id(F.col("recording"), F.col("idx")).alias("audio_id"), F.col("s.text").alias("text"),
        F.coalesce("s.start_ms", F.lit(0.0)).alias("start_ms"), F.coalesce("s.end_ms", F.lit(0.0)).alias("end_ms"), *[F.coalesce(F.col(f"s.{k}"), F.lit(v)).alias(k) for k, v in DEFAULTS.items()],
    )


def valid_segments(rows: DataFrame, least: float = 0.3) -> DataFrame:
    """segments with a text, of ``least`` seconds or more."""
    return rows.withColumn("duration_sec", (F.col("end_ms") - F.col("start_ms")) / 1000).where(text_present(F.col("text")) & (F.col("duration_sec") >= least))
