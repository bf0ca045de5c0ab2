"""Segment files in compressed numpy archives: scan (S05), sink (S06), format detection."""

from __future__ import annotations

import io
import posixpath
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .storage import exists, listing, put

_SCHEMA = (
    "path string, audio array<float>, codes array<int>, text string, speaker_id string, channel string, gender string, dialect string, tone string,"
    " duration_sec double, audio_id string, error string"
)
_STRINGS = ("text", "speaker_id", "channel", "gender", "dialect", "tone")


def _row(path: str, content: bytes) -> dict:
    """One archive's fields; what cannot be read gives the reason in ``error``.  Nothing is unpickled."""
    row = dict.fromkeys(("audio", "codes", *_STRINGS, "duration_sec", "audio_id"), None) | {"path": path, "error": None}
    try:
        with np.load(io.BytesIO(content), allow_pickle=False) as data:
            row["audio"] = np.asarray(data["audio"], np.float32).tolist()
            row["codes"] = np.asarray(data["codes"]).astype(np.int32).reshape(-1).tolist() if "codes" in data else []
            for k in _STRINGS:
                row[k] = str(data[k])
            row["duration_sec"] = float(data["duration_sec"])
            row["audio_id"] = str(data["audio_id"]) if "audio_id" in data else None
    except Exception as e:  # noqa: BLE001  any broken file goes to quarantine
        row |= {"error": f"{type(e).__name__}: {e}"[:300]}
    return row


def scan_npz(spark: SparkSession, path: str, channels: list[str] | None = None) -> DataFrame:
    """All archives under a path of any store that Spark reads, with ``error`` for broken ones.

    Channels, named by directory, are cut off in the listing, before any file is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.npz").load(path)
    if channels:
        found = found.where(F.element_at(F.split("path", "/"), -2).isin(channels))

    schema = to_arrow_schema(StructType.fromDDL(_SCHEMA))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([_row(p, c) for p, c in zip(*[x.to_pylist() for x in batch.columns], strict=True)], schema=schema)

    return found.select("path", "content").mapInArrow(run, _SCHEMA)


def readable(rows: DataFrame) -> DataFrame:
    """The segments table: ten fields, audio with its rate, durations as float."""
    audio = F.struct(F.col("audio").alias("array"), F.lit(16000).alias("sampling_rate"))
    return rows.where("error is null").select(audio.alias("audio"), "codes", *_STRINGS, F.col("duration_sec").cast("float").alias("duration_sec"), "audio_id")


def quarantine(rows: DataFrame) -> DataFrame:
    """Files that could not be read, and why."""
    return rows.where("error is not null").select("path", "error")


def _archive(row: dict) -> bytes:
    out = io.BytesIO()
    fields = {k: np.array(row[k] or "") for k in (*_STRINGS, "audio_id")}
    np.savez_compressed(out, audio=np.array(row["audio"] or [], np.float32), codes=np.array(row["codes"] or [], np.int32), duration_sec=np.array(float(row["duration_sec"])), **fields)
    return out.getvalue()


def write_npz(segments: DataFrame, path: str) -> DataFrame:
    """Write one archive per row to ``path/channel/audio_id.npz``; returns (path, bytes).

    The archives are made on the executors and written through a Spark sink of binary
    rows; :func:`export_files` turns such a table into files."""
    schema = "path string, content binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            names = [posixpath.join(path, r["channel"] or "unknown", f"{r['audio_id']}.npz") for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([_archive(r) for r in rows], pa.binary())], names=["path", "content"])

    flat = segments.select(F.col("audio.array").alias("audio"), "codes", *_STRINGS, F.col("duration_sec").cast("double").alias("duration_sec"), "audio_id")
    return flat.mapInArrow(run, schema)


def export_files(files: DataFrame) -> int:
    """Write (path, content) rows as files, through Hadoop's file system, a few at a time."""
    n = 0
    for row in files.toLocalIterator():
        put(files.sparkSession, row.path, bytes(row.content))
        n += 1
    return n


def detect_format(spark: SparkSession, path: str) -> str:
    """``dataset`` or ``npz``; an error for a path that does not exist or is neither.

    Markers of a dataset (its info file, or Parquet files) come before archives."""
    if not exists(spark, path):
        raise ValueError(f"path does not exist: {path}")
    if exists(spark, posixpath.join(path, "dataset_info.json")) or exists(spark, posixpath.join(path, "_SUCCESS")):
        return "dataset"
    if not listing(spark, path, ".npz").isEmpty():
        return "npz"
    raise ValueError(f"could not detect the format of {path}")


def channel_files(spark: SparkSession, path: str) -> DataFrame:
    """Archives one level below a path, with their channel."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(posixpath.join(path, "*"))
    return found.select(F.element_at(F.split("path", "/"), -2).alias("channel"), "path", F.col("length").alias("size"))
