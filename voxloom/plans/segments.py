"""Whole jobs: transcripts and audio to segments, segments to segments with codes.

Filters stand before Python stages by construction: transcripts are validated and what
is done already is taken away before any audio is opened, each recording is decoded
once however many segments it has, and a codec sees only rows that need codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.audio import duration_sec, slice_by_time
from ..operators.tables import codes_or, encode_eligible, first_with_prefix, pending
from ..sources.audio import Decoder, decode_wav, scan_audio
from ..sources.storage import listing, qualified

FIELDS = ("audio_id", "text", "speaker_id", "gender", "dialect", "tone", "duration_sec", "start_ms", "end_ms")


def build_segments(
    spark: SparkSession, segments: DataFrame, audio_root: str, channel: str, done: DataFrame | None = None, rate: int = 16000, decode: Decoder = decode_wav
) -> DataFrame:
    """The segments table of one channel from valid segments and the recordings under ``audio_root``.

    A recording's file is the least path that starts with its name (so ``v1`` may take
    ``v10.wav`` where it has none of its own); recordings without a file drop out."""
    root = qualified(spark, audio_root)
    todo = segments if done is None else pending(segments, done, ["audio_id"])
    # A recording's own segments, in one row.
    whole = todo.groupBy("recording").agg(F.collect_list(F.struct(*FIELDS)).alias("parts")).withColumn("prefix", F.concat(F.lit(root + "/"), "recording"))
    files = listing(spark, root).select("path")
    found = whole.join(first_with_prefix(whole, files, "prefix", "path"), "prefix").select("path", "parts")
    sound = scan_audio(spark, root, rate, decode, wanted=found.select("path")).where("error is null").select("path", F.col("audio").alias("sound"))
    rows = sound.join(found, "path").select("sound", F.inline("parts"))
    cut = slice_by_time(F.col("sound"), F.col("start_ms"), F.col("end_ms"), rate)
    return rows.select(
        F.struct(cut.alias("array"), F.lit(rate).alias("sampling_rate")).alias("audio"), F.array().cast("array<int>").alias("codes"), "text", "speaker_id",
        F.lit(channel).alias("channel"), "gender", "dialect", "tone", F.col("duration_sec").cast("float").alias("duration_sec"), "audio_id",
    )


def add_codes(segments: DataFrame, encode, force: bool = False, low: float = 0.1, high: float = 200.0) -> DataFrame:
    """The segments with codes; ``encode`` is a column function.

    The codec gets null, and does nothing, for rows that keep theirs or are not eligible."""
    audio: Column = F.col("audio.array")
    eligible = encode_eligible(audio, duration_sec(audio, F.col("audio.sampling_rate")), low, high)
    needed = eligible if force else eligible & ~F.coalesce(F.size("codes") > 0, F.lit(False))
    coded = segments.withColumn("__new", encode(F.when(needed, audio)))
    return coded.withColumn("codes", codes_or(F.col("codes"), eligible, F.coalesce("__new", F.array().cast("array<int>")), force)).drop("__new")


def encode_pending(segments: DataFrame, done: DataFrame, encode, force: bool = False) -> tuple[DataFrame, DataFrame]:
    """Segments not in the manifest with their codes, and the manifest rows to append.

    Only rows that got codes enter the manifest, so a failed one is tried again."""
    coded = add_codes(pending(segments, done, ["audio_id"]), encode, force)
    return coded, coded.where(F.size("codes") > 0).select("audio_id")
