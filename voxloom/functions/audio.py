"""Waveforms as arrays of floats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def slice_by_time(audio: Column, start_ms: Column, end_ms: Column, rate: int) -> Column:
    """Samples of a time range.  Times truncate to samples; the range is cut to the
    array, and negative times count as 0."""
    first = F.greatest((start_ms * rate / 1000).cast("long"), F.lit(0))
    last = F.least(F.greatest((end_ms * rate / 1000).cast("long"), F.lit(0)), F.size(audio).cast("long"))
    return F.slice(audio, (first + 1).cast("int"), F.greatest(last - first, F.lit(0)).cast("int"))


def duration_sec(audio: Column, rate: Column | int) -> Column:
    """X20."""
    return F.size(audio) / (F.lit(rate) if isinstance(rate, int) else rate)


def mono(left: Column, right: Column) -> Column:
    """The mean of two channels."""
    return F.zip_with(left, right, lambda a, b: (a + b) / 2)


def rounded(x: Column, digits: int) -> Column:
    """Halves away from 0 in binary arithmetic, as C and SQL engines round doubles: what is
    negative and rounds to nothing is -0.0, where Spark's own decimal ``round`` gives 0.0."""
    y = x * 10.0**digits
    near = F.rint(y)
    whole = F.when(F.abs(y - near) == 0.5, y + F.signum(y) * 0.5).otherwise(near) / 10.0**digits
    return F.when(F.isnan(whole) | (F.abs(whole) == float("inf")), x).otherwise(whole)


def as_float32(audio: Column) -> Column:
    """X23."""
    return audio.cast("array<float>")


def overlap_add(frames: DataFrame, keys: list[str], index: str, samples: str, stride: int) -> DataFrame:
    """Frames of a key, number ``index`` starting at ``index * stride``, to one waveform.

    Sample j of n weighs ``1 - (j + 1) / (n + 1)``; a position is the weighted mean of the
    samples on it.  Returns the keys, ``audio`` and ``gap`` (a position without a sample).
    Positions are summed in the shuffle's map side; a key's waveform is one array."""
    n = F.size(samples)
    placed = frames.select(*keys, F.col(index).alias("__i"), n.alias("__n"), F.posexplode(samples).alias("__j", "__x")).select(
        *keys, (F.col("__i") * stride + F.col("__j")).alias("__at"), F.col("__x").cast("double").alias("__x"), (1 - (F.col("__j") + 1.0) / (F.col("__n") + 1)).alias("__w")
    )
    summed = placed.groupBy(*keys, "__at").agg((F.sum(F.col("__w") * F.col("__x")) / F.sum("__w")).alias("__x"))
    whole = summed.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("__at", "__x"))).alias("__all"), F.max("__at").alias("__last"))
    return whole.select(*keys, F.transform("__all", lambda s: s["__x"]).alias("audio"), (F.col("__last") + 1 != F.size("__all")).alias("gap"))
