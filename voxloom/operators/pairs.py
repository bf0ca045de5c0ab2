"""Reference/target pairs of one speaker.

Keys travel first: groups are counted, pairs are formed of (group, id), and wide
payloads are joined to the pairs that stay.  A capped group never makes all its pairs:
its pairs are numbered 0 .. n(n-1)-1, ``cap`` of the numbers are drawn, and each is
decoded to two places in the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.text import recording_key

#: Rows of one group are numbered in so many parts, so a large group is no single task.
PARTS = 16
#: A prime larger than any number of pairs: steps of it visit all numbers of a group once.
STEP = (1 << 61) - 1


def speaker_key(scope: str, audio_id: str = "audio_id", channel: str = "channel") -> Column:
    """The first half of a group's key: the channel, or the recording that a segment is of."""
    if scope not in ("channel", "recording"):
        raise ValueError(f"speaker scope must be 'channel' or 'recording', not {scope!r}")
    return F.col(channel) if scope == "channel" else recording_key(F.col(audio_id))


def eligible(duration: Column, codes: Column, low: float = 0.5, high: float = 15.0) -> Column:
    """both bounds belong to the range; codes must not be null or empty."""
    return F.coalesce(duration.between(low, high) & (F.size(codes) > 0), F.lit(False))


def valid_speakers(rows: DataFrame, group: list[str], least: int = 2) -> DataFrame:
    """Groups with ``least`` rows or more, and their size ``n``."""
    return rows.groupBy(*group).agg(F.count("*").alias("n")).where(F.col("n") >= least)


def all_pairs(rows: DataFrame, group: list[str], key: str, least: int = 2) -> DataFrame:
    """(group, ref, target) of all ordered pairs of different rows of a group."""
    kept = rows.select(*group, key).join(valid_speakers(rows, group, least).select(*group), group, "left_semi")
    ref, target = (kept.withColumnRenamed(key, name) for name in ("ref", "target"))
    return ref.join(target, group).where(F.col("ref") != F.col("target"))


def _hex_number(text: Column) -> Column:
    """60 bits of a text's md5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def numbered(rows: DataFrame, group: list[str], key: str) -> DataFrame:
    """``rows`` with ``place``, 0 .. n-1 within the group, by (part, key).

    Rows are numbered within parts, and parts start where the ones before them end."""
    part = F.pmod(_hex_number(F.col(key).cast("string")), F.lit(PARTS)).alias("__part")
    parted = rows.select("*", part)
    starts = parted.groupBy(*group, "__part").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select(*group, "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    within = F.row_number().over(Window.partitionBy(*group, "__part").orderBy(key))
    ranked = parted.withColumn("__at", within)
    return ranked.join(starts, [*group, "__part"]).withColumn("place", F.col("__start") + F.col("__at") - 1).drop("__part", "__at", "__start")


def capped_pairs(rows: DataFrame, group: list[str], key: str, cap: int, seed: int = 42, least: int = 2) -> DataFrame:
    """(group, ref, target), ``min(n(n-1), cap)`` different pairs of each group.

    Which ones follows from the seed and the group alone."""
    sizes = valid_speakers(rows, group, least).withColumn("m", F.col("n") * (F.col("n") - 1)).where("m > 0")
    offset = F.pmod(_hex_number(F.concat_ws("|", F.lit(seed), *group)), F.col("m"))
    drawn = sizes.select(*group, "n", "m", F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.col("m"), F.lit(cap)) - 1)).alias("k"), offset.alias("offset"))
    number = F.pmod(F.lit(STEP) % F.col("m") * F.col("k") + F.col("offset"), F.col("m"))
    r = F.floor(number / (F.col("n") - 1)).cast("long")
    t = F.pmod(number, F.col("n") - 1)
    places = drawn.select(*group, r.alias("r"), (t + (t >= r).cast("long")).alias("t"))
    known = numbered(rows.select(*group, key), group, key)
    ref = known.withColumnRenamed("place", "r").withColumnRenamed(key, "ref")
    target = known.withColumnRenamed("place", "t").withColumnRenamed(key, "target")
    return places.join(ref, [*group, "r"]).join(target, [*group, "t"]).select(*group, "ref", "target")


def with_payload(pairs: DataFrame, rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The pairs with ``ref_*`` and ``target_*`` of each column, joined late."""
    for side in ("ref", "target"):
        own = rows.select(F.col(key).alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns])
        pairs = pairs.join(own, side)
    return pairs


def pair_counts(rows: DataFrame, group: list[str], cap: int | None = None, least: int = 2) -> DataFrame:
    """The group, n, and its number of pairs."""
    pairs = F.col("n") * (F.col("n") - 1)
    return valid_speakers(rows, group, least).withColumn("pairs", F.least(pairs, F.lit(cap)) if cap is not None else pairs)


def pair_stats(rows: DataFrame, group: list[str], cap: int | None = None, least: int = 2) -> DataFrame:
    """Over all groups, the sum, mean, least and largest number of pairs."""
    return pair_counts(rows, group, cap, least).agg(
        F.count("*").alias("speakers"), F.sum("pairs").alias("total_pairs"), F.avg("pairs").alias("avg_pairs"), F.min("pairs").alias("min_pairs"), F.max("pairs").alias("max_pairs")
    )


def paired_dataset(
    segments: DataFrame, scope: str = "channel", low: float = 0.5, high: float = 15.0, least: int = 2, cap: int | None = None, seed: int = 42
) -> DataFrame:
    """The paired table of 17 columns: eight ``ref_*``, eight ``target_*`` and ``channel``.

    ``segments`` needs ``audio_id``, which names a row."""
    columns = ["audio", "text", "codes", "speaker_id", "gender", "dialect", "tone", "duration_sec"]
    kept = segments.where(eligible(F.col("duration_sec").cast("double"), F.col("codes"), low, high))
    keys = kept.select(speaker_key(scope).alias("__scope"), F.col("speaker_id").alias("__speaker"), "audio_id")
    group = ["__scope", "__speaker"]
    pairs = all_pairs(keys, group, "audio_id", least) if cap is None else capped_pairs(keys, group, "audio_id", cap, seed, least)
    full = with_payload(pairs.select("ref", "target"), kept, "audio_id", [*columns, "channel"])
    return full.select(*[f"ref_{c}" for c in columns], *[f"target_{c}" for c in columns], F.col("ref_channel").alias("channel"))


#: A02-A05 want these columns of the segments table.
SEGMENT_SCHEMA = T.StructType(
    [
        T.StructField("audio", T.StructType([T.StructField("array", T.ArrayType(T.FloatType())), T.StructField("sampling_rate", T.IntegerType())])),
        T.StructField("codes", T.ArrayType(T.IntegerType())), T.StructField("text", T.StringType()), T.StructField("speaker_id", T.StringType()),
        T.StructField("channel", T.StringType()), T.StructField("gender", T.StringType()), T.StructField("dialect", T.StringType()),
        T.StructField("tone", T.StringType()), T.StructField("duration_sec", T.FloatType()), T.StructField("audio_id", T.StringType()),
    ]
)
