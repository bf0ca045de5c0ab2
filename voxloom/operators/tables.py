"""Filters, statistics, resume, lookups and ordering over segment tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


# Filters and their counters.


def encode_eligible(audio: Column, duration: Column, low: float = 0.1, high: float = 200.0) -> Column:
    """a waveform that is not empty, with a duration in the closed range."""
    return F.coalesce((F.size(audio) > 0) & duration.between(low, high), F.lit(False))


def codes_or(existing: Column, eligible: Column, encoded: Column, force: bool = False) -> Column:
    """Codes that are there stay unless forced; ineligible rows get an empty array."""
    kept = F.lit(not force) & F.coalesce(F.size(existing) > 0, F.lit(False))
    return F.when(kept, existing).when(eligible, encoded).otherwise(F.array().cast("array<int>"))


def skip_counters(rows: DataFrame, duration: Column, codes: Column, low: float = 0.5, high: float = 15.0, codes_first: bool = True) -> DataFrame:
    """How many rows stay, and how many go for which reason; the test that comes first
    takes the rows that fail both."""
    no_codes = ~F.coalesce(F.size(codes) > 0, F.lit(False))
    bad_time = ~F.coalesce(duration.between(low, high), F.lit(False))
    first, second = (no_codes, bad_time) if codes_first else (bad_time, no_codes)
    names = ("skipped_no_codes", "skipped_duration") if codes_first else ("skipped_duration", "skipped_no_codes")
    return rows.agg(F.count_if(~no_codes & ~bad_time).alias("kept"), F.count_if(first).alias(names[0]), F.count_if(~first & second).alias(names[1]))


def filter_delta(rows: DataFrame, keep: Column) -> DataFrame:
    """A10: rows before and after a filter, in one pass."""
    return rows.agg(F.count("*").alias("before"), F.count_if(keep).alias("after"), F.count_if(~F.coalesce(keep, F.lit(False))).alias("removed"))


# Statistics.


def dataset_stats(rows: DataFrame, channel: str = "channel", speaker: str = "speaker_id", duration: str = "duration_sec") -> DataFrame:
    """Rows, channels, speakers (by id alone) and hours; sums are in double."""
    return rows.agg(
        F.count("*").alias("segments"), F.array_sort(F.collect_set(channel)).alias("channels"), F.count_distinct(speaker).alias("speakers"),
        (F.sum(F.col(duration).cast("double")) / 3600).alias("hours"),
    )


def channel_counts(rows: DataFrame, channel: str = "channel") -> DataFrame:
    """A06."""
    return rows.groupBy(channel).agg(F.count("*").alias("n"))


def rate_stats(rows: DataFrame, seconds: str, audio_seconds: str) -> DataFrame:
    """Time of encoding, segments a second, and the real-time factor."""
    total = F.sum(seconds)
    return rows.agg(
        total.alias("total_sec"), F.avg(seconds).alias("avg_sec"), F.min(seconds).alias("min_sec"), F.max(seconds).alias("max_sec"),
        (F.count("*") / total).alias("segments_per_sec"), (F.sum(audio_seconds) / total).alias("realtime_factor"),
    )


def eta_hours(rows: Column, per_second: Column) -> Column:
    """A12."""
    return rows / per_second / 3600


def estimated_gb(files: Column) -> Column:
    """Of files of 0.35 MB."""
    return files * 0.35 / 1024


def mb_per_second(size: Column, seconds: Column) -> Column:
    """Null for no time."""
    return F.when(seconds > 0, size / (1024 * 1024) / seconds)


def batch_count(rows: Column, size: int) -> Column:
    """A17."""
    return F.ceil(rows / size)


# Resume.


def pending(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not in the manifest."""
    return rows.join(done.select(*keys), keys, "left_anti")


def merged_manifest(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of both, each once."""
    return old.select(*keys).unionByName(new.select(*keys)).distinct()


# Lookups.


def lookup_with_default(rows: DataFrame, names: DataFrame, key: str, value: str, bound: int = 100_000) -> DataFrame:
    """``value`` of the key, or the key itself.  The table of names is broadcast
    if it has ``bound`` rows at most."""
    names = names.select(F.col(key).alias("__key"), F.col(value).alias("__value"))
    small = F.broadcast(names) if names.limit(bound + 1).count() <= bound else names
    return rows.join(small, rows[key] == F.col("__key"), "left").withColumn(value, F.coalesce("__value", key)).drop("__key", "__value")


def first_with_prefix(prefixes: DataFrame, paths: DataFrame, prefix: str, path: str) -> DataFrame:
    """Of each prefix the least path that starts with it; prefixes without drop out.

    A path is cut to each length that a prefix has (a few, and never more than a path's own
    characters), the least path of each cut is an aggregate, and prefixes join on equality."""
    wanted = prefixes.select(prefix).where(F.col(prefix).isNotNull()).distinct()
    lengths = sorted(r[0] for r in wanted.select(F.length(prefix)).distinct().collect())
    if not lengths:
        return wanted.withColumn(path, F.lit(None).cast("string")).limit(0)
    cuts = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length(path))
    heads = paths.select(path, F.explode(cuts).alias("__n")).groupBy(F.substring(F.col(path), F.lit(1), F.col("__n")).alias(prefix)).agg(F.min(path).alias(path))
    return wanted.join(heads, prefix)


# Order, limits and unions.


def first_rows(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first rows of a stated order."""
    return rows.orderBy(*order).limit(n)


def row_numbers(rows: DataFrame, order: str, name: str = "row", part_rows: int = 1_000_000) -> DataFrame:
    """0-based numbers of the whole table in order of a unique numeric column.

    Approximate quantiles cut the column into parts of about ``part_rows`` rows (8 to 1,024
    parts); rows are numbered within a part, and a count per part gives where each starts,
    so no task sees all rows."""
    parts = min(1024, max(8, rows.count() // part_rows))
    cuts = rows.agg(F.percentile_approx(order, [k / parts for k in range(1, parts)])).first()[0] or []
    part = F.size(F.filter(F.array(*map(F.lit, sorted(set(cuts)))), lambda c: c <= F.col(order))) if cuts else F.lit(0)
    parted = rows.withColumn("__part", part)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parted.groupBy("__part").agg(F.count("*").alias("__n")).select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    within = parted.withColumn("__at", F.row_number().over(Window.partitionBy("__part").orderBy(order)))
    # ``parts`` rows at most.
    return within.join(F.broadcast(starts), "__part").withColumn(name, F.col("__start") + F.col("__at") - 1).drop("__part", "__at", "__start")


def row_range(rows: DataFrame, order: str, start: int, stop: int) -> DataFrame:
    """Rows ``start`` to ``stop`` (not included) of the order."""
    return row_numbers(rows, order).where((F.col("row") >= start) & (F.col("row") < stop))


def chunked(rows: DataFrame, order: str, size: int) -> DataFrame:
    """The rows with the number of their chunk."""
    return row_numbers(rows, order).withColumn("chunk", F.floor(F.col("row") / size))


def union_all(parts: list[DataFrame]) -> DataFrame:
    """By name; a missing column is null."""
    whole, *rest = parts
    for part in rest:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole
