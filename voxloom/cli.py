"""Command line: ``python -m voxloom.cli COMMAND ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from .operators import pairs, tables
from .sources import npz, storage, transcripts


def _segments(spark: SparkSession, path: str) -> DataFrame:
    if npz.detect_format(spark, path) == "npz":
        return npz.readable(npz.scan_npz(spark, path))
    return spark.read.parquet(path)


def _written(spark: SparkSession, path: str, rebuild: bool) -> bool:
    """Whether an output is there and stays."""
    return not rebuild and storage.exists(spark, path)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="voxloom")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, says in (("segments", "transcripts to validated segments"), ("table", "segment archives to one table"), ("pairs", "segments to reference/target pairs"),
                       ("stats", "statistics of a segments table"), ("copy", "files that a target lacks")):
        one = commands.add_parser(name, help=says)
        one.add_argument("source")
        if name != "stats":
            one.add_argument("target")
        if name in ("segments", "table", "pairs"):
            one.add_argument("--rebuild", action="store_true", help="write again what is there")
        if name in ("table", "copy"):
            one.add_argument("--channels", nargs="*")
        if name == "copy":
            one.add_argument("--suffix", default=".npz")
            one.add_argument("--limit", type=int)
            one.add_argument("--dry-run", action="store_true")
        if name == "pairs":
            one.add_argument("--scope", choices=("channel", "recording"), default="channel")
            one.add_argument("--min-duration", type=float, default=0.5)
            one.add_argument("--max-duration", type=float, default=15.0)
            one.add_argument("--min-segments", type=int, default=2)
            one.add_argument("--max-pairs", type=int)
            one.add_argument("--seed", type=int, default=42)
    a = parser.parse_args(argv)
    spark = SparkSession.builder.appName("voxloom").getOrCreate()
    if a.command in ("segments", "table", "pairs") and _written(spark, a.target, a.rebuild):
        print(f"{a.target} is there already; --rebuild writes it again")
        return
    if a.command == "segments":
        rows = transcripts.parse_transcripts(transcripts.read_transcripts(spark, a.source), "file", "json")
        transcripts.valid_segments(rows).write.mode("overwrite").parquet(a.target)
    elif a.command == "table":
        rows = npz.readable(npz.scan_npz(spark, a.source, a.channels))
        rows.write.mode("overwrite").partitionBy("channel").parquet(a.target)
    elif a.command == "pairs":
        made = pairs.paired_dataset(_segments(spark, a.source), a.scope, a.min_duration, a.max_duration, a.min_segments, a.max_pairs, a.seed)
        made.write.mode("overwrite").parquet(a.target)
    elif a.command == "stats":
        tables.dataset_stats(_segments(spark, a.source)).show(truncate=False)
    else:
        storage.copy_missing(spark, a.source, a.target, a.suffix, a.channels, a.limit, a.dry_run).show(10, truncate=False)


if __name__ == "__main__":
    main()
