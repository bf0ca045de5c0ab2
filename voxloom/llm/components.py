"""Connected components by alternating large and small stars over DataFrames.

Both steps are an aggregate (combined on the map side) and a join on the node, so a
node with very many neighbours is neither collected nor a single task's burden:
AQE splits the side of the join that is skewed.  Each round is written to the
shared folder, which cuts lineage; two numbers per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import Scratch


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to the node's least neighbour."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, move to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("m").alias("a"), "b").unionAll(least.select(F.col("m").alias("a"), F.col("a").alias("b")))
    return moved.where("a <> b").distinct()


def connected_components(edges: DataFrame, scratch: Scratch, most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); the component is its least node.

    Loops and repeated edges change nothing; no edges give no rows."""
    now = scratch.save(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    mark = _mark(now)
    for _ in range(most_rounds):
        # Edges never become more, so their number bounds the files that are needed.
        after = scratch.save(_small_star(_large_star(now)), files=1 + mark[0] // 500_000)
        scratch.drop(now)
        now, (old, mark) = after, (mark, _mark(after))
        if old == mark:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionAll(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
