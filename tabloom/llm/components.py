"""Connected components of an edge list by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Written, so that both sides of the join are shuffled for it: only then can Spark split a hub's edges.
    least = materialise(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")))
    out = materialise(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
    forget(least)
    return out


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = materialise(down.groupBy("a").agg(F.min("b").alias("m")))
    moved = down.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    out = materialise(moved.union(least.select("a", F.col("m").alias("b"))).distinct())
    forget(least)
    return out


def component_labels(edges: DataFrame) -> DataFrame:
    """(a, b): for every node that is not the smallest of its component, the node and the smallest one.

    ``edges``: a, b (long, not null); loops are dropped. Each round is written to the shared folder
    and compared with the last by count and a sum of hashes; a component of n nodes needs about
    log(n) rounds. Tables of earlier rounds are removed.
    """
    now = materialise(edges.filter("a != b").select("a", "b").distinct())
    mark = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    last = mark(now)
    while last[0]:
        large = _large_star(now)
        forget(now)
        now = _small_star(large)
        forget(large)
        if (new := mark(now)) == last:
            break
        last = new
    return now.select("a", "b")
