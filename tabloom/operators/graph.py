"""Graph table jobs on an edge DataFrame (src, dst[, w]) and node features.

Every step is a join on node ids plus an aggregate; two-hop questions are answered
with degree arithmetic rather than by materialising neighbour pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.core import hash_uniform
from ..operators.rank import ordered_scan, top_k_per_group
from ..session import written


def neighbour_pool(edges: DataFrame, nodes: DataFrame, feat: str) -> DataFrame:
    """Per src the mean, max and sum of neighbour features."""
    j = edges.join(nodes.select(F.col("id").alias("dst"), F.col(feat).alias("x")), "dst")
    return j.groupBy("src").agg(F.avg("x").alias("mean_pool"), F.max("x").alias("max_pool"), F.sum("x").alias("sum_pool"),
                                 F.count("x").alias("n"))


def gin_sum(edges: DataFrame, nodes: DataFrame, feat: str, eps: float = 0.1) -> DataFrame:
    """(1 + eps) * x_self + sum of neighbour features."""
    pooled = neighbour_pool(edges, nodes, feat)
    return (nodes.select(F.col("id").alias("src"), F.col(feat).alias("x")).join(pooled, "src", "left")
            .select("src", ((1 + eps) * F.col("x") + F.coalesce("sum_pool", F.lit(0.0))).alias("h")))


def sym_norm_propagate(edges: DataFrame, nodes: DataFrame, feat: str) -> DataFrame:
    """One step of D^-1/2 (A + I) D^-1/2 X on an undirected graph; ``edges`` may repeat and hold self loops.

    The self loop is added by arithmetic: features are scaled by 1 / sqrt(degree) on the node table, travel over one
    join with the edges (both directions, made distinct and written once, like the scaled nodes) and are scaled again where they arrive. Ends of
    edges that are no node send nothing; they receive, with their number of neighbours as degree."""
    ends = F.array(F.struct(F.col("src").alias("src"), F.col("dst").alias("dst")), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    und = written(edges.filter(F.col("src") != F.col("dst")).select(F.inline(ends)).distinct(), "edges")
    degree = und.groupBy("src").agg(F.count(F.lit(1)).cast("double").alias("n"))
    own = nodes.select(F.col("id").alias("src"), F.col(feat).cast("double").alias("x"), F.lit(1.0).alias("loop"))
    scaled = own.join(degree, "src", "full").select("src", (F.coalesce("n", F.lit(0.0)) + F.coalesce("loop", F.lit(0.0))).alias("d"), "x", "loop")
    scaled = written(scaled.select("src", "d", "loop", (F.col("x") / F.sqrt("d")).alias("y")), "nodes")
    sent = scaled.filter(F.col("y").isNotNull()).select(F.col("src").alias("dst"), "y")
    got = und.join(sent, "dst").groupBy("src").agg(F.sum("y").alias("s"))
    out = scaled.join(got, "src", "left").filter(F.col("loop").isNotNull() | F.col("s").isNotNull())
    total = F.when(F.col("s").isNotNull() | F.col("y").isNotNull(), F.coalesce("s", F.lit(0.0)) + F.coalesce("y", F.lit(0.0)))
    return out.select("src", (total / F.sqrt("d")).alias("h"))


def smoothness(edges: DataFrame, nodes: DataFrame, feat: str, weight: str | None = None) -> DataFrame:
    """1/2 * sum over directed edges of w * (f_src - f_dst)^2."""
    f = nodes.select("id", F.col(feat).alias("f"))
    j = (edges.join(f.select(F.col("id").alias("src"), F.col("f").alias("fs")), "src")
         .join(f.select(F.col("id").alias("dst"), F.col("f").alias("fd")), "dst"))
    w = F.col(weight) if weight else F.lit(1.0)
    return j.agg((0.5 * F.sum(w * F.pow(F.col("fs") - F.col("fd"), 2))).alias("smoothness"))


def metapath_counts(edges: DataFrame) -> DataFrame:
    """Number of src -> dst -> src' two-hop paths (src' != src) per src, from
    distinct edges and dst degrees, without listing the neighbour pairs."""
    e = edges.select("src", "dst").distinct()
    deg = e.groupBy("dst").agg(F.count(F.lit(1)).alias("deg"))
    return e.join(deg, "dst").groupBy("src").agg(F.sum(F.col("deg") - 1).alias("paths"),
                                                F.count(F.lit(1)).alias("neighbours"))


def transitions(events: DataFrame, key: str, ts: str, tiebreak: str, item: str) -> DataFrame:
    """Consecutive (item -> next item) pairs per key counted over all keys."""
    n = ordered_scan(events.select(key, ts, tiebreak, item), [(ts, True), (tiebreak, True)], by=[key], rank_col="_r", leads=[item])
    return (n.filter(F.col(f"{item}_next").isNotNull())
            .groupBy(F.col(item).alias("src"), F.col(f"{item}_next").alias("dst")).agg(F.count(F.lit(1)).alias("n")))


def sample_neighbours(edges: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """At most k neighbours per src, chosen by a seeded hash (top-k per group)."""
    e = edges.select("src", "dst").distinct().withColumn("_h", hash_uniform(["src", "dst"], seed))
    return top_k_per_group(e, ["src"], [F.col("_h"), F.col("dst")], k).drop("_h")
