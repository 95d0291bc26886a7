"""Exact top-k inner products with an impact-ordered, score-at-a-time index.

Vectors become integers floor(256 * x). They are dealt to blocks by a hash of their id; a block
stores, for each impact level (the bit length of |component|, highest first), the posting segment
of that level: component number, vector, signed value, sorted by component. A batch of queries
processes the segments level by level and adds to all scores: a thin segment posting by posting, one
that holds most components of its block as the matrix it is. After each level, Cauchy-Schwarz over what a vector
has in lower levels bounds its final score; a query stops as soon as its k-th best lower bound
proves that few vectors can still be members, and those are rescored exactly from the whole
vectors. Without proof it runs to the last level, where the sums are exact.

Defined results: vectors that are null or hold a null, NaN or infinite component take no part;
vectors of different lengths are compared over their common components (missing ones are 0);
rows that share the query's vec_id are the query's own; among rows that repeat a query id the
smallest vector asks; repeated candidate rows may each be a result; null ids take no part; extra
columns are ignored; an empty table gives an empty result. Sums are exact doubles up to 2**52; where the
largest components allow greater scores, blocks are scored in 64-bit integers without stops, and where they
allow scores of 2**63 an error is raised.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_VECTORS = 4096
BLOCK_QUERIES = 1024
#: Members still possible at which rescoring is cheaper than another level.
FEW = 64
#: Share of a level's places that must be taken for the segment to be kept as a matrix.
DENSE = 0.25
#: Scores up to which every partial sum is an exact double.
_EXACT = 1 << 52


def quantised(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id and the integer vector, of the rows that take part."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    df = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
    df = df.filter(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & finite)
    return df.select("vec_id", F.transform("x", lambda v: F.floor(v * scale).cast("long")).alias("v"))


def _matrix(vectors, width: int | None = None) -> np.ndarray:
    width = max((len(v) for v in vectors), default=0) if width is None else width
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, :min(len(v), width)] = v[:width]
    return out


class ImpactIndex:
    """A block's vectors by impact level, and the length of what is left below each level."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        size = np.abs(vectors)
        level = np.zeros(vectors.shape, dtype=np.int64)
        level[size > 0] = np.floor(np.log2(size[size > 0])).astype(np.int64) + 1
        self.levels = [int(n) for n in np.unique(level)[::-1] if n > 0]
        self.segments, self.rest = [], []
        left = (vectors.astype(np.float64) ** 2).sum(axis=1)
        for n in self.levels:
            at, component = np.nonzero(level == n)
            values = vectors[at, component].astype(np.float64)
            left = np.maximum(left - np.bincount(at, values ** 2, minlength=len(vectors)), 0)
            if len(at) >= DENSE * vectors.size:
                segment = np.zeros(vectors.shape[::-1])
                segment[component, at] = values
                self.segments.append(segment)
            else:
                order = np.argsort(component, kind="stable")
                self.segments.append((component[order], at[order], values[order]))
            self.rest.append(np.sqrt(left) * (1 + 1e-9) + 1e-3)

    @staticmethod
    def add(scores: np.ndarray, queries: np.ndarray, segment) -> None:
        """Add a segment's part to the scores (queries by vectors)."""
        if isinstance(segment, np.ndarray):
            scores += queries @ segment
            return
        component, at, values = segment
        edges = np.r_[0, np.flatnonzero(np.diff(component)) + 1, len(component)]
        for lo, hi in zip(edges, edges[1:]):  # the postings of one component: each vector once
            scores[:, at[lo:hi]] += queries[:, component[lo], None] * values[None, lo:hi]

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, exact: bool = True) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query (row of integers; ``own``: its id) the positions and exact scores that may be in its top k.
        ``exact``: doubles hold every sum exactly; else integers are compared, without stops."""
        n = len(self.ids)
        asked = queries.astype(np.float64)
        length = np.sqrt((asked ** 2).sum(axis=1)) * (1 + 1e-12)
        mine = self.ids[None, :] == own[:, None]
        scores, open_ = np.zeros((len(queries), n)), np.arange(len(queries))
        out: list = [None] * len(queries)
        if not exact:
            for i, whole in enumerate(queries @ self.vectors.T):
                others = np.flatnonzero(~mine[i])
                if len(others) > k:
                    others = others[whole[others] >= np.partition(whole[others], len(others) - k)[len(others) - k]]
                out[i] = (others, whole[others])
            return out
        for at, (segment, rest) in enumerate(zip(self.segments, self.rest)):
            part = scores[open_]
            self.add(part, asked[open_], segment)
            scores[open_] = part
            last = at == len(self.levels) - 1
            slack = length[open_, None] * rest[None, :]
            low = np.where(mine[open_], -np.inf, scores[open_] - slack)
            kth = np.partition(low, max(n - k, 0), axis=1)[:, max(n - k, 0)] if n > k else np.full(len(open_), -np.inf)
            possible = (scores[open_] + slack >= kth[:, None] - 1e-6) & ~mine[open_]
            done = (possible.sum(axis=1) <= FEW) | last
            for row in np.flatnonzero(done):
                members = np.flatnonzero(possible[row])
                out[open_[row]] = (members, self.vectors[members] @ queries[open_[row]])
            open_ = open_[~done]
            if not open_.size:
                break
        for i in open_:  # no level at all: every vector is zero
            members = np.flatnonzero(~mine[i])
            out[i] = (members, np.zeros(len(members), dtype=np.int64))
        return out


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def top_k(embeddings: DataFrame, asks: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: for every row for which ``asks`` (on vec_id) holds, its k highest
    scores among all other rows, ties to the smaller vec_id."""
    vectors = quantised(embeddings)
    total, n_queries, low, high, width = vectors.agg(F.count(F.lit(1)), F.sum(asks.cast("int")), F.min(F.array_min("v")), F.max(F.array_max("v")), F.max(F.size("v"))).first()
    peak = max(-(low or 0), high or 0) ** 2 * (width or 0)  # no score is greater
    if peak >= 1 << 63:
        raise ValueError("components are so large that scores may pass 64 bits")
    small = peak < _EXACT
    blocks, asked_blocks = max(1, math.ceil(total / BLOCK_VECTORS)), max(1, math.ceil((n_queries or 0) / BLOCK_QUERIES))
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    queries = (vectors.filter(asks).groupBy("vec_id").agg(F.min("v").alias("v"))
               .withColumn("ask", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(asked_blocks)).cast("int")))
    # The stated query set meets every block of the index: queries are copied once a block, vectors once a query block.
    queries = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumnRenamed("vec_id", "query_id")
    dealt = dealt.withColumn("ask", F.explode(F.sequence(F.lit(0), F.lit(asked_blocks - 1))))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = {"query_id": [], "vec_id": [], "score": []}
        if len(left) and len(right):
            width = max(left["v"].map(len).max(), right["v"].map(len).max())
            index = ImpactIndex(right["vec_id"].to_numpy(), _matrix(right["v"].tolist(), width))
            asked, own = _matrix(left["v"].tolist(), width), left["query_id"].to_numpy()
            for at in range(0, len(own), 128):
                for q, (members, scores) in zip(own[at:at + 128], index.search(asked[at:at + 128], own[at:at + 128], k, small)):
                    best = _best(index.ids[members], scores, k)
                    found["query_id"] += [q] * len(best)
                    found["vec_id"] += index.ids[members][best].tolist()
                    found["score"] += scores[best].tolist()
        return pd.DataFrame(found)

    near = (queries.groupBy("block", "ask").cogroup(dealt.groupBy("block", "ask"))
            .applyInPandas(search, "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
