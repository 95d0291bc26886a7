"""Centroid clustering (Lloyd rounds in whole numbers) with PCA-rotated filtering.

Vectors become integers floor(256 * x). One pass adds up their second moments; the eigenvectors of
the covariance turn every vector once, and a table keeps the integer vector, its ``LEADING`` rotated
coordinates and the length of the rest. In a round, for a vector and every centroid,

    |p - c|**2 + (r - s)**2 <= squared distance

(p, c: leading coordinates, r, s: lengths of the rests; the rests differ by at least |r - s|). Only
centroids whose bound does not pass the exact distance of the most promising one are verified, in
integers. A round is one pass over the table; tasks return a row of sums for each cluster they met,
so no vector is shuffled and a cluster that holds most rows is no heavier than the others.

Defined results: vectors that are null, hold a null, NaN or infinite component or have another
length take no part and return no row. Repeated rows are rows of their own; where the smallest
hashes fall on rows that share an id, the smaller vector comes first. Rows with a null id are
clustered and returned, but cannot be first centroids. With fewer rows than clusters every row is a
first centroid; without rows (or only null ids) the result is empty. Components at 2**27 or beyond,
whose distances may pass 64 bits, raise an error. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

LEADING = 16
#: Components stay below, so that 64 squared differences stay below 2**62.
LIMIT = 1 << 27
#: Vectors that a Python step compares at once.
ROWS = 8192
#: Share of the squared lengths by which a float bound may be off, at most (64 terms err by some 1e-14).
SLACK = 1e-10


def integer_vectors(embeddings: DataFrame, width: int, scale: int = 256) -> DataFrame:
    """vec_id and the integer vector of the rows that take part."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    df = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).filter((F.size("x") == width) & finite)
    small = F.forall("x", lambda v: F.abs(v) < LIMIT / scale)
    whole = F.transform("x", lambda v: F.floor(v * scale).cast("int"))
    return df.select("vec_id", F.when(small, whole).otherwise(F.raise_error(F.lit("a component is at 2**27 or beyond: distances may pass 64 bits"))).alias("v"))


def _matrix(column, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def second_moments(vectors: DataFrame, width: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Count, sum and matrix of products of all rows: width * (width + 1) numbers, added up by Spark."""
    def partial(batches):
        total = np.zeros((width + 1, width))
        count = 0
        for batch in batches:
            x = _matrix(batch.column(0), width).astype(np.float64)
            total[:width] += x.T @ x
            total[width] += x.sum(axis=0)
            count += len(x)
        yield pa.record_batch([pa.array([count], pa.int64()), pa.array([total.ravel()], pa.list_(pa.float64()))], names=["n", "m"])

    parts = vectors.select("v").mapInArrow(partial, "n long, m array<double>").select("n", F.posexplode("m").alias("at", "x"))
    sums = parts.groupBy("at").agg(F.sum("x").alias("x"), F.sum("n").alias("n")).orderBy("at").collect()
    if not sums:
        return 0, np.zeros(width), np.zeros((width, width))
    m = np.array([r["x"] for r in sums]).reshape(width + 1, width)
    return sums[0]["n"], m[width], m[:width]


def rotation(count: int, total: np.ndarray, products: np.ndarray) -> np.ndarray:
    """Orthogonal matrix whose columns are the covariance's eigenvectors, largest first."""
    mean = total / max(count, 1)
    _, axes = np.linalg.eigh(products / max(count, 1) - np.outer(mean, mean))
    return np.ascontiguousarray(axes[:, ::-1])


def rotated(x: np.ndarray, axes: np.ndarray, leading: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading rotated coordinates and the length of the rest."""
    turned = x.astype(np.float64) @ axes
    return turned[:, :leading], np.sqrt((turned[:, leading:] ** 2).sum(axis=1))


def nearest(x: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each row its nearest centroid (ties: smaller number) and the exact squared distance; also how many
    pairs were verified."""
    c, s = rotated(centroids, axes, lead.shape[1])
    size = (lead ** 2).sum(axis=1) + rest ** 2
    length = (c ** 2).sum(axis=1) + s ** 2
    low = (lead ** 2).sum(axis=1)[:, None] - 2 * (lead @ c.T) + (c ** 2).sum(axis=1)[None, :] + (rest[:, None] - s[None, :]) ** 2
    low -= SLACK * (size[:, None] + length[None, :]) + 1e-6
    exact = lambda i, j: ((x[i].astype(np.int64) - centroids[j]) ** 2).sum(axis=1)
    first = low.argmin(axis=1)
    best = exact(np.arange(len(x)), first)
    keep = low <= best[:, None]
    keep[np.arange(len(x)), first] = True
    i, j = np.nonzero(keep)
    d = np.empty(len(i), dtype=np.int64)
    for at in range(0, len(i), 4 * ROWS):
        d[at:at + 4 * ROWS] = exact(i[at:at + 4 * ROWS], j[at:at + 4 * ROWS])
    starts = np.flatnonzero(np.r_[True, np.diff(i) > 0]) if len(i) else np.zeros(0, dtype=np.int64)
    least = np.minimum.reduceat(d, starts) if len(i) else d
    won = np.flatnonzero(d == least[i])  # i counts the rows from 0, all of them
    won = won[np.r_[True, np.diff(i[won]) > 0]] if len(won) else won
    return j[won], least, len(i)


class RotatedTable:
    """The written table: vec_id, v, lead, rest, and its axes."""

    def __init__(self, vectors: DataFrame, width: int, leading: int = LEADING):
        self.width, self.leading = width, min(leading, width)
        whole = materialise(vectors)
        self.axes = axes = rotation(*second_moments(whole, width))
        leading = self.leading

        def turn(batches):
            for batch in batches:
                x = _matrix(batch.column(1), width)
                lead, rest = rotated(x, axes, leading)
                kept = pa.FixedSizeListArray.from_arrays(pa.array(lead.ravel()), leading).cast(pa.list_(pa.float64()))
                yield pa.record_batch([batch.column(0), batch.column(1), kept, pa.array(rest)], names=["vec_id", "v", "lead", "rest"])

        self.rows = materialise(whole.mapInArrow(turn, "vec_id long, v array<int>, lead array<double>, rest double"))

    def _parts(self, centroids: np.ndarray):
        """A function from record batches to (batch, x, cluster, distance)."""
        axes, width, leading = self.axes, self.width, self.leading

        def parts(batches):
            for whole in batches:
                for at in range(0, whole.num_rows, ROWS):
                    batch = whole.slice(at, ROWS)
                    x = _matrix(batch.column(1), width)
                    cluster, distance, _ = nearest(x, _matrix(batch.column(2), leading), batch.column(3).to_numpy(), centroids, axes)
                    yield batch, x, cluster, distance
        return parts

    def moved(self, centroids: np.ndarray) -> np.ndarray:
        """The centroids after one round: floor of the exact mean of what each is nearest to; empty ones stay."""
        parts, width, k = self._parts(centroids), self.width, len(centroids)

        def sums(batches):
            total, count = np.zeros((k, width), dtype=np.int64), np.zeros(k, dtype=np.int64)
            for _, x, cluster, _ in parts(batches):
                order = np.argsort(cluster, kind="stable")
                found, starts = np.unique(cluster[order], return_index=True)
                total[found] += np.add.reduceat(x[order].astype(np.int64), starts, axis=0)
                count += np.bincount(cluster, minlength=k)
            met = np.flatnonzero(count)
            yield pa.record_batch([pa.array(met.astype(np.int32)), pa.array(count[met]), pa.array(list(total[met]), pa.list_(pa.int64()))], names=["cluster", "n", "total"])

        parted = self.rows.mapInArrow(sums, "cluster int, n long, total array<long>").select("cluster", "n", F.posexplode("total").alias("at", "x"))
        wide = F.col("x").cast("decimal(38,0)")
        mean = parted.groupBy("cluster", "at").agg(F.sum(wide).alias("x"), F.sum("n").alias("n"))
        out = centroids.copy()
        for r in mean.collect():  # clusters times components
            out[r["cluster"], r["at"]] = int(r["x"]) // r["n"]
        return out

    def assigned(self, centroids: np.ndarray) -> DataFrame:
        """vec_id, cluster, distance of every row."""
        parts = self._parts(centroids)

        def assign(batches):
            for batch, _, cluster, distance in parts(batches):
                yield pa.record_batch([batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

        return self.rows.mapInArrow(assign, "vec_id long, cluster int, distance long")


def first_centroids(rows: DataFrame, k: int, width: int, salt: Column) -> np.ndarray:
    """The k vectors with the smallest ``salt``, in its order."""
    found = rows.filter("vec_id IS NOT NULL").select(salt.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in found], dtype=np.int64).reshape(len(found), width)


def cluster(embeddings: DataFrame, k: int = 40, rounds: int = 5, width: int = 64, leading: int = LEADING) -> DataFrame:
    """Per vector that takes part: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = embeddings.sparkSession
    table = RotatedTable(integer_vectors(embeddings, width), width, leading)
    centroids = first_centroids(table.rows, k, width, F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256))
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        centroids = table.moved(centroids)
    rows = materialise(table.assigned(centroids))
    text = spark.createDataFrame([(i, ",".join(map(str, c.tolist()))) for i, c in enumerate(centroids)], "cluster int, said string")
    named = text.select("cluster", F.sha2(F.col("said").cast("binary"), 256).alias("centroid_sha256"))
    per = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = per.agg(F.sum("cluster_inertia").alias("inertia")).first()["inertia"]
    about = per.join(named, "cluster")
    # k rows at most, so every task may hold them.
    return (rows.join(F.broadcast(about), "cluster", "left")
            .select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(total).cast("long").alias("inertia"), "centroid_sha256"))
