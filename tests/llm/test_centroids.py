"""Centroid clustering against plain Python, and the bound that its filter rests on."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.llm import centroids

from . import brute

COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
SCHEMA = "vec_id long, embedding array<float>, v int, cluster string, lead int"


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(3)


def rows_of(n, width, seed=1):
    r = np.random.default_rng(seed)
    middle = r.normal(0, 1, (9, width))
    return [(i, [float(np.float32(x)) for x in middle[i % 9] + r.normal(0, 0.3, width)]) for i in range(n)]


def test_awkward_rows(spark):
    rows = rows_of(300, 6)
    rows += [(300 + i, rows[7][1]) for i in range(60)]  # one vector many times: a cluster of many rows, empty clusters
    rows += [rows[0], (5, rows[9][1]), (None, rows[3][1]), (501, None), (502, [1.0] * 5), (503, [1.0] * 5 + [None]), (504, [float("nan")] * 6), (505, [math.inf] * 6), (506, [])]
    got = centroids.cluster(frame(spark, rows), k=12, rounds=3, width=6, leading=2)
    assert found(got) == sorted(brute.lloyd(rows, 12, 3, 6), key=repr)


def test_few_and_no_rows(spark):
    rows = rows_of(3, 6)
    assert found(centroids.cluster(frame(spark, rows), k=12, rounds=2, width=6)) == sorted(brute.lloyd(rows, 12, 2, 6), key=repr)
    assert centroids.cluster(frame(spark, rows).limit(0), width=6).count() == 0
    assert centroids.cluster(frame(spark, [(None, [1.0] * 6)]), width=6).columns == COLUMNS


def test_too_large_components_raise(spark):
    with pytest.raises(Exception, match="64 bits"):
        centroids.cluster(frame(spark, [(1, [1e9] * 6)]), width=6)


def test_nearest_is_exact_with_ties_and_large_numbers():
    r = np.random.default_rng(2)
    for scale in (1, 3, 100, 10**6, centroids.LIMIT - 10):
        x = r.integers(-scale, scale + 1, (400, 8))
        c = np.concatenate([x[:30], x[:5], r.integers(-scale, scale + 1, (5, 8))])  # centroids that are equal: ties
        axes = centroids.rotation(len(x), x.sum(axis=0).astype(float), (x.T @ x).astype(float))
        cluster, distance, _ = centroids.nearest(x, *centroids.rotated(x, axes, 3), c, axes)
        exact = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
        assert (cluster == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()


def test_the_filter_leaves_few_pairs():
    r = np.random.default_rng(3)
    c = (r.normal(0, 200, (40, 64)) * np.geomspace(3, 0.1, 64)).astype(np.int64)
    x = c[r.integers(0, 40, 2000)] + r.normal(0, 20, (2000, 64)).astype(np.int64)
    axes = centroids.rotation(len(x), x.sum(axis=0).astype(float), (x.T @ x).astype(float))
    assert np.allclose(axes.T @ axes, np.eye(64))
    _, _, verified = centroids.nearest(x, *centroids.rotated(x, axes, centroids.LEADING), c, axes)
    assert verified < 3 * len(x)  # of 40 a row


def test_registered_query(spark, sf):
    from tabloom.llm import queries
    got = queries.QUERIES["op11_centroids"](spark, sf)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert found(got) == sorted(brute.lloyd(rows, 40, 5, 64), key=repr)
    assert got.agg(F.countDistinct("inertia")).first()[0] == 1
