"""ordered_scan against pandas, also after operations that renumber partitions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.operators import encode, evaluate
from tabloom.operators.rank import ordered_scan, plateau_stops


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(0)
    # One hot group holds a third of the rows; some keys are null.
    key = np.where(np.arange(3000) % 3 == 0, "hot", np.array([f"k{i}" for i in r.integers(0, 40, 3000)]))
    return pd.DataFrame({"id": np.arange(3000), "k": [None if i % 97 == 0 else k for i, k in enumerate(key)], "o": r.integers(0, 50, 3000), "v": r.integers(0, 9, 3000).astype(float)})


def expected(rows):
    out = rows.assign(k=rows.k.fillna("~")).sort_values(["k", "o", "id"])
    g = out.groupby("k")
    return {i: (rank, s) for i, rank, s in zip(out.id, g.cumcount() + 1, g.v.cumsum())}


@pytest.mark.parametrize("after", ["plain", "union", "coalesce", "limit", "join"])
def test_scan_survives_renumbered_partitions(spark, rows, after):
    df = spark.createDataFrame([(int(i), k, int(o), float(v)) for i, k, o, v in rows.itertuples(index=False)], "id long, k string, o long, v double")
    scan = ordered_scan(df, [("o", True), ("id", True)], by=["k"], sums=["v"], num_partitions=7)
    if after == "union":
        scan = scan.unionByName(scan)
    elif after == "coalesce":
        scan = scan.coalesce(1)
    elif after == "limit":
        scan = scan.limit(2000)
    elif after == "join":
        scan = scan.join(df.select("id"), "id")
    got = [(r["id"], (r["rank"], r["cum_v"])) for r in scan.select("id", "rank", "cum_v").collect()]
    want = expected(rows)
    assert all(want[i] == x for i, x in got)
    assert len(got) == {"union": 6000, "limit": 2000}.get(after, 3000)


def test_scan_without_a_partition_count(spark):
    scan = ordered_scan(spark.range(100), [("id", False)])
    assert [(r["id"], r["rank"]) for r in scan.orderBy("rank").collect()] == [(99 - i, i + 1) for i in range(100)]


def test_metrics_of_one_class_and_constant_columns(spark):
    one = spark.createDataFrame([(i, 1, i / 10) for i in range(10)], "id long, y int, p double")
    assert evaluate.auc(one, "p", "y").first()["auc"] is None
    assert evaluate.ks_table(one, "p", "y", "id", nbins=10).count() == 11
    flat = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    fit = encode.normalize_fit(flat, ["x"])
    assert {r["x"] for r in encode.normalize_transform(flat, fit, kind="min-max").collect()} == {0.0}


def test_transforms_start_no_jobs(spark):
    df = spark.createDataFrame([(i % 2, f"a{i % 5}", f"b{i % 7}", None if i % 3 else "c") for i in range(200)], "y int, a string, b string, c string")
    tracker = spark.sparkContext.statusTracker()
    for cols in (["a"], ["a", "b", "c"]):
        fitted = encode.target_fit(df, "y", cols)
        spark.sparkContext.setJobGroup(f"transform-{len(cols)}", "transform")
        out = encode.target_transform(df, fitted, cols)
        assert not tracker.getJobIdsForGroup(f"transform-{len(cols)}")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert out.filter(F.col("a").isNull()).count() == 0


def test_lookup_of_many_keys_is_a_join(spark):
    table = spark.range(60_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    out = encode.lookup(spark.range(10).withColumn("x", F.col("id") * 7000), "x", table, "k", "v", "found", default=-1)
    assert {r["x"]: r["found"] for r in out.collect()} == {i * 7000: i * 14000 if i * 7000 < 60_000 else -1 for i in range(10)}


def scanned(spark, rows, kind, **more):
    df = spark.createDataFrame([(i, k, i % 7, float(i % 5)) for i, k in enumerate(rows)], f"id long, k {kind}, o int, v double").repartition(5)
    scan = ordered_scan(df, [("o", True), ("id", True)], by=["k"], sums=["v"], maxes=["v"], leads=["id"], **more)
    return sorted((tuple(r) for r in scan.select("k", "o", "id", "rank", "cum_v", "cmax_v", "id_next").collect()), key=repr)


def plain_scan(rows):
    out, groups = [], {}
    for i, k in enumerate(rows):
        groups.setdefault(k, []).append((i % 7, i, float(i % 5)))
    for k, members in groups.items():
        total, top = 0.0, 0.0
        members.sort()
        for r, (o, i, v) in enumerate(members, 1):
            total, top = total + v, max(top, v)
            out.append((k, o, i, r, total, top, members[r][1] if r < len(members) else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("parts", [1, 4, 9])
@pytest.mark.parametrize("kind, rows", [
    ("long", [None] * 10 + [1] * 990 + [(1 << 62) + i % 3 for i in range(90)]),  # nulls beside whole numbers, some beyond a double
    ("string", [None, None, "None", "None", "", "", "a\x1fb", "a", "n;", "1:a;"] * 30),
    ("double", [None, 0.0, 1.5, float("inf")] * 50),
])
def test_group_keys_keep_type_and_nulls(spark, kind, rows, parts):
    assert scanned(spark, rows, kind, num_partitions=parts) == plain_scan(rows)


def test_two_part_keys_do_not_meet(spark):
    rows = [("a\x1fb", "c"), ("a", "b\x1fc"), (None, "x"), ("None", "x"), ("1:a", ";"), ("1", ":a;")] * 3
    df = spark.createDataFrame([(i, *k) for i, k in enumerate(rows)], "id long, a string, b string")
    got = ordered_scan(df, [("id", True)], by=["a", "b"], num_partitions=4)
    assert sorted(r["rank"] for r in got.collect()) == sorted([1, 2, 3] * 6)


def test_zeros_of_both_signs_are_one_group(spark):
    df = spark.createDataFrame([(i, 0.0 if i % 2 else -0.0) for i in range(20)], "id long, k double")
    assert sorted(r["rank"] for r in ordered_scan(df, [("id", True)], by=["k"], num_partitions=3).collect()) == list(range(1, 21))


def test_large_nullable_numbers_pass_through(spark):
    df = spark.createDataFrame([(i, None if i % 2 else (1 << 60) + i) for i in range(40)], "id long, n long")
    got = ordered_scan(df, [("id", True)], leads=["n"], num_partitions=3).collect()
    assert {(r["id"], r["n"], r["n_next"]) for r in got} == {(i, None if i % 2 else (1 << 60) + i, (1 << 60) + i + 1 if i % 2 and i < 39 else None) for i in range(40)}


def early_stop(values, patience, delta):
    best, count = None, 0
    for r, v in enumerate(values, 1):
        if r == 1:
            best = v
        elif v == v and (best != best or v >= best + delta):
            best, count = v, 0
        else:
            count += 1
            if count >= patience:
                return r
    return None


@pytest.mark.parametrize("patience, delta, parts", [(1, 0.0, 5), (3, 0.0, 7), (4, 1.5, 7), (7, 2.0, 30), (60, 0.5, 9)])
def test_plateau_is_a_sequential_run(spark, patience, delta, parts):
    r = np.random.default_rng(patience)
    groups = {None: r.normal(0, 1, 40), 1: np.cumsum(r.normal(0.9, 1.5, 500)), 2: np.arange(300) * 0.4, 3: r.normal(0, 3, 3), 4: np.full(50, np.nan), 5: np.r_[np.nan, 1, 2, 9, np.nan, np.full(30, 9.0)],
              (1 << 62) + 1: np.cumsum(r.normal(0.5, 1, 200)), (1 << 62) + 2: np.cumsum(r.normal(0.5, 1, 200))}
    rows = [(k, t, float(v)) for k, x in groups.items() for t, v in enumerate(x)]
    df = spark.createDataFrame(rows, "k long, t long, v double").repartition(4)
    got = {x["k"]: x["stop_rank"] for x in plateau_stops(df, [("t", True)], "v", patience, delta, by=["k"], num_partitions=parts).collect()}
    assert got == {k: s for k, x in groups.items() if (s := early_stop(x.tolist(), patience, delta)) is not None}


def test_plateau_without_groups_and_of_no_rows(spark):
    df = spark.range(50).withColumn("v", F.when(F.col("id") < 20, F.col("id")).otherwise(5).cast("double"))
    assert [r["stop_rank"] for r in plateau_stops(df, [("id", True)], "v", 6, num_partitions=5).collect()] == [26]
    assert plateau_stops(df.limit(0), [("id", True)], "v", 6).count() == 0
