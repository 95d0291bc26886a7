"""Fitted models and their reports on a small table with a known signal."""

import math

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tabloom.operators import core, evaluate, fm, score, training

COLS = ["a", "b", "kind", "noise"]


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(11)
    n = 800
    a, b = r.normal(0, 1, n), r.normal(0, 1, n)
    kind = r.integers(0, 3, n)
    y = (r.random(n) < 1 / (1 + np.exp(-(2 * a + (kind == 1) * 2 - 1)))).astype(int)
    return [(int(i), int(y[i]) if i % 50 else None, float(a[i]) if i % 17 else None, float(b[i]), f"k{kind[i]}" if i % 23 else None, float(r.random())) for i in range(n)]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "id long, y int, a double, b double, kind string, noise double").repartition(2).cache()


def test_boosted_trees_report_and_importances(spark, df):
    model, held, report = training.train_report(df, COLS, "y", "id", rounds=6, depth=3)
    r = report.first()
    assert r["test_auc"] > 0.75 and r["trees"] == training.gbt_of(model).getNumTrees and 1 <= r["trees"] <= 6
    assert 0 <= r["hit_rate"] <= 1 and r["top_k"] == 1
    labelled = df.filter("y IS NOT NULL").count()
    assert held.count() == sum(math.floor(n["count"] * 0.2) for n in df.filter("y IS NOT NULL").groupBy("y").count().collect()) < labelled
    table = training.importance_table([model, model], COLS, spark).collect()
    assert sum(x["share"] for x in table) == pytest.approx(1) and table[0]["feature"] == "a" and [x["rank"] for x in table] == [1, 2, 3, 4]


def test_every_row_is_scored_once_out_of_fold(df):
    models, scored = training.cross_validate(df, ["a", "kind"], "y", "id", k=3, rounds=3, depth=2)
    assert len(models) == 3
    assert scored.count() == scored.select("id").distinct().count() == df.filter("y IS NOT NULL").count()
    sizes = [r["count"] for r in scored.groupBy("fold", "y").count().orderBy("y", "fold").collect()]
    assert max(sizes[:3]) - min(sizes[:3]) <= 1 and max(sizes[3:]) - min(sizes[3:]) <= 1
    report = {r["metric"]: r for r in training.fold_report(scored, "y", "id").collect()}
    aucs = [evaluate.auc(scored.filter(f"fold = {i}"), "p", "y").first()[0] for i in range(3)]
    assert report["auc"]["mean"] == pytest.approx(np.mean(aucs)) and report["auc"]["std"] == pytest.approx(np.std(aucs))


def test_leaves_feed_a_regression(df):
    model = training.fit_gbt(df, COLS, "y", "id", rounds=4, depth=2)
    rows = training.prepared(df, COLS, "y")
    leaves = training.leaf_columns(model, rows)
    counts = training.leaf_counts(model)
    assert [f"leaf_{i}" for i in range(len(counts))] == [c for c in leaves.columns if c.startswith("leaf_")]
    for i, n in enumerate(counts):
        assert 1 < n <= 4 and leaves.agg(F.max(f"leaf_{i}")).first()[0] < n
    regression = training.fit_leaf_regression(model, df, COLS, "y")
    auc = lambda x: evaluate.auc(x, "p", "y").first()[0]
    assert auc(training.leaf_scores(model, regression, df, COLS, "y")) >= auc(training.scored_rows(model, rows)) - 0.02


def test_leaf_regression_in_a_session_that_observed(spark, df):
    """An observed query gives the session a state that tasks cannot take; the scorer must not carry the session."""
    seen = Observation()
    assert spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).count() == 3 and seen.get["n"] == 3
    model = training.fit_gbt(df, COLS, "y", "id", rounds=2, depth=2)
    regression = training.fit_leaf_regression(model, df, COLS, "y")
    scores = training.leaf_scores(model, regression, df, COLS, "y")
    assert scores.filter("p > 0 AND p < 1").checkpoint().count() == df.filter("y IS NOT NULL").count()


def test_search_rejects_a_wide_gap(df):
    grid = [{"rounds": 2, "depth": 2}, {"rounds": 4, "depth": 3}]
    found = training.search(df, COLS, "y", "id", grid, lambda x: evaluate.auc(x, "p", "y").first()[0], max_gap=1.0).collect()
    assert sum(r["best"] for r in found) == 1 and max(found, key=lambda r: r["score"])["best"]
    assert not any(r["best"] or r["accepted"] for r in training.search(df, ["a"], "y", "id", grid[:1], lambda x: 0.5, max_gap=0.0).collect())


def test_many_valued_texts_and_unseen_ones(spark, df):
    wide = df.withColumn("name", F.concat(F.lit("n"), (F.col("id") % 200).cast("string")))
    model = training.fit_gbt(wide, ["name", "a"], "y", "id", rounds=2, depth=2)
    new = spark.createDataFrame([(1, 1, None, "never seen"), (2, 0, 3.0, None)], "id long, y int, a double, name string")
    assert all(0 < r["p"] < 1 for r in training.scored_rows(model, training.prepared(new, ["name", "a"], "y")).collect())


def test_single_features(df):
    found = {r["feature"]: r["auc"] for r in training.single_feature_auc(df, ["a", "noise"], "y", "id", rounds=2).collect()}
    assert found["a"] > 0.7 > found["noise"]


def test_permutation(df):
    moved = training.permuted(df.select("id", "a", "b"), ["a", "b"], "id", 3).collect()
    pairs = sorted(((r["a"], r["b"]) for r in moved), key=repr)
    assert pairs == sorted(((r["a__permuted"], r["b__permuted"]) for r in moved), key=repr) and sum(r["b"] == r["b__permuted"] for r in moved) < 20
    found = {r["feature"]: r for r in training.permutation_importance(df.fillna(0, ["a"]).filter("y IS NOT NULL"), ["a", "b"], "y", "id", lambda x: x.withColumn("p", F.col("a")), folds=2).collect()}
    assert found["b"]["mean"] == found["b"]["std"] == 0 and found["a"]["mean"] > 0.1


def test_permutation_ranks_by_key_once(df, monkeypatch):
    """One scan by key and one a permutation; the areas give back a number a range and scan no rows twice."""
    seen = []
    for module in (training, evaluate):
        monkeypatch.setattr(module, "ordered_scan", lambda x, order, scan=module.ordered_scan, **more: seen.append(order) or scan(x, order, **more))
    training.permutation_importance(df.fillna(0, ["a"]).filter("y IS NOT NULL"), ["a", "b"], "y", "id", lambda x: x.withColumn("p", F.col("a")), folds=2)
    assert seen == [[("id", True)], [("__hash", True), ("id", True)], [("__hash", True), ("id", True)]]


def test_area_over_ranges_with_ties(spark):
    r = np.random.default_rng(2)
    scored = [(float(s), int(y)) for s, y in zip(r.integers(0, 40, 500) / 8, r.random(500) < 0.3)] + [(0.0, 0)] * 300 + [(None, 1), (9.0, None)]
    d = spark.createDataFrame(scored, "p double, y int").repartition(5)
    tp = fp = area = 0.0
    pos = sum(y for s, y in scored if s is not None and y is not None)
    prec0, rec0 = 1.0, 0.0
    for s in sorted({s for s, y in scored if s is not None and y is not None}, reverse=True):
        own = [y for x, y in scored if x == s and y is not None]
        tp, fp = tp + sum(own), fp + len(own) - sum(own)
        prec, rec = tp / (tp + fp), tp / pos
        area, prec0, rec0 = area + 0.5 * (prec + prec0) * (rec - rec0), prec, rec
    assert [evaluate.aucpr(d, "p", "y", n).first()["aucpr"] for n in (None, 1, 7)] == pytest.approx([area] * 3)
    assert evaluate.aucpr(d.filter("p > 99"), "p", "y").first()["aucpr"] is None


def test_partial_dependence(df, rows):
    scorer = lambda x: x.withColumn("p", F.coalesce(F.col("a"), F.lit(0.0)) * 2 + F.col("b"))
    got = {(r["feature"], r["value"]): (r["mean"], r["n"]) for r in training.partial_dependence(df, {"a": [0, 1.5], "b": [-1]}, scorer).collect()}
    mean_a, mean_b = np.mean([(x[2] or 0) * 2 for x in rows]), np.mean([x[3] for x in rows])
    assert {k: v[1] for k, v in got.items()} == {("a", 0.0): 800, ("a", 1.5): 800, ("b", -1.0): 800}
    assert got["a", 1.5][0] == pytest.approx(3 + mean_b) and got["a", 0.0][0] == pytest.approx(mean_b) and got["b", -1.0][0] == pytest.approx(mean_a - 1)
    curves = training.individual_expectation(df, "id", {"b": [2]}, scorer)
    assert curves.count() == 800 and {r["p"] for r in curves.filter("id = 0").collect()} == {2.0}


def plain_fm(rows, k, passes, step):
    """Full gradients over dictionaries, entry by entry."""
    idx = sorted({i for _, _, xi, _ in rows for i in xi})
    w, v = dict.fromkeys(idx, 0.0), {i: [0.01 * math.sin((i + 1.0) * (j + 1)) for j in range(k)] for i in idx}
    losses = []
    for _ in range(passes + 1):
        gw, gv, loss = dict.fromkeys(idx, 0.0), {i: [0.0] * k for i in idx}, 0.0
        for _, y, xi, xv in rows:
            s = [sum(v[i][f] * x for i, x in zip(xi, xv)) for f in range(k)]
            z = sum(w[i] * x for i, x in zip(xi, xv)) + sum(s[f] ** 2 - sum((v[i][f] * x) ** 2 for i, x in zip(xi, xv)) for f in range(k)) / 2
            p = 1 / (1 + math.exp(-z))
            loss -= math.log(p if y else 1 - p)
            for i, x in zip(xi, xv):
                gw[i] += (p - y) * x
                for f in range(k):
                    gv[i][f] += (p - y) * x * (s[f] - v[i][f] * x)
        losses.append(loss / len(rows))
        last = ({i: w[i] for i in idx}, {i: list(v[i]) for i in idx})
        for i in idx:
            w[i] -= step * gw[i] / len(rows)
            v[i] = [a - step * b / len(rows) for a, b in zip(v[i], gv[i])]
    return losses, last


def test_factorisation_machine(spark):
    r = np.random.default_rng(2)
    data = []
    for n in range(300):
        xi = [int(r.integers(0, 8)), 8 + int(r.integers(0, 5)), 13]  # index 13 is in every row
        data.append((n, int(r.random() < 0.15 + 0.7 * (xi[0] % 2 == xi[1] % 2)), xi, [1.0, 1.0, float(np.float32(r.random()))]))
    rows = spark.createDataFrame(data, "id long, y int, xi array<int>, xv array<float>").repartition(3)
    weights, losses = fm.train(rows, "id", "y", k=2, passes=3, step=1.0)
    want, (w, v) = plain_fm(data, 2, 3, 1.0)
    assert losses == pytest.approx(want, abs=1e-12) and all(a > b for a, b in zip(losses, losses[1:]))
    got = {x["idx"]: (x["w"], [x["v0"], x["v1"]]) for x in weights.collect()}
    assert all(got[i][0] == pytest.approx(w[i]) and got[i][1] == pytest.approx(v[i]) for i in w)
    served = {x["id"]: x["score"] for x in score.fm_score(rows, weights, key="id", k=2).collect()}
    trained = {x["key"]: x["p"] for x in fm.row_scores(fm.entries(rows, "id", "y"), weights, 2).collect()}
    assert served == pytest.approx(trained)
    _, more = fm.train(rows, "id", "y", k=2, passes=4, step=1e6)  # far too large a step is halved until the loss falls
    assert all(a > b for a, b in zip(more, more[1:])) and len(more) > 1
    assert fm.train(rows.limit(0), "id", "y")[1] == []


def test_rows_are_dealt_and_stay_so(spark, df, monkeypatch):
    """Fitting reads partitions of bounded size; a hold-out by class does not gather a class in a task."""
    monkeypatch.setattr(training, "PART_ROWS", 100)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = training.dealt(df.filter("y IS NOT NULL"), "id")
        marked = core.holdout(rows, "id", 0.2, seed=1, stratify="y").checkpoint()
        sizes = [r["count"] for r in marked.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8 and sum(sizes) == rows.count() and max(sizes) < 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
