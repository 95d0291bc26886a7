"""Sampling, splits, text, graph and stream operators against plain Python, with hot groups, nulls and late rows."""

import datetime as dt
import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tabloom.operators import core, graph, text
from tabloom.streaming import streams


def uniform(key, seed):
    return int(hashlib.md5(f"{key}:{seed}".encode()).hexdigest()[:8], 16) / 2 ** 32


def test_poisson_copies_hash_once_and_follow_the_distribution(spark):
    df = spark.range(20_000).withColumnRenamed("id", "k")
    drawn = core.poisson_copies(df, "k", 2.5, seed=3)
    plan = drawn._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1
    got = {r["k"]: r["copies"] for r in drawn.collect()}
    steps = core.poisson_cdf(2.5)
    assert got == {k: n for k in range(20_000) if (n := sum(uniform(k, 3) >= p for p in steps))}
    for n in range(6):
        share = sum(got.get(k, 0) == n for k in range(20_000)) / 20_000
        assert share == pytest.approx(math.exp(-2.5) * 2.5 ** n / math.factorial(n), abs=0.015)
    assert core.poisson_replicate(df, "k", 2.5, seed=3).count() == sum(got.values())


@pytest.mark.parametrize("rate", [0.01, 1.0, 30.0, 700.0])
def test_poisson_steps_rise_to_one(rate):
    steps = core.poisson_cdf(rate)
    assert steps[0] == math.exp(-rate) and all(a <= b for a, b in zip(steps, steps[1:])) and steps[-1] < 1
    assert 1 - steps[-1] < 1e-9


def test_poisson_rate_out_of_range():
    for rate in (0, -1, 800):
        with pytest.raises(ValueError):
            core.poisson_cdf(rate)


@pytest.mark.parametrize("ratio", [0.0, 0.2, 1.0])
def test_holdout_marks_rows_where_they_lie(spark, ratio):
    rows = [(i, None if i % 10 == 0 else "hot" if i % 3 else f"s{i % 7}", "x" * 50) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, s string, wide string").repartition(5)
    plain = {r["k"]: r["is_test"] for r in core.holdout(df, "k", ratio, seed=4).collect()}
    order = sorted(range(600), key=lambda k: (uniform(k, 4), k))
    assert {k for k, t in plain.items() if t} == set(order[600 - int(600 * ratio):]) and len(plain) == 600
    strata = core.holdout(df, "k", ratio, seed=4, stratify="s")
    assert strata.columns == ["k", "s", "wide", "is_test"]
    got = {r["k"]: r["is_test"] for r in strata.collect()}
    assert len(got) == 600
    by = defaultdict(list)
    for k in order:
        by[rows[k][1]].append(k)
    assert {k for k, t in got.items() if t} == {k for ks in by.values() for k in ks[len(ks) - int(len(ks) * ratio):]}


def test_folds_and_positions_keep_wide_rows(spark):
    rows = [(i, None if i % 4 == 0 else i % 2, f"w{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "k long, y int, wide string").repartition(4)
    folds = core.stratified_kfold(df, "k", "y", 3, seed=1).collect()
    order = sorted(range(300), key=lambda k: (uniform(k, 1), k))
    want, seen = {}, Counter()
    for k in order:
        want[k] = seen[rows[k][1]] % 3
        seen[rows[k][1]] += 1
    assert {r["k"]: r["fold"] for r in folds} == want and all(r["wide"] == f"w{r['k']}" for r in folds)
    moved = core.shuffle_rows(df, "k", seed=1)
    assert moved.columns == ["k", "y", "wide", "pos"]
    assert {r["k"]: r["pos"] for r in moved.collect()} == {k: i for i, k in enumerate(order)}


def test_newest_rows_of_all_and_of_each_group(spark):
    rows = [(i, i % 40, "hot" if i % 3 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, t long, g string").repartition(6)
    newest = sorted(rows, key=lambda r: (-r[1], -r[0]))
    assert [r["k"] for r in core.newest_n(df, "t", "k", 7).collect()] == [r[0] for r in newest[:7]]
    got = core.newest_n(df, "t", "k", 5, by=["g"])
    assert got.columns == ["k", "t", "g"]
    assert {r["k"] for r in got.collect()} == {r[0] for g in ("hot", None) for r in [x for x in newest if x[2] == g][:5]}


DOCS = [(1, "a", "the cat the dog"), (2, "a", "the the the"), (3, "b", "cat"), (4, None, "cat dog"), (5, "b", "")]


def token_table(spark):
    d = spark.createDataFrame(DOCS, "doc_id long, lang string, text string")
    return d.select("doc_id", "lang", F.explode(F.split("text", " ")).alias("term")).filter("term <> ''")


def test_unigrams_weights_and_centroids(spark):
    t = token_table(spark)
    tf = {i: Counter(re.findall(r"\w+", x)) for i, _, x in DOCS}
    total = sum(tf.values(), Counter())
    got = {r["term"]: (r["n"], r["p"]) for r in text.unigram_shares(t).collect()}
    assert got == {w: (n, pytest.approx(n / total.total())) for w, n in total.items()}
    df = Counter(w for c in tf.values() for w in c)
    weights = {(r["doc_id"], r["term"]): r["w"] for r in text.tfidf(t, 5).collect()}
    assert weights == {(i, w): pytest.approx(n * math.log(6 / (df[w] + 1))) for i, c in tf.items() for w, n in c.items()}
    lang = {i: g for i, g, _ in DOCS}
    cos = {r["doc_id"]: r["cos_lang"] for r in text.centroid_similarity(t, "lang").collect()}
    assert set(cos) == {1, 2, 3}  # no group: no centroid; no words: no direction
    for i in cos:
        cen = sum((c for j, c in tf.items() if lang[j] == lang[i]), Counter())
        norm = lambda c: math.sqrt(sum(n * n for n in c.values()))
        assert cos[i] == pytest.approx(sum(n * cen[w] for w, n in tf[i].items()) / norm(tf[i]) / norm(cen))


def test_symmetric_propagation(spark):
    # Repeated, reversed and self edges; a node without edges, one without a feature, and an end that is no node.
    edges = [(1, 2), (2, 1), (1, 2), (1, 1), (2, 3), (3, 4), (9, 1), (8, 9)]
    feats = {1: 1.0, 2: -2.0, 3: 4.0, 4: None, 5: 3.0}
    near = defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    degree = {n: len(near[n]) + (n in feats) for n in {*near, *feats}}
    want = {}
    for n in degree:
        x = [feats[m] / math.sqrt(degree[n] * degree[m]) for m in [*near[n], *([n] if n in feats else [])] if feats.get(m) is not None]
        if x or n in feats:
            want[n] = pytest.approx(sum(x)) if x else None
    got = graph.sym_norm_propagate(spark.createDataFrame(edges, "src long, dst long"), spark.createDataFrame(list(feats.items()), "id long, x double"), "x")
    assert {r["src"]: r["h"] for r in got.collect()} == want


def event_files(spark, folder, files):
    """One file a list of (event_id, day, user, type): files are read in order of their time."""
    start = dt.datetime(2024, 1, 1)
    for i, rows in enumerate(files):
        full = [(e, start + dt.timedelta(days=d, minutes=e), u, t, float(e), "") for e, d, u, t in rows]
        df = spark.createDataFrame(full, streams.EVENT_SCHEMA)
        df.toPandas().to_parquet(f"{folder}/events-{i}.parquet", coerce_timestamps="us")
        import os
        os.utime(f"{folder}/events-{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))


def test_late_rows_within_the_watermark_count_and_later_ones_do_not(spark, tmp_path):
    files = [[(1, 0, 1, "a"), (2, 1, 1, "a")], [(3, 5, 1, "b"), (4, 5, 2, "a")], [(5, 4, 1, "a")], [(6, 1, 1, "a"), (7, 9, 1, "a")]]
    event_files(spark, str(tmp_path), files)
    s = streams.event_stream(spark, str(tmp_path))
    path = streams.run_to_table(streams.windowed_counts(s, "event_type", watermark="2 days"), "late", mode="update")
    got = {(r["day"], r["event_type"]): r["n"] for r in streams.latest_per_key(spark, path, ["day", "event_type"], "day string, event_type string, n long").collect()}
    # Event 5 comes a day late and counts. Event 6, four days behind, comes when its window has closed: late rows are held
    # against the watermark of the batch before, which the second file moved past that window.
    assert got == {("2024-01-01", "a"): 1, ("2024-01-02", "a"): 1, ("2024-01-06", "b"): 1, ("2024-01-06", "a"): 1, ("2024-01-05", "a"): 1, ("2024-01-10", "a"): 1}


def test_newest_buffer_over_several_batches_with_a_hot_key(spark, tmp_path):
    files = [[(e, e % 5, 7 if e % 3 else e % 4, "view") for e in range(f * 50, f * 50 + 50)] for f in range(3)]
    event_files(spark, str(tmp_path), files)
    path = streams.run_to_table(streams.newest_n_state(streams.event_stream(spark, str(tmp_path)), "user_id", 3), "buffer", mode="update")
    rows = spark.read.schema("user_id long, event_id long, slot long, _epoch long").parquet(path)
    last = rows.groupBy("user_id").agg(F.max("_epoch").alias("_epoch"))
    got = defaultdict(dict)
    for r in rows.join(last, ["user_id", "_epoch"]).collect():
        got[r["user_id"]][r["slot"]] = r["event_id"]
    every = [x for f in files for x in f]
    for user in {x[2] for x in every}:
        newest = sorted((x for x in every if x[2] == user), key=lambda x: (x[1], x[0]), reverse=True)[:3]
        assert [got[user][i] for i in range(len(newest))] == [x[0] for x in newest]


def test_stream_scores_unknown_types_and_nulls(spark):
    df = spark.createDataFrame([(1, "view", 100.0), (2, "odd", 100.0), (3, None, 0.0), (4, "click", None)], "event_id long, event_type string, value double")
    got = {r["event_id"]: r["score"] for r in streams.score_stream(df).collect()}
    logistic = lambda z: 1 / (1 + math.exp(-z))
    assert got == {1: pytest.approx(logistic(0.4)), 2: pytest.approx(logistic(0.0)), 3: pytest.approx(logistic(-1.0)), 4: None}
