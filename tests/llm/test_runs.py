"""Periodic runs against plain Python."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tabloom.llm import queries, runs

from . import brute

COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def words(rng, n, kinds=5000):
    return [f"w{rng.randrange(kinds)}" for _ in range(n)]


def made(seed=4):
    """Texts with runs of periods under, at and over each scale's edge, cut and nested."""
    rng, out = random.Random(seed), []
    for q in (1, 2, 3, 5, 15, 16, 17, 31, 32, 33, 47, 63, 64, 65, 100, 130):
        for extra in (-1, 0, 1, q // 2, 3 * q):
            unit = words(rng, q)
            run = (unit * 9)[:max(6, 4 * q) + extra]
            out.append(" ".join(words(rng, rng.randrange(30)) + run + words(rng, rng.randrange(30))))
    nested = (words(rng, 3) * 6 + words(rng, 11)) * 5
    out += [" ".join(nested), " ".join(["a"] * 400), " ".join(["a", "b"] * 300 + ["b", "a"] * 200), "x " * 90 + "y " * 90 + "x " * 90]
    out += [None, "", " \n\x0b", "one", "a a a a a", "a a a a a a", "A a A a A a A a", "é é é é " * 9, "\n".join(words(rng, 4000, 3)), " ".join(words(rng, 12) * 2)]
    return out


def test_awkward_rows(spark):
    rows = [(i * 7, t) for i, t in enumerate(made())] + [(None, "b c " * 30), (7, "b c " * 30), (7, "b c " * 30)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, words string, start int").repartition(3)
    assert found(runs.periodic_run_table(frame, runs.planted)) == sorted(brute.periodic(rows), key=repr)
    assert found(runs.periodic_run_table(frame)) == sorted(brute.periodic(rows, plant=False), key=repr)
    spans = sorted((tuple(r) for r in runs.run_spans(frame).collect()), key=repr)
    assert spans == sorted(((d, *r) for d, t in rows for r in brute.runs(brute.words_of(t))), key=repr)
    assert runs.periodic_run_table(frame.limit(0)).count() == 0


def test_registered_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = [r for r in rows if len(r[1]) < 6000]  # the plain version takes the square of a text
    got = {tuple(r) for r in queries.QUERIES["op12_periodic_runs"](spark, sf).select(*COLUMNS).collect()}
    assert set(brute.periodic(rows)) <= got and sum(r[1] > 0 for r in got) > 10


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=40), st.integers(1, 7)), max_size=6))
def test_any_words(pieces):
    x = np.array([w for unit, times in pieces for w in unit * times], dtype=np.int64)
    assert runs.periodic_runs([x, x[:5], x[::-1]]) == [brute.runs(list(x)), brute.runs(list(x[:5])), brute.runs(list(x[::-1]))]


def test_strongest_compares_exactly():
    assert runs.strongest([(0, 12, 3), (20, 8, 2), (40, 13, 3), (60, 13, 3)]) == (40, 13, 3)
    assert runs.strongest([]) is None


def test_minimizers_of_a_run_repeat_at_its_period():
    rng = np.random.default_rng(1)
    for q in (33, 48, 64):
        unit = rng.integers(0, 1 << 62, q).astype(np.uint64)
        grams = np.resize(unit, 4 * q - 64 + 1)  # k = 64: what a run of four periods leaves
        _, lags = runs.scale_seeds(grams, 32)
        assert (lags == q).any()


def test_work_grows_with_the_text_not_with_its_square():
    rng = np.random.default_rng(5)
    text = np.concatenate([np.resize(rng.integers(0, 9, q), 5 * q) for q in (7, 400, 30_000)] + [np.zeros(100_000, dtype=np.int64), rng.integers(0, 2, 100_000)])
    got = runs.periodic_runs([text])[0]
    assert {7, 400, 30_000, 1} <= {q for _, _, q in got}
