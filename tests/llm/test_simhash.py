"""SimHash groups against plain Python, with nodes split in Spark and dense families."""

import random

import numpy as np
import pytest

from tabloom.llm import queries, simhash

from . import brute
from .test_operators import awkward, frame

COLUMNS = ["doc_id", "fingerprint", "component_id"]


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def components(prints, errors=4):
    up = list(range(len(prints)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(prints)):
        near = np.flatnonzero(np.bitwise_count(prints[:i] ^ prints[i]) <= errors)
        for j in near.tolist():
            a, b = root(i), root(j)
            up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def test_awkward_rows(spark):
    rows = [r for r in dict.fromkeys(awkward()) if r[0] is not None and r[0] != 7]
    rows += [(10_000 + i, t) for i, t in enumerate(["", None, " ", "one two", "ONE two", "one two three four", "É é"])]
    assert found(simhash.simhash_groups(frame(spark, rows))) == sorted(brute.simhash(rows), key=repr)
    repeated = rows + [(None, "one two"), rows[5], (rows[5][0], "one two")]
    whole = simhash.simhash_groups(frame(spark, repeated))
    assert found(whole) == sorted(brute.simhash(repeated), key=repr)
    assert simhash.simhash_groups(frame(spark, rows).limit(0)).count() == 0


def test_registered_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op13_simhash"](spark, sf)
    assert found(got) == sorted(brute.simhash(rows), key=repr)


def family(n, seed, spread=9, seeds=3):
    """Fingerprints around a few middles, some bits apart, and some alone."""
    r = random.Random(seed)
    middles = [r.getrandbits(64) for _ in range(seeds)]
    out = set()
    while len(out) < n:
        x = r.choice(middles) if r.random() < 0.8 else r.getrandbits(64)
        for _ in range(r.randrange(spread)):
            x ^= 1 << r.randrange(64)
        out.add(x)
    return np.array(sorted(out, key=lambda x: r.random()), dtype=np.uint64)


@pytest.mark.parametrize("direct, walk", [(128, 1 << 16), (1, 1 << 16), (1, 50)])
def test_walk_finds_every_link(monkeypatch, direct, walk):
    monkeypatch.setattr(simhash, "_DIRECT", direct)
    monkeypatch.setattr(simhash, "_WALK", walk)
    for seed in range(6):
        keys = np.sort(family(300, seed, spread=4 + seed))
        moved, roots = simhash.cell_links(keys, [(0, 300, 300, 0)], 4)
        got = np.arange(300)
        got[moved] = roots
        assert got.tolist() == components(keys)
        half = int(np.searchsorted(keys, np.uint64(1 << 63)))
        moved, roots = simhash.cell_links(keys, [(0, half, half, 1), (half, 300, 300, 1), (0, half, 300, 1)], 4)
        got = np.arange(300)
        got[moved] = roots
        assert got.tolist() == components(keys)


def test_a_dense_family_does_not_cost_its_square(monkeypatch):
    compared = []
    count = np.bitwise_count
    monkeypatch.setattr(simhash.np, "bitwise_count", lambda x: compared.append(np.size(x)) or count(x))
    middle = random.Random(1).getrandbits(64)
    spots = random.Random(2).sample(range(64), 14)
    keys = np.sort(np.array([middle ^ sum(1 << s for b, s in enumerate(spots) if i >> b & 1) for i in range(1 << 14)], dtype=np.uint64))
    moved, roots = simhash.cell_links(keys, [(0, len(keys), len(keys), 0)], 4)
    assert len(moved) == len(keys) - 1 and set(roots) == {0}
    assert sum(compared) < 300 * len(keys)  # all pairs would be 8,192 a key


@pytest.mark.parametrize("limit", [None, 400, 40])
def test_nodes_are_split_until_they_fit(spark, limit):
    prints = family(1500, 8, spread=12, seeds=2)
    entries = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long").repartition(3)
    label = {r["a"]: r["b"] for r in simhash.component_labels(simhash.fingerprint_links(entries, 4, limit)).collect()}
    got = {}
    for x in prints.view(np.int64).tolist():
        got.setdefault(label.get(x, x), set()).add(x)
    want = {}
    for x, c in zip(prints.view(np.int64).tolist(), components(prints)):
        want.setdefault(c, set()).add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    if limit:
        sizes = simhash.cells(entries, 4, limit).groupBy("trie", "low", "high", "level").count()
        assert sizes.agg({"count": "max"}).first()[0] <= limit


def test_majority_of_long_lists_of_hashes(monkeypatch):
    monkeypatch.setattr(simhash, "_SHINGLES", 7)
    h = np.random.default_rng(1).integers(0, 1 << 63, 100, dtype=np.uint64) * np.uint64(2)
    assert simhash.majority(h) == sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in h) > 100)
    assert simhash.majority(h[:0]) == 0 and simhash.majority(h[:1]) == int(h[0])
