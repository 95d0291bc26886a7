"""Supervised bins against a plain best-first tree, and the tables on degenerate columns."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import binning, evaluate


def plain_edges(values, labels, max_leaves=6, min_leaf=0.05):
    """Grow the tree over the sorted rows, one leaf after the other."""
    rows = sorted(zip(values, labels))
    n = len(rows)
    least = max(1, math.ceil(n * min_leaf))
    up = np.r_[0, np.cumsum([y for _, y in rows])]

    def mass(a, b):
        total, pos = b - a, up[b] - up[a]
        return sum(-k * math.log2(k / total) for k in (pos, total - pos) if k > 0)

    def best(a, b):
        if not 0 < up[b] - up[a] < b - a:
            return None
        cuts = [(-round((mass(a, b) - mass(a, i) - mass(i, b)) / n, binning.PLACES), a, rows[i - 1][0], rows[i][0], i)
                for i in range(a + least, b - least + 1) if rows[i - 1][0] < rows[i][0]]
        return min(cuts, default=None)

    leaves, cuts = {(0, n): best(0, n)}, []
    while len(leaves) < max_leaves and (ready := [(c, leaf) for leaf, c in leaves.items() if c]):
        (_, _, low, high, i), (a, b) = min(ready)
        cuts.append(low / 2 + high / 2)
        del leaves[a, b]
        leaves[a, i], leaves[i, b] = best(a, i), best(i, b)
    return [rows[0][0], *sorted(cuts), rows[-1][0] + 0.1]


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(7)
    n = 900
    a = np.round(r.normal(0, 1, n), 2)
    y = (r.random(n) < 1 / (1 + np.exp(-np.sin(3 * a)))).astype(int)
    few = r.integers(0, 4, n).astype(float)
    rare = np.where(np.arange(n) < 30, 50.0, r.random(n))  # 30 rows are under 5 %
    return [(int(i), int(y[i]), float(a[i]), float(few[i]), float(rare[i]), 5.0, float(y[i]), float(i) if i % 3 else None) for i in range(n)]


COLS = ["a", "few", "rare", "flat", "leak", "gaps"]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "id long, y int, " + ", ".join(f"{c} double" for c in COLS)).repartition(3)


@pytest.mark.parametrize("leaves, least", [(6, 0.05), (3, 0.05), (6, 0.2), (2, 0.5), (12, 0.001)])
def test_edges_are_those_of_a_plain_tree(df, rows, leaves, least):
    got = binning.optimal_boundaries(df, COLS, "y", leaves, least)
    for i, c in enumerate(COLS):
        want = plain_edges([-999.0 if r[2 + i] is None else r[2 + i] for r in rows], [r[1] for r in rows], leaves, least)
        assert got[c] == pytest.approx(want, abs=1e-12), c
    assert got["flat"] == [5.0, 5.1] and len(got["leak"]) == (3 if least < 0.4 else 2)


def test_empty_columns_and_one_class(spark, df):
    none = df.withColumn("a", F.lit(None).cast("double"))
    assert binning.optimal_boundaries(none, ["a"], "y", fill=None) == {}
    assert binning.optimal_boundaries(df.limit(0), ["a"], "y") == {}
    one = df.withColumn("y", F.lit(1))
    assert len(binning.optimal_boundaries(one, ["a"], "y")["a"]) == 2
    table = {r["bins"]: r for r in binning.numeric_iv_table(one, "a", "y").collect()}
    assert set(table) == {"0", "Total"} and table["0"]["good"] == 0 and table["0"]["goodRecall"] is None and table["Total"]["iv"] is None
    summary = binning.column_summary(one, ["a", "gaps"], "y", "id").collect()
    assert all(r["auc"] is None and r["ks"] is None for r in summary) and {r["coverage_rate"] for r in summary} == {1.0, 600 / 900}
    assert binning.column_summary(none, ["a"], "y", "id").first()["iv"] is None


def test_numeric_iv_table_counts_every_row_once(df, rows):
    t = {r["bins"]: r for r in binning.numeric_iv_table(df, "gaps", "y").collect()}
    assert t["Total"]["total"] == 600 == sum(r["total"] for b, r in t.items() if b != "Total")
    for r in t.values():
        if r["lo"] is not None:
            held = [x for x in rows if x[7] is not None and r["lo"] <= x[7] < r["hi"]]
            assert (r["total"], r["bad"]) == (len(held), sum(x[1] for x in held))
    flat = {r["bins"]: r for r in binning.numeric_iv_table(df, "flat", "y").collect()}
    assert flat["Total"]["iv"] == pytest.approx(0)


def test_summary_agrees_with_the_single_tables(df):
    got = {r["feature"]: r for r in binning.column_summary(df, COLS, "y", "id").collect()}
    for c in COLS:
        assert got[c]["ks"] == pytest.approx(evaluate.ks_table(df, c, "y", "id").filter("Rank = 'Total'").first()["K-S"])
        assert got[c]["auc"] == pytest.approx(evaluate.auc(df, c, "y").first()[0])
        iv = binning.numeric_iv_table(df, c, "y").filter("bins = 'Total'").first()["iv"]
        assert got[c]["iv"] == (pytest.approx(iv) if iv is not None else None)


def test_ks_modes(df, rows):
    by = {r["Rank"]: r for r in binning.ks_table_by_category(df, "few", "y", ascending=True).collect()}
    assert [by[str(i + 1)]["Total"] for i in range(4)] == [sum(r[3] == i for r in rows) for i in range(4)]
    edges = [-1.0, 0.0, 0.5, 9.0, 10.0]
    by = {r["Rank"]: r for r in binning.ks_table_by_edges(df, "a", "y", edges).collect()}
    inside = lambda lo, hi: sum(lo < r[2] <= hi for r in rows)
    assert [by[str(i)]["Total"] for i in (1, 2, 3, 4)] == [inside(9, 10), inside(0.5, 9), inside(0, 0.5), inside(-1, 0)]
    assert by["1"]["InnerBadRate"] is None and by["Total"]["Total"] == inside(-1, 10)
    assert binning.ks_table_by_category(df.limit(0), "few", "y").filter("Rank != 'Total'").count() == 0
