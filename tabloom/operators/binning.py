"""Supervised binning (E1), the tables that rest on it (E3 for numbers, E5) and the KS table's modes.

All columns are handled at once in long form (feature, value, label). A tree is grown best-first over a
histogram of class counts: one row for every distinct value, with running counts from ``ordered_scan``, so
that the class counts on both sides of every cut are differences of two running counts. A round is one
aggregate that finds the best cut of each leaf that is new; only leaves (a few a column) reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .evaluate import iv_table, ks_layout
from .rank import ordered_scan

#: Gains are compared after rounding to so many places; equal ones go to the smaller value.
PLACES = 12


def long_form(df: DataFrame, cols: list[str], label: str, fill: float | None = None, keep: list[str] = ()) -> DataFrame:
    """(feature, v, y, kept columns): a row for every numeric value; nulls and NaN become ``fill`` or go."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias("v")) for c in cols])
    out = df.select(F.col(label).cast("long").alias("y"), *keep, F.explode(pairs).alias("p")).select("p.feature", "p.v", "y", *keep).filter("y IS NOT NULL")
    return out.fillna(float(fill), ["v"]) if fill is not None else out.filter("v IS NOT NULL")


def class_histogram(long: DataFrame) -> DataFrame:
    """(feature, v, n, pos, cum_n, cum_pos, v_next) of every distinct value, checkpointed."""
    per = long.groupBy("feature", "v").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos"))
    return cut_lineage(ordered_scan(per, [("v", True)], by=["feature"], sums=["n", "pos"], leads=["v"], rank_col="_r").drop("_r"))


def _mass(n: Column, pos: Column) -> Column:
    """Entropy in bits times the number of rows."""
    part = lambda k: F.when(k > 0, -k * F.log2(k / n)).otherwise(F.lit(0.0))
    return part(pos) + part(n - pos)


def _best_cuts(hist: DataFrame, leaves: list[tuple]) -> dict[tuple, tuple]:
    """(feature, rows before) -> (gain, value, next value, rows up to it, positives up to it) of each leaf
    (feature, rows and positives before, at its end, least rows of a side, all rows) that can be cut."""
    spark = hist.sparkSession
    table = spark.createDataFrame(leaves, "feature string, a_n double, a_pos double, b_n double, b_pos double, least double, total double")
    # A few leaves a column: every task may hold them.
    j = hist.join(F.broadcast(table), "feature").filter((F.col("cum_n") - F.col("a_n") >= F.col("least")) & (F.col("b_n") - F.col("cum_n") >= F.col("least")) & (F.col("b_n") > F.col("cum_n")) & (F.col("cum_n") > F.col("a_n")))
    n, pos = F.col("b_n") - F.col("a_n"), F.col("b_pos") - F.col("a_pos")
    ln, lp = F.col("cum_n") - F.col("a_n"), F.col("cum_pos") - F.col("a_pos")
    gain = F.round((_mass(n, pos) - _mass(ln, lp) - _mass(n - ln, pos - lp)) / F.col("total"), PLACES)
    best = j.groupBy("feature", "a_n").agg(F.min(F.struct((-gain).alias("loss"), "v", "v_next", "cum_n", "cum_pos")).alias("b"))
    return {(r["feature"], r["a_n"]): (-r["b"]["loss"], *r["b"][1:]) for r in best.collect()}


def boundaries_of(hist: DataFrame, max_leaves: int = 6, min_leaf: float = 0.05) -> dict[str, list[float]]:
    """Edges [smallest, cuts..., largest + 0.1] of every feature of a ``class_histogram``.

    Best-first: of all leaves the one whose best cut lowers the entropy most is cut next, until there are
    ``max_leaves``; a side keeps at least ``min_leaf`` of all rows (rounded up); a pure leaf is not cut.
    Cuts lie midway between two neighbouring values.
    """
    ends = {r["feature"]: r for r in hist.groupBy("feature").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.max("cum_n").alias("n"), F.max("cum_pos").alias("pos")).collect()}
    least = {f: max(1.0, float(-(-r["n"] * min_leaf // 1))) for f, r in ends.items()}
    # feature -> {rows before the leaf: (positives before, rows and positives at its end, best cut or None)}
    leaves = {f: {0.0: (0.0, r["n"], r["pos"], None)} for f, r in ends.items()}
    cuts: dict[str, list[float]] = {f: [] for f in ends}
    fresh = [(f, 0.0) for f in ends]
    for _ in range(max_leaves - 1):
        open_ = [(f, a, leaves[f][a]) for f, a in fresh]
        asked = [(f, a, x[0], x[1], x[2], least[f], ends[f]["n"]) for f, a, x in open_ if x[1] - a >= 2 * least[f] and 0 < x[2] - x[0] < x[1] - a]
        if asked:
            for (f, a), cut in _best_cuts(hist, asked).items():
                leaves[f][a] = (*leaves[f][a][:3], cut)
        fresh = []
        for f, mine in leaves.items():
            ready = [(-x[3][0], a) for a, x in mine.items() if x[3] is not None]
            if ready:
                a = min(ready)[1]
                a_pos, b_n, b_pos, (_, v, after, at_n, at_pos) = mine[a]
                cuts[f].append(v / 2 + after / 2)
                mine[a], mine[at_n] = (a_pos, at_n, at_pos, None), (at_pos, b_n, b_pos, None)
                fresh += [(f, a), (f, at_n)]
        if not fresh:
            break
    return {f: [ends[f]["lo"], *sorted(cuts[f]), ends[f]["hi"] + 0.1] for f in ends}


def optimal_boundaries(df: DataFrame, cols: list[str], label: str, max_leaves: int = 6, min_leaf: float = 0.05, fill: float | None = -999.0) -> dict[str, list[float]]:
    """Binning edges of every column, chosen by the label. Null is ``fill``, or left out where that is None.
    Columns without a value are missing from the result."""
    return boundaries_of(class_histogram(long_form(df, cols, label, fill)), max_leaves, min_leaf)


def boundary_table(spark, edges: dict[str, list[float]]) -> DataFrame:
    """(feature, bin, lo, hi) of all bins [lo, hi)."""
    rows = [(f, i, lo, hi) for f, e in edges.items() for i, (lo, hi) in enumerate(zip(e, e[1:]))]
    return spark.createDataFrame(rows, "feature string, bin int, lo double, hi double")


def bin_of(x: Column, edges: list[float]) -> Column:
    """Number of the bin [edge, next edge) that holds x; null outside."""
    x = x.cast("double")
    inner = sum((F.when(x >= e, 1).otherwise(0) for e in edges[1:-1]), F.lit(0))
    return F.when((x >= edges[0]) & (x < edges[-1]), inner)


def numeric_iv_table(df: DataFrame, x: str, label: str, max_leaves: int = 6, min_leaf: float = 0.05) -> DataFrame:
    """E3 for a number: the table of ``iv_table`` over the bins of ``optimal_boundaries`` (nulls left out), with ``lo``
    and ``hi`` of each bin; the bins are numbered from 0."""
    edges = optimal_boundaries(df, [x], label, max_leaves, min_leaf, fill=None).get(x, [0.0, 0.0])
    table = iv_table(df, x, label, bins_expr=bin_of(F.col(x), edges).cast("string"))
    places = boundary_table(df.sparkSession, {x: edges}).select(F.col("bin").cast("string").alias("bins"), "lo", "hi")
    return table.join(F.broadcast(places), "bins", "left")


# ------------------------------------------------------------------ E2 modes --------
def ks_table_by_category(df: DataFrame, score: str, label: str, ascending: bool = False) -> DataFrame:
    """KS table with a group for every distinct score, in the order of the scores. Meant for few categories."""
    data = df.select(score, label).dropna()
    per = cut_lineage(data.groupBy(score).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("bad")))
    ranked = ordered_scan(per, [(score, ascending)], rank_col="_r")
    s = F.col(score).cast("double")
    groups = ranked.select((F.col("_r") - 1).cast("int").alias("_g"), F.col("n").alias("Total"), s.alias("MinScore"), s.alias("MeanScore"), s.alias("MaxScore"), F.col("bad").alias("BadCnt"))
    return ks_layout(groups, None, None)


def ks_table_by_edges(df: DataFrame, score: str, label: str, edges: list[float], ascending: bool = False) -> DataFrame:
    """KS table with the groups (edge, next edge], the highest scores first unless ``ascending``. Scores outside all
    edges are in no group; they count in the population."""
    edges = sorted(edges)
    data = df.select(F.col(score).cast("double").alias("s"), F.col(label).cast("long").alias("y")).dropna()
    above = sum((F.when(F.col("s") > e, 1).otherwise(0) for e in edges[1:-1]), F.lit(0))
    group = F.when((F.col("s") > edges[0]) & (F.col("s") <= edges[-1]), above if ascending else len(edges) - 2 - above)
    groups = (data.groupBy(group.alias("_g")).agg(F.count(F.lit(1)).alias("Total"), F.min("s").alias("MinScore"), F.avg("s").alias("MeanScore"),
                                                  F.max("s").alias("MaxScore"), F.sum("y").alias("BadCnt")))
    groups = cut_lineage(groups)
    n = groups.agg(F.sum("Total")).first()[0] or 0
    return ks_layout(groups.filter("_g IS NOT NULL"), len(edges) - 1, n)


# ------------------------------------------------------------------ E5 --------------
def column_summary(df: DataFrame, cols: list[str], label: str, tiebreak: str, nbins: int = 10) -> DataFrame:
    """E5: coverage_rate, ks, auc and iv of every numeric column against the label; nulls are left out of all but the
    coverage. ks is the greatest difference of the cumulative shares over ``nbins`` equal-count groups of falling
    values, iv the total of ``numeric_iv_table``. Columns without a value have a coverage only."""
    spark = df.sparkSession
    long = cut_lineage(long_form(df.withColumnRenamed(tiebreak, "_id"), cols, label, keep=["_id"]))
    covered = df.agg(*[F.avg((~F.isnull(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")))).cast("double")).alias(c) for c in cols])
    coverage = covered.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("coverage_rate")) for c in cols])))
    # ks
    sizes = long.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("bad"))
    ranked = ordered_scan(long, [("v", False), ("_id", True)], by=["feature"], rank_col="_r").join(F.broadcast(sizes), "feature")
    group = F.least(F.lit(nbins - 1), F.floor(F.col("_r") / (F.col("n") / nbins))).cast("int")
    per = ranked.groupBy("feature", "n", "bad", group.alias("g")).agg(F.sum("y").alias("b"), F.count(F.lit(1)).alias("c"))
    upto = Window.partitionBy("feature").orderBy("g").rowsBetween(Window.unboundedPreceding, 0)  # nbins rows a column
    gap = F.try_divide(F.sum("b").over(upto), F.col("bad")) - F.try_divide(F.sum(F.col("c") - F.col("b")).over(upto), F.col("n") - F.col("bad"))
    ks = per.select("feature", gap.alias("gap")).groupBy("feature").agg(F.max("gap").alias("ks"))
    # auc and edges from the histogram
    hist = class_histogram(long)
    less = F.col("cum_n") - F.col("cum_pos") - (F.col("n") - F.col("pos"))
    auc = hist.groupBy("feature").agg(F.try_divide(F.sum(F.col("pos") * (less + (F.col("n") - F.col("pos")) / 2)), F.sum("pos") * (F.sum("n") - F.sum("pos"))).alias("auc"))
    bins = F.broadcast(boundary_table(spark, boundaries_of(hist)))  # a few bins a column
    good = (F.col("n") - F.col("pos")).alias("good")
    per_bin = (hist.join(bins, "feature").filter("v >= lo AND v < hi").groupBy("feature", "bin").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).select("feature", good, F.col("pos").alias("bad")))
    whole = Window.partitionBy("feature")
    share = lambda c: F.try_divide(F.col(c), F.sum(c).over(whole))
    shares = per_bin.select("feature", share("good").alias("g"), share("bad").alias("b"))
    iv = shares.groupBy("feature").agg(F.sum(F.when((F.col("g") > 0) & (F.col("b") > 0), (F.col("g") - F.col("b")) * F.ln(F.col("g") / F.col("b")))).alias("iv"))
    out = coverage.join(ks, "feature", "left").join(auc, "feature", "left").join(iv, "feature", "left")
    return out.select("feature", "coverage_rate", "ks", "auc", "iv")
