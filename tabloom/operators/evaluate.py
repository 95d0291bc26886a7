"""Evaluation of scored tables.

Ranked metrics use ``ordered_scan`` (pattern B5) or first aggregate to distinct
scores (pattern B6), so no metric needs one task to see all rows. Every result is a
small table (bins, cut-offs, one summary row).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .rank import lay_out, ordered_scan
from .stats import equal_width_bucket, fit_minmax, label_totals, long_counts

# The cut-offs of the depth table.
DEPTH_RATIOS = [0.001, 0.002, 0.003, 0.004, 0.005, 0.01, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3,
                0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95, 1]


def _ln_ratio(a: Column, b: Column) -> Column:
    return F.when((a > 0) & (b > 0), F.ln(a / b))


# ------------------------------------------------------------------ E4 ------------
def feature_iv(df: DataFrame, label: str, cat_cols: list[str], num_cols: list[str], bins: int = 10,
               reg: float = 1.0, fill_num: float = -99.0, fill_cat: str = "-99") -> DataFrame:
    """IV per column: numeric -> ``bins`` equal-width bins after filling nulls with -99,
    categorical -> values with null as '-99'; Laplace ``reg``; empty bins count (T12)."""
    P, N = label_totals(df, label)
    mm = fit_minmax(df, num_cols, fill=fill_num)
    buckets = {c: F.coalesce(F.col(c).cast("string"), F.lit(fill_cat)) for c in cat_cols}
    for c in num_cols:
        x = F.coalesce(F.col(c).cast("double"), F.lit(fill_num))
        buckets[c] = F.concat(F.lit("v"), equal_width_bucket(x, *mm[c], bins).cast("string"))
    counts = long_counts(df, label, buckets)
    spark = df.sparkSession
    grid = spark.createDataFrame([(c, f"v{i}") for c in num_cols for i in range(bins)], "feature string, bucket string")
    counts = counts.unionByName(grid.join(counts, ["feature", "bucket"], "left_anti")
                                .withColumn("n", F.lit(0).cast("long")).withColumn("pos", F.lit(0).cast("long")))
    pos = (F.col("pos") + reg) / F.lit(P + 2 * reg)
    neg = (F.col("n") - F.col("pos") + reg) / F.lit(N + 2 * reg)
    return counts.groupBy("feature").agg(F.sum((pos - neg) * F.ln(pos / neg)).alias("iv"))


# ------------------------------------------------------------------ E3 ------------
def iv_table(df: DataFrame, x: str, label: str, bins_expr: Column | None = None) -> DataFrame:
    """Per-bin good/bad table with WOE = ln(good%/bad%), IV, lift and a Total row.

    Rows with a null bin are dropped for the per-bin shares but still count in the
    global good/bad totals used by the recalls (as the reference does).
    """
    P, N = label_totals(df, label)
    T = P + N
    rate = F.lit(P / T if T else None).cast("double")
    b = bins_expr if bins_expr is not None else F.col(x).cast("string")
    g = (df.select(b.alias("bins"), F.col(label).cast("long").alias("_y")).filter(F.col("bins").isNotNull())
         .groupBy("bins").agg((F.count(F.lit(1)) - F.sum("_y")).alias("good"), F.sum("_y").alias("bad"),
                              F.count(F.lit(1)).alias("total")))
    g = cut_lineage(g)  # one row a bin, used several times
    sums = g.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    t = (g.withColumn("good_pct", F.try_divide(F.col("good"), F.lit(sums["good"]).cast("long")))
         .withColumn("bad_pct", F.try_divide(F.col("bad"), F.lit(sums["bad"]).cast("long")))
         .withColumn("goodRecall", F.try_divide(F.col("good"), F.lit(float(N))))
         .withColumn("badRecall", F.try_divide(F.col("bad"), F.lit(float(P))))
         .withColumn("groupRecall", F.try_divide(F.col("total"), F.lit(float(T))))
         .withColumn("innerBadRate", F.col("bad") / F.col("total"))
         .withColumn("woe", _ln_ratio(F.col("good_pct"), F.col("bad_pct")))
         .withColumn("iv", (F.col("good_pct") - F.col("bad_pct")) * F.col("woe"))
         .withColumn("lift", F.try_divide(F.col("bad") / F.col("total"), rate)))
    tot = t.agg(F.lit("Total").alias("bins"), F.sum("good").alias("good"), F.sum("bad").alias("bad"),
                F.sum("total").alias("total"), F.sum("good_pct").alias("good_pct"), F.sum("bad_pct").alias("bad_pct"),
                F.sum("goodRecall").alias("goodRecall"), F.sum("badRecall").alias("badRecall"),
                F.sum("groupRecall").alias("groupRecall"),
                F.try_divide(F.sum("bad"), F.sum("good") + F.sum("bad")).alias("innerBadRate"),
                F.lit(None).cast("double").alias("woe"), F.sum("iv").alias("iv"),
                F.try_divide(F.try_divide(F.sum("bad"), F.sum("good") + F.sum("bad")), rate).alias("lift"))
    return t.unionByName(tot)


# ------------------------------------------------------------------ E2 ------------
def ks_table(df: DataFrame, score: str, label: str, tiebreak: str, nbins: int = 10,
             ascending: bool = False) -> DataFrame:
    """KS table with equal-count groups ``min(nb-1, floor(rank/(n/nb)))`` (trap T5)."""
    data = df.select(score, label, tiebreak).dropna(subset=[score, label])
    n = data.count()
    ranked = ordered_scan(data, [(score, ascending), (tiebreak, True)], rank_col="_rank")
    grp = F.least(F.lit(nbins - 1), F.floor(F.col("_rank") / F.lit(n / nbins))).cast("int")
    g = (ranked.withColumn("_g", grp).groupBy("_g")
         .agg(F.count(F.lit(1)).alias("Total"), F.min(score).alias("MinScore"), F.avg(score).alias("MeanScore"),
              F.max(score).alias("MaxScore"), F.sum(F.col(label).cast("long")).alias("BadCnt")))
    return ks_layout(g, nbins, n)


def ks_layout(groups: DataFrame, nbins: int | None, n: int | None) -> DataFrame:
    """The KS table from its groups (_g from 0, Total, MinScore, MeanScore, MaxScore, BadCnt): rates, cumulative rates,
    bumps, lift and a Total row. Groups that are missing of ``nbins`` are empty (None: there are as many as rows);
    ``n``: all rows (None: those of the groups)."""
    groups = cut_lineage(groups)  # a row a group, used several times
    n = n if n is not None else groups.agg(F.sum("Total")).first()[0] or 0
    full = groups if nbins is None else groups.sparkSession.range(nbins).select(F.col("id").cast("int").alias("_g")).join(groups, "_g", "left").fillna(0, ["Total", "BadCnt"])
    w = Window.orderBy("_g")  # nbins rows
    wall = Window.partitionBy()
    rate = F.try_divide("BadCnt", "Total")
    t = (full.withColumn("GoodCnt", F.col("Total") - F.col("BadCnt"))
         .withColumn("InnerBadRate", rate)
         .withColumn("_up", F.when(F.col("InnerBadRate") > F.lag("InnerBadRate").over(w), 1).otherwise(0))
         .withColumn("bumps", F.sum("_up").over(w.rowsBetween(Window.unboundedPreceding, 0)))
         .withColumn("BadRate", F.try_divide(F.col("BadCnt"), F.sum("BadCnt").over(wall)))
         .withColumn("GoodRate", F.try_divide(F.col("GoodCnt"), F.sum("GoodCnt").over(wall)))
         .withColumn("CumTotalBadRate", F.sum("BadRate").over(w.rowsBetween(Window.unboundedPreceding, 0)))
         .withColumn("CumTotalGoodRate", F.sum("GoodRate").over(w.rowsBetween(Window.unboundedPreceding, 0)))
         .withColumn("K-S", F.col("CumTotalBadRate") - F.col("CumTotalGoodRate"))
         .withColumn("Lift", F.try_divide(F.col("InnerBadRate") * (F.sum("BadCnt").over(wall) + F.sum("GoodCnt").over(wall)),
                                            F.sum("BadCnt").over(wall)))
         .withColumn("Population", F.try_divide(F.col("Total"), F.lit(float(n))))
         .withColumn("Rank", (F.col("_g") + 1).cast("string")))
    # The columns of the table.
    cols = ["Rank", "Population", "Total", "bumps", "MinScore", "MeanScore", "MaxScore", "BadCnt", "GoodCnt",
            "InnerBadRate", "BadRate", "CumTotalBadRate", "GoodRate", "CumTotalGoodRate", "K-S", "Lift"]
    t = t.select(*[F.col(f"`{c}`") for c in cols])
    tot = t.agg(F.lit("Total").alias("Rank"), F.lit(1.0).alias("Population"), F.sum("Total").alias("Total"),
                F.lit(None).cast("long").alias("bumps"), F.min("MinScore").alias("MinScore"),
                F.try_divide(F.sum(F.col("MeanScore") * F.col("Total")), F.sum("Total")).alias("MeanScore"),
                F.max("MaxScore").alias("MaxScore"), F.sum("BadCnt").alias("BadCnt"), F.sum("GoodCnt").alias("GoodCnt"),
                F.try_divide(F.sum("BadCnt"), F.sum("Total")).alias("InnerBadRate"), F.lit(None).cast("double").alias("BadRate"),
                F.lit(None).cast("double").alias("CumTotalBadRate"),
                F.try_divide(F.sum("GoodCnt"), F.sum("Total")).alias("GoodRate"),
                F.lit(None).cast("double").alias("CumTotalGoodRate"), F.max("`K-S`").alias("K-S"),
                F.lit(None).cast("double").alias("Lift"))
    return t.unionByName(tot)


# ------------------------------------------------------------------ E8 ------------
def auc(df: DataFrame, score: str, label: str, dropna: bool = True, nan: float = -999.0) -> DataFrame:
    """Exact ROC AUC (Mann-Whitney with mid-ranks for ties), via distinct scores."""
    s = F.col(score).cast("double")
    data = df.select((s if dropna else F.coalesce(s, F.lit(nan))).alias("s"), F.col(label).cast("long").alias("y"))
    data = data.dropna()
    per = data.groupBy("s").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    sc = ordered_scan(per, [("s", True)], sums=["neg"], rank_col="_r")
    # One class only: no pair to order, the area is null.
    return sc.agg(F.try_divide(F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + 0.5 * F.col("neg"))),
                               F.sum("pos") * F.sum("neg")).alias("auc"))


# ------------------------------------------------------------------ E9 ------------
def aucpr(df: DataFrame, score: str, label: str, num_partitions: int | None = None) -> DataFrame:
    """Trapezoid over (recall, precision) at every distinct threshold, starting from
    the point (recall 0, precision 1) and stopping at full recall (trap T16).

    Thresholds are laid out in ranges; the totals of the ranges before it (a row a range on the driver) tell each range
    where it starts, and it gives back its share of the area."""
    data = df.select(F.col(score).cast("double").alias("s"), F.col(label).cast("long").alias("y")).dropna()
    per = data.groupBy("s").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    laid = lay_out(per, [("s", False)], [], num_partitions)
    totals = {r["__range"]: (r["p"], r["n"]) for r in laid.groupBy("__range").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).collect()}
    starts, at = {}, (0, 0)
    for i in sorted(totals):
        starts[i], at = at, (at[0] + totals[i][0], at[1] + totals[i][1])

    def area(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = {}, 0.0
        for batch in batches:
            ranges, pos, neg = (batch.column(i).to_numpy() for i in range(3))
            cuts = np.flatnonzero(np.diff(ranges)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(ranges)] if len(ranges) else []):
                own = int(ranges[lo])
                p0, n0 = now.get(own, starts[own])
                p, n = p0 + np.cumsum(pos[lo:hi]), n0 + np.cumsum(neg[lo:hi])
                now = {own: (int(p[-1]), int(n[-1]))}
                prec = p / (p + n)
                before = p0 / (p0 + n0) if p0 + n0 else 1.0
                total += float(np.sum(0.5 * (prec + np.r_[before, prec[:-1]]) * pos[lo:hi]))  # 0 wide beyond full recall
        yield pa.record_batch([pa.array([total])], names=["part"])

    parts = laid.select("__range", "pos", "neg").mapInArrow(area, "part double")
    return parts.agg(F.try_divide(F.sum("part"), F.lit(float(at[0]))).alias("aucpr"))


# ------------------------------------------------------------------ E10 -----------
def gini_normalization(df: DataFrame, score: str, label: str, tiebreak: str) -> DataFrame:
    """0.5 - mean midpoint of the cumulative positive share in ascending score order."""
    data = df.select(score, label, tiebreak)
    sc = ordered_scan(data, [(score, True), (tiebreak, True)], sums=[label], rank_col="_r")
    P = data.agg(F.sum(label)).first()[0]
    r = F.col(f"cum_{label}") / F.lit(float(P))
    agg = sc.agg(F.sum(r).alias("sr"), F.count(F.lit(1)).alias("n"),
                 F.max(F.when(F.col("_r") == 1, r)).alias("r0"))
    return agg.select((F.lit(0.5) - (F.col("sr") - (F.col("r0") + F.lit(1.0)) / 2) / (F.col("n") - 1)).alias("gini"))


# ------------------------------------------------------------------ E6/E7 ---------
def _ranked_desc(df, score, label, tiebreak):
    data = df.select(score, label, tiebreak)
    return ordered_scan(data, [(score, False), (tiebreak, True)], rank_col="_r")


def top_ratio_hit_rate(df: DataFrame, score: str, label: str, tiebreak: str, top_ratio: float = 0.001) -> DataFrame:
    """Hit rate in the top share (one row at least) and cover of the top 30 %."""
    n = df.count()
    k = max(1, int(n * top_ratio))
    k30 = int(0.3 * n)
    rk = _ranked_desc(df, score, label, tiebreak)
    y = F.col(label).cast("double")
    return rk.agg((F.sum(F.when(F.col("_r") <= k, y)) / F.lit(float(k))).alias("hit_rate"),
                  F.lit(k).cast("long").alias("top_k"),
                  (F.sum(F.when(F.col("_r") <= k30, y)) / F.sum(y)).alias("cover"))


def depth_table(df: DataFrame, score: str, label: str, tiebreak: str, ratios=DEPTH_RATIOS) -> DataFrame:
    """Hit rate, cover, size, lift and threshold at each cut-off: one pass, one aggregate."""
    n = df.count()
    ks = [max(1, int(n * r)) for r in ratios]
    rk = _ranked_desc(df, score, label, tiebreak)
    y = F.col(label).cast("double")
    aggs = [F.sum(y).alias("P")]
    for i, k in enumerate(ks):
        aggs += [F.sum(F.when(F.col("_r") <= k, y)).alias(f"h{i}"), F.max(F.when(F.col("_r") == k, F.col(score))).alias(f"t{i}")]
    row = rk.agg(*aggs)
    structs = [F.struct(F.lit(r).alias("depth"), (F.col(f"h{i}") / F.lit(float(k))).alias("hit_rate"),
                        (F.col(f"h{i}") / F.col("P")).alias("cover"), F.lit(k).cast("long").alias("samples"),
                        ((F.col(f"h{i}") / F.lit(float(k))) / (F.col("P") / F.lit(float(n)))).alias("lift"),
                        F.col(f"t{i}").alias("threshold")) for i, (r, k) in enumerate(zip(ratios, ks))]
    return row.select(F.inline(F.array(*structs)))


# ------------------------------------------------------------------ E11/E12 -------
def log_loss(p: Column, y: Column, pos_weight: float = 1.0, eps: float = 1e-7) -> Column:
    q = F.least(F.greatest(p.cast("double"), F.lit(eps)), F.lit(1 - eps))
    return -(F.lit(pos_weight) * y * F.ln(q) + (1 - y) * F.ln(1 - q))


def focal_loss(p: Column, y: Column, alpha: float = 0.25, gamma: float = 2.0, eps: float = 1e-7) -> Column:
    q = F.least(F.greatest(p.cast("double"), F.lit(eps)), F.lit(1 - eps))
    return (-F.lit(alpha) * F.pow(1 - q, gamma) * y * F.ln(q)
            - F.lit(1 - alpha) * F.pow(q, gamma) * (1 - y) * F.ln(1 - q))


def focal_loss_classes(p: Column, y: Column, alpha: list[float], gamma: float = 2.0, eps: float = 1e-7) -> Column:
    """E12 for several classes: ``p`` an array of probabilities, ``y`` the class from 0, a weight for every class."""
    q = F.least(F.greatest(p[y].cast("double"), F.lit(eps)), F.lit(1 - eps))
    return -F.array(*[F.lit(float(a)) for a in alpha])[y] * F.pow(1 - q, gamma) * F.ln(q)


# ------------------------------------------------------------------ E15/E16 -------
def calibration(df: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    """Mean predicted vs observed rate per equal-width bin of [0, 1]."""
    b = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return (df.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_p"),
                                          F.avg(F.col(label).cast("double")).alias("rate")))


def conditional_rate(df: DataFrame, key: str, cond: Column, event: Column) -> DataFrame:
    """p(z|y) = p(z and y) / p(y) over units ``key`` (e.g. users)."""
    per = df.groupBy(key).agg(F.max(cond.cast("int")).alias("y"), F.max(event.cast("int")).alias("z"))
    return per.agg(F.sum("y").alias("n_y"), F.sum(F.col("y") * F.col("z")).alias("n_zy"),
                   (F.sum(F.col("y") * F.col("z")) / F.sum("y")).alias("p_z_given_y"))


def mean_std(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mean and population std per metric column."""
    structs = [F.struct(F.lit(c).alias("metric"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")) for c in cols]
    return df.agg(F.array(*structs).alias("a")).select(F.inline("a"))
