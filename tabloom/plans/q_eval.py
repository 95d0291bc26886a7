"""Queries over the labelled / scored fixtures: encoders' fit tables and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encode as enc
from ..operators import evaluate as ev
from .fixtures import LABELLED_SQL, SCORED_SQL, labelled, scored, table, with_sql
from .registry import register, round_doubles
from .sqlgen import ew_bucket_sql, r6

TOT_SQL = "tot AS (SELECT CAST(sum(y) AS DOUBLE) AS gpos, CAST(count(*) - sum(y) AS DOUBLE) AS gneg FROM labelled)"


# ---------------------------------------------------------------- N6 + E4 ---------
@register("woe_priority", ["N6", "B1"], sql=with_sql(LABELLED_SQL, TOT_SQL, """
g AS (SELECT 'priority' AS feature, coalesce(priority, '-99') AS value,
             CAST(sum(y) AS BIGINT) AS pos, CAST(count(*) - sum(y) AS BIGINT) AS neg
      FROM labelled GROUP BY 2)""") + f"""
SELECT feature, value, pos, neg,
       {r6("ln((pos + 1.0) / (neg + 1.0)) - ln((gpos + 2.0) / (gneg + 2.0))", "woe")}
FROM g, tot""")
def woe_priority(spark, sf):
    """Minimum slice: label, unpivot, group, WOE per value of the order priority."""
    return round_doubles(enc.woe_fit(labelled(spark, sf), "y", ["priority"]))


def _iv_sql(source_cte: str, src: str, label: str, cats: list[str], nums: list[str], bins: int = 10) -> str:
    mm = ", ".join(f"min(coalesce(CAST({c} AS DOUBLE), -99.0)) AS lo_{c}, max(coalesce(CAST({c} AS DOUBLE), -99.0)) AS hi_{c}"
                   for c in nums)
    parts = [f"SELECT '{c}' AS feature, coalesce(CAST({c} AS VARCHAR), '-99') AS bucket, {label} AS y FROM {src}" for c in cats]
    for c in nums:
        b = ew_bucket_sql(f"coalesce(CAST({c} AS DOUBLE), -99.0)", f"lo_{c}", f"hi_{c}", bins)
        parts.append(f"SELECT '{c}' AS feature, 'v' || CAST({b} AS VARCHAR) AS bucket, {label} AS y FROM {src}, mm")
    grid = " UNION ALL ".join(f"SELECT '{c}' AS feature, 'v' || CAST(i AS VARCHAR) AS bucket FROM range({bins}) t(i)"
                              for c in nums)
    return f"""WITH {source_cte},
tot AS (SELECT CAST(sum({label}) AS DOUBLE) AS gpos, CAST(count(*) - sum({label}) AS DOUBLE) AS gneg FROM {src}),
mm AS (SELECT {mm} FROM {src}),
long AS ({' UNION ALL '.join(parts)}),
cnt AS (SELECT feature, bucket, count(*) AS n, sum(y) AS pos FROM long GROUP BY 1, 2),
full_ AS (SELECT feature, bucket, n, pos FROM cnt
          {"UNION ALL SELECT g.feature, g.bucket, 0, 0 FROM (" + grid + ") g ANTI JOIN cnt USING (feature, bucket)" if nums else ""}),
r AS (SELECT feature, (pos + 1.0) / (gpos + 2.0) AS pr, (n - pos + 1.0) / (gneg + 2.0) AS nr FROM full_, tot)
SELECT feature, {r6("sum((pr - nr) * ln(pr / nr))", "iv")} FROM r GROUP BY feature"""


@register("feature_iv_orders", ["E4", "B1", "A19"], sql=_iv_sql(LABELLED_SQL, "labelled", "y",
                                                              ["priority", "app_month"], ["price", "custkey"]))
def feature_iv_orders(spark, sf):
    df = labelled(spark, sf)
    return round_doubles(ev.feature_iv(df, "y", ["priority", "app_month"], ["price", "custkey"]))


LINE_SQL = """line AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, l_quantity, l_extendedprice, l_discount,
                      l_tax, l_linestatus FROM lineitem)"""


@register("feature_iv_lineitem", ["E4", "B1"], sql=_iv_sql(LINE_SQL, "line", "y", ["l_linestatus"],
                                                        ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))
def feature_iv_lineitem(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
    return round_doubles(ev.feature_iv(li, "y", ["l_linestatus"], ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))


# ---------------------------------------------------------------- E3 --------------
@register("iv_table_priority", ["E3"], sql=with_sql(LABELLED_SQL, TOT_SQL, """
g AS (SELECT priority AS bins, CAST(count(*) - sum(y) AS BIGINT) AS good, CAST(sum(y) AS BIGINT) AS bad,
             count(*) AS total FROM labelled WHERE priority IS NOT NULL GROUP BY 1),
t AS (SELECT g.*, good / sum(good) OVER () AS good_pct, bad / sum(bad) OVER () AS bad_pct,
             good / gneg AS goodRecall, bad / gpos AS badRecall, total / (gpos + gneg) AS groupRecall,
             bad / total AS innerBadRate, (bad / total) / (gpos / (gpos + gneg)) AS lift FROM g, tot),
u AS (SELECT bins, good, bad, total, good_pct, bad_pct, goodRecall, badRecall, groupRecall, innerBadRate,
             CASE WHEN good_pct > 0 AND bad_pct > 0 THEN ln(good_pct / bad_pct) END AS woe, lift FROM t)""") + """
SELECT bins, good, bad, total, round(good_pct, 6) AS good_pct, round(bad_pct, 6) AS bad_pct,
       round(goodRecall, 6) AS goodRecall, round(badRecall, 6) AS badRecall, round(groupRecall, 6) AS groupRecall,
       round(innerBadRate, 6) AS innerBadRate, round(woe, 6) AS woe, round((good_pct - bad_pct) * woe, 6) AS iv,
       round(lift, 6) AS lift FROM u
UNION ALL
SELECT 'Total', CAST(sum(good) AS BIGINT), CAST(sum(bad) AS BIGINT), CAST(sum(total) AS BIGINT),
       round(sum(good_pct), 6), round(sum(bad_pct), 6), round(sum(goodRecall), 6), round(sum(badRecall), 6),
       round(sum(groupRecall), 6), round(sum(bad) / (sum(good) + sum(bad)), 6), NULL,
       round(sum((good_pct - bad_pct) * woe), 6),
       round((sum(bad) / (sum(good) + sum(bad))) / (max(gpos) / (max(gpos) + max(gneg))), 6) FROM u, tot""")
def iv_table_priority(spark, sf):
    return round_doubles(ev.iv_table(labelled(spark, sf), "priority", "y"))


# ---------------------------------------------------------------- E2 --------------
KS_SQL = with_sql(SCORED_SQL, """
r AS (SELECT p, y, row_number() OVER (ORDER BY p DESC, id) AS rk, count(*) OVER () AS n FROM scored),
g AS (SELECT CAST(least(9, floor(rk / (n / 10.0))) AS INTEGER) AS g, count(*) AS Total, min(p) AS MinScore,
             avg(p) AS MeanScore, max(p) AS MaxScore, CAST(sum(y) AS BIGINT) AS BadCnt, max(n) AS n FROM r GROUP BY 1),
f AS (SELECT i AS g, coalesce(Total, 0) AS Total, MinScore, MeanScore, MaxScore, coalesce(BadCnt, 0) AS BadCnt,
             (SELECT count(*) FROM scored) AS n
      FROM range(10) t(i) LEFT JOIN g ON g.g = t.i),
h AS (SELECT *, Total - BadCnt AS GoodCnt, BadCnt / Total AS InnerBadRate FROM f),
k AS (SELECT *, CASE WHEN InnerBadRate > lag(InnerBadRate) OVER (ORDER BY g) THEN 1 ELSE 0 END AS up,
             BadCnt / sum(BadCnt) OVER () AS BadRate, GoodCnt / sum(GoodCnt) OVER () AS GoodRate,
             InnerBadRate * (sum(BadCnt) OVER () + sum(GoodCnt) OVER ()) / sum(BadCnt) OVER () AS Lift FROM h),
m AS (SELECT *, sum(up) OVER (ORDER BY g ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bumps,
             sum(BadRate) OVER (ORDER BY g ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS CumTotalBadRate,
             sum(GoodRate) OVER (ORDER BY g ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS CumTotalGoodRate
      FROM k)""") + """
SELECT CAST(g + 1 AS VARCHAR) AS Rank, round(Total / n, 6) AS Population, Total, CAST(bumps AS BIGINT) AS bumps,
       round(MinScore, 6) AS MinScore, round(MeanScore, 6) AS MeanScore, round(MaxScore, 6) AS MaxScore,
       BadCnt, GoodCnt, round(InnerBadRate, 6) AS InnerBadRate, round(BadRate, 6) AS BadRate,
       round(CumTotalBadRate, 6) AS CumTotalBadRate, round(GoodRate, 6) AS GoodRate,
       round(CumTotalGoodRate, 6) AS CumTotalGoodRate, round(CumTotalBadRate - CumTotalGoodRate, 6) AS "K-S",
       round(Lift, 6) AS Lift FROM m
UNION ALL
SELECT 'Total', 1.0, CAST(sum(Total) AS BIGINT), NULL, round(min(MinScore), 6), round((SELECT avg(p) FROM scored), 6),
       round(max(MaxScore), 6), CAST(sum(BadCnt) AS BIGINT), CAST(sum(GoodCnt) AS BIGINT), round(sum(BadCnt) / sum(Total), 6), NULL, NULL,
       round(sum(GoodCnt) / sum(Total), 6), NULL, round(max(CumTotalBadRate - CumTotalGoodRate), 6), NULL FROM m"""


@register("ks_table_scored", ["E2", "W2", "W3", "W4", "W5", "B5", "IO13"], sql=KS_SQL)
def ks_table_scored(spark, sf):
    return round_doubles(ev.ks_table(scored(spark, sf), "p", "y", "id"))


# ---------------------------------------------------------------- E8/E9/E10 -------
@register("auc_scored", ["E8", "B6"], sql=with_sql(SCORED_SQL, """
per AS (SELECT p AS s, sum(y) AS pos, sum(1 - y) AS neg FROM scored GROUP BY 1),
c AS (SELECT *, sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg FROM per)""") + """
SELECT round(sum(pos * (cum_neg - neg + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS auc FROM c""")
def auc_scored(spark, sf):
    return round_doubles(ev.auc(scored(spark, sf), "p", "y"))


@register("aucpr_scored", ["E9", "T16"], sql=with_sql(SCORED_SQL, """
per AS (SELECT p AS s, sum(y) AS pos, sum(1 - y) AS neg FROM scored GROUP BY 1),
c AS (SELECT s, row_number() OVER (ORDER BY s DESC) AS r,
             sum(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
             sum(neg) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp FROM per),
P AS (SELECT sum(y) AS P FROM scored),
pts AS (SELECT r, tp / (tp + fp) AS prec, tp / P AS rec, tp, P FROM c, P),
lastr AS (SELECT min(r) AS lr FROM pts WHERE tp >= P),
j AS (SELECT pts.prec, pts.rec, coalesce(lag(prec) OVER (ORDER BY r), 1.0) AS prec0,
             coalesce(lag(rec) OVER (ORDER BY r), 0.0) AS rec0, r FROM pts)""") + """
SELECT round(sum(0.5 * (prec + prec0) * (rec - rec0)), 6) AS aucpr FROM j, lastr WHERE r <= lr""")
def aucpr_scored(spark, sf):
    return round_doubles(ev.aucpr(scored(spark, sf), "p", "y"))


@register("gini_scored", ["E10"], sql=with_sql(SCORED_SQL, """
c AS (SELECT row_number() OVER (ORDER BY p, id) AS r,
             sum(y) OVER (ORDER BY p, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / (SELECT sum(y) FROM scored) AS ratio
      FROM scored)""") + """
SELECT round(0.5 - (sum(ratio) - (max(CASE WHEN r = 1 THEN ratio END) + 1.0) / 2) / (count(*) - 1), 6) AS gini FROM c""")
def gini_scored(spark, sf):
    return round_doubles(ev.gini_normalization(scored(spark, sf), "p", "y", "id"))


# ---------------------------------------------------------------- E6/E7 -----------
@register("top_hit_rate", ["E6", "O6", "T30"], sql=with_sql(SCORED_SQL, """
r AS (SELECT y, row_number() OVER (ORDER BY p DESC, id) AS rk, count(*) OVER () AS n FROM scored),
k AS (SELECT greatest(1, floor(max(n) * 0.001)) AS k,
             floor(max(n) * 0.3) AS k30 FROM r)""") + """
SELECT round(sum(CASE WHEN rk <= k THEN y END) / max(k), 6) AS hit_rate, CAST(max(k) AS BIGINT) AS top_k,
       round(sum(CASE WHEN rk <= k30 THEN y END) / sum(y), 6) AS cover FROM r, k""")
def top_hit_rate(spark, sf):
    return round_doubles(ev.top_ratio_hit_rate(scored(spark, sf), "p", "y", "id"))


def _depth_sql():
    vals = ", ".join(f"({r!r})" for r in ev.DEPTH_RATIOS)
    return with_sql(SCORED_SQL, f"""
r AS (SELECT y, p, row_number() OVER (ORDER BY p DESC, id) AS rk FROM scored),
n AS (SELECT count(*) AS n, sum(y) AS npos FROM scored),
d AS (SELECT ratio, CAST(greatest(1, floor(n * ratio)) AS BIGINT) AS k, n, npos FROM (VALUES {vals}) v(ratio), n)""") + """
SELECT ratio AS depth, round(sum(CASE WHEN rk <= k THEN y END) / max(k), 6) AS hit_rate,
       round(sum(CASE WHEN rk <= k THEN y END) / max(npos), 6) AS cover, max(k) AS samples,
       round((sum(CASE WHEN rk <= k THEN y END) / max(k)) / (max(npos) / max(n)), 6) AS lift,
       round(max(CASE WHEN rk = k THEN p END), 6) AS threshold
FROM d JOIN r ON r.rk <= d.k GROUP BY ratio"""


@register("depth_table", ["E7", "W2"], sql=_depth_sql())
def depth_table(spark, sf):
    return round_doubles(ev.depth_table(scored(spark, sf), "p", "y", "id"))


# ---------------------------------------------------------------- E11/E12 ---------
@register("loss_metrics", ["E11", "E12"], sql=with_sql(SCORED_SQL, """
q AS (SELECT CAST(y AS DOUBLE) AS y, least(greatest(p, 1e-7), 1 - 1e-7) AS q FROM scored)""") + """
SELECT round(avg(-(y * ln(q) + (1 - y) * ln(1 - q))), 6) AS logloss,
       round(avg(-(5.0 * y * ln(q) + (1 - y) * ln(1 - q))), 6) AS logloss_pw5,
       round(avg(-0.25 * pow(1 - q, 2) * y * ln(q) - 0.75 * pow(q, 2) * (1 - y) * ln(1 - q)), 6) AS focal_mean,
       round(sum(-0.25 * pow(1 - q, 2) * y * ln(q) - 0.75 * pow(q, 2) * (1 - y) * ln(1 - q)), 6) AS focal_sum
FROM q""")
def loss_metrics(spark, sf):
    s = scored(spark, sf)
    y = F.col("y").cast("double")
    return round_doubles(s.agg(F.avg(ev.log_loss(F.col("p"), y)).alias("logloss"),
                               F.avg(ev.log_loss(F.col("p"), y, pos_weight=5.0)).alias("logloss_pw5"),
                               F.avg(ev.focal_loss(F.col("p"), y)).alias("focal_mean"),
                               F.sum(ev.focal_loss(F.col("p"), y)).alias("focal_sum")))


# ---------------------------------------------------------------- E15/E16 ---------
@register("calibration_bins", ["E15"], sql=with_sql(SCORED_SQL) + """
SELECT CAST(least(floor(p * 10), 9) AS INTEGER) AS bin, count(*) AS n, round(avg(p), 6) AS mean_p,
       round(avg(CAST(y AS DOUBLE)), 6) AS rate FROM scored GROUP BY 1""")
def calibration_bins(spark, sf):
    return round_doubles(ev.calibration(scored(spark, sf), "p", "y"))


@register("conversion_click_purchase", ["E16"], sql="""
WITH per AS (SELECT user_id, max(CAST(event_type = 'click' AS INTEGER)) AS y,
                    max(CAST(event_type = 'purchase' AS INTEGER)) AS z FROM events GROUP BY 1)
SELECT CAST(sum(y) AS BIGINT) AS n_y, CAST(sum(y * z) AS BIGINT) AS n_zy, round(sum(y * z) / sum(y), 6) AS p_z_given_y
FROM per""")
def conversion_click_purchase(spark, sf):
    e = table(spark, sf, "events")
    return round_doubles(ev.conditional_rate(e, "user_id", F.col("event_type") == "click", F.col("event_type") == "purchase"))


@register("focal_loss_classes", ["E12"], sql="""
WITH z AS (SELECT CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS INTEGER) AS y, 0.2 + 0.5 * (o_orderkey % 7) / 7.0 AS a, 0.1 + 0.1 * (o_custkey % 3) / 3.0 AS b FROM orders),
q AS (SELECT y, least(greatest(CASE y WHEN 0 THEN a WHEN 1 THEN b ELSE 1 - a - b END, 1e-7), 1 - 1e-7) AS q FROM z)
SELECT y, count(*) AS n, round(avg(-CASE y WHEN 0 THEN 0.25 WHEN 1 THEN 0.5 ELSE 1.0 END * pow(1 - q, 2) * ln(q)), 6) AS focal FROM q GROUP BY 1""")
def focal_loss_classes(spark, sf):
    """Three classes with a weight each."""
    o = table(spark, sf, "orders")
    a, b = 0.2 + 0.5 * (F.col("o_orderkey") % 7) / 7.0, 0.1 + 0.1 * (F.col("o_custkey") % 3) / 3.0
    y = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    z = o.select(y.alias("y"), F.array(a, b, 1 - a - b).alias("p"))
    loss = ev.focal_loss_classes(F.col("p"), F.col("y"), [0.25, 0.5, 1.0])
    return round_doubles(z.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.avg(loss).alias("focal")))
