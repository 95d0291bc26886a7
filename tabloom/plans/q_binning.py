"""Queries of the supervised bins (E1) and of the tables built on them (E3, E5), and the KS table's modes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import binning
from .fixtures import SCORED_SQL, scored, table, with_sql
from .registry import register, round_doubles

LONG_LINE = """y_ AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem),
long_ AS (SELECT feature, CAST(v AS DOUBLE) AS v, y FROM (UNPIVOT y_ ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME feature VALUE v))"""


def _mass(n: str, p: str) -> str:
    part = lambda k: f"(CASE WHEN {k} > 0 THEN -({k}) * log2(({k}) / ({n})) ELSE 0.0 END)"
    return f"({part(p)} + {part(f'({n}) - ({p})')})"


def edges_sql(source: str = "long_", max_leaves: int = 6, min_leaf: float = 0.05) -> str:
    """CTEs from (feature, v, y) to ``edge_`` (feature, bin, lo, hi): the best-first growth, a cut a step."""
    gain = (f"round(({_mass('s.b_n - s.a_n', 's.b_pos - s.a_pos')} - {_mass('h.cum_n - s.a_n', 'h.cum_pos - s.a_pos')} - {_mass('s.b_n - h.cum_n', 's.b_pos - h.cum_pos')})"
            f" / e.n, {binning.PLACES})")
    parts = [f"hist_ AS MATERIALIZED (SELECT feature, v, CAST(sum(count(*)) OVER w AS DOUBLE) AS cum_n, CAST(sum(sum(y)) OVER w AS DOUBLE) AS cum_pos, lead(v) OVER w AS v_next FROM {source} GROUP BY feature, v WINDOW w AS (PARTITION BY feature ORDER BY v))",
             f"end_ AS (SELECT feature, min(v) AS lo, max(v) AS hi, max(cum_n) AS n, max(cum_pos) AS pos, greatest(1.0, ceil(max(cum_n) * {min_leaf})) AS least FROM hist_ GROUP BY feature)",
             "s0 AS MATERIALIZED (SELECT feature, CAST(0 AS DOUBLE) AS a_n, CAST(0 AS DOUBLE) AS a_pos, n AS b_n, pos AS b_pos FROM end_)"]
    for i in range(max_leaves - 1):
        parts.append(f"""b{i} AS MATERIALIZED (SELECT s.feature, s.a_n, s.a_pos, s.b_n, s.b_pos, h.cum_n, h.cum_pos, h.v / 2 + h.v_next / 2 AS cut
  FROM s{i} s JOIN end_ e USING (feature) JOIN hist_ h ON h.feature = s.feature AND h.cum_n > s.a_n AND h.cum_n < s.b_n
  WHERE s.b_pos > s.a_pos AND s.b_pos - s.a_pos < s.b_n - s.a_n AND h.cum_n - s.a_n >= e.least AND s.b_n - h.cum_n >= e.least
  QUALIFY row_number() OVER (PARTITION BY s.feature ORDER BY {gain} DESC, s.a_n, h.v) = 1)""")
        parts.append(f"""s{i + 1} AS MATERIALIZED (SELECT s.* FROM s{i} s ANTI JOIN b{i} b ON b.feature = s.feature AND b.a_n = s.a_n
  UNION ALL SELECT feature, a_n, a_pos, cum_n, cum_pos FROM b{i} UNION ALL SELECT feature, cum_n, cum_pos, b_n, b_pos FROM b{i})""")
    points = " UNION ALL ".join(["SELECT feature, lo AS x FROM end_", "SELECT feature, hi + 0.1 FROM end_"] + [f"SELECT feature, cut FROM b{i}" for i in range(max_leaves - 1)])
    parts.append(f"edge_ AS (SELECT feature, CAST(row_number() OVER w - 1 AS INTEGER) AS bin, x AS lo, lead(x) OVER w AS hi FROM ({points}) WINDOW w AS (PARTITION BY feature ORDER BY x) QUALIFY hi IS NOT NULL)")
    return ",\n".join(parts)


@register("supervised_bins_lineitem", ["E1"], sql=f"WITH {LONG_LINE},\n{edges_sql()}\nSELECT feature, bin, round(lo, 6) AS lo, round(hi, 6) AS hi FROM edge_")
def supervised_bins_lineitem(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
    edges = binning.optimal_boundaries(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "y")
    return round_doubles(binning.boundary_table(spark, edges))


@register("iv_table_price_binned", ["E3", "E1"], sql=with_sql(SCORED_SQL, "long_ AS (SELECT 'p' AS feature, p AS v, y FROM scored WHERE p IS NOT NULL)", edges_sql()) + """,
g AS (SELECT bin, lo, hi, CAST(count(*) - sum(y) AS BIGINT) AS good, CAST(sum(y) AS BIGINT) AS bad, count(*) AS total
      FROM long_ JOIN edge_ ON v >= lo AND v < hi GROUP BY ALL),
a AS (SELECT CAST(sum(y) AS DOUBLE) AS gpos, CAST(count(*) - sum(y) AS DOUBLE) AS gneg FROM scored),
t AS (SELECT g.*, good / sum(good) OVER () AS good_pct, bad / sum(bad) OVER () AS bad_pct, good / gneg AS goodRecall, bad / gpos AS badRecall,
             total / (gpos + gneg) AS groupRecall, bad / total AS innerBadRate, (bad / total) / (gpos / (gpos + gneg)) AS lift FROM g, a),
u AS (SELECT *, CASE WHEN good_pct > 0 AND bad_pct > 0 THEN ln(good_pct / bad_pct) END AS woe FROM t)
SELECT CAST(bin AS VARCHAR) AS bins, round(lo, 6) AS lo, round(hi, 6) AS hi, good, bad, total, round(good_pct, 6) AS good_pct, round(bad_pct, 6) AS bad_pct,
       round(goodRecall, 6) AS goodRecall, round(badRecall, 6) AS badRecall, round(groupRecall, 6) AS groupRecall, round(innerBadRate, 6) AS innerBadRate,
       round(woe, 6) AS woe, round((good_pct - bad_pct) * woe, 6) AS iv, round(lift, 6) AS lift FROM u
UNION ALL
SELECT 'Total', NULL, NULL, CAST(sum(good) AS BIGINT), CAST(sum(bad) AS BIGINT), CAST(sum(total) AS BIGINT), round(sum(good_pct), 6), round(sum(bad_pct), 6),
       round(sum(goodRecall), 6), round(sum(badRecall), 6), round(sum(groupRecall), 6), round(sum(bad) / (sum(good) + sum(bad)), 6), NULL,
       round(sum((good_pct - bad_pct) * woe), 6), round((sum(bad) / (sum(good) + sum(bad))) / (max(gpos) / (max(gpos) + max(gneg))), 6) FROM u, a""")
def iv_table_price_binned(spark, sf):
    return round_doubles(binning.numeric_iv_table(scored(spark, sf), "p", "y"))


@register("column_summary_orders", ["E5", "E1", "E2", "E8"], sql=with_sql(SCORED_SQL, """
z AS (SELECT id, y, CAST(price AS DOUBLE) AS price, CAST(custkey AS DOUBLE) AS custkey, p FROM scored),
long_ AS (SELECT feature, v, y, id FROM (UNPIVOT z ON price, custkey, p INTO NAME feature VALUE v))""", edges_sql()) + """,
cov AS (SELECT 'price' AS feature, count(price) / count(*) AS c FROM z UNION ALL SELECT 'custkey', count(custkey) / count(*) FROM z UNION ALL SELECT 'p', count(p) / count(*) FROM z),
r AS (SELECT feature, y, row_number() OVER (PARTITION BY feature ORDER BY v DESC, id) AS rk, count(*) OVER (PARTITION BY feature) AS n FROM long_),
k AS (SELECT feature, least(9, floor(rk / (n / 10.0))) AS g, sum(y) AS b, count(*) - sum(y) AS gd FROM r GROUP BY 1, 2),
ks AS (SELECT feature, max(x) AS ks FROM (SELECT feature, sum(b) OVER w / sum(b) OVER (PARTITION BY feature) - sum(gd) OVER w / sum(gd) OVER (PARTITION BY feature) AS x
       FROM k WINDOW w AS (PARTITION BY feature ORDER BY g ROWS UNBOUNDED PRECEDING)) GROUP BY 1),
d AS (SELECT feature, v, sum(y) AS pos, sum(1 - y) AS neg FROM long_ GROUP BY 1, 2),
au AS (SELECT feature, sum(pos * (cum - neg / 2)) / (sum(pos) * sum(neg)) AS auc FROM (SELECT *, sum(neg) OVER (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING) AS cum FROM d) GROUP BY 1),
bb AS (SELECT l.feature, bin, sum(y) AS bad, sum(1 - y) AS good FROM long_ l JOIN edge_ e ON e.feature = l.feature AND v >= lo AND v < hi GROUP BY 1, 2),
sh AS (SELECT feature, good / sum(good) OVER w AS g, bad / sum(bad) OVER w AS b FROM bb WINDOW w AS (PARTITION BY feature)),
iv AS (SELECT feature, sum(CASE WHEN g > 0 AND b > 0 THEN (g - b) * ln(g / b) END) AS iv FROM sh GROUP BY 1)
SELECT feature, round(c, 6) AS coverage_rate, round(ks, 6) AS ks, round(auc, 6) AS auc, round(iv, 6) AS iv FROM cov LEFT JOIN ks USING (feature) LEFT JOIN au USING (feature) LEFT JOIN iv USING (feature)""")
def column_summary_orders(spark, sf):
    return round_doubles(binning.column_summary(scored(spark, sf), ["price", "custkey", "p"], "y", "id"))


def _ks_sql(groups: str, n: str, nbins: str) -> str:
    """The KS layout over the CTE ``g`` (g, Total, MinScore, MeanScore, MaxScore, BadCnt)."""
    return f"""{groups},
f AS (SELECT CAST(i AS INTEGER) AS g, coalesce(Total, 0) AS Total, MinScore, MeanScore, MaxScore, coalesce(BadCnt, 0) AS BadCnt, {n} AS n FROM range(CAST({nbins} AS BIGINT)) t(i) LEFT JOIN g ON g.g = t.i),
h AS (SELECT *, Total - BadCnt AS GoodCnt, CASE WHEN Total > 0 THEN BadCnt / Total END AS InnerBadRate FROM f),
k AS (SELECT *, CASE WHEN InnerBadRate > lag(InnerBadRate) OVER (ORDER BY g) THEN 1 ELSE 0 END AS up, BadCnt / sum(BadCnt) OVER () AS BadRate, GoodCnt / sum(GoodCnt) OVER () AS GoodRate,
             InnerBadRate * (sum(BadCnt) OVER () + sum(GoodCnt) OVER ()) / sum(BadCnt) OVER () AS Lift FROM h),
m AS (SELECT *, sum(up) OVER w AS bumps, sum(BadRate) OVER w AS cb, sum(GoodRate) OVER w AS cg FROM k WINDOW w AS (ORDER BY g ROWS UNBOUNDED PRECEDING))
SELECT CAST(g + 1 AS VARCHAR) AS Rank, round(Total / n, 6) AS Population, CAST(Total AS BIGINT) AS Total, CAST(bumps AS BIGINT) AS bumps, round(MinScore, 6) AS MinScore, round(MeanScore, 6) AS MeanScore,
       round(MaxScore, 6) AS MaxScore, CAST(BadCnt AS BIGINT) AS BadCnt, CAST(GoodCnt AS BIGINT) AS GoodCnt, round(InnerBadRate, 6) AS InnerBadRate, round(BadRate, 6) AS BadRate, round(cb, 6) AS CumTotalBadRate,
       round(GoodRate, 6) AS GoodRate, round(cg, 6) AS CumTotalGoodRate, round(cb - cg, 6) AS "K-S", round(Lift, 6) AS Lift FROM m
UNION ALL
SELECT 'Total', 1.0, CAST(sum(Total) AS BIGINT), NULL, round(min(MinScore), 6), round(sum(MeanScore * Total) / sum(Total), 6), round(max(MaxScore), 6), CAST(sum(BadCnt) AS BIGINT), CAST(sum(GoodCnt) AS BIGINT),
       round(sum(BadCnt) / sum(Total), 6), NULL, NULL, round(sum(GoodCnt) / sum(Total), 6), NULL, round(max(cb - cg), 6), NULL FROM m"""


@register("ks_table_categories", ["E2"], sql=_ks_sql("""WITH z AS (SELECT CAST(l_quantity AS DOUBLE) AS s, CAST(l_returnflag = 'R' AS INTEGER) AS y FROM lineitem),
g AS (SELECT row_number() OVER (ORDER BY s DESC) - 1 AS g, count(*) AS Total, s AS MinScore, s AS MeanScore, s AS MaxScore, sum(y) AS BadCnt FROM z GROUP BY s)""", "(SELECT count(*) FROM z)", "(SELECT count(DISTINCT s) FROM z)"))
def ks_table_categories(spark, sf):
    li = table(spark, sf, "lineitem").select("l_quantity", (F.col("l_returnflag") == "R").cast("int").alias("y"))
    return round_doubles(binning.ks_table_by_category(li, "l_quantity", "y"))


KS_EDGES = [0.05, 0.1, 0.2, 0.5, 0.9, 2.0, 3.0]


@register("ks_table_edges", ["E2"], sql=_ks_sql(with_sql(SCORED_SQL, f"""z AS (SELECT p AS s, y FROM scored WHERE p IS NOT NULL AND y IS NOT NULL),
g AS (SELECT {len(KS_EDGES) - 2} - ({' + '.join(f'CAST(s > {e} AS INTEGER)' for e in KS_EDGES[1:-1])}) AS g, count(*) AS Total, min(s) AS MinScore, avg(s) AS MeanScore, max(s) AS MaxScore, sum(y) AS BadCnt
      FROM z WHERE s > {KS_EDGES[0]} AND s <= {KS_EDGES[-1]} GROUP BY 1)"""), "(SELECT count(*) FROM z)", str(len(KS_EDGES) - 1)))
def ks_table_edges(spark, sf):
    """Given edges: the last group is empty, the lowest scores are outside."""
    return round_doubles(binning.ks_table_by_edges(scored(spark, sf), "p", "y", KS_EDGES))
