"""Drift, selection and synthesis queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift, select
from ..operators import evaluate as ev
from ..session import scratch_path
from .fixtures import LABELLED_SQL, labelled, table, with_sql
from .registry import register, round_doubles
from .sqlgen import ew_bucket_sql

# ------------------------------------------------------------------ E14 -----------
MONTHLY_PSI_SQL = with_sql(LABELLED_SQL, f"""
months AS (SELECT DISTINCT app_month FROM labelled ORDER BY app_month DESC LIMIT 4),
ranked AS (SELECT app_month, row_number() OVER (ORDER BY app_month DESC) - 1 AS lag FROM months),
sub AS (SELECT l.*, r.lag FROM labelled l JOIN ranked r USING (app_month)),
mm AS (SELECT min(price) AS lo, max(price) AS hi FROM sub WHERE lag = 0),
b AS (SELECT lag, 'priority' AS feature, coalesce(priority, '__nan__') AS bucket FROM sub
      UNION ALL
      SELECT lag, 'price', CASE WHEN price > lo - (hi - lo) * 0.001 AND price <= hi
                                THEN CAST({ew_bucket_sql('price', 'lo', 'hi', 10)} AS VARCHAR) ELSE '__nan__' END
      FROM sub, mm),
cnt AS (SELECT lag, feature, bucket, count(*) AS n FROM b GROUP BY ALL),
grid AS (SELECT r.lag, 'price' AS feature, CAST(i AS VARCHAR) AS bucket FROM ranked r, range(10) t(i)),
full_ AS (SELECT g.lag, g.feature, g.bucket, coalesce(c.n, 0) AS n FROM grid g LEFT JOIN cnt c USING (lag, feature, bucket)
          UNION ALL SELECT lag, feature, bucket, n FROM cnt WHERE feature <> 'price' OR bucket = '__nan__'),
sh AS (SELECT *, n / sum(n) OVER (PARTITION BY lag, feature) AS share FROM full_),
j AS (SELECT o.lag, o.feature, bs.share AS b, o.share AS c FROM sh o JOIN sh bs
      ON bs.lag = 0 AND o.lag > 0 AND o.feature = bs.feature AND o.bucket = bs.bucket),
psi AS (SELECT lag, feature, sum((b - c) * ln((b + 1e-6) / (c + 1e-6))) AS psi FROM j GROUP BY ALL)""") + """
SELECT feature, round(max(psi) FILTER (WHERE lag = 1), 6) AS "N-1", round(max(psi) FILTER (WHERE lag = 2), 6) AS "N-2",
       round(max(psi) FILTER (WHERE lag = 3), 6) AS "N-3",
       round((coalesce(max(psi) FILTER (WHERE lag = 1), 0) + coalesce(max(psi) FILTER (WHERE lag = 2), 0)
              + coalesce(max(psi) FILTER (WHERE lag = 3), 0)) / 3.0, 6) AS avg
FROM psi GROUP BY feature"""


@register("monthly_psi", ["E14", "T15", "F6"], sql=MONTHLY_PSI_SQL)
def monthly_psi(spark, sf):
    return round_doubles(drift.monthly_psi(labelled(spark, sf), "app_month", ["priority"], ["price"]))


# ------------------------------------------------------------------ E13 -----------
PSI_SQL = with_sql(LABELLED_SQL, """
d AS (SELECT substr(app_month, 1, 4) AS part, price, coalesce(priority, 'nan') AS pr FROM labelled),
bp AS (SELECT min(part) AS bp FROM d),
q AS (SELECT list_sort(list_distinct(quantile_cont(price, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e
      FROM d, bp WHERE part = bp AND price IS NOT NULL),
inner_ AS (SELECT e[2:len(e) - 1] AS inner_e FROM q),
bv AS (SELECT DISTINCT pr FROM d, bp WHERE part = bp),
b AS (SELECT part, 'price' AS feature,
             CASE WHEN price IS NULL THEN '_missing'
                  ELSE CAST(len(list_filter(inner_e, lambda v: price > v)) AS VARCHAR) END AS bucket FROM d, inner_
      UNION ALL
      SELECT part, 'priority', CASE WHEN pr IN (SELECT pr FROM bv) THEN pr ELSE '_missing' END FROM d),
cnt AS (SELECT part, feature, bucket, count(*) AS n FROM b GROUP BY ALL),
parts AS (SELECT DISTINCT part FROM d),
dom AS (SELECT 'price' AS feature, CAST(i AS VARCHAR) AS bucket FROM inner_, range(len(inner_e) + 1) t(i)
        UNION ALL SELECT 'price', '_missing'
        UNION ALL SELECT 'priority', pr FROM bv
        UNION ALL SELECT 'priority', '_missing' WHERE '_missing' NOT IN (SELECT pr FROM bv)),
grid AS (SELECT p.part, dom.feature, dom.bucket FROM parts p, dom),
full0 AS (SELECT g.part, g.feature, g.bucket, coalesce(c.n, 0) AS n FROM grid g LEFT JOIN cnt c USING (part, feature, bucket)),
hn AS (SELECT feature, max(n) AS mx FROM full0 WHERE bucket = '_missing' GROUP BY 1),
full_ AS (SELECT f.part, f.feature, f.bucket, CAST(CASE WHEN n = 0 THEN 1 ELSE n END AS DOUBLE) AS n
          FROM full0 f JOIN hn USING (feature) WHERE f.bucket <> '_missing' OR hn.mx > 0),
sh AS (SELECT *, n / sum(n) OVER (PARTITION BY part, feature) AS share FROM full_),
j AS (SELECT o.part, o.feature, bs.share AS b, o.share AS c FROM sh o JOIN sh bs
      ON bs.part = (SELECT bp FROM bp) AND o.feature = bs.feature AND o.bucket = bs.bucket)""") + """
SELECT feature AS var, part, round(sum((b - c) * ln(b / c)), 6) AS psi FROM j GROUP BY ALL"""


@register("psi_by_year", ["E13"], sql=PSI_SQL)
def psi_by_year(spark, sf):
    df = labelled(spark, sf).withColumn("part", F.substring("app_month", 1, 4))
    return round_doubles(drift.psi_table(df, "part", continuous=["price"], discrete=["priority"]))


@register("psi_detail_saved_base", ["E13", "IO22"], sql=PSI_SQL.rsplit("SELECT feature AS var", 1)[0].replace("j AS (SELECT o.part, o.feature, bs.share AS b, o.share AS c", "j AS (SELECT o.part, o.feature, o.bucket, o.n, bs.share AS b, o.share AS c") + """
SELECT feature AS var, part, bucket, CAST(n AS BIGINT) AS n, round(c, 6) AS share, round(b, 6) AS base_share, round((b - c) * ln(b / c), 6) AS term FROM j""")
def psi_detail_saved_base(spark, sf):
    """The first year's base, saved and read back, against every year, bucket by bucket."""
    df = labelled(spark, sf).withColumn("part", F.substring("app_month", 1, 4))
    years = [r[0] for r in df.select("part").distinct().orderBy("part").collect()]
    path = scratch_path(spark, "psi-base")
    drift.save_base(drift.psi_base(df.filter(F.col("part") == years[0]), ["price"], ["priority"]), path)
    return round_doubles(drift.psi_detail(df, "part", drift.load_base(spark, path), years))


# ------------------------------------------------------------------ X1-X6 ---------
WIDE_SQL = """wide AS (SELECT o_orderkey AS id, CAST(o_orderstatus = 'F' AS INTEGER) AS y, o_totalprice,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
  c_acctbal, c_nationkey, c_mktsegment, c_name, CAST(NULL AS DOUBLE) AS empty_col, 'x' AS const_col
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def wide(spark, sf):
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .select(F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "F").cast("int").alias("y"),
                    "o_totalprice",
                    F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
                    "c_acctbal", "c_nationkey", "c_mktsegment", "c_name",
                    F.lit(None).cast("double").alias("empty_col"), F.lit("x").alias("const_col")))


@register("category_report_wide", ["X2", "A20", "N12"], sql=with_sql(WIDE_SQL) + """
SELECT feature, n_distinct, kind, CAST(CASE WHEN kind = 'category' THEN n_distinct > 50 OR n_distinct = 1
                                             ELSE n_distinct = 1 END AS INTEGER) AS dropped FROM (
  SELECT 'o_orderpriority' AS feature, count(DISTINCT o_orderpriority) + max(CAST(o_orderpriority IS NULL AS BIGINT)) AS n_distinct, 'category' AS kind FROM wide
  UNION ALL SELECT 'c_mktsegment', count(DISTINCT c_mktsegment) + max(CAST(c_mktsegment IS NULL AS BIGINT)), 'category' FROM wide
  UNION ALL SELECT 'c_name', count(DISTINCT c_name) + max(CAST(c_name IS NULL AS BIGINT)), 'category' FROM wide
  UNION ALL SELECT 'const_col', count(DISTINCT const_col) + max(CAST(const_col IS NULL AS BIGINT)), 'category' FROM wide
  UNION ALL SELECT 'id', count(DISTINCT id) + max(CAST(id IS NULL AS BIGINT)), 'numeric' FROM wide
  UNION ALL SELECT 'o_totalprice', count(DISTINCT o_totalprice) + max(CAST(o_totalprice IS NULL AS BIGINT)), 'numeric' FROM wide
  UNION ALL SELECT 'c_acctbal', count(DISTINCT c_acctbal) + max(CAST(c_acctbal IS NULL AS BIGINT)), 'numeric' FROM wide
  UNION ALL SELECT 'c_nationkey', count(DISTINCT c_nationkey) + max(CAST(c_nationkey IS NULL AS BIGINT)), 'numeric' FROM wide
  UNION ALL SELECT 'empty_col', count(DISTINCT empty_col) + max(CAST(empty_col IS NULL AS BIGINT)), 'numeric' FROM wide) t""")
def category_report_wide(spark, sf):
    return select.category_report(wide(spark, sf).drop("y"))


@register("null_report_wide", ["X1"], sql=with_sql(WIDE_SQL) + """
SELECT feature, round(r, 6) AS null_ratio, CAST(r >= 0.1 AS INTEGER) AS dropped FROM (
  SELECT 'o_orderpriority' AS feature, avg(CAST(o_orderpriority IS NULL AS DOUBLE)) AS r FROM wide
  UNION ALL SELECT 'empty_col', avg(CAST(empty_col IS NULL AS DOUBLE)) FROM wide
  UNION ALL SELECT 'c_acctbal', avg(CAST(c_acctbal IS NULL AS DOUBLE)) FROM wide) t""")
def null_report_wide(spark, sf):
    return round_doubles(select.null_report(wide(spark, sf), 0.1, ["o_orderpriority", "empty_col", "c_acctbal"]))


@register("iv_importance_report", ["X3", "X4", "T37"], sql=with_sql(LABELLED_SQL, """
tot AS (SELECT sum(y) AS gpos, count(*) - sum(y) AS gneg FROM labelled),
long AS (SELECT 'priority' AS feature, coalesce(priority, '-99') AS bucket, y FROM labelled
         UNION ALL SELECT 'app_month', coalesce(app_month, '-99'), y FROM labelled
         UNION ALL SELECT 'status', coalesce(status, '-99'), y FROM labelled),
cnt AS (SELECT feature, bucket, count(*) AS n, sum(y) AS pos FROM long GROUP BY 1, 2),
r AS (SELECT feature, (pos + 1.0) / (gpos + 2.0) AS pr, (n - pos + 1.0) / (gneg + 2.0) AS nr FROM cnt, tot),
iv AS (SELECT feature, sum((pr - nr) * ln(pr / nr)) AS iv FROM r GROUP BY 1),
thr AS (SELECT quantile_cont(iv, 0.5) AS t FROM iv)""") + """
SELECT feature, round(iv, 6) AS iv, CAST(iv <= 0.02 AS INTEGER) AS iv_dropped, round(t, 6) AS threshold,
       CAST(NOT (iv >= t) AS INTEGER) AS imp_dropped FROM iv, thr""")
def iv_importance_report(spark, sf):
    df = labelled(spark, sf)
    iv = ev.feature_iv(df, "y", ["priority", "app_month", "status"], [])
    rep = select.iv_report(iv, 0.02).withColumnRenamed("dropped", "iv_dropped")
    imp = select.importance_report(iv.withColumnRenamed("iv", "score"), score_quantile=0.5)
    out = rep.join(imp.select("feature", "threshold", F.col("dropped").alias("imp_dropped")), "feature")
    return round_doubles(out)


@register("correlation_pairs_lineitem", ["X5", "A16", "T8"], sql="""
WITH l AS (SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_quantity * 2 + 1 AS q2 FROM lineitem)
SELECT * FROM (VALUES
 ('l_quantity', 'l_extendedprice', (SELECT round(corr(l_quantity, l_extendedprice), 6) FROM l)),
 ('l_quantity', 'l_discount', (SELECT round(corr(l_quantity, l_discount), 6) FROM l)),
 ('l_quantity', 'l_tax', (SELECT round(corr(l_quantity, l_tax), 6) FROM l)),
 ('l_quantity', 'q2', (SELECT round(corr(l_quantity, q2), 6) FROM l)),
 ('l_extendedprice', 'l_discount', (SELECT round(corr(l_extendedprice, l_discount), 6) FROM l)),
 ('l_extendedprice', 'l_tax', (SELECT round(corr(l_extendedprice, l_tax), 6) FROM l)),
 ('l_extendedprice', 'q2', (SELECT round(corr(l_extendedprice, q2), 6) FROM l)),
 ('l_discount', 'l_tax', (SELECT round(corr(l_discount, l_tax), 6) FROM l)),
 ('l_discount', 'q2', (SELECT round(corr(l_discount, q2), 6) FROM l)),
 ('l_tax', 'q2', (SELECT round(corr(l_tax, q2), 6) FROM l))) t(col1, col2, corr)""")
def correlation_pairs_lineitem(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("q2", F.col("l_quantity") * 2 + 1)
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "q2"]
    return round_doubles(select.correlation_pairs(li, cols))


@register("feature_extract_wide", ["X6", "X5"])
def feature_extract_wide(spark, sf):
    df = wide(spark, sf)
    iv = ev.feature_iv(df, "y", ["o_orderpriority", "c_mktsegment"], ["o_totalprice", "c_acctbal"])
    steps = select.feature_extract(df, "y", null_percent=0.8, iv=iv, iv_threshold=0.001, unuse=["id"])
    dropped, _ = select.correlation_prune(df, ["o_totalprice", "c_acctbal", "c_nationkey"], 0.99)
    extra = spark.createDataFrame([(c, "corr") for c in dropped] or [("", "")], "feature string, step string")
    return steps.unionByName(extra.filter("feature != ''"))


# ------------------------------------------------------------------ X10-X14 -------
@register("dfs_order_features", ["X10", "X11", "X12", "X13", "F6"], sql="""
WITH a AS (SELECT l_orderkey AS o_orderkey, count(*) AS "COUNT(lineitem)",
                  round(avg(l_quantity), 6) AS "MEAN(lineitem.l_quantity)",
                  max(l_quantity) AS "MAX(lineitem.l_quantity)", min(l_quantity) AS "MIN(lineitem.l_quantity)",
                  round(avg(CAST(l_returnflag = 'R' AS DOUBLE)), 6) AS "PERCENT_TRUE(lineitem.returned)",
                  round(avg(CAST(l_extendedprice > 10000 AS DOUBLE)), 6) AS "PERCENT_TRUE(lineitem.big_line)",
                  count(*) FILTER (WHERE l_linestatus = 'F') AS "COUNT(lineitem WHERE l_linestatus = F)",
                  count(*) FILTER (WHERE l_linestatus = 'O') AS "COUNT(lineitem WHERE l_linestatus = O)"
           FROM lineitem GROUP BY 1),
top AS (SELECT o_orderpriority AS v, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) AS r FROM orders GROUP BY 1)
SELECT o.o_orderkey, coalesce(a."COUNT(lineitem)", 0) AS "COUNT(lineitem)", a."MEAN(lineitem.l_quantity)",
       a."MAX(lineitem.l_quantity)", a."MIN(lineitem.l_quantity)", a."PERCENT_TRUE(lineitem.returned)",
       a."PERCENT_TRUE(lineitem.big_line)", a."COUNT(lineitem WHERE l_linestatus = F)",
       a."COUNT(lineitem WHERE l_linestatus = O)", CAST(month(o.o_orderdate) AS INTEGER) AS "MONTH(o_orderdate)",
       CAST(o.o_orderpriority = (SELECT v FROM top WHERE r = 1) AS INTEGER) AS o_orderpriority_top1,
       CAST(o.o_orderpriority = (SELECT v FROM top WHERE r = 2) AS INTEGER) AS o_orderpriority_top2
FROM orders o LEFT JOIN a USING (o_orderkey)""")
def dfs_order_features(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority", "o_custkey")
    li = table(spark, sf, "lineitem")
    feats = select.dfs(o, "o_orderkey", li, "l_orderkey", "lineitem", numeric=["l_quantity", "l_tax"],
                       booleans={"returned": F.col("l_returnflag") == "R"},
                       seeds={"big_line": F.col("l_extendedprice") > 10000},
                       where={"l_linestatus": ("l_linestatus", ["F", "O"])}, aggs=("mean", "max", "min"),
                       trans={"o_orderdate": "month"}, ignore=["l_tax"])
    feats, top = select.encode_top(feats, "o_orderpriority", 2)
    for i, v in enumerate(top, 1):
        feats = feats.withColumnRenamed(f"o_orderpriority_{v}", f"o_orderpriority_top{i}")
    return round_doubles(feats.drop("o_orderdate", "o_orderpriority", "o_custkey"))


@register("dfs_user_primitives", ["X14", "D8"], sql="""
WITH a AS (SELECT l_orderkey AS o_orderkey, count(*) AS n, round(max(l_quantity) - min(l_quantity), 6) AS spread FROM lineitem GROUP BY 1)
SELECT o_orderkey, coalesce(n, 0) AS "COUNT(lineitem)", spread AS "SPREAD(lineitem.l_quantity)", CAST(month(o_orderdate) % 2 = 0 AS INTEGER) AS "EVEN_MONTH(o_orderdate)",
       round(o_totalprice / (1 + o_custkey % 7), 6) AS "PER_GROUP(o_totalprice, o_custkey)" FROM orders LEFT JOIN a USING (o_orderkey)""")
def dfs_user_primitives(spark, sf):
    """Primitives of the user: many rows to one, one column, two columns; the number of aggregates is capped at two."""
    select.register_primitive("spread", lambda c: F.max(c) - F.min(c))
    select.register_primitive("even_month", lambda c: (F.month(c) % 2 == 0).cast("int"), kind="trans")
    select.register_primitive("per_group", lambda a, b: a / (1 + b % 7), kind="trans2")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice", "o_custkey")
    feats = select.dfs(o, "o_orderkey", table(spark, sf, "lineitem"), "l_orderkey", "lineitem", numeric=["l_quantity", "l_tax"], aggs=("spread",),
                       trans={"o_orderdate": "even_month"}, pairs={("o_totalprice", "o_custkey"): "per_group"}, max_features=2)
    return round_doubles(feats.drop("o_orderdate", "o_totalprice", "o_custkey"))


@register("drop_sparse_columns", ["P20", "X1"], sql="""
SELECT * FROM (VALUES ('id'), ('y'), ('o_totalprice'), ('o_orderpriority'), ('c_acctbal'), ('c_nationkey'),
                      ('c_mktsegment'), ('const_col')) t(kept)""")
def drop_sparse_columns(spark, sf):
    from ..operators.core import drop_sparse_columns as dsc
    kept = dsc(wide(spark, sf), 0.005, also=["c_name"]).columns
    return spark.createDataFrame([(c,) for c in kept], "kept string")
