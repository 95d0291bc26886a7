"""Encoder fit/transform queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encode as enc
from ..session import scratch_path, written
from .fixtures import LABELLED_SQL, labelled, table, with_sql
from .registry import register, round_doubles
from .sqlgen import ew_bucket_sql


@register("normalize_zscore_minmax", ["N1", "F9"], sql=with_sql(LABELLED_SQL, """
s AS (SELECT avg(price) AS m, stddev_samp(price) AS sd, min(price) AS lo, max(price) AS hi FROM labelled)""") + """
SELECT id, round((coalesce(price, m) - m) / (sd + 1e-8), 6) AS z,
       round(least(greatest(0.0 + (coalesce(price, m) - lo) / (hi - lo) * 1.0, 0.0), 1.0), 6) AS mm
FROM labelled, s""")
def normalize_zscore_minmax(spark, sf):
    df = labelled(spark, sf).select("id", "price")
    sc = enc.normalize_fit(df, ["price"])
    z = enc.normalize_transform(df, sc, "z-score").withColumnRenamed("price", "z")
    mm = enc.normalize_transform(df, sc, "min-max").withColumnRenamed("price", "mm")
    return round_doubles(z.join(mm, "id"))


@register("target_encode_priority", ["N2", "T31"], sql=with_sql(LABELLED_SQL, """
pr AS (SELECT avg(CAST(y AS DOUBLE)) AS prior FROM labelled),
g AS (SELECT priority, count(*) AS n, avg(CAST(y AS DOUBLE)) AS mean FROM labelled GROUP BY 1),
c AS (SELECT priority, CASE WHEN n <= 1 THEN prior
                            ELSE prior * (1 - 1 / (1 + exp(-(n - 1) / 1.0))) + mean * (1 / (1 + exp(-(n - 1) / 1.0))) END AS code
      FROM g, pr)""") + """
SELECT coalesce(l.priority, '<null>') AS priority, round(c.code, 6) AS code, count(*) AS n
FROM labelled l LEFT JOIN c ON l.priority IS NOT DISTINCT FROM c.priority GROUP BY 1, 2""")
def target_encode_priority(spark, sf):
    df = labelled(spark, sf).select("id", "priority", "y")
    fit = enc.target_fit(df, "y", ["priority"])
    tr = enc.target_transform(df.withColumnRenamed("priority", "code").withColumn("priority", F.col("code")),
                              fit.withColumn("feature", F.lit("code")), ["code"])
    return round_doubles(tr.groupBy(F.coalesce("priority", F.lit("<null>")).alias("priority"), "code")
                         .agg(F.count(F.lit(1)).alias("n")))


@register("onehot_priority", ["N3", "X13"], sql=with_sql(LABELLED_SQL) + """
SELECT "priority_-99", "priority_1-URGENT", "priority_2-HIGH", "priority_3-MEDIUM", "priority_4-NOT SPECIFIED",
       "priority_5-LOW", count(*) AS n FROM (
  SELECT CAST(coalesce(priority, '-99') = '-99' AS INTEGER) AS "priority_-99",
         CAST(coalesce(priority, '-99') = '1-URGENT' AS INTEGER) AS "priority_1-URGENT",
         CAST(coalesce(priority, '-99') = '2-HIGH' AS INTEGER) AS "priority_2-HIGH",
         CAST(coalesce(priority, '-99') = '3-MEDIUM' AS INTEGER) AS "priority_3-MEDIUM",
         CAST(coalesce(priority, '-99') = '4-NOT SPECIFIED' AS INTEGER) AS "priority_4-NOT SPECIFIED",
         CAST(coalesce(priority, '-99') = '5-LOW' AS INTEGER) AS "priority_5-LOW" FROM labelled) t GROUP BY ALL""")
def onehot_priority(spark, sf):
    df = labelled(spark, sf).select("priority", "app_month", "custkey")
    cats = enc.onehot_fit(df, ["priority", "app_month", "custkey"], category_threshold=50)  # only priority survives
    out = enc.onehot_transform(df, cats).drop("app_month", "custkey")
    return out.groupBy(*out.columns).agg(F.count(F.lit(1)).alias("n"))


@register("label_encode_strings", ["N4", "T4"], sql="""
WITH v AS (SELECT DISTINCT CAST(p_size AS VARCHAR) AS value FROM part),
c AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS code FROM v)
SELECT p_partkey, CAST(code AS BIGINT) AS code FROM part JOIN c ON CAST(p_size AS VARCHAR) = c.value""")
def label_encode_strings(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_size")
    fit = enc.label_fit(p, ["p_size"])
    return enc.label_transform(p, fit, ["p_size"]).select("p_partkey", F.col("p_size").alias("code"))


@register("mean_encode_multiclass", ["N5", "T33"], sql="""
WITH d AS (SELECT coalesce(CAST(c_mktsegment AS VARCHAR), '-99') AS value, c_nationkey % 3 AS cls FROM customer),
pr AS (SELECT cls, count(*) / (SELECT count(*) FROM d) AS prior FROM d GROUP BY 1),
vals AS (SELECT DISTINCT value FROM d),
cell AS (SELECT value, cls, count(*) AS cnt FROM d GROUP BY 1, 2),
full_ AS (SELECT v.value, pr.cls, coalesce(cell.cnt, 0) AS cnt, pr.prior FROM vals v CROSS JOIN pr
          LEFT JOIN cell ON cell.value = v.value AND cell.cls = pr.cls),
r AS (SELECT *, cnt / sum(cnt) OVER (PARTITION BY value) AS post, 1 / (1 + exp(-(cnt - 1) / 1.0)) AS s FROM full_),
raw AS (SELECT value, cls, cnt, (1 - s) * prior + s * post AS raw FROM r)
SELECT 'c_mktsegment' AS feature, value, cls, cnt, round(raw / sum(raw) OVER (PARTITION BY value), 6) AS code FROM raw""")
def mean_encode_multiclass(spark, sf):
    c = table(spark, sf, "customer").withColumn("cls", F.col("c_nationkey") % 3)
    return round_doubles(enc.mean_fit(c, "cls", ["c_mktsegment"]))


@register("mean_encode_transform", ["N5"], sql="""
WITH c AS (SELECT c_custkey, c_mktsegment, c_nationkey % 3 AS cls FROM customer),
f AS (SELECT * FROM c WHERE c_mktsegment <> 'BUILDING'),
pr AS (SELECT cls, count(*) / (SELECT count(*) FROM f) AS prior FROM f GROUP BY 1),
cell AS (SELECT v.c_mktsegment AS value, pr.cls, prior, (SELECT count(*) FROM f WHERE f.c_mktsegment = v.c_mktsegment AND f.cls = pr.cls) AS cnt FROM (SELECT DISTINCT c_mktsegment FROM f) v, pr),
raw AS (SELECT value, cls, (1 - s) * prior + s * cnt / sum(cnt) OVER (PARTITION BY value) AS raw FROM (SELECT *, 1.0 / (1.0 + exp(-(cnt - 1))) AS s FROM cell)),
code AS (SELECT value, cls, raw / sum(raw) OVER (PARTITION BY value) AS code FROM raw)
SELECT c_custkey, round(coalesce(max(code) FILTER (code.cls = 0), (SELECT prior FROM pr WHERE cls = 0)), 6) AS c_mktsegment_0, round(coalesce(max(code) FILTER (code.cls = 1), (SELECT prior FROM pr WHERE cls = 1)), 6) AS c_mktsegment_1
FROM c LEFT JOIN code ON c_mktsegment = value GROUP BY 1""")
def mean_encode_transform(spark, sf):
    """Fitted without one segment, applied to all: its customers get the prior; the last class is left out."""
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", (F.col("c_nationkey") % 3).alias("cls"))
    fit = enc.mean_fit(c.filter("c_mktsegment <> 'BUILDING'"), "cls", ["c_mktsegment"])
    return round_doubles(enc.mean_transform(c, fit, ["c_mktsegment"], drop_last=True).drop("cls"))


@register("woe_transform_orders", ["N6", "J7"], sql=with_sql(LABELLED_SQL, """
tot AS (SELECT sum(y) AS gpos, count(*) - sum(y) AS gneg FROM labelled),
w AS (SELECT coalesce(app_month, '-99') AS value,
             ln((sum(y) + 1.0) / (count(*) - sum(y) + 1.0)) AS lw FROM labelled GROUP BY 1)""") + """
SELECT id, round(w.lw - ln((gpos + 2.0) / (gneg + 2.0)), 6) AS app_month
FROM labelled l JOIN w ON coalesce(l.app_month, '-99') = w.value, tot""")
def woe_transform_orders(spark, sf):
    df = labelled(spark, sf).select("id", "app_month", "y")
    fit = enc.woe_fit(df, "y", ["app_month"])
    return round_doubles(enc.woe_transform(df, fit, ["app_month"]).select("id", "app_month"))


@register("woe_custkey_partkey", ["N6", "J7"], sql="""
WITH r AS (SELECT l_orderkey, l_linenumber, CAST(o_custkey AS VARCHAR) AS c, CAST(l_partkey AS VARCHAR) AS p, CAST(l_returnflag = 'R' AS INT) AS y
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
tot AS (SELECT ln((sum(y) + 2.0) / (count(*) - sum(y) + 2.0)) AS lt FROM r),
wc AS (SELECT c, ln((sum(y) + 1.0) / (count(*) - sum(y) + 1.0)) AS w FROM r GROUP BY 1),
wp AS (SELECT p, ln((sum(y) + 1.0) / (count(*) - sum(y) + 1.0)) AS w FROM r GROUP BY 1)
SELECT l_orderkey, l_linenumber, round(wc.w - lt, 6) AS c, round(wp.w - lt, 6) AS p FROM r JOIN wc USING (c) JOIN wp USING (p), tot""")
def woe_custkey_partkey(spark, sf):
    """WOE of two columns with as many values as there are customers and parts."""
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c"))
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p"), (F.col("l_returnflag") == "R").cast("int").alias("y"))
    df = written(li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_linenumber", "c", "p", "y"), "lines")  # joined once, read by fit and transform
    fit = enc.woe_fit(df, "y", ["c", "p"])
    return round_doubles(enc.woe_transform(df, fit, ["c", "p"]).select("l_orderkey", "l_linenumber", "c", "p"))


@register("factorize_first_seen", ["N7", "T3"], sql="""
WITH f AS (SELECT event_type, min(ts) AS first FROM events GROUP BY 1),
c AS (SELECT event_type, row_number() OVER (ORDER BY first, event_type) - 1 AS code FROM f)
SELECT e.event_id, CAST(c.code AS BIGINT) AS code FROM events e JOIN c USING (event_type)""")
def factorize_first_seen(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", "ts")
    return enc.factorize(e, "event_type", "ts", out="code").select("event_id", "code")


@register("cast_and_narrow", ["N8", "N11", "N13", "T26", "T27"], sql="""
SELECT
  (SELECT count(*) FROM events WHERE TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) IS NOT NULL) AS castable,
  (SELECT CASE WHEN bool_and(value = floor(value)) THEN 1 ELSE 0 END FROM events) AS value_integral,
  (SELECT CASE WHEN bool_and(p_size = floor(p_size)) THEN 1 ELSE 0 END FROM part) AS size_integral,
  (SELECT CASE WHEN min(p_size) > -128 AND max(p_size) < 127 THEN 'tinyint' ELSE 'other' END FROM part) AS size_type,
  (SELECT CASE WHEN min(o_orderkey) > -32768 AND max(o_orderkey) < 32767 THEN 'smallint'
               WHEN min(o_orderkey) > -2147483648 AND max(o_orderkey) < 2147483647 THEN 'int' ELSE 'bigint' END
   FROM orders) AS key_type""")
def cast_and_narrow(spark, sf):
    e = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k"))
    castable = enc.cast_to_numeric(e, ["k"], errors="coerce").filter(F.col("k").isNotNull()).select(F.count(F.lit(1))).scalar()
    _, ok_v = enc.float_to_int_if_integral(e, ["value"])
    p = table(spark, sf, "part").withColumn("p_size", F.col("p_size").cast("double"))
    _, ok_s = enc.float_to_int_if_integral(p, ["p_size"])
    pn = enc.narrow_types(table(spark, sf, "part"), ["p_size"])
    on = enc.narrow_types(table(spark, sf, "orders"), ["o_orderkey"])
    return spark.range(1).select(castable.alias("castable"), F.lit(int(bool(ok_v))).alias("value_integral"),
                                 F.lit(int(bool(ok_s))).alias("size_integral"),
                                 F.lit(pn.schema["p_size"].dataType.simpleString()).alias("size_type"),
                                 F.lit(on.schema["o_orderkey"].dataType.simpleString()).alias("key_type"))


@register("cut_equal_width", ["N9", "T6"], sql="""
WITH mm AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer)
SELECT 'C' || CAST(""" + ew_bucket_sql("c_acctbal", "lo", "hi", 8) + """ AS VARCHAR) AS bin, count(*) AS n
FROM customer, mm GROUP BY 1""")
def cut_equal_width(spark, sf):
    c = enc.cut(table(spark, sf, "customer").select("c_acctbal"), ["c_acctbal"], bins=8)
    return c.groupBy(F.col("c_acctbal").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def _qcut_sql():
    return """
WITH q AS (SELECT list_sort(list_distinct(quantile_cont(o_totalprice, [0.0, 0.25, 0.5, 0.75, 1.0]))) AS e FROM orders),
b AS (SELECT CASE WHEN o_totalprice >= e[1] AND o_totalprice <= e[len(e)]
                  THEN len(list_filter(e[2:len(e) - 1], lambda v: o_totalprice > v)) END AS b FROM orders, q)
SELECT 'C' || CAST(b AS VARCHAR) AS bin, count(*) AS n FROM b GROUP BY 1"""


@register("qcut_equal_freq", ["N10", "T7"], sql=_qcut_sql())
def qcut_equal_freq(spark, sf):
    c = enc.qcut(table(spark, sf, "orders").select("o_totalprice"), ["o_totalprice"], q=4)
    return c.groupBy(F.col("o_totalprice").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@register("bin_cdf_map", ["N14"], sql="""
WITH r AS (SELECT l_extendedprice AS x, row_number() OVER (ORDER BY l_extendedprice) - 1 AS pos, count(*) OVER () AS n FROM lineitem),
i AS (SELECT CAST(floor(n * i / 20.0) AS BIGINT) AS p FROM (SELECT max(n) AS n FROM r), range(20) t(i) UNION SELECT max(n) - 1 FROM r),
k AS (SELECT p, x FROM i JOIN r ON pos = p),
e AS (SELECT x AS edge, min(p) AS p, row_number() OVER (ORDER BY x) - 1 AS j, count(*) OVER () AS k FROM k GROUP BY x),
m AS (SELECT least(c, k - 2) AS bin, avg(x) AS mean FROM (SELECT r.x, max(e.j) AS c, max(e.k) AS k FROM r JOIN e ON e.p <= r.pos GROUP BY r.pos, r.x) GROUP BY 1),
t AS (SELECT least(c, k - 2) AS bin, k, count(*) AS n FROM (SELECT r.pos, max(e.j) AS c, max(e.k) AS k FROM r JOIN e ON e.edge <= r.x GROUP BY r.pos) GROUP BY 1, 2)
SELECT round(t.bin / (t.k - 1), 6) AS cdf, t.n, round(e.edge, 4) AS edge, round(m.mean, 4) AS mean FROM t JOIN m USING (bin) JOIN e ON e.j = t.bin""")
def bin_cdf_map(spark, sf):
    """Rows per CDF value, with the bin's edge and the mean that the inverse map returns."""
    li = table(spark, sf, "lineitem").select("l_extendedprice")
    fit = enc.bin_cdf_fit(li, "l_extendedprice", number_bins=20)
    tr = enc.bin_cdf_transform(li, "l_extendedprice", fit)
    counted = tr.groupBy("cdf").agg(F.count(F.lit(1)).alias("n"))
    bins = fit.select((F.col("bin") / (F.col("n_edges") - 1.0)).alias("cdf"), "edge", "mean")
    return round_doubles(counted.join(bins, "cdf"), 4).withColumn("cdf", F.round("cdf", 6))


@register("ecdf_quantize", ["N15"], sql="""
WITH c AS (SELECT c_acctbal, cume_dist() OVER (ORDER BY c_acctbal) AS cdf FROM customer)
SELECT round(floor(cdf * 10) / 10.0, 6) AS qnorm, count(*) AS n FROM c GROUP BY 1""")
def ecdf_quantize(spark, sf):
    c = enc.ecdf_quantize(table(spark, sf, "customer").select("c_acctbal"), "c_acctbal", 10)
    return round_doubles(c.groupBy("qnorm").agg(F.count(F.lit(1)).alias("n")))


@register("label_smoothing", ["N22"], sql=with_sql(LABELLED_SQL) + """
SELECT round(CAST(y AS DOUBLE) * (1 - 0.1) + 0.05, 6) AS y_smooth, count(*) AS n FROM labelled GROUP BY 1""")
def label_smoothing(spark, sf):
    df = labelled(spark, sf)
    return round_doubles(df.groupBy(enc.label_smoothing(F.col("y"), 0.1).alias("y_smooth")).agg(F.count(F.lit(1)).alias("n")))





# Rows for the processors: texts of a few values, of very many, numbers that are nearly all null, constant, and skewed.
PROCESS_SQL = LABELLED_SQL + """,
mixed AS (SELECT id, y, priority, status, CAST(custkey AS VARCHAR) AS customer, price, CASE WHEN id % 50 = 0 THEN 1.0 END AS rare, 7.0::DOUBLE AS flat,
                 CASE WHEN id % 9 = 0 THEN NULL ELSE pow(id % 20, 12) END AS tail FROM labelled)"""


def mixed_rows(spark, sf):
    d = labelled(spark, sf)
    return d.select("id", "y", "priority", "status", F.col("custkey").cast("string").alias("customer"), "price", F.when(F.col("id") % 50 == 0, 1.0).alias("rare"), F.lit(7.0).alias("flat"),
                    F.when(F.col("id") % 9 != 0, F.pow(F.col("id") % 20, F.lit(12))).alias("tail"))


CONF = {"skew_double": True, "skew_threshold": 1.0, "skew_bins": 4}


def _qcut_sql(q: int) -> str:
    """edges_ (i, e): distinct linear quantiles of the column tail."""
    return f"""edges_ AS (SELECT row_number() OVER (ORDER BY e) - 1 AS i, e FROM (SELECT DISTINCT unnest(quantile_cont(tail, {[i / q for i in range(q + 1)]})) AS e FROM mixed))"""


SQUASH_SQL = "CASE WHEN price > {t} THEN {up} WHEN price < -{t} THEN {down} ELSE price END"
_FIT = SQUASH_SQL.format(t=4, up="log2(price * price)", down="-log2(price * price)")
_SERVE = SQUASH_SQL.format(t=2, up="pow(log2(price), 2)", down="-pow(log2(-price), 2)")


def _ids_sql(squash: str) -> str:
    """Rows with the ids of shared numbering: priority, status, customer, price, tail."""
    return with_sql(PROCESS_SQL, _qcut_sql(4), f"""
pv AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS idx FROM (SELECT DISTINCT coalesce(priority, '-999') AS value FROM mixed)),
sv AS (SELECT value, row_number() OVER (ORDER BY value) - 1 + (SELECT count(*) FROM pv) AS idx FROM (SELECT DISTINCT coalesce(status, '-999') AS value FROM mixed)),
cv AS (SELECT value, row_number() OVER (ORDER BY value) - 1 + (SELECT count(*) FROM pv) + (SELECT count(*) FROM sv) AS idx FROM (SELECT DISTINCT coalesce(customer, '-999') AS value FROM mixed)),
n AS (SELECT (SELECT count(*) FROM pv) + (SELECT count(*) FROM sv) + (SELECT count(*) FROM cv) AS at, (SELECT count(*) FROM edges_) AS edges),
m AS (SELECT avg({_FIT}) AS mean, stddev_samp({_FIT}) AS std FROM mixed),
ids AS (SELECT id, pv.idx AS priority, sv.idx AS status, cv.idx AS customer, (coalesce({squash}, mean) - mean) / (std + 1e-8) AS price,
          n.at + 1 + CASE WHEN tail IS NULL THEN edges + 1 ELSE (SELECT count(*) FROM edges_ WHERE e < tail) END AS tail, n.at AS price_id
        FROM mixed JOIN pv ON coalesce(priority, '-999') = pv.value JOIN sv ON coalesce(status, '-999') = sv.value JOIN cv ON coalesce(customer, '-999') = cv.value, n, m)""")


def _mixed_spec(spark, sf):
    from ..operators import spec as fs
    df = mixed_rows(spark, sf)
    return fs, df, fs.fit(df, exclude=["id", "y"], conf=CONF, shared_ids=True)


@register("mixed_processor_orders", ["N16", "N17", "B3"], sql=_ids_sql(_FIT) + """
SELECT id, CAST(priority AS INTEGER) AS priority, CAST(status AS INTEGER) AS status, CAST(customer AS INTEGER) AS customer, round(price, 6) AS price, CAST(tail AS INTEGER) AS tail FROM ids""")
def mixed_processor_orders(spark, sf):
    """Every transformed column of every row; 'rare' (null) and 'flat' (one value) go."""
    fs, df, sp = _mixed_spec(spark, sf)
    return round_doubles(fs.transform(df, sp).drop("y"))


@register("mixed_processor_serving", ["N18", "N19", "IO22"], sql=_ids_sql(_SERVE) + """
SELECT id, CAST(list_value(priority, status, customer, tail, price_id) AS VARCHAR) AS xi, 1.0 + 1.0 + 1.0 + 1.0 AS xv_coded, round(CAST(CAST(price AS FLOAT) AS DOUBLE), 3) AS xv_price FROM ids""")
def mixed_processor_serving(spark, sf):
    """The serving form of the squash, from a spec that was saved and read back, as index and value arrays."""
    fs, df, sp = _mixed_spec(spark, sf)
    path = scratch_path(spark, "spec")
    fs.save(sp, path, spark)
    back = fs.load(spark, path)
    x = fs.model_input(fs.transform(df, back, log_mode="serve"), back, "id")
    coded = F.aggregate(F.slice("xv", 1, 4), F.lit(0.0), lambda a, v: a + v)
    return x.select("id", F.concat(F.lit("["), F.concat_ws(", ", F.transform("xi", lambda i: i.cast("string"))), F.lit("]")).alias("xi"), coded.alias("xv_coded"), F.round(F.col("xv")[4].cast("double"), 3).alias("xv_price"))


LETTER_SQL = "chr(CAST(97 + least(greatest((SELECT count(*) FROM edges_ WHERE e < tail) - 1, 0), (SELECT count(*) FROM edges_) - 2) AS INTEGER))"


@register("network_input_orders", ["N20", "N3", "N10", "N1"], sql=with_sql(PROCESS_SQL, _qcut_sql(5), f"""
m AS (SELECT avg(price) AS mean, stddev_samp(price) AS std, avg(y) AS ymean, stddev_samp(y) AS ystd, avg(flat) AS f FROM mixed),
l AS (SELECT *, CASE WHEN tail IS NULL THEN 'null' ELSE {LETTER_SQL} END AS letter FROM mixed),
hot AS (SELECT id, list_sort(['priority_' || coalesce(priority, '-99'), 'status_' || status, 'tail_' || letter]) AS on_ FROM l)""") + """
SELECT id, round((coalesce(price, mean) - mean) / (std + 1e-8), 6) AS price, 0.0 AS flat, array_to_string(on_, ',') AS hot,
       (SELECT count(DISTINCT coalesce(priority, '-99')) + count(DISTINCT status) + count(DISTINCT letter) FROM l) AS n_hot_columns
FROM mixed JOIN hot USING (id), m""")
def network_input_orders(spark, sf):
    """One-hot columns of a row as the list of those that are 1; 'customer' has too many values, 'rare' too many nulls."""
    from ..operators import spec as fs
    df = mixed_rows(spark, sf).drop("y")
    sp = fs.network_fit(df, exclude=["id"], skew_threshold=1.0)
    out = fs.network_transform(df, sp, keep=["id"])
    hot = [c for c in out.columns if c not in ("id", "price", "flat")]
    on = F.array_sort(F.filter(F.array(*[F.when(F.col(f"`{c}`") == 1, F.lit(c)) for c in hot]), F.isnotnull))
    return round_doubles(out.select("id", "price", "flat", F.array_join(on, ",").alias("hot"), F.lit(len(hot)).cast("long").alias("n_hot_columns")))


@register("fm_input_orders", ["N21"], sql=with_sql(PROCESS_SQL, _qcut_sql(5), f"""
tr AS (SELECT * FROM mixed WHERE id % 2 = 0 AND (status <> 'P')),
m AS (SELECT avg(price) AS mean, stddev_samp(price) AS std FROM tr),
pv AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS idx FROM (SELECT DISTINCT coalesce(priority, '-99') AS value FROM tr)),
sv AS (SELECT value, row_number() OVER (ORDER BY value) - 1 + (SELECT count(*) FROM pv) AS idx FROM (SELECT DISTINCT status AS value FROM tr)),
n AS (SELECT (SELECT count(*) FROM pv) AS p, (SELECT count(*) FROM pv) + (SELECT count(*) FROM sv) AS at)""") + """
SELECT id, CAST(list_value(coalesce(pv.idx, 0), coalesce(sv.idx, n.p), n.at) AS VARCHAR) AS xi, CASE WHEN pv.idx IS NULL THEN 0.0 ELSE 1.0 END AS x0, CASE WHEN sv.idx IS NULL THEN 0.0 ELSE 1.0 END AS x1,
       round(CAST(CAST((coalesce(price, mean) - mean) / (std + 1e-8) AS FLOAT) AS DOUBLE), 3) AS x2
FROM mixed LEFT JOIN pv ON coalesce(priority, '-99') = pv.value LEFT JOIN sv ON status = sv.value, n, m""")
def fm_input_orders(spark, sf):
    """Fitted on the even finished or open orders, applied to all: a status that was not there has the smallest id and value 0."""
    from ..operators import spec as fs
    df = mixed_rows(spark, sf).drop("y", "tail")
    sp = fs.fm_fit(df.filter("id % 2 = 0 AND status <> 'P'"), exclude=["id"], skew_threshold=1.0)
    x = fs.fm_transform(df, sp, "id")
    at = lambda i: F.col("xv")[i].cast("double")
    return x.select("id", F.concat(F.lit("["), F.concat_ws(", ", F.transform("xi", lambda i: i.cast("string"))), F.lit("]")).alias("xi"), at(0).alias("x0"), at(1).alias("x1"), F.round(at(2), 3).alias("x2"))
