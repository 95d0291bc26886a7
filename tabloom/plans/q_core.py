"""Guide-level DataFrame operators as named queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import core
from ..operators.rank import ordered_scan, plateau_stops, top_k_per_group
from ..operators.stats import distinct_counts, null_share, sample_skewness
from .fixtures import LABELLED_SQL, labelled, table, with_sql
from .registry import register, round_doubles

H = core.hash_uniform_sql


# ------------------------------------------------------------------ P1-P15 --------
@register("column_ops_orders", ["P1", "P4", "P5", "P6", "P7", "P8", "P9", "P10", "P11", "P12", "P13", "P14", "P15", "F22"],
          sql="""
SELECT o_orderkey AS key,
       CAST(o_totalprice BETWEEN 100000 AND 200000 AS INTEGER) AS mid_price,
       o_orderkey & 7 AS k_and, o_custkey | 1 AS c_or, xor(o_orderkey, o_custkey) AS k_xor,
       CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS prio,
       CAST(o_orderpriority LIKE '%URGENT' AS INTEGER) AS is_urgent,
       CAST(regexp_matches(o_orderpriority, '^[12]-') AS INTEGER) AS is_high,
       CAST(contains(o_orderpriority, 'SPEC') AS INTEGER) AS is_spec,
       CAST(starts_with(o_orderpriority, '5') AS INTEGER) AS starts5,
       CAST(ends_with(o_orderpriority, 'LOW') AS INTEGER) AS ends_low,
       CASE WHEN o_orderstatus = 'F' THEN 'final' WHEN o_orderstatus = 'O' THEN 'open' END AS status_name,
       CAST(o_orderstatus IN ('F', 'O') AS INTEGER) AS known,
       CAST(o_orderdate IS NULL AS INTEGER) AS no_date,
       o_custkey AS cust_from_struct, o_orderkey AS first_of_array, o_orderpriority AS from_map,
       round(o_totalprice / 1000.0, 6) AS price_k
FROM orders WHERE o_totalprice > 1000""")
def column_ops_orders(spark, sf):
    o = table(spark, sf, "orders").filter("o_totalprice > 1000")  # SQL-text filter (P4)
    st = F.struct("o_orderkey", "o_custkey").alias("s")
    arr = F.array("o_orderkey", "o_custkey")
    m = F.create_map(F.lit("p"), F.col("o_orderpriority"))
    out = o.select(
        F.col("o_orderkey").alias("key", metadata={"max": 99}),
        F.col("o_totalprice").between(100000, 200000).cast("int").alias("mid_price"),
        F.col("o_orderkey").bitwiseAND(7).alias("k_and"), F.col("o_custkey").bitwiseOR(1).alias("c_or"),
        F.col("o_orderkey").bitwiseXOR(F.col("o_custkey")).alias("k_xor"),
        F.col("o_orderpriority").substr(1, 1).cast("int").alias("prio"),
        F.col("o_orderpriority").like("%URGENT").cast("int").alias("is_urgent"),
        F.col("o_orderpriority").rlike("^[12]-").cast("int").alias("is_high"),
        F.col("o_orderpriority").contains("SPEC").cast("int").alias("is_spec"),
        F.col("o_orderpriority").startswith("5").cast("int").alias("starts5"),
        F.col("o_orderpriority").endswith("LOW").cast("int").alias("ends_low"),
        F.when(F.col("o_orderstatus") == "F", "final").when(F.col("o_orderstatus") == "O", "open").alias("status_name"),
        F.col("o_orderstatus").isin("F", "O").cast("int").alias("known"),
        F.col("o_orderdate").isNull().cast("int").alias("no_date"),
        st.getField("o_custkey").alias("cust_from_struct"), arr.getItem(0).alias("first_of_array"),
        m.getItem("p").alias("from_map"),
        (F.col("o_totalprice") / 1000.0).alias("price_k"))
    return round_doubles(out)


@register("prefix_bucket_parts", ["P21", "P6"], sql="""
SELECT CASE WHEN starts_with(lower(p_name), 'a') THEN 'a' WHEN starts_with(lower(p_name), 'reno') THEN 'reno'
            WHEN starts_with(lower(p_name), 'k') THEN 'k' WHEN starts_with(lower(p_name), 'find') THEN 'find'
            WHEN starts_with(lower(p_name), 'r') THEN 'r' ELSE 'other' END AS bucket,
       count(*) AS n FROM part GROUP BY 1""")
def prefix_bucket_parts(spark, sf):
    p = table(spark, sf, "part")
    return p.groupBy(core.prefix_bucket(F.col("p_name"), core.MODEL_PREFIXES).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@register("three_sigma_events", ["P19"], sql="""
WITH s AS (SELECT avg(value) AS m, stddev_samp(value) AS sd FROM events)
SELECT event_type, count(*) AS n, round(sum(value), 6) AS total FROM events, s
WHERE value >= m - 3 * sd AND value <= m + 3 * sd GROUP BY 1""")
def three_sigma_events(spark, sf):
    e = core.three_sigma_filter(table(spark, sf, "events"), "value")
    return round_doubles(e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")))


@register("nulls_fill_replace", ["P16", "P17", "P18"], sql=with_sql(LABELLED_SQL) + """
SELECT CASE WHEN coalesce(priority, 'unknown') = '1-URGENT' THEN 'urgent' ELSE coalesce(priority, 'unknown') END
         AS priority,
       count(*) AS n, round(sum(coalesce(price, 0.0)), 6) AS total,
       count(*) FILTER (WHERE priority IS NOT NULL AND price IS NOT NULL) AS complete_rows
FROM labelled GROUP BY 1""")
def nulls_fill_replace(spark, sf):
    df = labelled(spark, sf)
    complete = df.dropna(how="any", subset=["priority", "price"]).groupBy("priority").agg(F.count(F.lit(1)).alias("complete_rows"))
    filled = df.na.fill({"priority": "unknown", "price": 0.0}).na.replace({"1-URGENT": "urgent"}, subset=["priority"])
    agg = filled.groupBy("priority").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("total"))
    complete = complete.na.replace({"1-URGENT": "urgent"}, subset=["priority"])
    out = agg.join(complete, "priority", "left").fillna(0, ["complete_rows"])
    return round_doubles(out)


@register("dropna_thresh", ["P16"], sql=with_sql(LABELLED_SQL) + """
SELECT count(*) FILTER (WHERE priority IS NOT NULL AND price IS NOT NULL) AS any_kept,
       count(*) FILTER (WHERE priority IS NOT NULL OR price IS NOT NULL) AS all_kept,
       count(*) FILTER (WHERE (CAST(priority IS NOT NULL AS INTEGER) + CAST(price IS NOT NULL AS INTEGER)
                               + CAST(app_month IS NOT NULL AS INTEGER)) >= 3) AS thresh3_kept
FROM labelled""")
def dropna_thresh(spark, sf):
    df = labelled(spark, sf).select("priority", "price", "app_month")
    a = df.dropna(how="any", subset=["priority", "price"]).select(F.count(F.lit(1))).scalar()
    b = df.dropna(how="all", subset=["priority", "price"]).select(F.count(F.lit(1))).scalar()
    c = df.dropna(thresh=3).select(F.count(F.lit(1))).scalar()
    return spark.range(1).select(a.alias("any_kept"), b.alias("all_kept"), c.alias("thresh3_kept"))


@register("key_value_pairs", ["P22", "P23", "A7", "A9"], sql="""
SELECT o_custkey AS k, count(*) AS n, round(sum(o_totalprice * 2), 6) AS doubled, round(avg(o_totalprice), 6) AS mean
FROM orders GROUP BY 1""")
def key_value_pairs(spark, sf):
    o = table(spark, sf, "orders")
    kv = o.select(F.col("o_custkey").alias("k"), F.struct("o_orderkey", "o_totalprice").alias("v"))  # keyBy
    mapped = kv.select("k", (F.col("v.o_totalprice") * 2).alias("v2"), F.col("v.o_totalprice").alias("v1"))  # mapValues
    return round_doubles(mapped.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("v2").alias("doubled"),
                                                 F.avg("v1").alias("mean")))


@register("flat_map_values", ["P2", "P23"], sql="""
SELECT conv_id, count(*) AS n_words, count(DISTINCT w) AS n_distinct FROM (
  SELECT conv_id, unnest(string_split_regex(lower(text), '[ \\t\\n\\r]+')) AS w FROM conversations) t
WHERE w <> '' GROUP BY 1""")
def flat_map_values(spark, sf):
    c = table(spark, sf, "conversations")
    words = c.select("conv_id", F.explode(F.split(F.lower("text"), "[ \\t\\n\\r]+")).alias("w")).filter(F.col("w") != "")
    return words.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_words"), F.count_distinct("w").alias("n_distinct"))


@register("map_partitions_revenue", ["P3"], sql="""
SELECT l_returnflag, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue, count(*) AS n
FROM lineitem GROUP BY 1""")
def map_partitions_revenue(spark, sf):
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice", "l_discount")

    def per_batch(it):
        for pdf in it:
            pdf["rev"] = pdf["l_extendedprice"] * (1 - pdf["l_discount"])
            yield pdf[["l_returnflag", "rev"]]

    out = li.mapInPandas(per_batch, "l_returnflag string, rev double")
    return out.groupBy("l_returnflag").agg(F.round(F.sum("rev"), 4).alias("revenue"), F.count(F.lit(1)).alias("n"))


@register("zip_orders_customers", ["P24", "P25", "B5"], sql="""
WITH a AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS r FROM orders),
     b AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey DESC) AS r FROM customer)
SELECT r - 1 AS idx, o_orderkey, c_custkey FROM a JOIN b USING (r)""")
def zip_orders_customers(spark, sf):
    a = table(spark, sf, "orders").select("o_orderkey")
    b = table(spark, sf, "customer").select("c_custkey")
    return core.zip_by_position(a, [("o_orderkey", True)], b, [("c_custkey", False)]).select("idx", "o_orderkey", "c_custkey")


# ------------------------------------------------------------------ J* ------------
@register("join_inner_revenue", ["J1", "J9"], sql="""
SELECT o_orderpriority, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue, count(*) AS n
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def join_inner_revenue(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), "l_extendedprice", "l_discount")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), "o_orderpriority")
    j = core.copartitioned_join(li, o, "k", int(spark.conf.get("spark.sql.shuffle.partitions")))
    return j.groupBy("o_orderpriority").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("revenue"),
                                            F.count(F.lit(1)).alias("n"))


@register("join_outer_counts", ["J2"], sql="""
WITH c AS (SELECT c_custkey AS k, c_mktsegment FROM customer),
     o AS (SELECT o_custkey AS k, count(*) AS n_orders FROM orders GROUP BY 1)
SELECT coalesce(c_mktsegment, 'none') AS segment, count(*) AS n, CAST(sum(coalesce(n_orders, 0)) AS BIGINT) AS orders,
       count(*) FILTER (WHERE n_orders IS NULL) AS no_orders,
       count(*) FILTER (WHERE c_mktsegment IS NULL) AS no_customer
FROM c FULL OUTER JOIN o USING (k) GROUP BY 1""")
def join_outer_counts(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), "c_mktsegment")
    o = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n_orders"))
    j = c.join(o, "k", "full")
    left_only = c.join(o, "k", "left").filter(F.col("n_orders").isNull()).count()  # noqa: F841 (left form exercised)
    return (j.groupBy(F.coalesce("c_mktsegment", F.lit("none")).alias("segment"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("n_orders", F.lit(0))).alias("orders"),
                 F.count_if(F.col("n_orders").isNull()).alias("no_orders"),
                 F.count_if(F.col("c_mktsegment").isNull()).alias("no_customer")))


@register("anti_join_parts", ["J4", "U3"], sql="""
SELECT p_type, count(*) AS n FROM part p
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_partkey = p.p_partkey AND l.l_quantity > 45) GROUP BY 1""")
def anti_join_parts(spark, sf):
    p = table(spark, sf, "part")
    li = table(spark, sf, "lineitem").filter(F.col("l_quantity") > 45).select(F.col("l_partkey").alias("p_partkey"))
    return p.join(li, "p_partkey", "left_anti").groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))


@register("cogroup_orders_lines", ["J5"], sql="""
WITH a AS (SELECT o_orderkey AS k, count(*) AS n_orders, round(sum(o_totalprice), 4) AS total FROM orders GROUP BY 1),
     b AS (SELECT l_orderkey AS k, count(*) AS n_lines, round(sum(l_quantity), 4) AS qty FROM lineitem GROUP BY 1)
SELECT CAST(n_orders IS NULL AS INTEGER) AS lines_only, CAST(n_lines IS NULL AS INTEGER) AS orders_only,
       count(*) AS n_keys, CAST(sum(coalesce(n_lines, 0)) AS BIGINT) AS lines, round(sum(coalesce(qty, 0)), 4) AS qty
FROM a FULL OUTER JOIN b USING (k) GROUP BY 1, 2""")
def cogroup_orders_lines(spark, sf):
    o = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "k")
    li = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "k")
    g = core.cogroup_agg(o, li, "k", [F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 4).alias("total")],
                         [F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_quantity"), 4).alias("qty")])
    return (g.groupBy(F.col("n_orders").isNull().cast("int").alias("lines_only"),
                      F.col("n_lines").isNull().cast("int").alias("orders_only"))
            .agg(F.count(F.lit(1)).alias("n_keys"), F.sum(F.coalesce("n_lines", F.lit(0))).alias("lines"),
                 F.round(F.sum(F.coalesce("qty", F.lit(0.0))), 4).alias("qty")))


@register("natural_merge_chain", ["J6"], sql="""
SELECT c_mktsegment, count(*) AS n_lines, round(sum(l_quantity), 4) AS qty
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def natural_merge_chain(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("orderkey"), "l_quantity")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("custkey"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), "c_mktsegment")
    m = core.natural_join(core.natural_join(li, o), c)
    return m.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_quantity"), 4).alias("qty"))


@register("dictionary_lookup_default", ["J7", "N4"], sql="""
WITH d AS (SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS code
           FROM (SELECT DISTINCT p_type FROM part WHERE p_size > 10) t)
SELECT coalesce(code, -999) AS code, count(*) AS n FROM part LEFT JOIN d USING (p_type) GROUP BY 1""")
def dictionary_lookup_default(spark, sf):
    from ..operators.encode import lookup
    p = table(spark, sf, "part")
    d = p.filter("p_size > 10").select("p_type").distinct()
    d = ordered_scan(d, [("p_type", True)], rank_col="code").select("p_type", (F.col("code") - 1).alias("code"))
    res = lookup(p, "p_type", d, "p_type", "code", "code", default=-999)
    return res.groupBy(F.col("code").cast("long").alias("code")).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ A* ------------
@register("agg_global_lineitem", ["A1", "A6", "A12"], sql="""
SELECT count(l_quantity) AS count, round(avg(l_quantity), 6) AS mean, round(sum(l_quantity), 6) AS sum,
       min(l_quantity) AS min, max(l_quantity) AS max, round(var_pop(l_quantity), 6) AS variance,
       round(var_samp(l_quantity), 6) AS sample_variance, round(stddev_pop(l_quantity), 6) AS stdev,
       round(stddev_samp(l_quantity), 6) AS sample_stdev, max(l_extendedprice) AS max_price FROM lineitem""")
def agg_global_lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    s = core.summary_stats(li, "l_quantity")
    mx = li.agg({"l_extendedprice": "max"}).select(F.col("max(l_extendedprice)")).scalar()  # dict form (A1)
    return round_doubles(s.withColumn("max_price", mx))


@register("group_agg_flags", ["A2", "A7", "A9"], sql="""
SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 6) AS sum_qty,
       round(avg(l_extendedprice), 6) AS avg_price, min(l_discount) AS min_disc, max(l_tax) AS max_tax
FROM lineitem GROUP BY 1, 2""")
def group_agg_flags(spark, sf):
    li = table(spark, sf, "lineitem")
    return round_doubles(li.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("sum_qty"), F.avg("l_extendedprice").alias("avg_price"),
        F.min("l_discount").alias("min_disc"), F.max("l_tax").alias("max_tax")))


@register("cube_rollup_flags", ["A3"], sql="""
SELECT 'cube' AS kind, l_returnflag, l_linestatus, CAST(GROUPING(l_returnflag, l_linestatus) AS INTEGER) AS gid,
       count(*) AS n, round(sum(l_quantity), 6) AS qty FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)
UNION ALL
SELECT 'rollup', l_returnflag, l_linestatus, CAST(GROUPING(l_returnflag, l_linestatus) AS INTEGER),
       count(*), round(sum(l_quantity), 6) FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def cube_rollup_flags(spark, sf):
    li = table(spark, sf, "lineitem")
    aggs = [F.grouping_id().cast("int").alias("gid"), F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty")]
    c = li.cube("l_returnflag", "l_linestatus").agg(*aggs).withColumn("kind", F.lit("cube"))
    r = li.rollup("l_returnflag", "l_linestatus").agg(*aggs).withColumn("kind", F.lit("rollup"))
    return round_doubles(c.unionByName(r))


@register("pivot_qty", ["A4"], sql="""
SELECT l_returnflag, round(sum(l_quantity) FILTER (WHERE l_linestatus = 'F'), 6) AS F,
       round(sum(l_quantity) FILTER (WHERE l_linestatus = 'O'), 6) AS O FROM lineitem GROUP BY 1""")
def pivot_qty(spark, sf):
    li = table(spark, sf, "lineitem")
    return round_doubles(li.groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).sum("l_quantity"))


@register("group_by_function", ["A5"], sql="""
SELECT CAST(o_orderkey % 2 AS BIGINT) AS parity, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM orders GROUP BY 1""")
def group_by_function(spark, sf):
    o = table(spark, sf, "orders")
    return o.groupBy((F.col("o_orderkey") % 2).alias("parity")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))


@register("group_values_chunks", ["A8"], sql="""
SELECT o_custkey, CAST((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 8 AS BIGINT) AS part,
       o_orderkey FROM orders""")
def group_values_chunks(spark, sf):
    o = table(spark, sf, "orders")
    g = core.group_values(o, "o_custkey", "o_orderkey", chunk=8)
    return g.select("o_custkey", "part", F.explode("values").alias("o_orderkey"))


@register("histogram_quantity", ["A11"], sql="""
WITH mm AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem),
b AS (SELECT CAST(least(floor((l_quantity - lo) / ((hi - lo) / 7)), 6) AS INTEGER) AS bucket FROM lineitem, mm)
SELECT t.i AS bucket, coalesce(c.n, 0) AS count FROM range(7) t(i)
LEFT JOIN (SELECT bucket, count(*) AS n FROM b GROUP BY 1) c ON c.bucket = t.i""")
def histogram_quantity(spark, sf):
    h = core.histogram(table(spark, sf, "lineitem"), "l_quantity", 7)
    return h.select("bucket", "count")


@register("histogram_edges", ["A11"], sql="""
SELECT t.i AS bucket, coalesce(c.n, 0) AS count FROM range(3) t(i) LEFT JOIN (
  SELECT CASE WHEN l_quantity >= 25 THEN 2 WHEN l_quantity >= 5 THEN 1 ELSE 0 END AS bucket, count(*) AS n
  FROM lineitem WHERE l_quantity >= 0 AND l_quantity <= 50 GROUP BY 1) c ON c.bucket = t.i""")
def histogram_edges(spark, sf):
    return core.histogram(table(spark, sf, "lineitem"), "l_quantity", [0, 5, 25, 50]).select("bucket", "count")


@register("describe_lineitem", ["A13"], sql="""
WITH s AS (SELECT count(l_quantity) AS n1, count(l_discount) AS n2, avg(l_quantity) AS a1, avg(l_discount) AS a2, stddev_samp(l_quantity) AS s1, stddev_samp(l_discount) AS s2,
                  min(l_quantity) AS lo1, min(l_discount) AS lo2, max(l_quantity) AS hi1, max(l_discount) AS hi2 FROM lineitem)
SELECT unnest(['count', 'mean', 'stddev', 'min', 'max']) AS summary, round(unnest([n1, a1, s1, lo1, hi1]::DOUBLE[]), 6) AS l_quantity, round(unnest([n2, a2, s2, lo2, hi2]::DOUBLE[]), 6) AS l_discount FROM s""")
def describe_lineitem(spark, sf):
    d = table(spark, sf, "lineitem").describe("l_quantity", "l_discount")
    return round_doubles(d.select("summary", F.col("l_quantity").cast("double").alias("l_quantity"), F.col("l_discount").cast("double").alias("l_discount")))


@register("crosstab_status_priority", ["A14"], sql="""
SELECT o_orderstatus AS o_orderstatus_o_orderpriority,
       count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS "1-URGENT",
       count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS "2-HIGH",
       count(*) FILTER (WHERE o_orderpriority = '3-MEDIUM') AS "3-MEDIUM",
       count(*) FILTER (WHERE o_orderpriority = '4-NOT SPECIFIED') AS "4-NOT SPECIFIED",
       count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS "5-LOW"
FROM orders GROUP BY 1""")
def crosstab_status_priority(spark, sf):
    vals = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    return core.crosstab(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority", vals)


@register("freq_items_events", ["A15"], sql="""
WITH i AS (SELECT 'event_type' AS col, event_type AS item, count(*) AS n FROM events GROUP BY ALL UNION ALL SELECT 'value', CAST(round(value) AS VARCHAR), count(*) FROM events GROUP BY ALL)
SELECT col, item, n, true AS proposed FROM i WHERE n > 0.1 * (SELECT count(*) FROM events)""")
def freq_items_events(spark, sf):
    """Every item above the support, with its exact count; the one-pass proposal (false positives allowed) holds them all."""
    e = table(spark, sf, "events").select("event_type", F.round("value").cast("long").cast("string").alias("value"))
    proposed = e.freqItems(["event_type", "value"], support=0.1).first()
    items = F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).alias("item")) for c in e.columns]))
    counts = e.select(items.alias("i")).groupBy("i.col", "i.item").agg(F.count(F.lit(1)).alias("n"))
    n = e.select(F.count(F.lit(1))).scalar()
    found = F.when(F.col("col") == "event_type", F.col("item").isin(proposed["event_type_freqItems"])).otherwise(F.col("item").isin(proposed["value_freqItems"]))
    return counts.filter(F.col("n") > 0.1 * n).withColumn("proposed", found)


@register("corr_cov_lineitem", ["A16", "T8"], sql="""
SELECT round(corr(l_quantity, l_extendedprice), 6) AS corr_qp, round(covar_samp(l_quantity, l_extendedprice), 6) AS cov_qp,
       round(covar_pop(l_discount, l_tax), 6) AS covpop_dt FROM lineitem""")
def corr_cov_lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    return round_doubles(li.agg(F.corr("l_quantity", "l_extendedprice").alias("corr_qp"),
                                F.covar_samp("l_quantity", "l_extendedprice").alias("cov_qp"),
                                F.covar_pop("l_discount", "l_tax").alias("covpop_dt")))


@register("distinct_dedup", ["A17"], sql="""
SELECT (SELECT count(*) FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_tax FROM lineitem)) AS n_distinct,
       (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS n_dedup_orders""")
def distinct_dedup(spark, sf):
    li = table(spark, sf, "lineitem")
    a = li.select("l_returnflag", "l_linestatus", "l_tax").distinct().select(F.count(F.lit(1))).scalar()
    b = li.dropDuplicates(["l_orderkey"]).select(F.count(F.lit(1))).scalar()
    return spark.range(1).select(a.alias("n_distinct"), b.alias("n_dedup_orders"))


@register("null_share_labelled", ["A19", "X1"], sql=with_sql(LABELLED_SQL) + """
SELECT * FROM (VALUES ('priority', (SELECT round(avg(CAST(priority IS NULL AS DOUBLE)), 6) FROM labelled)),
                      ('price', (SELECT round(avg(CAST(price IS NULL AS DOUBLE)), 6) FROM labelled)),
                      ('app_month', (SELECT round(avg(CAST(app_month IS NULL AS DOUBLE)), 6) FROM labelled)),
                      ('y', (SELECT round(avg(CAST(y IS NULL AS DOUBLE)), 6) FROM labelled))) t(feature, null_ratio)""")
def null_share_labelled(spark, sf):
    return round_doubles(null_share(labelled(spark, sf), ["priority", "price", "app_month", "y"]))


@register("distinct_counts_labelled", ["A20"], sql=with_sql(LABELLED_SQL) + """
SELECT * FROM (VALUES
  ('priority', (SELECT count(DISTINCT priority) + max(CAST(priority IS NULL AS BIGINT)) FROM labelled)),
  ('price', (SELECT count(DISTINCT price) + max(CAST(price IS NULL AS BIGINT)) FROM labelled)),
  ('app_month', (SELECT count(DISTINCT app_month) + max(CAST(app_month IS NULL AS BIGINT)) FROM labelled)),
  ('custkey', (SELECT count(DISTINCT custkey) + max(CAST(custkey IS NULL AS BIGINT)) FROM labelled))) t(feature, n_distinct)""")
def distinct_counts_labelled(spark, sf):
    return distinct_counts(labelled(spark, sf), ["priority", "price", "app_month", "custkey"])


@register("skewness_events", ["A21", "T1"], sql="""
SELECT round(skewness(value), 6) AS skew_value, round(skewness(pow(value, 3)), 6) AS skew_cube FROM events""")
def skewness_events(spark, sf):
    e = table(spark, sf, "events").withColumn("cube", F.pow("value", 3))
    return round_doubles(e.agg(sample_skewness("value").alias("skew_value"), sample_skewness("cube").alias("skew_cube")))


@register("posterior_by_group", ["A22"], sql=with_sql(LABELLED_SQL) + """
SELECT priority, app_month, count(*) AS n, round(avg(CAST(y AS DOUBLE)), 6) AS p_y,
       round((SELECT avg(CAST(y AS DOUBLE)) FROM labelled), 6) AS base_rate,
       round(avg(CAST(y AS DOUBLE)) / (SELECT avg(CAST(y AS DOUBLE)) FROM labelled), 6) AS ratio
FROM labelled GROUP BY 1, 2""")
def posterior_by_group(spark, sf):
    return round_doubles(core.posterior_by_group(labelled(spark, sf), "y", ["priority", "app_month"]))


@register("value_samples_orders", ["A23"], sql="""
WITH d AS (SELECT DISTINCT CAST(o_orderpriority AS VARCHAR) AS v FROM orders),
     e AS (SELECT DISTINCT CAST(o_orderstatus AS VARCHAR) AS v FROM orders)
SELECT 'o_orderpriority' AS feature, 'string' AS dtype, (SELECT count(*) FROM d) AS cardinality,
       list_sort((SELECT list(v) FROM (SELECT v FROM d ORDER BY md5(v || ':0') LIMIT 3))) AS samples
UNION ALL
SELECT 'o_orderstatus', 'string', (SELECT count(*) FROM e),
       list_sort((SELECT list(v) FROM (SELECT v FROM e ORDER BY md5(v || ':0') LIMIT 3)))""")
def value_samples_orders(spark, sf):
    return core.value_samples(table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"], k=3)


# ------------------------------------------------------------------ W* ------------
@register("window_mean_per_user", ["W1"], sql="""
SELECT event_id, user_id, round(value - avg(value) OVER (PARTITION BY user_id), 6) AS centered,
       round(avg(value) OVER (PARTITION BY user_id), 6) AS mean_v FROM events""")
def window_mean_per_user(spark, sf):
    """Unbounded-frame mean per key as aggregate + join: a hot key is pre-aggregated
    map-side instead of being sorted into one window partition."""
    e = table(spark, sf, "events")
    means = e.groupBy("user_id").agg(F.avg("value").alias("mean_v"))
    j = e.join(means, "user_id")
    return round_doubles(j.select("event_id", "user_id", (F.col("value") - F.col("mean_v")).alias("centered"), "mean_v"))


@register("running_scan_events", ["W6", "W4", "B5"], sql="""
SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS rank,
       round(sum(value) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS running,
       round(max(value) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS running_max
FROM events""")
def running_scan_events(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts", "value")
    s = ordered_scan(e, [("ts", True), ("event_id", True)], sums=["value"], maxes=["value"])
    return s.select("event_id", "rank", F.round("cum_value", 4).alias("running"), F.round("cmax_value", 4).alias("running_max"))


@register("running_scan_per_user", ["W4", "W6", "B5"], sql="""
SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rank,
       round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4)
         AS running FROM events""")
def running_scan_per_user(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    s = ordered_scan(e, [("ts", True), ("event_id", True)], by=["user_id"], sums=["value"])
    return s.select("event_id", "user_id", "rank", F.round("cum_value", 4).alias("running"))


@register("plateau_detector", ["W7", "T36"], sql="""
WITH r AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rk,
                  max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best,
                  count(*) OVER (PARTITION BY user_id) AS n FROM events),
imp AS (SELECT user_id, rk, n, lead(rk) OVER (PARTITION BY user_id ORDER BY rk) AS next_rk FROM r WHERE value = best)
SELECT user_id, CAST(min(rk + 3) AS BIGINT) AS stop_rank FROM imp
WHERE coalesce(next_rk, n + 1) > rk + 3 AND rk + 3 <= n GROUP BY 1""")
def plateau_detector(spark, sf):
    """Early-stopping with patience 3 and delta 0 per user over ``value`` in time
    order: the first row whose counter (rows since the last score >= best) hits 3."""
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    return plateau_stops(e, [("ts", True), ("event_id", True)], "value", patience=3, by=["user_id"])


@register("plateau_detector_delta", ["W7", "T36"], sql="""
WITH RECURSIVE r AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rk FROM events),
s AS (SELECT user_id, rk, value AS best, 0 AS counter FROM r WHERE rk = 1
      UNION ALL
      SELECT r.user_id, r.rk, CASE WHEN r.value >= s.best + 5 THEN r.value ELSE s.best END, CASE WHEN r.value >= s.best + 5 THEN 0 ELSE s.counter + 1 END
      FROM s JOIN r ON r.user_id = s.user_id AND r.rk = s.rk + 1 WHERE s.counter < 4)
SELECT user_id, CAST(rk AS BIGINT) AS stop_rank FROM s WHERE counter = 4""")
def plateau_detector_delta(spark, sf):
    """Early stopping per user with patience 4: a value counts as better from 5 above the best on."""
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    return plateau_stops(e, [("ts", True), ("event_id", True)], "value", patience=4, delta=5.0, by=["user_id"])


@register("session_prefixes", ["W8", "G6"], sql="""
SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS prefix_len,
       event_type AS target FROM events QUALIFY prefix_len > 0""")
def session_prefixes(spark, sf):
    """Every prefix of a user's event sequence as one sample (user, prefix length,
    next item): linear in rows; the prefix itself is the user's first rows."""
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    s = ordered_scan(e, [("ts", True), ("event_id", True)], by=["user_id"], rank_col="rk")
    return s.filter(F.col("rk") > 1).select("user_id", (F.col("rk") - 1).alias("prefix_len"), F.col("event_type").alias("target"))


@register("one_step_return", ["W9"], sql="""
WITH b AS (SELECT event_id, value / 100.0 AS r, event_type = 'purchase' AS done,
                  lead(value) OVER (ORDER BY ts, event_id) / 100.0 AS v_next FROM events)
SELECT event_id, round(CASE WHEN done OR v_next IS NULL THEN r ELSE r + 0.99 * v_next END, 6) AS q FROM b""")
def one_step_return(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts", "value", "event_type")
    j = ordered_scan(e, [("ts", True), ("event_id", True)], rank_col="rk", leads=["value"])
    r = F.col("value") / 100.0
    q = F.when((F.col("event_type") == "purchase") | F.col("value_next").isNull(), r).otherwise(r + 0.99 * F.col("value_next") / 100.0)
    return round_doubles(j.select("event_id", q.alias("q")))


# ------------------------------------------------------------------ O* ------------
@register("top_orders", ["O1", "O3", "O4", "T20"], sql="""
SELECT * FROM (SELECT 'top' AS kind, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10)
UNION ALL
SELECT * FROM (SELECT 'smallest', o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10)""")
def top_orders(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    top = o.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10).withColumn("kind", F.lit("top"))
    low = o.sort("o_totalprice", "o_orderkey").limit(10).withColumn("kind", F.lit("smallest"))  # takeOrdered is ascending
    return top.unionByName(low).select("kind", "o_orderkey", "o_totalprice")


@register("best_k_per_customer", ["O5", "O2"], sql="""
WITH r AS (SELECT o_custkey, o_orderkey, o_totalprice,
                  row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn,
                  count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
SELECT o_custkey, o_orderkey, rn, CAST(greatest(n - 3, 0) AS BIGINT) AS evicted FROM r WHERE rn <= 3""")
def best_k_per_customer(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    kept = top_k_per_group(o, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3, "rn")
    ev = o.groupBy("o_custkey").agg(F.greatest(F.count(F.lit(1)) - 3, F.lit(0)).cast("long").alias("evicted"))
    return kept.join(ev, "o_custkey").select("o_custkey", "o_orderkey", F.col("rn").cast("long").alias("rn"), "evicted")


# ------------------------------------------------------------------ U* ------------
@register("set_ops_custkeys", ["U1", "U2", "U3", "T21"], sql="""
SELECT (SELECT count(*) FROM (SELECT o_custkey AS k FROM orders UNION ALL SELECT c_custkey FROM customer)) AS n_union_all,
       (SELECT count(*) FROM (SELECT o_custkey FROM orders INTERSECT SELECT c_custkey FROM customer)) AS n_intersect,
       (SELECT count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)) AS n_subtract,
       (SELECT count(*) FROM (SELECT o_custkey FROM orders EXCEPT ALL SELECT c_custkey FROM customer)) AS n_except_all""")
def set_ops_custkeys(spark, sf):
    a = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    b = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    cnt = lambda d: d.select(F.count(F.lit(1))).scalar()
    return spark.range(1).select(cnt(a.union(b)).alias("n_union_all"), cnt(a.intersect(b)).alias("n_intersect"),
                                 cnt(b.subtract(a)).alias("n_subtract"), cnt(a.exceptAll(b)).alias("n_except_all"))


# ------------------------------------------------------------------ S* ------------
@register("hash_sample_orders", ["S1"], sql=f"""
SELECT o_orderstatus, count(*) AS n FROM orders WHERE {H('o_orderkey', 7)} < 0.1 GROUP BY 1""")
def hash_sample_orders(spark, sf):
    s = core.hash_sample(table(spark, sf, "orders"), "o_orderkey", 0.1, seed=7)
    return s.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@register("exact_sample_orders", ["S2"], sql=f"""
SELECT o_orderkey FROM orders ORDER BY {H('o_orderkey', 3)}, o_orderkey LIMIT 100""")
def exact_sample_orders(spark, sf):
    return core.exact_sample(table(spark, sf, "orders"), "o_orderkey", 100, seed=3).select("o_orderkey")


@register("stratified_sample_status", ["S3"], sql=f"""
SELECT o_orderstatus, count(*) AS n FROM orders
WHERE {H('o_orderkey', 5)} < CASE o_orderstatus WHEN 'F' THEN 0.5 WHEN 'O' THEN 0.1 ELSE 0.0 END GROUP BY 1""")
def stratified_sample_status(spark, sf):
    s = core.stratified_sample(table(spark, sf, "orders"), "o_orderstatus", {"F": 0.5, "O": 0.1}, "o_orderkey", seed=5)
    return s.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@register("random_split_orders", ["S4"], sql=f"""
SELECT (CASE WHEN {H('o_orderkey', 11)} >= 0.7 THEN 1 ELSE 0 END)
       + (CASE WHEN {H('o_orderkey', 11)} >= 0.9 THEN 1 ELSE 0 END) AS split, count(*) AS n FROM orders GROUP BY 1""")
def random_split_orders(spark, sf):
    s = core.random_split(table(spark, sf, "orders"), [0.7, 0.2, 0.1], "o_orderkey", seed=11)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@register("holdout_orders", ["S5"], sql=f"""
WITH r AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY {H('o_orderkey', 42)}, o_orderkey) AS rk,
                  count(*) OVER () AS n FROM orders)
SELECT o_orderstatus, CAST(rk > n - floor(n * 0.2) AS INTEGER) AS is_test, count(*) AS n FROM r GROUP BY 1, 2""")
def holdout_orders(spark, sf):
    h = core.holdout(table(spark, sf, "orders"), "o_orderkey", 0.2, seed=42)
    return h.groupBy("o_orderstatus", "is_test").agg(F.count(F.lit(1)).alias("n"))


@register("stratified_holdout_orders", ["S6"], sql=f"""
WITH r AS (SELECT o_orderkey, o_orderstatus,
                  row_number() OVER (PARTITION BY o_orderstatus ORDER BY {H('o_orderkey', 42)}, o_orderkey) AS rk,
                  count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
SELECT o_orderstatus, CAST(rk > n - floor(n * 0.1) AS INTEGER) AS is_test, count(*) AS n FROM r GROUP BY 1, 2""")
def stratified_holdout_orders(spark, sf):
    h = core.holdout(table(spark, sf, "orders"), "o_orderkey", 0.1, seed=42, stratify="o_orderstatus")
    return h.groupBy("o_orderstatus", "is_test").agg(F.count(F.lit(1)).alias("n"))


@register("stratified_kfold_orders", ["S7"], sql=f"""
WITH r AS (SELECT o_orderkey, o_orderstatus,
                  row_number() OVER (PARTITION BY o_orderstatus ORDER BY {H('o_orderkey', 1)}, o_orderkey) AS rk FROM orders)
SELECT o_orderkey, o_orderstatus, CAST((rk - 1) % 5 AS INTEGER) AS fold FROM r""")
def stratified_kfold_orders(spark, sf):
    k = core.stratified_kfold(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey",
                              "o_orderstatus", 5, seed=1)
    return k.select("o_orderkey", "o_orderstatus", "fold")


@register("rebalance_labels", ["S8", "T23"], sql=with_sql(LABELLED_SQL, f"""
t AS (SELECT sum(y) AS p, count(*) - sum(y) AS n FROM labelled)""") + f"""
SELECT 'down' AS method, y, count(*) AS n FROM labelled, t
WHERE y = 1 OR {H('id', 9)} < least(1.0, p / (1.0 * n)) GROUP BY 1, 2
UNION ALL
SELECT 'up', y, CAST(sum(CASE WHEN y = 1 THEN floor(2.0 * n / p)
                               + (CASE WHEN {H('id', 9)} < 2.0 * n / p - floor(2.0 * n / p) THEN 1 ELSE 0 END)
                          ELSE 1 END) AS BIGINT) FROM labelled, t GROUP BY 1, 2""")
def rebalance_labels(spark, sf):
    df = labelled(spark, sf)
    down = core.rebalance(df, "y", "id", 1.0, "down", seed=9).groupBy("y").agg(F.count(F.lit(1)).alias("n"))
    up = core.rebalance(df, "y", "id", 2.0, "up", seed=9).groupBy("y").agg(F.count(F.lit(1)).alias("n"))
    return down.withColumn("method", F.lit("down")).unionByName(up.withColumn("method", F.lit("up")))


@register("shuffle_positions", ["S9"], sql=f"""
SELECT o_orderkey, row_number() OVER (ORDER BY {H('o_orderkey', 13)}, o_orderkey) - 1 AS pos FROM orders""")
def shuffle_positions(spark, sf):
    return core.shuffle_rows(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", seed=13).select("o_orderkey", "pos")


@register("priority_draw_events", ["S10", "T24"], sql=f"""
WITH w AS (SELECT event_id, sqrt(value + 0.01) AS w FROM events),
c AS (SELECT event_id, w, sum(w) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cw FROM w),
t AS (SELECT sum(w) / 64 AS seg FROM w),
d AS (SELECT i AS draw, (CAST(i AS DOUBLE) + {H('i', 17)}) * seg AS u FROM range(64) r(i), t)
SELECT draw, event_id FROM d JOIN c ON d.u > c.cw - c.w AND d.u <= c.cw""")
def priority_draw_events(spark, sf):
    e = table(spark, sf, "events").select("event_id", "value")
    d = core.priority_draw(e, "event_id", F.sqrt(F.col("value") + 0.01), 64, seed=17)
    return d.select("draw", "event_id")


@register("newest_events", ["S11"], sql="""
SELECT event_id, user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 500""")
def newest_events(spark, sf):
    return core.newest_n(table(spark, sf, "events"), "ts", "event_id", 500).select("event_id", "user_id")


@register("rare_values_users", ["S12"], sql="""
WITH c AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1)
SELECT CASE WHEN n >= 70 THEN CAST(user_id AS VARCHAR) ELSE '__rare__' END AS user_bucket, CAST(sum(n) AS BIGINT) AS n
FROM c GROUP BY 1""")
def rare_values_users(spark, sf):
    r = core.rare_to_other(table(spark, sf, "events"), "user_id", 70)
    return r.groupBy(F.col("user_id").alias("user_bucket")).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ V* ------------
@register("partition_layout", ["V1", "V2", "V3", "D9"], sql="""
SELECT 'rows' AS fact, count(*) AS n FROM orders UNION ALL SELECT 'hash: keys not where their hash says', 0 UNION ALL SELECT 'coalesce: partitions', 4 UNION ALL SELECT 'coalesce to 50 of 8: partitions', 8
UNION ALL SELECT 'range: pairs of neighbours that overlap', 0 UNION ALL SELECT 'own function: rows elsewhere', 0 UNION ALL SELECT 'hash: partitions of a key, at most', 1""")
def partition_layout(spark, sf):
    """Where rows go: by hash of a key, by range, by a function of the user; fewer partitions without a shuffle."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    here = F.spark_partition_id()
    hashed = o.repartition(8, "o_custkey").withColumn("pid", here)
    wrong = hashed.filter(F.col("pid") != F.pmod(F.hash("o_custkey"), F.lit(8)))
    spread = hashed.groupBy("o_custkey").agg(F.count_distinct("pid").alias("p")).agg(F.max("p").cast("long").alias("n"))
    fewer = o.repartition(8, "o_custkey").coalesce(4)
    ranges = o.repartitionByRange(5, "o_orderkey").groupBy(here.alias("pid")).agg(F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"))
    overlap = ranges.alias("a").join(ranges.alias("b"), F.col("b.pid") == F.col("a.pid") + 1).filter("a.hi >= b.lo")
    own = o.repartitionById(4, (F.col("o_custkey") % 4).cast("int")).withColumn("pid", here).filter(F.col("pid") != F.col("o_custkey") % 4)
    fact = lambda name, df: df.select(F.lit(name).alias("fact"), F.col("n").cast("long").alias("n"))
    n = F.count(F.lit(1)).alias("n")
    facts = [fact("rows", hashed.agg(n)), fact("hash: keys not where their hash says", wrong.agg(n)), fact("hash: partitions of a key, at most", spread),
             fact("coalesce: partitions", spark.range(1).select(F.lit(fewer.rdd.getNumPartitions()).alias("n"))),
             fact("coalesce to 50 of 8: partitions", spark.range(1).select(F.lit(o.repartition(8, "o_custkey").coalesce(50).rdd.getNumPartitions()).alias("n"))),
             fact("range: pairs of neighbours that overlap", overlap.agg(n)), fact("own function: rows elsewhere", own.agg(n))]
    out = facts[0]
    for f in facts[1:]:
        out = out.unionByName(f)
    return out
