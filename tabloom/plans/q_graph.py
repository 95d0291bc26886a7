"""Graph queries: customer -> part edges from orders x lineitem (G1-G5, S13), event
transitions per user (G6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph
from ..operators.core import hash_uniform_sql
from .fixtures import table
from .registry import register, round_doubles

EDGES_SQL = """edges AS (SELECT DISTINCT o_custkey AS src, l_partkey AS dst FROM orders JOIN lineitem ON l_orderkey = o_orderkey)"""


def edges(spark, sf, distinct=True):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    pairs = o.join(li, o.o_orderkey == li.l_orderkey).select(F.col("o_custkey").alias("src"), F.col("l_partkey").alias("dst"))
    return pairs.distinct() if distinct else pairs


def parts(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), (F.col("p_retailprice") / 1000.0).alias("x"))


@register("neighbour_pooling", ["G1"], sql=f"""
WITH {EDGES_SQL},
p AS (SELECT src, CAST(round(p_retailprice * 100) AS BIGINT) AS x FROM edges JOIN part ON dst = p_partkey),
g AS (SELECT src, CAST(sum(x) AS BIGINT) AS s, max(x) AS m, count(*) AS n FROM p GROUP BY 1)
SELECT src, ((20 * s + n) // (2 * n)) / 1000000.0 AS mean_pool, m / 100000.0 AS max_pool, s / 100000.0 AS sum_pool FROM g""")
def neighbour_pooling(spark, sf):
    """Features are whole cents: sums are exact, and the mean is rounded half up in integers to 6 places of a thousand."""
    cents = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.round(F.col("p_retailprice") * 100).cast("long").alias("x"))
    g = graph.neighbour_pool(edges(spark, sf), cents, "x")
    return g.select("src", (F.expr("(20 * sum_pool + n) div (2 * n)") / 1000000.0).alias("mean_pool"),
                    (F.col("max_pool") / 100000.0).alias("max_pool"), (F.col("sum_pool") / 100000.0).alias("sum_pool"))


@register("sym_norm_propagation", ["G3"], sql=f"""
WITH {EDGES_SQL},
nodes AS (SELECT 'c' || c_custkey AS id, c_acctbal / 1000.0 AS x FROM customer
          UNION ALL SELECT 'p' || p_partkey, p_retailprice / 1000.0 FROM part),
e AS (SELECT 'c' || src AS s, 'p' || dst AS d FROM edges),
a AS (SELECT s AS src, d AS dst FROM e UNION SELECT d, s FROM e UNION SELECT id, id FROM nodes),
deg AS (SELECT src, count(*) AS d FROM a GROUP BY 1)
SELECT a.src, round(sum(x / sqrt(ds.d * dd.d)), 6) AS h FROM a JOIN deg ds ON ds.src = a.src JOIN deg dd ON dd.src = a.dst
JOIN nodes n ON n.id = a.dst GROUP BY 1""")
def sym_norm_propagation(spark, sf):
    """Customers have even ids and parts odd ones, so that ids stay whole numbers until the result names them."""
    even, odd = lambda c: 2 * F.col(c), lambda c: 2 * F.col(c) + 1
    e = edges(spark, sf, distinct=False).select(even("src").alias("src"), odd("dst").alias("dst"))
    c = table(spark, sf, "customer").select(even("c_custkey").alias("id"), (F.col("c_acctbal") / 1000.0).alias("x"))
    p = table(spark, sf, "part").select(odd("p_partkey").alias("id"), (F.col("p_retailprice") / 1000.0).alias("x"))
    h = graph.sym_norm_propagate(e, c.unionByName(p), "x")
    name = F.concat(F.when(F.col("src") % 2 == 0, "c").otherwise("p"), F.expr("cast(src div 2 as string)"))
    return round_doubles(h.select(name.alias("src"), "h"))


@register("graph_smoothness", ["G4"], sql=f"""
WITH {EDGES_SQL}
SELECT round(0.5 * sum(pow(c_acctbal / 1000.0 - p_retailprice / 1000.0, 2)), 4) AS smoothness
FROM edges JOIN customer ON src = c_custkey JOIN part ON dst = p_partkey""")
def graph_smoothness(spark, sf):
    e = edges(spark, sf).select(F.concat(F.lit("c"), F.col("src")).alias("src"), F.concat(F.lit("p"), F.col("dst")).alias("dst"))
    c = table(spark, sf, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("id"), (F.col("c_acctbal") / 1000.0).alias("f"))
    p = table(spark, sf, "part").select(F.concat(F.lit("p"), "p_partkey").alias("id"), (F.col("p_retailprice") / 1000.0).alias("f"))
    return graph.smoothness(e, c.unionByName(p), "f").select(F.round("smoothness", 4).alias("smoothness"))


@register("metapath_two_hop", ["G5"], sql=f"""
WITH {EDGES_SQL}, deg AS (SELECT dst, count(*) AS deg FROM edges GROUP BY 1)
SELECT src, CAST(sum(deg - 1) AS BIGINT) AS paths, count(*) AS neighbours FROM edges JOIN deg USING (dst) GROUP BY 1""")
def metapath_two_hop(spark, sf):
    return graph.metapath_counts(edges(spark, sf))


@register("event_transitions", ["G6", "W8"], sql="""
WITH s AS (SELECT event_type AS src, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS dst FROM events)
SELECT src, dst, count(*) AS n FROM s WHERE dst IS NOT NULL GROUP BY 1, 2""")
def event_transitions(spark, sf):
    return graph.transitions(table(spark, sf, "events"), "user_id", "ts", "event_id", "event_type")


@register("neighbour_sampling", ["S13"], sql=f"""
WITH {EDGES_SQL},
r AS (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY {hash_uniform_sql(['src', 'dst'], 21)}, dst) AS rn FROM edges)
SELECT src, dst FROM r WHERE rn <= 3""")
def neighbour_sampling(spark, sf):
    return graph.sample_neighbours(edges(spark, sf), 3, seed=21).select("src", "dst")
