"""Guide operators on whole tables: pandas UDFs, right join, Poisson sample, array and map work,
values of a key, loading a file into a table, and the (1 + eps) neighbour sum."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F

from ..operators import core, graph
from ..operators.core import hash_uniform_sql
from ..session import scratch_path
from .fixtures import table
from .registry import register

#: Rows that one grouped pandas call sees at most: groups go in chunks of consecutive keys.
CHUNK = 10_000


@register("pandas_udf_square", ["D2"], sql="""
SELECT l_returnflag, CAST(sum(CAST(l_quantity AS BIGINT) * CAST(l_quantity AS BIGINT)) AS BIGINT) AS sq, count(*) AS n FROM lineitem GROUP BY 1""")
def pandas_udf_square(spark, sf):
    """Series to Series of the same length, in Arrow batches."""
    @F.pandas_udf("long")
    def square(v: pd.Series) -> pd.Series:
        return v * v

    li = table(spark, sf, "lineitem").select("l_returnflag", F.col("l_quantity").cast("long").alias("q"))
    return li.withColumn("sq", square("q")).groupBy("l_returnflag").agg(F.sum("sq").alias("sq"), F.count(F.lit(1)).alias("n"))


def _cents(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"),
                                               F.round(F.col("c_acctbal") * 100).cast("long").alias("x"), F.floor(F.col("c_custkey") / CHUNK).alias("chunk"))


_SEGMENT_SQL = """WITH c AS (SELECT c_custkey AS id, c_mktsegment AS segment, CAST(round(c_acctbal * 100) AS BIGINT) AS x FROM customer),
m AS (SELECT segment, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM c GROUP BY 1) """


@register("grouped_agg_mean", ["D4"], sql=_SEGMENT_SQL + "SELECT segment, round(s / n, 4) AS mean FROM m")
def grouped_agg_mean(spark, sf):
    """Series to scalar per chunk of a group; chunks are combined natively, so no group meets in one call."""
    @F.pandas_udf("long")
    def total(v: pd.Series) -> int:
        return int(v.sum())

    part = _cents(spark, sf).groupBy("segment", "chunk").agg(total("x").alias("s"))
    sizes = _cents(spark, sf).groupBy("segment").agg(F.count(F.lit(1)).alias("n"))
    return part.groupBy("segment").agg(F.sum("s").alias("s")).join(sizes, "segment").select("segment", F.round(F.col("s") / F.col("n"), 4).alias("mean"))


@register("grouped_map_centred", ["D3"], sql=_SEGMENT_SQL + "SELECT id, segment, CAST(x * n - s AS BIGINT) AS centred FROM c JOIN m USING (segment)")
def grouped_map_centred(spark, sf):
    """Subtract the group mean (times the group size, to stay whole) in a grouped map over chunks of a group."""
    c = _cents(spark, sf)
    m = c.groupBy("segment").agg(F.sum("x").alias("s"), F.count(F.lit(1)).alias("n"))

    def centre(g: pd.DataFrame) -> pd.DataFrame:
        return g[["id", "segment"]].assign(centred=g["x"] * g["n"] - g["s"])

    return c.join(m, "segment").groupBy("segment", "chunk").applyInPandas(centre, "id long, segment string, centred long")


@register("join_right_counts", ["J2"], sql="""
SELECT count(*) AS n, count(o_orderkey) AS matched, count(*) - count(o_orderkey) AS without_orders FROM orders RIGHT JOIN customer ON o_custkey = c_custkey""")
def join_right_counts(spark, sf):
    o, c = table(spark, sf, "orders").select("o_orderkey", "o_custkey"), table(spark, sf, "customer").select("c_custkey")
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey"), "right")
    return j.agg(F.count(F.lit(1)).alias("n"), F.count("o_orderkey").alias("matched"), F.count_if(F.col("o_orderkey").isNull()).alias("without_orders"))


LAMBDA = 0.5


@register("poisson_sample_orders", ["S1"], sql="WITH u AS (SELECT o_orderkey, " + hash_uniform_sql(["o_orderkey"], 41) + " AS u FROM orders), c AS (SELECT o_orderkey, "
          + " + ".join(f"CAST(u >= {p!r} AS INT)" for p in core.poisson_cdf(LAMBDA)) + " AS copies FROM u) SELECT o_orderkey, CAST(copies AS INT) AS copies FROM c WHERE copies > 0")
def poisson_sample_orders(spark, sf):
    """Sample with replacement: each row's number of copies is Poisson(0.5), drawn from a seeded hash."""
    return core.poisson_copies(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", LAMBDA, 41)


_LINES = "(SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS q, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS i FROM lineitem)"


def _quantities(spark, sf):
    """An order's quantities in line order: an array a few entries long."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("long").alias("q"))
    lines = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "q")))
    return li.groupBy("l_orderkey").agg(F.transform(lines, lambda s: s["q"]).alias("q"))


@register("array_zip_quantities", ["F17"], sql=f"""
SELECT l_orderkey, CAST(sum(q * CASE WHEN i < 2 THEN q ELSE -1 END) AS BIGINT) AS zipped, CAST(sum(i * q) AS BIGINT) AS indexed FROM {_LINES} GROUP BY 1""")
def array_zip_quantities(spark, sf):
    """zipAll of a list with its first two entries (-1 where the shorter one ends), and zipWithIndex."""
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)
    z = F.arrays_zip(F.col("q").alias("a"), F.slice("q", 1, 2).alias("b"))
    return _quantities(spark, sf).select(
        "l_orderkey", total(F.transform(z, lambda p: p["a"] * F.coalesce(p["b"], F.lit(-1)))).alias("zipped"),
        total(F.transform("q", lambda x, i: x * i)).alias("indexed"))


@register("guarded_quantities", ["F21"], sql=f"""
SELECT l_orderkey, CAST(count(*) FILTER (q % 2 = 0) AS INT) AS kept, CAST(coalesce(sum(q * q) FILTER (q % 2 = 0), 0) AS BIGINT) AS squares FROM {_LINES} GROUP BY 1""")
def guarded_quantities(spark, sf):
    """Squares of the even quantities: transform over filter."""
    even = F.transform(F.filter("q", lambda x: x % 2 == 0), lambda x: x * x)
    return _quantities(spark, sf).select("l_orderkey", F.size(even).alias("kept"), F.aggregate(even, F.lit(0).cast("long"), lambda s, x: s + x).alias("squares"))


@register("map_ops_events", ["F20"], sql="""
WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2)
SELECT user_id, CAST(coalesce(max(n) FILTER (event_type = 'click'), 0) AS BIGINT) AS clicks, coalesce(bool_or(event_type = 'error'), false) AS has_error,
       CAST(count(*) + 1 AS INT) AS merged, CAST(count(*) FILTER (event_type <> 'view') AS INT) AS without_view FROM c GROUP BY 1""")
def map_ops_events(spark, sf):
    """Per user a map from event type to count: get or default, contains, merge, remove."""
    c = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    m = c.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    return m.select("user_id", F.coalesce(F.try_element_at("m", F.lit("click")), F.lit(0).cast("long")).alias("clicks"), F.map_contains_key("m", "error").alias("has_error"),
                    F.size(F.map_concat("m", F.create_map(F.lit("__total"), F.lit(0).cast("long")))).alias("merged"), F.size(F.map_filter("m", lambda k, v: k != "view")).alias("without_view"))


@register("values_of_keys", ["A10"], sql="""
SELECT n_regionkey, string_agg(n_nationkey || '=' || n_name, ',' ORDER BY n_nationkey) AS pairs FROM nation GROUP BY 1""")
def values_of_keys(spark, sf):
    """All (key, value) pairs of a region as one map (a region's nations are few), shown in key order."""
    m = table(spark, sf, "nation").groupBy("n_regionkey").agg(F.map_from_entries(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("m"))
    return m.select("n_regionkey", F.array_join(F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("pairs"))


@register("load_file_into_table", ["IO20"], sql="SELECT s_nationkey, count(*) AS n, CAST(sum(s_suppkey) AS BIGINT) AS keys FROM supplier GROUP BY 1")
def load_file_into_table(spark, sf):
    """A CSV file read and inserted into an existing table; the table's files are read back."""
    file, where, name = scratch_path(spark, "load-csv"), scratch_path(spark, "load-table"), f"load_{uuid.uuid4().hex[:12]}"
    table(spark, sf, "supplier").select("s_suppkey", "s_nationkey").write.option("header", True).csv(file)
    spark.sql(f"CREATE TABLE {name} (s_suppkey BIGINT, s_nationkey BIGINT) USING parquet LOCATION '{where}'")
    spark.read.option("header", True).schema("s_suppkey BIGINT, s_nationkey BIGINT").csv(file).write.insertInto(name)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(where).groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"), F.sum("s_suppkey").alias("keys"))


@register("gin_neighbour_sum", ["G2"], sql="""
WITH e AS (SELECT DISTINCT 2 * o_custkey AS src, 2 * l_partkey + 1 AS dst FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
n AS (SELECT 2 * c_custkey AS id, CAST(round(c_acctbal * 100) AS BIGINT) AS x FROM customer UNION ALL SELECT 2 * p_partkey + 1, CAST(round(p_retailprice * 100) AS BIGINT) FROM part),
s AS (SELECT src, CAST(sum(x) AS BIGINT) AS s FROM e JOIN n ON id = dst GROUP BY 1)
SELECT id AS src, 1.25 * x + coalesce(s, 0) AS h FROM n LEFT JOIN s ON src = id""")
def gin_neighbour_sum(spark, sf):
    """(1 + 0.25) * own feature + sum of the neighbours', in whole cents (a quarter is exact in binary)."""
    o, li = table(spark, sf, "orders").select("o_orderkey", "o_custkey"), table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    e = o.join(li, F.col("o_orderkey") == F.col("l_orderkey")).select((2 * F.col("o_custkey")).alias("src"), (2 * F.col("l_partkey") + 1).alias("dst")).distinct()
    cents = lambda c: F.round(F.col(c) * 100).cast("long").alias("x")
    nodes = (table(spark, sf, "customer").select((2 * F.col("c_custkey")).alias("id"), cents("c_acctbal"))
             .unionByName(table(spark, sf, "part").select((2 * F.col("p_partkey") + 1).alias("id"), cents("p_retailprice"))))
    return graph.gin_sum(e, nodes, "x", eps=0.25)
