"""Derived inputs shared by queries: one Spark builder and one SQL view text each.

The SQL texts are the DuckDB-side definitions of the very same derivations, so a
query and its oracle start from identical rows (FIXTURES.md part C).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- labelled: orders with a binary label and deterministic nulls --------------------
def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("y"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_orderkey") % 13 == 0, F.lit(None)).otherwise(F.col("o_totalprice")).alias("price"),
        F.date_format("o_orderdate", "yyyy-MM").alias("app_month"),
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderstatus").alias("status"),
    )


LABELLED_SQL = """labelled AS (
  SELECT o_orderkey AS id,
         CAST(o_orderstatus = 'F' AS INTEGER) AS y,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS priority,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice END AS price,
         strftime(o_orderdate, '%Y-%m') AS app_month,
         o_custkey AS custkey,
         o_orderstatus AS status
  FROM orders)"""


# --- scored: labelled plus a deterministic score p -----------------------------------
def score_expr(id_col="id", y_col="y"):
    return (F.lit(0.7) * ((F.col(id_col) * 7919) % 10007).cast("double") / F.lit(10007.0)
            + F.lit(0.3) * F.col(y_col).cast("double") * ((F.col(id_col) % 3).cast("double") / F.lit(2.0)))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spark, sf_dir).withColumn("p", score_expr())


SCORED_SQL = LABELLED_SQL + """,
scored AS (
  SELECT *, CAST(0.7 AS DOUBLE) * CAST((id * 7919) % 10007 AS DOUBLE) / 10007.0
            + CAST(0.3 AS DOUBLE) * CAST(y AS DOUBLE) * (CAST(id % 3 AS DOUBLE) / 2.0) AS p
  FROM labelled)"""


# --- events with a signed value and a skewed cube (FIXTURES C) ----------------------
def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def with_sql(*ctes: str) -> str:
    """Join CTE texts into a WITH prefix."""
    return "WITH " + ",\n".join(ctes) + "\n"
