"""Streaming queries: each runs its stream to completion and returns the result table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import streams
from .registry import register, round_doubles


def _events_path(sf):
    return sf.rstrip("/")


@register("stream_window_counts", ["R1", "R2", "R4"], sql="""
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def stream_window_counts(spark, sf):
    s = streams.event_stream(spark, _events_path(sf))
    path = streams.run_to_table(streams.windowed_counts(s, "event_type"), "stream-counts", mode="update")
    return streams.latest_per_key(spark, path, ["day", "event_type"], "day string, event_type string, n long")


@register("stream_drift_psi", ["R4", "E13"], sql="""
WITH c AS (SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2),
s AS (SELECT *, n / sum(n) OVER (PARTITION BY day) AS s FROM c),
b AS (SELECT event_type, s AS b FROM s WHERE day = (SELECT min(day) FROM c))
SELECT day, round(sum((b - s) * ln(b / s)), 6) AS psi FROM s JOIN b USING (event_type) GROUP BY 1""")
def stream_drift_psi(spark, sf):
    s = streams.event_stream(spark, _events_path(sf))
    path = streams.run_to_table(streams.windowed_counts(s, "event_type"), "stream-drift", mode="update")
    counts = streams.latest_per_key(spark, path, ["day", "event_type"], "day string, event_type string, n long")
    return round_doubles(streams.psi_against_first(counts, "day", "event_type"))


@register("stream_scoring", ["R3", "D5"], sql="""
SELECT event_id, round(1.0 / (1.0 + exp(-(0.01 * value - 1.0 + 0.1 * CASE event_type WHEN 'click' THEN 0
       WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 WHEN 'view' THEN 4 ELSE 0 END))), 6) AS score
FROM events""")
def stream_scoring(spark, sf):
    s = streams.event_stream(spark, _events_path(sf))
    path = streams.run_to_table(streams.score_stream(s), "stream-scores")
    return round_doubles(spark.read.schema("event_id long, score double, _epoch long").parquet(path).drop("_epoch"))


@register("stream_newest_buffer", ["R5", "S11"], sql="""
SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) - 1 AS slot
FROM events QUALIFY slot < 3""")
def stream_newest_buffer(spark, sf):
    s = streams.event_stream(spark, _events_path(sf))
    path = streams.run_to_table(streams.newest_n_state(s, "user_id", 3), "stream-buffer", mode="update")
    df = spark.read.schema("user_id long, event_id long, slot long, _epoch long").parquet(path)
    last = df.groupBy("user_id").agg(F.max("_epoch").alias("_epoch"))
    return df.join(last, ["user_id", "_epoch"]).drop("_epoch")
