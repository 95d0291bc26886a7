"""Structured Streaming jobs (R1-R5): file-source streams, windowed counts with a
watermark, stream scoring and a keyed newest-N buffer with per-key state.

Each job runs with ``trigger(availableNow=True)`` in tests and writes through
``foreachBatch`` to a table in the shared folder, so the results (and the
checkpoint) survive executor loss and driver restarts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..session import scratch_path

EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def event_stream(spark: SparkSession, directory: str, glob: str = "events*.parquet", max_files: int = 1) -> DataFrame:
    """Event files of a directory as a stream (``glob`` picks the files, at most
    ``max_files`` per micro-batch); ``ts`` cast to TIMESTAMP for watermarks (H9)."""
    s = (spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", max_files)
         .option("pathGlobFilter", glob).parquet(directory))
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


def run_to_table(stream: DataFrame, name: str, mode: str = "append") -> str:
    """Run a stream to completion (availableNow) into a parquet table; return its path."""
    spark = stream.sparkSession
    out, ckpt = scratch_path(spark, name), scratch_path(spark, name + "-ckpt")

    def sink(batch: DataFrame, epoch: int):
        # One folder an epoch, overwritten: a batch that is tried again replaces its own rows.
        batch.write.mode("overwrite").parquet(f"{out}/_epoch={epoch}")

    q = (stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out


def latest_per_key(spark: SparkSession, path: str, keys: list[str], schema: str) -> DataFrame:
    """Newest emitted version of each key across micro-batches (update-mode sinks)."""
    df = spark.read.schema(schema + ", _epoch long").parquet(path)
    last = df.groupBy(*keys).agg(F.max("_epoch").alias("_epoch"))
    return df.join(last, keys + ["_epoch"]).drop("_epoch")


def windowed_counts(stream: DataFrame, key: str, window: str = "1 day", watermark: str = "1 day") -> DataFrame:
    """Counts per tumbling window and key, with a watermark for late data."""
    return (stream.withWatermark("ts", watermark).groupBy(F.window("ts", window).alias("w"), key)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), key, "n"))


def psi_against_first(counts: DataFrame, part: str, key: str, eps: float = 0.0) -> DataFrame:
    """PSI of each part's key distribution against the first part (small count table)."""
    tot = counts.groupBy(part).agg(F.sum("n").alias("t"))
    sh = counts.join(tot, part).withColumn("s", F.col("n") / F.col("t"))
    first = counts.agg(F.min(part)).first()[0]
    b = sh.filter(F.col(part) == first).select(key, F.col("s").alias("b"))
    return (sh.join(b, key).groupBy(part)
            .agg(F.sum((F.col("b") - F.col("s")) * F.ln((F.col("b") + eps) / (F.col("s") + eps))).alias("psi")))


# Fixed demo scorer for the stream (our own coefficients).
TYPE_CODE = {"click": 0, "error": 1, "purchase": 2, "signup": 3, "view": 4}


def score_stream(stream: DataFrame) -> DataFrame:
    """Per-event score of a streaming DataFrame, 1 / (1 + exp(-(0.01 * value - 1 + 0.1 * code))), as one Spark
    expression. A type without a code counts as 0 there, like "click"; a null value gives a null score."""
    codes = F.create_map(*[F.lit(x) for pair in TYPE_CODE.items() for x in pair])
    z = 0.01 * F.col("value") - 1.0 + 0.1 * F.coalesce(codes[F.col("event_type")], F.lit(0))
    return stream.select("event_id", (1.0 / (1.0 + F.exp(-z))).alias("score"))


def _newest_of_batches(batches, key: str, n: int):
    """The newest ``n`` (ts, event_id) of every key of a record batch."""
    for batch in batches:
        rows = batch.to_pandas().sort_values(["ts", "event_id"], ascending=False)
        yield pa.RecordBatch.from_pandas(rows.groupby(key, sort=False, dropna=False).head(n), schema=batch.schema, preserve_index=False)


def newest_n_state(stream: DataFrame, key: str, n: int = 3) -> DataFrame:
    """Keyed newest-N buffer. State per key holds at most n (ts, id) pairs, so
    memory is bounded per key whatever the key's volume.

    Record batches are reduced to n rows a key where they are read, before the shuffle: a hot key sends n rows a record
    batch to the task of its state, not all its events."""
    def update(k, pdfs, state):
        if state.exists:
            ts, ids = state.get
            buf = pd.DataFrame({"ts": list(ts), "event_id": list(ids)})
        else:
            buf = pd.DataFrame({"ts": pd.Series(dtype="datetime64[us]"), "event_id": pd.Series(dtype="int64")})
        for pdf in pdfs:
            part = pdf[["ts", "event_id"]].sort_values(["ts", "event_id"], ascending=False).head(n)
            buf = pd.concat([buf, part]).sort_values(["ts", "event_id"], ascending=False).head(n)
        state.update((buf["ts"].tolist(), buf["event_id"].astype("int64").tolist()))
        yield pd.DataFrame({key: [k[0]] * len(buf), "event_id": buf["event_id"].astype("int64").to_numpy(),
                            "slot": np.arange(len(buf), dtype=np.int64)})

    slim = stream.select(key, "ts", "event_id")
    first = slim.mapInArrow(lambda batches: _newest_of_batches(batches, key, n), slim.schema)
    return first.groupBy(key).applyInPandasWithState(
        update, f"{key} long, event_id long, slot long", "ts array<timestamp>, ids array<long>", "update",
        GroupStateTimeout.NoTimeout)
