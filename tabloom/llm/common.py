"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that a Python step works on at once; batches are cut to this size.
CHUNK_BYTES = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder under the shared checkpoint location."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        from ..session import ensure_checkpoint_dir
        base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later uses do not recompute it, and
    they survive the loss of any executor."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Remove the folder of a table from ``materialise`` that nothing reads any more."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/llm-" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def doc_columns(docs: DataFrame, carry: bool = False) -> DataFrame:
    """Only the two columns the operators read, so that extra columns cannot clash.

    ``carry``: also ``row``, a struct of all columns but the text, for steps that hand documents on.
    """
    own = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    if carry:
        own.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"))
    return docs.select(*own)


def restored(df: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` from a carried ``row`` and the column ``text``."""
    return df.select(*[F.col(text).alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def text_chunks(batches, column: str = "text", limit: int = CHUNK_BYTES):
    """Slices of the record batches whose texts hold about ``limit`` bytes (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        sizes = np.nan_to_num(np.asarray(pc.binary_length(col).to_numpy(zero_copy_only=False), dtype="float64"))
        ends = np.cumsum(sizes)
        at = 0
        while at < n:
            base = ends[at - 1] if at else 0.0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def text_bytes(batch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [x or b"" for x in batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()]


def sha_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 output bits (wraps modulo 2**64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
