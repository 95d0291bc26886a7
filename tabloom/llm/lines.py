"""Line dedup: sharded minimal perfect hashes index the lines that many documents share.

1. A task hashes each document's distinct long lines (128 bits), and one map-side-combined
   aggregate counts the documents of each line and finds the largest doc_id.
2. Lines found in enough documents are dealt to shards of bounded size. Each shard becomes one
   minimal perfect hash with arrays beside it: fingerprint, document count, largest doc_id.
3. Line hashes meet their shard's arrays (a shard with many probes is dealt to several tasks by
   doc_id) and only hits come back, collected per document, which then drops those lines.

Defined results: null or empty text is one empty line; rows that repeat a doc_id count as
documents of their own, keep or lose a line alike, and give a row each; a null doc_id is never the
largest; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import doc_columns, materialise, mix64, text_bytes, text_chunks

#: Keys of a shard, and probes of a task that meets one, about.
SHARD_KEYS = 100_000
TASK_PROBES = 100_000
#: At least so many probe groups in all, so that they spread evenly.
LEAST_SALTS = 64
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"


def line_key(line: bytes) -> bytes:
    return line.strip(SPACES).lower()  # bytes: only A-Z change


def long_key(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars)


def key_hash(key: bytes) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(key)
    to = lambda x: x - (1 << 64) if x >> 63 else x
    return to(h >> 64), to(h & 0xFFFFFFFFFFFFFFFF)


def _hashes(min_chars: int, batches):
    for part in text_chunks(batches):
        rows, hi, lo = [], [], []
        for i, raw in enumerate(text_bytes(part)):
            seen = {k for k in map(line_key, raw.split(b"\n")) if long_key(k, min_chars)}
            for h in map(key_hash, seen):
                rows.append(i)
                hi.append(h[0])
                lo.append(h[1])
        yield pa.record_batch([part.column(0).take(pa.array(rows, pa.int32())), pa.array(hi, pa.int64()), pa.array(lo, pa.int64())],
                              names=["doc_id", "h1", "h2"])


class MinimalPerfectHash:
    """Levels of bit arrays: a key is placed at the first level where no other key shares its bit; its
    number is the count of set bits before it. Keys not built in get some number or -1."""

    GAMMA = 2.0

    def __init__(self, words: list[np.ndarray], rest: np.ndarray):
        self.words, self.rest = words, np.sort(rest)
        self.ranks, total = [], 0
        for w in words:
            ones = np.bitwise_count(w).astype(np.int64)
            self.ranks.append(total + np.cumsum(ones) - ones)
            total += int(ones.sum())
        self.placed = total

    @staticmethod
    def slot(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
        return (mix64(keys + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)) % np.uint64(bits)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> "MinimalPerfectHash":
        left, words = keys.astype(np.uint64), []
        for level in range(40):
            if not left.size:
                break
            bits = 64 * math.ceil(max(64, cls.GAMMA * left.size) / 64)
            at = cls.slot(left, level, bits)
            alone = np.bincount(at, minlength=bits) == 1
            packed = np.packbits(alone, bitorder="little").view(np.uint64)
            words.append(packed)
            left = left[~alone[at]]
        return cls(words, left)  # what 40 levels leave, if anything, is looked up by sorted order

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.astype(np.uint64)
        out, open_ = np.full(keys.size, -1, dtype=np.int64), np.arange(keys.size)
        for level, w in enumerate(self.words):
            at = self.slot(keys[open_], level, w.size * 64)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            here = (w[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(w[word] & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[open_[here]] = (self.ranks[level][word] + below)[here]
            open_ = open_[~here]
        if self.rest.size and open_.size:
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), self.rest.size - 1)
            found = self.rest[at] == keys[open_]
            out[open_[found]] = self.placed + at[found]
        return out


SHARD_SCHEMA = "shard int, levels array<binary>, rest binary, prints binary, counts binary, last binary"


def build_shard(keys: tuple, table: pa.Table) -> pa.Table:
    """A shard's lines (h1, h2, n, last) as a minimal perfect hash over h1 and its arrays."""
    h1 = table["h1"].to_numpy().view(np.uint64)
    # Two lines that agree in h1 but not in h2 cannot share a slot: key on both halves mixed.
    key = h1 ^ mix64(table["h2"].to_numpy().view(np.uint64))
    mph = MinimalPerfectHash.build(key)
    at = mph(key)
    arrays = []
    for column in ("h2", "n", "last"):
        out = np.zeros(key.size, dtype=np.int64)
        out[at] = table[column].to_numpy()
        arrays.append(out.tobytes())
    return pa.table({"shard": pa.array([int(table["shard"][0].as_py())], pa.int32()), "levels": pa.array([[w.tobytes() for w in mph.words]], pa.list_(pa.binary())),
                     "rest": pa.array([mph.rest.tobytes()], pa.binary()), "prints": pa.array([arrays[0]], pa.binary()),
                     "counts": pa.array([arrays[1]], pa.binary()), "last": pa.array([arrays[2]], pa.binary())})


def probe_shard(probes: pa.Table, shard: pa.Table) -> pa.Table:
    """Of the probes, those whose line is in the shard's arrays and whose document is not its last holder."""
    if not shard.num_rows or not probes.num_rows:
        return probes.select(["doc_id", "h1", "h2"]).slice(0, 0)
    row = {k: shard[k][0].as_py() for k in shard.column_names}
    mph = MinimalPerfectHash([np.frombuffer(w, dtype=np.uint64) for w in row["levels"]], np.frombuffer(row["rest"], dtype=np.uint64))
    prints, last = np.frombuffer(row["prints"], dtype=np.int64), np.frombuffer(row["last"], dtype=np.int64)
    h1, h2 = probes["h1"].to_numpy(), probes["h2"].to_numpy()
    at = mph(h1.view(np.uint64) ^ mix64(h2.view(np.uint64)))
    ids = probes["doc_id"].combine_chunks() if isinstance(probes["doc_id"], pa.ChunkedArray) else probes["doc_id"]
    known = ~np.asarray(ids.is_null())
    own = np.asarray(ids.fill_null(0))
    safe = np.where((at >= 0) & (at < prints.size), at, 0)
    hit = (at >= 0) & (at < prints.size) & (prints[safe] == h2) & ~(known & (last[safe] == own))
    return probes.select(["doc_id", "h1", "h2"]).filter(pa.array(hit))


def _rewrite(min_chars: int, batches):
    for part in text_chunks(batches):
        drops = part.column(part.schema.get_field_index("gone")).to_pylist()
        out = {"n_lines": [], "n_dropped": [], "kept": []}
        for raw, drop in zip(text_bytes(part), drops):
            lines = raw.split(b"\n")
            kept = lines
            if drop:
                gone = {(d["h1"], d["h2"]) for d in drop}
                kept = [x for x in lines if not (long_key(k := line_key(x), min_chars) and key_hash(k) in gone)]
            out["n_lines"].append(len(lines))
            out["n_dropped"].append(len(lines) - len(kept))
            out["kept"].append(b"\n".join(kept))
        yield part, out


def line_dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, digest: bool = False, carry: bool = False) -> DataFrame:
    """Per document row: doc_id, n_lines, n_dropped and the kept text (``digest``: its SHA-256 instead);
    ``carry``: also ``row``, the other columns of ``docs``.

    A key is the stripped line with A-Z in lower case; keys of ``min_chars`` code points found in
    ``min_docs`` documents lose their lines except in the largest doc_id holding them.
    """
    df = doc_columns(docs)
    hashed = df.mapInArrow(lambda b: _hashes(min_chars, b), "doc_id long, h1 long, h2 long")
    seen = Observation()
    counted = (hashed.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last"))
               .observe(seen, F.coalesce(F.sum("n"), F.lit(0)).alias("probes"))
               .filter(F.col("n") >= min_docs).withColumn("last", F.coalesce("last", F.lit(-(1 << 63)))))
    frequent = materialise(counted)
    n_keys = frequent.count()
    shards = max(1, math.ceil(n_keys / SHARD_KEYS))
    shard = F.pmod(F.col("h1"), F.lit(shards)).cast("int")
    frequent = frequent.withColumn("shard", shard)
    # A shard is probed in as many salted groups as its frequent lines' rows and an even share of the rest ask for.
    share = seen.get["probes"] / shards
    load = frequent.groupBy("shard").agg(F.greatest(F.lit(math.ceil(LEAST_SALTS / shards)), F.ceil((F.sum("n") + share) / TASK_PROBES)).cast("int").alias("salts"))
    index = materialise(frequent.groupBy("shard").applyInArrow(build_shard, SHARD_SCHEMA).join(load, "shard"))
    # One pair of ints for every SHARD_KEYS frequent lines: a broadcast of megabytes at 10**10 such lines.
    salts = F.broadcast(index.select("shard", "salts"))
    probes = (hashed.withColumn("shard", shard).join(salts, "shard")
              .withColumn("salt", F.pmod(F.xxhash64(F.coalesce("doc_id", F.col("h2"))), F.col("salts")).cast("int"))
              .select("shard", "salt", "doc_id", "h1", "h2"))
    dealt = index.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    hits = (probes.groupBy("shard", "salt").cogroup(dealt.groupBy("shard", "salt"))
            .applyInArrow(lambda left, right: probe_shard(left, right), "doc_id long, h1 long, h2 long"))
    drops = hits.groupBy("doc_id").agg(F.collect_set(F.struct("h1", "h2")).alias("gone"))
    whole = doc_columns(docs, carry)
    joined = whole.join(drops.withColumnRenamed("doc_id", "drop_id"), F.col("doc_id").eqNullSafe(F.col("drop_id")), "left").select(*whole.columns, "gone")
    last = "kept_sha256" if digest else "kept_text"

    def rewrite(batches):
        for part, out in _rewrite(min_chars, batches):
            kept = [hashlib.sha256(k).hexdigest() for k in out["kept"]] if digest else [k.decode("utf-8", "replace") for k in out["kept"]]
            yield pa.record_batch([part.column(0), pa.array(out["n_lines"], pa.int64()), pa.array(out["n_dropped"], pa.int64()),
                                   pa.array(kept, pa.string()), *part.columns[2:-1]], names=["doc_id", "n_lines", "n_dropped", last, *part.schema.names[2:-1]])

    schema = T.StructType([*T.StructType.fromDDL(f"doc_id long, n_lines long, n_dropped long, {last} string").fields, *whole.schema.fields[2:]])
    return joined.mapInArrow(rewrite, schema)
