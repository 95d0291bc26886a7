"""Removing repeated passages by anchors (winnowing) that are ranked by hashes of growing prefixes.

This is not full prefix doubling: no position but an anchor is ranked, and ranks are hashes, not places in a sort (README).

Every window of ``LENGTH`` bytes has one anchor: the position in it whose 32-byte prefix has the
smallest hash (the same in every copy of the window). Only anchors are ranked, one in
35 bytes or so, each with the run of windows it stands for. Ranks are hashes of prefixes at growing
offsets around the anchor:

1. rank 32: anchors are dealt by the hash of their 32 bytes and sorted; an anchor whose rank is
   unique cannot be in a repeat and leaves (unless its own run holds it twice);
2. rank of the pair (32 bytes, the whole run of its windows, past the threshold), by a 128-bit digest
   of the run's bytes: equal pairs stand for equal runs; all but the first in (doc_id, position)
   order are repeats as a whole. What is repeated inside a batch of texts is settled there, so a
   passage shared by a third of all documents costs one row a batch, not one a document;
3. anchors that share rank 32 but not the run: their runs' bytes are compared window by window,
   grouped by rank 32 in tasks that stream; each window but the first of its kind is a repeat. The
   windows of a hot rank are dealt one by one, again settled in their batch first.

The ranges found go back to their documents, which drop the covered bytes.

Defined results: null or empty text has no bytes; rows that repeat a doc_id with another text are
documents of their own, ordered by a hash of the text; rows equal in both are one document and give
the same result each; a null doc_id comes after all others; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_columns, materialise, mix64, text_bytes, text_chunks

LENGTH = 100
PREFIX = 32
#: Text bytes hashed at once: the arrays stay in the processor's cache.
_PART = 1 << 17
_rng = np.random.default_rng(71)
_VALUES = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class Rolling:
    """Hashes of all substrings of one length from one cumulative sum (modulo 2**64)."""

    _powers: dict = {}

    @classmethod
    def powers(cls, base: int, n: int) -> np.ndarray:
        have = cls._powers.get(base)
        if have is None or have.size < n:
            size = max(n, _PART * 2)
            have = cls._powers[base] = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, base, dtype=np.uint64)])
        return have[:n]

    def __init__(self, data: np.ndarray):
        self.sums = np.r_[np.uint64(0), np.cumsum(_VALUES[data] * self.powers(_BASE, data.size))]
        self.back = self.powers(_INVERSE, data.size + 1)

    def __call__(self, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        return mix64((self.sums[at + length] - self.sums[at]) * self.back[at])

    def all(self, length: int) -> np.ndarray:
        n = self.sums.size - length
        return mix64((self.sums[length:] - self.sums[:n]) * self.back[:n])


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over every ``width`` consecutive values, by doubling."""
    out, have = values, 1
    while have * 2 <= width:
        out = pick(out[:-have], out[have:])
        have *= 2
    return pick(out[:out.size - (width - have)], out[width - have:]) if have < width else out


def window_runs(texts: list[bytes], length: int = LENGTH, prefix: int = PREFIX):
    """Arrays (text, first window, number of windows, rank of the anchor, both halves of the rank of the
    run, loops) of the runs of windows that share an anchor. ``loops``: the anchor's prefix occurs
    twice in the run, so the run may repeat a window by itself."""
    whole = b"".join(texts)
    data = np.frombuffer(whole, dtype=np.uint8)
    if data.size < length:
        return tuple(np.zeros(0, dtype=d) for d in (np.int64, np.int64, np.int64, np.uint64, np.uint64, np.uint64, bool))
    sizes = np.array([len(t) for t in texts])
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), sizes)
    roll, span = Rolling(data), length - prefix + 1
    rank = roll.all(prefix)
    least = sliding(rank, span, np.minimum)
    inside = owner[:least.size] == owner[length - 1:]
    cut = np.r_[True, (least[1:] != least[:-1]) | (owner[1:least.size] != owner[:least.size - 1]) | (inside[1:] != inside[:-1])]
    first = np.flatnonzero(cut)
    count = np.diff(np.r_[first, least.size])
    keep = inside[first]
    first, count = first[keep], count[keep]
    # Periodic text makes runs of any length: they go in pieces.
    pieces = -(-count // span)
    if pieces.size and pieces.max() > 1:
        at = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        total = np.repeat(count, pieces)
        first, count = np.repeat(first, pieces) + at * span, np.minimum(span, total - at * span)
    key = least[first]
    digests = b"".join([xxhash.xxh3_128_digest(whole[a:b]) for a, b in zip(first.tolist(), (first + count + (length - 1)).tolist())])
    run, more = np.frombuffer(digests, dtype=np.uint64).reshape(-1, 2).T
    # Anchors: positions whose rank is the least of some window over them.
    edge = np.zeros(span - 1, dtype=np.uint64)
    spots = np.flatnonzero(sliding(np.r_[edge, least, edge], span, np.maximum)[:rank.size] == rank)
    twins = spots[:-1][(rank[spots[1:]] == rank[spots[:-1]]) & (np.diff(spots) < span)]
    loops = np.searchsorted(twins, first + count + span - 1) > np.searchsorted(twins, first)
    text = owner[first]
    return text, first - starts[text], count, key, run, more, loops


#: Runs under one rank from which their windows are dealt one by one.
HOT = 4096
_NO_ID = (1 << 63) - 1
_RUNS = "key long, run long, more long, doc long, tie int, at long, n int, loops boolean"


def _batch(names: str, arrays) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [x.split() for x in names.split(", ")]
    return pa.record_batch([a if isinstance(a, pa.Array) else pa.array(a, kinds[k]) for a, (_, k) in zip(arrays, fields)], names=[n for n, _ in fields])


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)


def _merged(doc, tie, start, stop):
    """Ranges joined where they touch, per (doc, tie)."""
    order = np.lexsort((start, tie, doc))
    doc, tie, start, stop = doc[order], tie[order], start[order], stop[order]
    if not doc.size:
        return doc, tie, start, stop
    new = np.r_[True, (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1])]
    part = np.cumsum(new)
    wide = int(stop.max()) + 1  # shifting each document past the last makes one running maximum do for all
    reach = np.maximum.accumulate(stop + part * wide)
    first = np.r_[True, start[1:] + part[1:] * wide > reach[:-1]]
    at = np.flatnonzero(first)
    return doc[at], tie[at], start[at], reach[np.r_[at[1:] - 1, doc.size - 1]] - part[at] * wide


def _settle(rank, doc, tie, at):
    """For rows sorted by all, with a tuple of columns as rank: (rows that repeat an earlier equal row's run, distinct first rows)."""
    same_run = np.r_[False, np.logical_and.reduce([x[1:] == x[:-1] for x in rank])]
    same_row = np.r_[False, same_run[1:] & (doc[1:] == doc[:-1]) & (tie[1:] == tie[:-1]) & (at[1:] == at[:-1])]
    first = ~same_run
    # An equal row repeated is the first itself, as long as nothing else came between.
    led = np.flatnonzero(first)[np.cumsum(first) - 1] if first.size else np.zeros(0, dtype=np.int64)
    itself = (doc == doc[led]) & (tie == tie[led]) & (at == at[led])
    return same_run & ~itself & ~same_row, first


def _runs_of_texts(batches):
    """Rows of _RUNS for the runs that are first in their batch; ranges settled in the batch have n = 0, loops null and key = stop."""
    for batch in batches:
        if not batch.num_rows:
            continue
        found, row, part, size = [], 0, [], 0
        docs, ties = (np.asarray(batch.column(i)) for i in (0, 2))
        texts = text_bytes(batch)
        for i, raw in enumerate(texts):
            part.append(raw)
            size += len(raw)
            if size >= _PART or i == len(texts) - 1:
                r = window_runs(part)
                found.append((r[0] + row, *r[1:]))
                row, part, size = i + 1, [], 0
        text, at, n, key, run, more, loops = (np.concatenate(x) for x in zip(*found))
        doc, tie, key, run, more = docs[text], ties[text], _signed(key), _signed(run), _signed(more)
        order = np.lexsort((at, tie, doc, more, run, key))
        doc, tie, at, n, key, run, more, loops = (x[order] for x in (doc, tie, at, n, key, run, more, loops))
        again, first = _settle((key, run, more), doc, tie, at)
        yield _batch(_RUNS, (key[first], run[first], more[first], doc[first], tie[first], at[first], n[first], loops[first]))
        d, t, start, stop = _merged(doc[again], tie[again], at[again], at[again] + n[again] + (LENGTH - 1))
        none = pa.nulls(d.size, pa.bool_())
        zero = np.zeros(d.size, dtype=np.int64)
        yield _batch(_RUNS, (stop, zero, zero, d, t, start, np.zeros(d.size, dtype=np.int32), none))


_SETTLED = "doc long, tie int, start long, stop long, key long, runs int"


def _complete_groups(batches, columns: int):
    """Column tuples holding whole groups of the first column, from batches sorted by it."""
    held, held_key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [batch.column(i) for i in range(columns)]
        key = np.asarray(now[0])
        # The last group may go on in the next batch: everything before it is complete.
        other = np.flatnonzero(key != key[-1])
        last = int(other[-1]) + 1 if other.size else 0
        if held and (last or held_key != key[0]):
            held.append([c.slice(0, last) for c in now])
            yield [pa.concat_arrays([p[i] for p in held]) for i in range(columns)]
            held = []
        elif last:
            yield [c.slice(0, last) for c in now]
        held.append([c.slice(last) for c in now])
        held_key = key[-1]
    if held:
        yield [pa.concat_arrays([p[i] for p in held]) for i in range(columns)]


def _settle_runs(batches):
    """Rows of _RUNS sorted by rank, run and position -> ranges (runs = 0) and runs still to compare (runs > 0)."""
    for cols in _complete_groups(batches, 8):
        loops = cols[7].fill_null(False).to_numpy(zero_copy_only=False)
        key, run, more, doc, tie, at, n = (np.asarray(c) for c in cols[:7])
        ready = n == 0
        yield _batch(_SETTLED, (doc[ready], tie[ready], at[ready], key[ready], np.zeros(ready.sum(), dtype=np.int64), np.zeros(ready.sum(), dtype=np.int32)))
        key, run, more, doc, tie, at, n, loops = (x[~ready] for x in (key, run, more, doc, tie, at, n, loops))
        again, first = _settle((key, run, more), doc, tie, at)
        stop = at + n + (LENGTH - 1)
        group = np.cumsum(np.r_[True, key[1:] != key[:-1]]) - 1 if key.size else np.zeros(0, dtype=np.int64)
        runs = np.bincount(group, weights=first)[group].astype(np.int32) if key.size else np.zeros(0, dtype=np.int32)
        open_ = first & ((runs > 1) | loops)
        yield _batch(_SETTLED, tuple(np.r_[x[again], y[open_]] for x, y in (
            (doc, doc), (tie, tie), (at, at), (stop, stop), (np.zeros_like(key), key), (np.zeros_like(runs), runs))))


_PIECES = "key long, doc long, tie int, at long, n int, piece binary"


def _cut_pieces(batches):
    """Bytes of the runs still open; a run under a hot rank goes window by window, as digests that are first in the batch."""
    for batch in batches:
        rows, seen, settled = [], {}, []
        texts = text_bytes(batch)
        for doc, tie, raw, todo in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), texts, batch.column(3).to_pylist()):
            for x in todo:
                piece = raw[x["start"]:x["stop"]]
                if x["runs"] <= HOT:
                    rows.append((x["key"], doc, tie, x["start"], len(piece) - LENGTH + 1, piece))
                    continue
                for i in range(len(piece) - LENGTH + 1):
                    digest = xxhash.xxh3_128_digest(piece[i:i + LENGTH])
                    here, before = (doc, tie, x["start"] + i), seen.get(digest)
                    if before is None or here < before:
                        seen[digest] = here
                    if before is not None and before != here:
                        settled.append(max(here, before))
        for digest, (doc, tie, at) in seen.items():
            rows.append((int.from_bytes(digest[:8], "little", signed=True), doc, tie, at, 0, digest))
        rows += [(doc ^ at, doc, tie, at, 0, None) for doc, tie, at in settled]
        for at in range(0, len(rows), 20_000):
            yield _batch(_PIECES, tuple(zip(*rows[at:at + 20_000])))


_RANGES = "doc long, tie int, start long, stop long"


def _settle_windows(batches):
    """Pieces sorted by rank and position -> ranges of the windows that an earlier equal window has."""
    for key, doc, tie, at, n, piece in _complete_groups(batches, 6):
        key, doc, tie, at, n = (np.asarray(c) for c in (key, doc, tie, at, n))
        ready = np.asarray(piece.is_null())
        out = [(doc[ready], tie[ready], at[ready], at[ready] + LENGTH)]
        whole = np.flatnonzero((n > 0) & ~ready)
        single = np.flatnonzero((n == 0) & ~ready)
        if whole.size:
            lengths = n[whole].astype(np.int64)
            data = np.frombuffer(b"".join(piece.take(pa.array(whole)).to_pylist()), dtype=np.uint8)
            starts = np.cumsum(lengths + LENGTH - 1) - (lengths + LENGTH - 1)
            inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            value = Rolling(data).all(LENGTH)[np.repeat(starts, lengths) + inside]
            row = np.repeat(whole, lengths)
            out.append(_repeated(key[row], value, doc[row], tie[row], at[row] + inside))
        if single.size:
            digests = np.frombuffer(b"".join(piece.take(pa.array(single)).to_pylist()), dtype=np.uint64).reshape(-1, 2)
            out.append(_repeated(digests[:, 0], digests[:, 1], doc[single], tie[single], at[single]))
        yield _batch(_RANGES, _merged(*(np.concatenate(x) for x in zip(*out))))


def _repeated(key, value, doc, tie, at):
    order = np.lexsort((at, tie, doc, value, key))
    key, value, doc, tie, at = (x[order] for x in (key, value, doc, tie, at))
    again, _ = _settle((key, value), doc, tie, at)
    return doc[again], tie[again], at[again], at[again] + LENGTH


def _remove(digest: bool, batches):
    for part in text_chunks(batches):
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        for raw, gone in zip(text_bytes(part), part.column(2).to_pylist()):
            left, reach, spans = [], 0, 0
            for x in sorted((g["start"], g["stop"]) for g in gone or ()):
                if x[0] > reach or not spans:
                    left.append(raw[reach:x[0]])
                    spans += 1
                reach = max(reach, x[1])
            left.append(raw[reach:])
            rest = b"".join(left)
            n_bytes.append(len(raw))
            n_removed.append(len(raw) - len(rest))
            n_spans.append(spans)
            kept.append(hashlib.sha256(rest).hexdigest() if digest else rest)
        yield pa.record_batch([part.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()),
                               pa.array(kept, pa.string() if digest else pa.binary())],
                              names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256" if digest else "kept"])


def remove_repeats(docs: DataFrame, digest: bool = False) -> DataFrame:
    """Per document row: doc_id, n_bytes, n_removed, n_spans and the remaining bytes (``digest``: their SHA-256)."""
    df = doc_columns(docs).select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    df = df.select("doc", "text", F.pmod(F.xxhash64("text"), F.lit(1 << 31)).cast("int").alias("tie"))
    runs = df.mapInArrow(_runs_of_texts, _RUNS)
    ranked = runs.repartition("key").sortWithinPartitions("key", "run", "more", "doc", "tie", "at")
    settled = materialise(ranked.mapInArrow(_settle_runs, _SETTLED))
    todo = settled.filter("runs > 0").groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "stop", "key", "runs")).alias("todo"))
    pieces = df.join(todo, ["doc", "tie"]).select("doc", "text", "tie", "todo").mapInArrow(_cut_pieces, _PIECES)
    compared = pieces.repartition("key").sortWithinPartitions("key", "doc", "tie", "at").mapInArrow(_settle_windows, _RANGES)
    ranges = settled.filter("runs = 0").select("doc", "tie", "start", "stop").unionByName(compared)
    gone = ranges.groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "stop")).alias("gone"))
    doc_id = F.when(F.col("doc") != _NO_ID, F.col("doc")).alias("doc_id")
    joined = df.join(gone, ["doc", "tie"], "left").select(doc_id, "text", "gone")
    last = "kept_sha256 string" if digest else "kept binary"
    return joined.mapInArrow(lambda b: _remove(digest, b), f"doc_id long, n_bytes long, n_removed long, n_spans long, {last}")
