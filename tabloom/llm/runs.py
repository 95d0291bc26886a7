"""Periodic runs of words, found by multi-scale minimizers.

A run is a stretch of words with smallest period q, at least ``max(6, 4 * q)`` words long, that no
neighbouring word extends. Words become integers; the documents of a chunk are laid end to end with
a separator of their own after each, so that one pass of array operations serves all of them.

* Periods up to ``SHORT`` are found by a direct scan at each lag.
* Scale s serves the periods q with 2**(s-1) < q <= 2**s by k-grams of k = 2**s words and windows of
  w = 2**(s-1) k-grams. Inside a run the window a period further on holds the same k-grams, and a run
  of four periods has room for both (q + k + w - 1 < 4 * q), so the minimum of a window and its copy
  q words on are both chosen. As k >= q, no copy is nearer. Hence every run shows at its scale a pair
  of neighbouring equal minimizers at distance q: these pairs are the seeds.
* A seed is extended to both sides word by word, kept if it is long enough and no smaller period
  fits (a smaller one would divide q, so the prime divisors tell).

The hashes only propose seeds; runs are confirmed on the words. Work is a few array operations for
every word and scale; scales that a document is too short for leave it out.

Defined results: null text has no words; a null id counts as no number to disturb the text by, and
stays null; empty tables give an empty result; repeated rows are rows of their own; extra columns are
ignored. The texts of a chunk are bounded by bytes; one text, however long, is one row and one chunk.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import doc_columns, mix64, text_bytes, text_chunks

#: Periods that are scanned lag by lag; a power of two.
SHORT = 16
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def least_length(period: int) -> int:
    return max(6, 4 * period)


def prime_divisors(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return out + [n] if n > 1 else out


def smallest(x: np.ndarray, start: int, period: int) -> bool:
    """No smaller period fits the stretch of at least two periods from ``start``."""
    head = x[start:start + period]
    return not any(np.array_equal(head, x[start + period // f:start + period + period // f]) for f in prime_divisors(period))


def _equal_after(x: np.ndarray, a: int, b: int) -> int:
    """Number of words that agree from ``a`` and from ``b`` on (a < b)."""
    n, step = 0, 64
    while (room := min(step, len(x) - b - n)) > 0:
        differ = x[a + n:a + n + room] != x[b + n:b + n + room]
        if differ.any():
            return n + int(differ.argmax())
        n, step = n + room, min(2 * step, 1 << 16)
    return n


def _equal_before(x: np.ndarray, a: int, b: int) -> int:
    """Number of words that agree before ``a`` and before ``b`` (a < b)."""
    n, step = 0, 64
    while (room := min(step, a - n)) > 0:
        differ = (x[a - n - room:a - n] != x[b - n - room:b - n])[::-1]
        if differ.any():
            return n + int(differ.argmax())
        n, step = n + room, min(2 * step, 1 << 16)
    return n


def short_runs(x: np.ndarray, lags: int = SHORT) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs with periods up to ``lags``."""
    out = []
    for q in range(1, min(lags, len(x) // 4) + 1):
        same = np.zeros(len(x) - q + 2, dtype=np.int8)
        same[1:-1] = x[q:] == x[:-q]
        edges = np.flatnonzero(np.diff(same))
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts + q >= least_length(q)
        out += [(s, e - s + q, q) for s, e in zip(starts[long].tolist(), ends[long].tolist()) if smallest(x, s, q)]
    return out


def scale_seeds(grams: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Position and distance of neighbouring equal minimizers: the leftmost minimum of each window of ``window``
    (a power of two) k-gram hashes, and the next chosen place with the same hash."""
    n = len(grams) - window + 1
    if n < 1:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    least, at = grams, np.arange(len(grams))
    step = 1
    while step < window:
        later = least[step:] < least[:-step]
        least, at = np.where(later, least[step:], least[:-step]), np.where(later, at[step:], at[:-step])
        step *= 2
    chosen = at[np.r_[True, at[1:] != at[:-1]]]  # leftmost minima never move back
    order = np.argsort(grams[chosen], kind="stable")
    p, h = chosen[order], grams[chosen][order]
    pair = h[1:] == h[:-1]
    return p[:-1][pair], (p[1:] - p[:-1])[pair]


def long_runs(x: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs with periods over SHORT. ``x`` holds documents by falling length; each
    ends, with its separator, at ``ends``."""
    out = []
    sizes = np.diff(np.r_[0, ends]) - 1
    grams, k = mix64(x.astype(np.uint64) + _PRIME), 1
    while k < 2 * SHORT:
        grams, k = mix64(grams[:-k] * _PRIME + grams[k:]) if len(grams) > k else grams[:0], 2 * k
    while True:
        fit = int(np.searchsorted(-sizes, -(2 * k + 4), side="right"))  # periods from k / 2 + 1 on
        if not fit:
            return out
        grams = grams[:ends[fit - 1] - k + 1]
        places, lags = scale_seeds(grams, k // 2)
        near = (lags > k // 2) & (lags <= k)
        places, lags = places[near], lags[near]
        order = np.lexsort((places, lags))
        q_before, end_before = 0, -1
        for p, q in zip(places[order].tolist(), lags[order].tolist()):
            if q == q_before and p < end_before:
                continue  # within the stretch that the last seed was extended to
            after = _equal_after(x, p, p + q)
            start = p - _equal_before(x, p, p + q)
            q_before, end_before = q, p + after
            length = p + after + q - start
            if length >= least_length(q) and smallest(x, start, q):
                out.append((start, length, q))
        grams, k = mix64(grams[:-k] * _PRIME + grams[k:]) if len(grams) > k else grams[:0], 2 * k


def periodic_runs(documents: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """For each document (an array of word numbers from 0) its runs by start, then period."""
    order = sorted(range(len(documents)), key=lambda i: -len(documents[i]))
    if not order:
        return []
    parts = []
    for place, i in enumerate(order):
        parts += [documents[i].astype(np.int64), np.array([-1 - place])]
    x = np.concatenate(parts)
    ends = np.cumsum([len(documents[i]) + 1 for i in order])
    found = short_runs(x) + long_runs(x, ends)
    starts = np.r_[0, ends]
    out: list[list] = [[] for _ in documents]
    for start, length, period in found:
        place = int(np.searchsorted(ends, start, side="right"))
        out[order[place]].append((start - int(starts[place]), length, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """False where any run holds the word after its first period."""
    cover = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    return np.cumsum(cover[:n]) == 0


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest exact length / period; ties: smallest start, then period."""
    best = None
    for run in runs:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which word stands at each place when the id's checksum asks for a periodic tail; None: the text as it is."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


_OUT = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
        "collapsed_sha256 string, n_words long, n_dropped long")


def _scan(rearrange: Callable | None, batches):
    for part in text_chunks(batches):
        ids = part.column(0).to_pylist()
        known: dict[bytes, int] = {}
        texts, numbers = [], []
        for doc_id, raw in zip(ids, text_bytes(part)):
            words = raw.split()  # bytes: the six ASCII spaces part words
            codes = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))
            at = rearrange(doc_id, len(words)) if rearrange else None
            texts.append((words, at))
            numbers.append(codes if at is None else codes[at])
        rows = []
        for doc_id, (words, at), runs in zip(ids, texts, periodic_runs(numbers)):
            if at is not None:
                words = [words[i] for i in at.tolist()]
            kept = kept_words(len(words), runs)
            left = words if kept.all() else [words[i] for i in np.flatnonzero(kept).tolist()]
            best = strongest(runs)
            said = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
            rows.append((doc_id, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
                         hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(b" ".join(left)).hexdigest(), len(words), len(words) - len(left)))
        names = [c.split()[0] for c in _OUT.split(", ")]
        kinds = [pa.string() if c.endswith("string") else pa.int64() for c in _OUT.split(", ")]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def periodic_run_table(docs: DataFrame, rearrange: Callable | None = None) -> DataFrame:
    """Per document: doc_id, n_runs, the strongest run (start, length, period, exponent_milli), digests of all runs
    and of the text without what runs repeat, n_words, n_dropped. ``rearrange`` (id, number of words -> places or
    None) may change which word stands where."""
    return doc_columns(docs).mapInArrow(lambda b: _scan(rearrange, b), _OUT)


def _spans(batches):
    for part in text_chunks(batches):
        ids, numbers, known = part.column(0).to_pylist(), [], {}
        for raw in text_bytes(part):
            words = raw.split()
            numbers.append(np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words)))
        rows = [(d, *run) for d, runs in zip(ids, periodic_runs(numbers)) for run in runs]
        yield pa.record_batch([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], names=["doc_id", "start", "length", "period"])


def run_spans(docs: DataFrame) -> DataFrame:
    """doc_id, start, length, period (in words): a row for every run."""
    return doc_columns(docs).mapInArrow(_spans, "doc_id long, start long, length long, period long")
