"""Benchmark decontamination with a distributed positional inverted index.

1. Index. A task takes texts by chunks of bounded size; each chunk becomes a segment, a row of a written table: for every
   word that the benchmark may have (a bitmap of fixed size tells) its positions, sorted; for every adjacent pair of words
   that the benchmark may have its number; and the documents' first positions. Documents are kept apart by gaps.
2. Benchmark. Items become windows in Spark, distinct ones once. Counts of the index tell each window's rarest adjacent pair
   (of one word: the word); windows with a pair that no text has end here.
3. Lookup. Windows meet the segments that hold their rarest pair by a join; nothing passes through the driver, and a
   segment sees only windows that have a chance in it, however large the benchmark.
4. Intersection. Beside its segment each window starts from the postings of the word that is rarest there, shifted by the
   word's offset, and intersects the shifted postings of its other words; what is left are exact phrase matches. An item
   without one in a text, but with the three words of a window that are rarest in the benchmark close together, is a
   proximity match (``n_near``: reported, never judged).

Words are compared by 64-bit hashes: a false match needs a collision of a benchmark word with another word between the
window's true neighbours.

Defined results: null or empty text has no words and is clean; an item without words matches nothing; repeated items count
once (item ids are a set); repeated rows give a row each; null item ids are ignored; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, doc_columns, materialise, mix64, text_bytes, text_chunks

WINDOW = 13
#: Proximity: the second and third rarest word of a window within this many words of the rarest.
NEAR = 26
#: Bits of the maps that tell which words and pairs the benchmark may have (2 MB each, at any size of the benchmark).
MAP_BITS = 24
_PRIME = np.uint64(0x9E3779B97F4A7C15)
#: Bytes that are no part of a word: 0-9, a-z and everything beyond ASCII are.
_TABLE = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(raw: bytes) -> list[bytes]:
    return raw.lower().translate(_TABLE).split()  # bytes: only A-Z change


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))  # faster than a look into a dictionary


def pair_hashes(h: np.ndarray) -> np.ndarray:
    return mix64(h[:-1] * _PRIME + h[1:])


# ------------------------------------------------------------------ benchmark -------
def _items(batches):
    for batch in batches:
        rows = []
        for item, raw in zip(batch.column(0).to_pylist(), text_bytes(batch)):
            words = words_of(raw)
            if words:
                h = word_hashes(words)
                rows.append((item, [w.decode() for w in words], h.view(np.int64), pair_hashes(h).view(np.int64)))
        kinds = [pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int64())]
        yield pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["item", "words", "hashes", "pairs"])


def _key(words: Column) -> Column:
    return F.unhex(F.md5(F.array_join(words, " ")))  # words hold no space


class Benchmark:
    """Tables of the benchmark: windows (key, hashes, pairs), triples (key, hashes) and who holds each (key, item)."""

    def __init__(self, benchmark: DataFrame, window: int):
        rows = benchmark.select(F.col("item_id").cast("long").alias("item"), F.col("text").cast("string").alias("text")).filter("item IS NOT NULL")
        self.items = items = materialise(rows.mapInArrow(_items, "item long, words array<string>, hashes array<bigint>, pairs array<bigint>"))
        size = F.least(F.size("words"), F.lit(window))
        starts = items.select("*", size.alias("n"), F.explode(F.sequence(F.lit(1), F.size("words") - size + 1)).alias("i"))
        pairs = F.when(F.col("n") > 1, F.slice("pairs", F.col("i"), F.greatest(F.col("n") - 1, F.lit(1)))).otherwise(F.array().cast("array<bigint>"))
        whole = materialise(starts.select("item", F.slice("words", F.col("i"), F.col("n")).alias("words"), F.slice("hashes", F.col("i"), F.col("n")).alias("hashes"), pairs.alias("pairs")).withColumn("key", _key(F.col("words"))))
        self.windows = materialise(whole.groupBy("key").agg(F.first("words").alias("words"), F.first("hashes").alias("hashes"), F.first("pairs").alias("pairs")))
        holders = whole.select("key", "item").distinct()
        # The three words of a window that are rarest in the benchmark.
        often = items.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        each = self.windows.select("key", F.explode(F.array_distinct(F.arrays_zip("words", "hashes"))).alias("w"))
        ranked = each.select("key", F.col("w.words").alias("word"), F.col("w.hashes").alias("hash")).join(often, "word")
        rare = ranked.groupBy("key").agg(F.slice(F.sort_array(F.collect_list(F.struct("n", "word", "hash"))), 1, 3).alias("r")).filter(F.size("r") == 3)  # a window's words
        triples = materialise(rare.select("key", _key(F.col("r.word")).alias("triple"), F.col("r.hash").alias("hashes")))
        self.holders = materialise(holders)
        self.near_holders = materialise(triples.select("key", "triple").join(self.holders, "key").select(F.col("triple").alias("key"), "item").distinct())
        self.triples = triples.groupBy(F.col("triple").alias("key")).agg(F.first("hashes").alias("hashes"))

    def bitmap(self, column: str) -> np.ndarray:
        """Which hashes occur, by their lowest bits: rows of 2**15 bits are made in Spark and come back whole (2 MB at most)."""
        bit = F.col("h").bitwiseAND(F.lit((1 << MAP_BITS) - 1))
        found = self.items.select(F.explode(column).alias("h")).select(F.shiftright(bit, 15).alias("row"), bit.bitwiseAND(F.lit((1 << 15) - 1)).alias("at"))
        out = np.zeros(1 << (MAP_BITS - 3), dtype=np.uint8)
        for r in found.groupBy("row").agg(F.call_function("bitmap_construct_agg", F.col("at")).alias("bits")).collect():
            bits = np.frombuffer(r["bits"], dtype=np.uint8)
            out[r["row"] << 12:(r["row"] << 12) + len(bits)] = bits
        return out


def _maybe(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & np.uint64((1 << MAP_BITS) - 1)
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


# ------------------------------------------------------------------ index -----------
_SEGMENT = ("shard long, docs array<bigint>, digests array<string>, n_words array<bigint>, first array<int>, length int, "
            "terms array<bigint>, counts array<int>, positions binary, pairs array<bigint>, pair_counts array<int>")
_KINDS = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32(),
          pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]


def _index(word_map: np.ndarray, pair_map: np.ndarray, chunk: int, batches):
    number = 0
    for part in text_chunks(batches, limit=chunk):
        hashes, first, n_words, pairs, at = [], [], [], [], 0
        for raw in text_bytes(part):
            h = word_hashes(words_of(raw))
            pairs.append(pair_hashes(h) if len(h) > 1 else h[:0])
            hashes.append(h)
            n_words.append(len(h))
            first.append(at)
            at += len(h) + NEAR + 1
        h, starts = np.concatenate(hashes), np.array(first)
        place = np.arange(len(h)) + np.repeat(starts - np.r_[0, np.cumsum(n_words)[:-1]].astype(np.int64), n_words)
        mine = _maybe(word_map, h)
        h, place = h[mine], place[mine]
        order = np.argsort(h, kind="stable")
        terms, counts = np.unique(h, return_counts=True)
        p = np.concatenate(pairs)
        pair_terms, pair_counts = np.unique(p[_maybe(pair_map, p)], return_counts=True)
        row = (TaskContext.get().partitionId() << 23 | number, part.column(0).to_pylist(), part.column(2).to_pylist(), n_words, first, at, terms.view(np.int64), counts.astype(np.int32),
               np.diff(place[order], prepend=0).astype("<i4").tobytes(), pair_terms.view(np.int64), pair_counts.astype(np.int32))
        number += 1
        yield pa.record_batch([pa.array([v], t) for v, t in zip(row, _KINDS)], names=[c.split()[0] for c in _SEGMENT.split(", ")])


class Postings:
    """A segment: positions of each word, sorted."""

    def __init__(self, terms: np.ndarray, counts: np.ndarray, positions: bytes, first: np.ndarray, length: int):
        self.terms, self.counts, self.first, self.length = terms, counts, first, length
        self.positions = np.cumsum(np.frombuffer(positions, dtype="<i4"), dtype=np.int64)
        self.starts = np.cumsum(counts) - counts
        self.edge = np.zeros(length + 1, dtype=np.int64)

    def lists(self, window: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Start and length of each word's postings; None where a word has none."""
        i = np.searchsorted(self.terms, window)
        if i.max() == len(self.terms) or (self.terms[i] != window).any():
            return None
        return self.starts[i], self.counts[i]

    def documents(self, at: np.ndarray) -> np.ndarray:
        return np.unique(np.searchsorted(self.first, at, side="right") - 1)


def match_window(index: Postings, window: np.ndarray) -> np.ndarray:
    """Start positions of the phrase: its words' postings shifted by their offsets, rarest first, intersected."""
    if (found := index.lists(window)) is None:
        return index.positions[:0]
    begin, size = found
    starts = None
    for offset in np.argsort(size, kind="stable").tolist():
        postings = index.positions[begin[offset]:begin[offset] + size[offset]]
        if starts is None:
            starts = postings - offset
            continue
        wanted = starts + offset
        starts = starts[postings.take(postings.searchsorted(wanted), mode="clip") == wanted]
        if not starts.size:
            break
    return starts


def match_near(index: Postings, triple: np.ndarray, within: int = NEAR) -> np.ndarray:
    """Positions of the first word that have both others within ``within`` words."""
    if (found := index.lists(triple)) is None:
        return index.positions[:0]
    first, *others = (index.positions[a:a + n] for a, n in zip(*found))
    for postings in others:
        i = postings.searchsorted(first - within)  # the next one from there on, if there is any
        first = first[(i < postings.size) & (postings.take(i, mode="clip") <= first + within)]
    return first


def _match(batches):
    """Rows (shard, kind, key, hashes, first, length, terms, counts, positions), sorted by the first two: a segment (kind 0),
    then the phrases (1) and triples (2) to look for in it. Gives (row, kind, key, n_hit): what was found, and per document
    the words inside any phrase (kind 0)."""
    index, shard = None, None

    def table(rows):
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.int64()]
        return pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["row", "kind", "key", "n_hit"])

    def covered():
        at = np.flatnonzero(np.cumsum(index.edge[:-1]) > 0)
        docs, n = np.unique(np.searchsorted(index.first, at, side="right") - 1, return_counts=True)
        return [(shard << 20 | int(d), 0, None, int(c)) for d, c in zip(docs, n)]

    for batch in batches:
        rows = []
        asked = batch.column(3)
        flat, edges = asked.values.to_numpy(zero_copy_only=False).view(np.uint64), asked.offsets.to_numpy()
        columns = (batch.column(c).to_pylist() for c in range(3))
        for i, (s, kind, key) in enumerate(zip(*columns)):
            if kind == 0:
                if index is not None:
                    rows += covered()
                values = [batch.column(c)[i] for c in range(4, 9)]
                first, terms, counts = (np.array(values[j].values.to_numpy(zero_copy_only=False)) for j in (0, 2, 3))
                index, shard = Postings(terms.astype(np.int64).view(np.uint64), counts.astype(np.int64), values[4].as_py(), first, values[1].as_py()), s
                continue
            hashes = flat[edges[i]:edges[i + 1]]
            found = match_window(index, hashes) if kind == 1 else match_near(index, hashes)
            if found.size:
                if kind == 1:
                    np.add.at(index.edge, found, 1)
                    np.add.at(index.edge, found + len(hashes), -1)
                rows += [(s << 20 | int(d), kind, key, None) for d in index.documents(found)]
        yield table(rows)
    if index is not None:
        yield table(covered())


# ------------------------------------------------------------------ judging ---------
def _lookups(bench: Benchmark, segments: DataFrame) -> DataFrame:
    """(shard, kind, key, hashes): the windows and triples that a segment may hold."""
    terms = segments.select("shard", F.explode(F.arrays_zip("terms", "counts")).alias("t")).select("shard", F.col("t.terms").alias("term"), F.col("t.counts").alias("n"))
    pairs = segments.select("shard", F.explode(F.arrays_zip("pairs", "pair_counts")).alias("t")).select("shard", F.col("t.pairs").alias("term"), F.col("t.pair_counts").alias("n"))
    often = materialise(pairs.groupBy("term").agg(F.sum("n").alias("n")))
    # A window of several words is looked up by its rarest pair; one whose pair no text has cannot occur.
    asked = bench.windows.select("key", F.explode("pairs").alias("term")).join(often, "term", "left")
    rarest = asked.groupBy("key").agg(F.min_by("term", "n").alias("term"), F.max(F.col("n").isNull()).alias("absent")).filter("NOT absent").select("key", "term")
    phrases = materialise(bench.windows.join(rarest, "key").select("term", "key", "hashes"))
    single = bench.windows.filter(F.size("hashes") == 1).select(F.col("hashes")[0].alias("term"), F.lit(1).alias("kind"), "key", "hashes")
    triples = bench.triples.select(F.col("hashes")[0].alias("term"), F.lit(2).alias("kind"), "key", "hashes")
    by_word = materialise(single.unionByName(triples))
    return (pairs.join(phrases, "term").select("shard", F.lit(1).alias("kind"), "key", "hashes")
            .unionByName(terms.join(by_word, "term").select("shard", "kind", "key", "hashes")))


def _judged(docs: DataFrame, benchmark: DataFrame, window: int, share: int, chunk: int) -> DataFrame:
    bench = Benchmark(benchmark, window)
    words, pairs = bench.bitmap("hashes"), bench.bitmap("pairs")
    df = doc_columns(docs).withColumn("digest", F.md5(F.coalesce("text", F.lit(""))))
    segments = materialise(df.mapInArrow(lambda b: _index(words, pairs, chunk, b), _SEGMENT))
    own = segments.select("shard", F.lit(0).alias("kind"), F.lit(None).cast("binary").alias("key"), F.lit(None).cast("array<bigint>").alias("hashes"), "first", "length", "terms", "counts", "positions")
    found = _lookups(bench, segments).select("shard", "kind", "key", "hashes", *[F.lit(None).cast(own.schema[c].dataType).alias(c) for c in ("first", "length", "terms", "counts", "positions")])
    laid = own.unionByName(found).repartition("shard").sortWithinPartitions("shard", "kind")
    out = materialise(laid.mapInArrow(_match, "row long, kind int, key binary, n_hit long"))
    exact = materialise(out.filter("kind = 1").join(bench.holders, "key").select("row", "item").distinct())
    near = out.filter("kind = 2").join(bench.near_holders, "key").select("row", "item").distinct().join(exact, ["row", "item"], "left_anti")
    items = exact.groupBy("row").agg(F.count(F.lit(1)).alias("n_items"), F.sha2(F.array_join(F.array_sort(F.collect_list(F.col("item").cast("string"))), ",").cast("binary"), 256).alias("sha"))
    rows = segments.select("shard", F.posexplode(F.arrays_zip("docs", "digests", "n_words")).alias("i", "d"))
    rows = rows.select(F.shiftleft("shard", 20).bitwiseOR(F.col("i").cast("long")).alias("row"), F.col("d.docs").alias("doc_id"), F.col("d.digests").alias("digest"), F.col("d.n_words").alias("n_words"))
    joined = (rows.join(out.filter("kind = 0").select("row", "n_hit"), "row", "left").join(items, "row", "left")
              .join(near.groupBy("row").agg(F.count(F.lit(1)).alias("n_near")), "row", "left").fillna(0, ["n_hit", "n_items", "n_near"]))
    return joined.select("doc_id", "n_words", "n_hit", "n_items", F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
                         ((F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "n_near", "digest")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20, chunk: int = CHUNK_BYTES) -> DataFrame:
    """Per document row: words, words inside an occurrence of a benchmark window, the items with such windows, and whether
    the document counts as contaminated (``share`` * n_hit >= n_words). ``chunk``: bytes of text in a segment."""
    return _judged(docs, benchmark, window, share, chunk).drop("digest")


def uncontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20, chunk: int = CHUNK_BYTES) -> DataFrame:
    """The rows of ``docs`` that are not contaminated. What holds for a text holds for its copies, so rows meet the digests of
    contaminated texts."""
    bad = materialise(_judged(docs, benchmark, window, share, chunk).filter("contaminated").select(F.col("digest").alias("__digest")).distinct())
    return docs.join(bad, F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))) == F.col("__digest"), "left_anti")
