"""Near-duplicate documents by min-max hashing of word shingles.

1. A task takes each document's distinct shingles (64-bit hashes) and hashes them under
   ``PERMUTATIONS`` functions, keeping the minimum and the maximum of each: two signature values for
   one evaluation. The values are banded. Documents with equal sets become one class.
2. Class representatives that share a band key with others are linked to the key's smallest
   representative (no pairs inside a bucket); the components of these links are families.
3. Every family is joined exactly on full sets. In a large one, members are first compared with a few
   candidates for its hub; those linked with the candidate that has most links are one component
   already and need not meet each other. The rest meets all: blocks by set size, hash and that
   distinction, and each pair of blocks that can hold a missing link is solved by itself: shared
   shingles are counted through postings, and a spanning forest of the confirmed links comes back.
   So a family's members are copied for the blocks of its rest, not for all its blocks.
4. Components of the confirmed links give component_id; copies follow their class.

Two documents at similarity s share a band with probability 1 - (1 - s**ROWS)**BANDS; at 0.8 one in
300,000 is missed. As families join through any member, a missed pair still meets in its family.

Defined results: no words or null text: an empty set, linked with nothing, its own component; fewer
words than a shingle: the whole sequence is the one shingle; rows that repeat a doc_id are documents
of their own under one name (two texts of one id that both lead their class count as linked); null
ids give null components and are kept; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rank import top_k_per_group
from .common import doc_columns, materialise, mix64, text_bytes, text_chunks
from .components import component_labels

PERMUTATIONS = 80
ROWS = 5
BANDS = 2 * PERMUTATIONS // ROWS
#: Members of a block of a family.
BLOCK = 512
#: Members of a large family that are tried as its hub; the choice changes the work, not the result.
HUBS = 8
#: Postings read at once, at most.
_POSTINGS = 1 << 21
#: Parts that a large family's members are dealt to while they are placed in blocks.
_SALTS = 64
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20240229)
_FACTORS = _rng.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)


class Shingler:
    """Distinct shingle hashes of a text; remembers the hashes of words it has met (up to a bound)."""

    def __init__(self, size: int, remember: int = 200_000):
        self.size, self.remember, self.known = size, remember, {}

    def __call__(self, raw: bytes) -> np.ndarray:
        words = raw.lower().split()  # bytes: only A-Z change; the six ASCII spaces part words
        if not words:
            return np.zeros(0, dtype=np.uint64)
        known = self.known
        if len(known) > self.remember:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        size = min(self.size, len(words))
        out = np.zeros(len(words) - size + 1, dtype=np.uint64)
        for i in range(size):
            out = mix64(out * _PRIME + h[i:len(words) - size + 1 + i] + np.uint64(size))
        return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum and maximum under each permutation: 2 * PERMUTATIONS values."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
    high = np.zeros(PERMUTATIONS, dtype=np.uint64)
    for at in range(0, len(shingles), 2048):
        values = shingles[None, at:at + 2048] * _FACTORS[:, None] + _SHIFTS[:, None]
        values ^= values >> np.uint64(32)
        values *= _PRIME
        low, high = np.minimum(low, values.min(axis=1)), np.maximum(high, values.max(axis=1))
    return np.r_[low, high]


def bands(sig: np.ndarray) -> np.ndarray:
    out = np.arange(BANDS, dtype=np.uint64)
    # Row r of band b takes value r * BANDS + b: a band never holds both ends of one permutation.
    for row in sig.reshape(ROWS, BANDS):
        out = mix64(out * _PRIME + row)
    return out


def _sign(size: int, batches):
    shingle = Shingler(size)
    for part in text_chunks(batches):
        n, key, band = [], [], []
        for raw in text_bytes(part):
            s = shingle(raw)
            n.append(len(s))
            key.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            band.append(bands(signature(s)).view(np.int64) if len(s) else None)
        yield pa.record_batch([part.column(0), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(band, pa.list_(pa.int64()))], names=["doc_id", "n", "key", "bands"])


def _sets(size: int, batches):
    shingle = Shingler(size)
    for part in text_chunks(batches):
        yield pa.record_batch([part.column(0), *part.columns[2:], pa.array([shingle(raw).tobytes() for raw in text_bytes(part)], pa.binary())],
                              names=["rep", *part.schema.names[2:], "shingles"])


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def confirmed_links(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs with 100 * intersection >= percent * union; ``right`` None: inside
    ``left``. Positions of ``right`` follow those of ``left``."""
    sets = left + (right or [])
    sizes = np.array([len(s) for s in sets])
    if len(sets) == 2:  # the usual family
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(0, 1)] if 100 * both >= percent * (sizes.sum() - both) else []
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, term = np.unique(flat, return_inverse=True)
    often = np.bincount(term)[term] > 1
    term, owner = term[often], owner[often]
    order = np.argsort(term, kind="stable")  # postings: owners by shingle
    posted = owner[order]
    counts = np.bincount(term)
    starts = np.cumsum(counts) - counts
    ends = np.searchsorted(owner, np.arange(len(sets) + 1))
    forest, out = Forest(len(sets)), []
    first = 0 if right is None else len(left)
    step = max(1, _POSTINGS // len(sets))
    for i in range(len(left)):
        mine = term[ends[i]:ends[i + 1]]
        if not mine.size:
            continue
        shared = np.zeros(len(sets), dtype=np.int64)
        for at in range(0, mine.size, step):
            some = mine[at:at + step]
            spans = counts[some]
            shared += np.bincount(posted[np.repeat(starts[some] - np.r_[0, np.cumsum(spans)[:-1]], spans) + np.arange(spans.sum())], minlength=len(sets))
        ok = 100 * shared >= percent * (sizes[i] + sizes - shared)
        ok[:max(first, i + 1)] = False
        for j in np.flatnonzero(ok):
            if forest.join(i, int(j)):
                out.append((i, int(j)))
    return out


def _join_blocks(percent: int, batches):
    """Rows (family, lo, hi, block, rep, shingles) sorted by the first three: each run is a pair of blocks."""
    def solve(run):
        one, two = ([r for r in run if r[3] == b] for b in run[0][1:3])
        sets = lambda rows: [np.frombuffer(r[5], dtype=np.uint64) for r in rows]
        if run[0][1] == run[0][2]:
            names, links = [r[4] for r in one], confirmed_links(sets(one), None, percent)
        else:
            names = [r[4] for r in one + two]
            links = confirmed_links(sets(one), sets(two), percent) if one and two else []
        return [(names[i], names[j]) for i, j in links]

    def table(links):
        return pa.record_batch([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], names=["a", "b"])

    run: list = []
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part, links = batch.slice(at, 256), []
            for row in zip(*(c.to_pylist() for c in part.columns)):
                if run and run[0][:3] != row[:3]:
                    links += solve(run)
                    run = []
                run.append(row)
            yield table(links)
    yield table(solve(run) if run else [])


def _salted(members: DataFrame) -> DataFrame:
    return members.withColumn("salt", F.pmod(F.xxhash64("member"), F.lit(_SALTS)).cast("int"))


def _every_salt():
    return F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt")


def _hub_links(percent: int, batches):
    """Rows (family, salt, place, member, shingles) sorted by the first three, the hub candidates (places under HUBS) before
    the members: the candidates that each member is linked with, as a bit mask."""
    at, hubs = None, []
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            names, masks = [], []
            for family, salt, place, member, raw in zip(*(c.to_pylist() for c in batch.slice(start, 256).columns)):
                if (family, salt) != at:
                    at, hubs = (family, salt), []
                own = np.frombuffer(raw, dtype=np.uint64)
                if place < HUBS:
                    hubs += [(place, own)] if own.size else []
                    continue
                mask = 0
                for bit, hub in hubs if own.size else ():
                    if 100 * min(own.size, hub.size) >= percent * max(own.size, hub.size):
                        both = int(np.count_nonzero(hub[np.minimum(np.searchsorted(hub, own), hub.size - 1)] == own))
                        if 100 * both >= percent * (own.size + hub.size - both):
                            mask |= 1 << bit
                names.append((member, family))
                masks.append(mask)
            yield pa.record_batch([pa.array([m for m, _ in names], pa.int64()), pa.array([f for _, f in names], pa.int64()), pa.array(masks, pa.int32())],
                                  names=["member", "family", "mask"])


def _stars(df: DataFrame, members: DataFrame, words: int, percent: int) -> DataFrame:
    """(member, family, hub) for the members of large families that are linked with the hub of their family, which is the
    candidate with most links (ties: the first). Of two texts under one name, one that is linked is enough."""
    size = members.groupBy("family").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > BLOCK)
    # Large families are one in BLOCK members at most: they go to every salt, so that no task meets a whole family.
    large = _salted(members).join(size.select("family", _every_salt()), ["family", "salt"], "left_semi")
    large = materialise(large.select("member", "family", "salt"))
    tried = materialise(top_k_per_group(large, ["family"], [F.xxhash64("member"), F.col("member")], HUBS, "place").select("member", "family", (F.col("place") - 1).alias("place")))
    rows = materialise(large.withColumn("place", F.lit(HUBS)).unionByName(tried.select("member", "family", _every_salt(), "place")))
    texts = df.select("doc_id", "text").join(rows.withColumnRenamed("member", "doc_id"), "doc_id").select("doc_id", "text", "family", "salt", "place")
    sets = texts.mapInArrow(lambda b: _sets(words, b), "rep long, family long, salt int, place int, shingles binary").select("family", "salt", "place", F.col("rep").alias("member"), "shingles")
    dealt = sets.repartition("family", "salt").sortWithinPartitions("family", "salt", "place", "member")
    masks = dealt.mapInArrow(lambda b: _hub_links(percent, b), "member long, family long, mask int")
    masks = materialise(_salted(masks.groupBy("member", "family").agg(F.bit_or("mask").alias("mask"))))
    linked = lambda place: F.getbit("mask", place) == 1
    bits = F.filter(F.sequence(F.lit(0), F.lit(HUBS - 1)), linked)
    most = masks.select("family", F.explode(bits).alias("place")).groupBy("family", "place").agg(F.count(F.lit(1)).alias("c"))
    best = most.groupBy("family").agg(F.max_by("place", F.struct("c", -F.col("place"))).alias("place"))
    hubs = materialise(best.join(tried.withColumnRenamed("member", "hub"), ["family", "place"]))
    return masks.join(hubs.select("family", "place", "hub", _every_salt()), ["family", "salt"]).filter(linked(F.col("place"))).select("member", "family", "hub")


def _pairs_of_blocks(members: DataFrame, percent: int) -> DataFrame:
    """``members`` (member, family, n, star) with ``block`` and ``meets``: the (lo, hi) pairs of blocks each row takes part in.

    A family of up to BLOCK members is one block. A larger one is cut into classes by set size, so
    wide that only equal or neighbouring classes can hold a link, and each class into blocks by hash, stars apart from
    the rest: two blocks of stars do not meet.
    """
    width = 100.0 / percent * 1.01
    size = members.groupBy("family").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > BLOCK)
    salted = _salted(members).withColumn("kind", 2 * F.floor(F.log("n") / F.log(F.lit(width))).cast("long") + F.col("star").cast("long"))
    # Sizes of the kinds of large families; the count by salt is merged per kind, a row a salt.
    large = salted.join(size.select("family", _every_salt()), ["family", "salt"], "left_semi")
    counts = large.groupBy("family", "kind").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("here"))
    near = counts.groupBy("family").agg(F.map_from_entries(F.collect_list(F.struct("kind", "here"))).alias("blocks"))  # two entries a size class
    df = salted.join(near.select("family", "blocks", _every_salt()), ["family", "salt"], "left")
    alone = F.create_map(F.lit(0).cast("long"), F.lit(1).cast("long"))
    df = df.withColumns({"kind": F.when(F.col("blocks").isNull(), F.lit(0).cast("long")).otherwise(F.col("kind")), "blocks": F.coalesce("blocks", alone)})
    span = lambda k: F.coalesce(F.try_element_at("blocks", k), F.lit(0))
    number = lambda k, i: k * (1 << 24) + i
    df = df.withColumn("sub", F.pmod(F.xxhash64("member"), span(F.col("kind")))).withColumn("block", number(F.col("kind"), F.col("sub")))
    star = F.col("kind") % 2

    def meet(step, other_star):
        k = F.col("kind") - star + 2 * step + other_star
        other = F.when((span(k) > 0) & (star + other_star < 2), F.sequence(F.lit(0).cast("long"), span(k) - 1)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(other, lambda j: F.struct(F.least(number(k, j), F.col("block")).alias("lo"), F.greatest(number(k, j), F.col("block")).alias("hi")))

    met = F.concat(*[meet(step, other) for step in (0, -1, 1) for other in (0, 1)])
    return df.select("member", "family", "block", met.alias("meets")).filter(F.size("meets") > 0)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Per document row: doc_id, n_shingles, component_id (smallest doc_id reachable), kept."""
    df = doc_columns(docs)
    signed = materialise(df.mapInArrow(lambda b: _sign(words, b), "doc_id long, n long, key binary, bands array<bigint>"))
    named = signed.filter("n > 0 AND doc_id IS NOT NULL")
    classes = materialise(named.groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n")))
    # Representatives that share a band key hang on the smallest of them. A class has one row of bands for every map task.
    keys = named.groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")).select("rep", F.posexplode("bands").alias("band", "value"))
    buckets = keys.groupBy("band", "value").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    edges = keys.join(buckets, ["band", "value"]).filter("rep != hub").select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    families = component_labels(edges)
    members = families.union(families.select("b", "b").distinct()).toDF("member", "family")
    members = materialise(members.join(classes.groupBy("rep").agg(F.max("n").alias("n")).withColumnRenamed("rep", "member"), "member"))
    stars = materialise(_stars(df, members, words, percent))
    known = stars.select("member", F.lit(True).alias("star"))
    placed = materialise(_pairs_of_blocks(members.join(known, "member", "left").fillna(False, ["star"]), percent))
    # Full sets of the families' members, of the texts that lead their class.
    # A table of all members has no bound, so it is never sent to every task: the texts meet it by shuffle at every size.
    texts = df.join(placed.select(F.col("member").alias("doc_id"), "family", "block", "meets").hint("merge"), "doc_id")
    sets = texts.mapInArrow(lambda b: _sets(words, b), "rep long, family long, block long, meets array<struct<lo:bigint,hi:bigint>>, shingles binary")
    met = sets.select("rep", "family", "block", "shingles", F.explode("meets").alias("m")).select("family", "m.lo", "m.hi", "block", "rep", "shingles")
    dealt = met.repartition("family", "lo", "hi").sortWithinPartitions("family", "lo", "hi", "rep")
    links = dealt.mapInArrow(lambda b: _join_blocks(percent, b), "a long, b long")
    links = links.unionByName(stars.filter("member != hub").select(F.col("member").alias("a"), F.col("hub").alias("b")))
    labels = component_labels(links).toDF("rep", "label")
    of_class = classes.select("key", "rep").join(labels, "rep", "left").select("key", F.coalesce("label", "rep").alias("component"))
    out = signed.select("doc_id", "n", "key").join(of_class, "key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
