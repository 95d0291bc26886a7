"""SimHash near-duplicates by a self-join of a binary trie of fingerprints.

1. A fingerprint bit is 1 if more than half the document's shingle hashes (XXH64, seed 42) set it.
   Equal fingerprints become one entry.
2. Four differing bits leave one of five bit groups untouched. Five tries hold every entry, each
   with another group as its first levels; below the nodes of that group a pair may spend its whole
   error budget. These nodes are spread over the tasks.
3. A task walks pairs of nodes down together: a pair splits into its (at most four) child pairs, each
   adds the bit in which the children differ, and a pair beyond the budget is pruned. Small pairs are
   compared entry by entry. A union-find over the entries prunes pairs of nodes whose entries are all
   linked already, so a dense family does not cost its square; a spanning forest of the links comes
   back, never the pairs.
4. A node of more than ``CELL`` entries is first split in Spark, four levels at a time, into pairs of
   descendants within the budget, each a cell of its own: a family of any size is spread over tasks.
5. Components of the links give component_id; documents follow their fingerprint.

Defined results: no words or null text: fingerprint zero, linked like any other; fewer words than a
shingle: the whole sequence is the one shingle; rows that repeat a doc_id are documents of their own
under one name (each row gets the component of its own text); rows with a null id have a fingerprint
and a null component, and link nothing; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_columns, materialise, text_bytes, text_chunks
from .components import component_labels

BITS = 64
#: Differing bits allowed; one more group of bits than that.
ERRORS = 4
#: Entries under a node that one task may walk at once.
CELL = 1 << 20
#: Levels by which a larger node is split in Spark.
LEVELS = 4
#: Pairs of entries compared without walking further, and node pairs walked at once.
_DIRECT, _WALK = 128, 1 << 16
_SHINGLES = 1 << 15


# ------------------------------------------------------------------ fingerprints ---
def shingle_hashes(raw: bytes, size: int) -> np.ndarray:
    words = raw.lower().split()  # bytes: only A-Z change; the six ASCII spaces part words
    n = len(words) - size + 1
    if n < 1:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)] if words else [], dtype=np.uint64)
    said = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = np.r_[0, ends[:-1]]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(said[a:b], 42) for a, b in zip(starts[:n].tolist(), (ends[size - 1:] - 1).tolist())), dtype=np.uint64, count=n)


def majority(hashes: np.ndarray) -> int:
    """The bits set in more than half the hashes; zero without any."""
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), _SHINGLES):
        part = np.ascontiguousarray(hashes[at:at + _SHINGLES]).astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > len(hashes)).tolist())


def _sign(size: int, batches):
    for part in text_chunks(batches):
        prints = np.array([majority(shingle_hashes(raw, size)) for raw in text_bytes(part)], dtype=np.uint64)
        yield pa.record_batch([part.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])


# ------------------------------------------------------------------ walking a trie ---
class Linked:
    """Union-find over positions, by arrays; the smallest position leads."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self) -> np.ndarray:
        while not np.array_equal(up := self.up[self.up], self.up):
            self.up = up
        return self.up

    def join(self, i: np.ndarray, j: np.ndarray) -> bool:
        """Link pairs of positions; whether that joined anything."""
        some = False
        while True:
            up = self.roots()
            a, b = up[i], up[j]
            apart = a != b
            if not apart.any():
                return some
            some, i, j = True, i[apart], j[apart]
            np.minimum.at(self.up, np.maximum(a[apart], b[apart]), np.minimum(a[apart], b[apart]))


def _bit(keys: np.ndarray, level: int) -> np.ndarray:
    return (keys >> np.uint64(BITS - 1 - level)) & np.uint64(1)


def walk(keys: np.ndarray, pairs: np.ndarray, level: int, budget: int, linked: Linked) -> None:
    """Join in ``linked`` all entries of the node pairs whose keys differ in ``budget`` bits at most.

    ``keys``: rotated fingerprints, sorted inside every node. ``pairs``: rows (from, to, from, to, errors
    so far); a pair of a node with itself has the same span twice. ``level``: depth of the nodes.
    """
    zeros: dict[int, np.ndarray] = {}
    stack = [(level, pairs)]
    change, fresh = None, None
    while stack:
        depth, now = stack.pop()
        if len(now) > _WALK:
            stack += [(depth, now[_WALK:]), (depth, now[:_WALK])]
            continue
        if change is None:
            fresh = linked.roots()
            change = np.cumsum(np.r_[0, fresh[1:] != fresh[:-1]])
        a, b, c, d, spent = now.T
        settled = (fresh[a] == fresh[c]) & (change[b - 1] == change[a]) & (change[d - 1] == change[c])
        now = now[~settled & (spent <= budget)]
        a, b, c, d, spent = now.T
        few = (b - a) * (d - c) <= _DIRECT  # at the last level at most: a node holds one entry there
        if few.any():
            a1, c1, n2 = a[few], c[few], (d - c)[few]
            count = (b - a)[few] * n2
            owner = np.repeat(np.arange(len(a1)), count)
            inner = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            i, j = a1[owner] + inner // n2[owner], c1[owner] + inner % n2[owner]
            near = np.bitwise_count(keys[i] ^ keys[j]) <= budget
            near &= i != j
            if near.any() and linked.join(i[near], j[near]):
                change = None
            now = now[~few]
            a, b, c, d, spent = now.T
        if not len(now):
            continue
        if depth not in zeros:
            zeros[depth] = np.r_[0, np.cumsum(_bit(keys, depth) == 0)]
        z = zeros[depth]
        m, n = a + z[b] - z[a], c + z[d] - z[c]
        own = (a == c) & (b == d)
        apart = np.concatenate([np.c_[a, m, n, d, spent + 1], np.c_[m, b, c, n, spent + 1][~own]])
        alike = np.concatenate([np.c_[a, m, c, n, spent], np.c_[m, b, n, d, spent]])
        children = np.concatenate([alike, apart])  # pairs that agree are walked first: what they link prunes the others
        children = children[(children[:, 0] < children[:, 1]) & (children[:, 2] < children[:, 3]) & (children[:, 4] <= budget)]
        if len(children):
            stack.append((depth + 1, children))


def cell_links(keys: np.ndarray, cells: list[tuple[int, int, int, int]], budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (position, smallest position of its set) inside cells (from, middle, to, level): the entries from
    ``from`` to ``middle`` against those up to ``to``, or against themselves where middle equals to."""
    linked = Linked(len(keys))
    by_level: dict[int, list] = {}
    for start, middle, stop, level in cells:
        row = (start, stop, start, stop, 0) if middle == stop else (start, middle, middle, stop, None)
        if row[4] is None:
            shift = np.uint64(BITS - level)
            row = (*row[:4], int(np.bitwise_count((keys[start] >> shift) ^ (keys[middle] >> shift))) if level else 0)
        by_level.setdefault(level, []).append(row)
    for level, rows in by_level.items():
        pairs = np.array(rows, dtype=np.int64)
        large = pairs[(pairs[:, 1] - pairs[:, 0]) > 1024]
        if len(large):
            walk(keys, large, level, 1, linked)  # near neighbours first: they prune most of a dense family
        walk(keys, pairs, level, budget, linked)
    roots = linked.roots()
    moved = np.flatnonzero(roots != np.arange(len(roots)))
    return moved, roots[moved]


def _solve(budget: int, limit: int, batches):
    """Rows (trie, low, high, level, side, key, fp), sorted by the first six: each run of the first four is a cell."""
    held: list[pa.RecordBatch] = []

    def solve(table: pa.Table):
        cols = [table.column(i).to_numpy() for i in (0, 1, 2, 3, 4)]
        keys, names = table.column(5).to_numpy().astype(np.int64).view(np.uint64), table.column(6).to_numpy()
        keys = keys ^ np.uint64(1 << 63)  # they were sorted as signed numbers
        edge = np.zeros(len(keys), dtype=bool)
        for c in cols[:4]:
            edge[1:] |= c[1:] != c[:-1]
        starts = np.r_[0, np.flatnonzero(edge)]
        stops = np.r_[starts[1:], len(keys)]
        sides = np.r_[0, np.cumsum(cols[4])]
        second = sides[stops] - sides[starts]
        cells = []
        for start, stop, n, low, high, level in zip(starts.tolist(), stops.tolist(), second.tolist(), cols[1][starts].tolist(), cols[2][starts].tolist(), cols[3][starts].tolist()):
            if low == high:
                cells.append((start, stop, stop, level))
            elif n and start + n < stop:
                cells.append((start, stop - n, stop, level))
        i, j = cell_links(keys, cells, budget)
        return pa.record_batch([pa.array(names[i]), pa.array(names[j])], names=["a", "b"])

    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= limit:  # keep the last cell, it may go on
            table = pa.Table.from_batches(held)
            last = [table.column(i)[-1].as_py() for i in range(4)]
            tail = np.ones(rows, dtype=bool)
            for i in range(4):
                tail &= table.column(i).to_numpy() == last[i]
            cut = int(rows - np.argmin(tail[::-1])) if not tail.all() else 0
            if cut:
                yield solve(table.slice(0, cut))
                held, rows = table.slice(cut).combine_chunks().to_batches(), rows - cut
    if rows:
        yield solve(pa.Table.from_batches(held))


# ------------------------------------------------------------------ the join in Spark ---
def _groups(errors: int) -> list[tuple[int, int]]:
    """(first bit, number of bits) of the errors + 1 groups."""
    edges = [round(i * BITS / (errors + 1)) for i in range(errors + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _prefix(key: Column, level: Column) -> Column:
    """The first ``level`` bits of a key, as a number (at most 62 of them are asked for)."""
    return F.call_function("shiftrightunsigned", key, (F.lit(BITS) - level).cast("int"))


def tries(entries: DataFrame, errors: int = ERRORS) -> DataFrame:
    """(trie, level, node, key, fp) of every entry (``fp``) in each of the tries: the key is the fingerprint
    turned until the trie's group of bits comes first, the node its first ``level`` bits."""
    groups = F.array(*[F.struct(F.lit(i).alias("trie"), F.lit(a).alias("turn"), F.lit(n).alias("level")) for i, (a, n) in enumerate(_groups(errors))])
    df = entries.select("fp", F.explode(groups).alias("g"))
    left = F.call_function("shiftleft", F.col("fp"), F.col("g.turn"))
    right = F.call_function("shiftrightunsigned", F.col("fp"), (F.lit(BITS) - F.col("g.turn")).cast("int"))
    key = F.when(F.col("g.turn") == 0, F.col("fp")).otherwise(left.bitwiseOR(right))
    return df.select(F.col("g.trie").alias("trie"), F.col("g.level").alias("level"), key.alias("key"), "fp").withColumn("node", _prefix(F.col("key"), F.col("level")))


def cells(entries: DataFrame, errors: int = ERRORS, limit: int | None = None) -> DataFrame:
    """Rows (trie, low, high, level, side, key, fp): the entries of each cell, a node (low = high) or a pair of nodes.

    Nodes with more than ``limit`` entries are replaced by the pairs of their descendants ``LEVELS`` deeper that
    differ in no more than ``errors`` bits, until none is left.
    """
    limit = limit or CELL
    placed = tries(entries, errors)
    whole = placed.select("trie", F.col("node").alias("low"), F.col("node").alias("high"), "level", F.lit(0).alias("side"), "key", "fp")
    sizes = placed.groupBy("trie", "level", "node").agg(F.count(F.lit(1)).alias("n"))
    large = materialise(sizes.filter(F.col("n") > limit).select("trie", "level", "node"))
    if large.isEmpty():
        return whole
    out = whole.join(large.select("trie", "level", F.col("node").alias("low")), ["trie", "level", "low"], "left_anti").select(*whole.columns)
    # Entries under large nodes, and the pairs of nodes still to be split.
    under = materialise(placed.join(large, ["trie", "level", "node"], "left_semi").select("trie", "key", "fp"))
    pairs = large.select("trie", "level", F.col("node").alias("low"), F.col("node").alias("high"), F.lit(0).alias("spent"))
    span = 1 << LEVELS
    while not pairs.isEmpty():
        child = lambda c: F.explode(F.sequence(F.col(c) * span, F.col(c) * span + (span - 1)))
        deeper = (pairs.withColumn("level", F.col("level") + LEVELS).withColumn("l", child("low")).withColumn("h", child("high")).filter("low != high OR l <= h")
                  .withColumn("spent", F.bit_count(F.col("l").bitwiseXOR(F.col("h")))).filter(F.col("spent") <= errors).select("trie", "level", F.col("l").alias("low"), F.col("h").alias("high"), "spent"))
        deeper = materialise(deeper)
        levels = deeper.select("trie", "level").distinct()
        counts = materialise(under.join(levels, "trie").groupBy("trie", "level", _prefix(F.col("key"), F.col("level")).alias("node")).agg(F.count(F.lit(1)).alias("n")))
        here = lambda c: counts.select("trie", "level", F.col("node").alias(c), F.col("n").alias("n_" + c))
        met = materialise(deeper.join(here("low"), ["trie", "level", "low"]).join(here("high"), ["trie", "level", "high"]))
        # Pairs of full fingerprints (one entry a node) never pass the limit, so this ends.
        size = F.when(F.col("low") == F.col("high"), F.col("n_low")).otherwise(F.col("n_low") + F.col("n_high"))
        deep = F.col("level") + LEVELS <= BITS - 2
        done = met.filter((size <= limit) | ~deep).select("trie", "level", "low", "high")
        member = under.join(levels, "trie").withColumn("node", _prefix(F.col("key"), F.col("level")))
        first = member.join(done.withColumn("node", F.col("low")), ["trie", "level", "node"]).withColumn("side", F.lit(0))
        second = member.join(done.filter("low != high").withColumn("node", F.col("high")), ["trie", "level", "node"]).withColumn("side", F.lit(1))
        out = out.unionByName(first.unionByName(second).select(*whole.columns))
        pairs = materialise(met.filter((size > limit) & deep).select("trie", "level", "low", "high", "spent"))
    return out


def fingerprint_links(entries: DataFrame, errors: int = ERRORS, limit: int | None = None) -> DataFrame:
    """(a, b): links between distinct fingerprints (column ``fp``) that differ in ``errors`` bits at most; their
    components are those of all such pairs."""
    limit = limit or CELL
    dealt = cells(entries, errors, limit).withColumn("order", F.col("key").bitwiseXOR(F.lit(-(1 << 63)).cast("long")))
    # The turned sign bit makes them sort as unsigned numbers; the task turns it back.
    laid = dealt.repartition("trie", "low", "high", "level").sortWithinPartitions("trie", "low", "high", "level", "side", "order")
    rows = laid.select("trie", "low", "high", "level", "side", F.col("order").alias("key"), "fp")
    return rows.mapInArrow(lambda b: _solve(errors, limit, b), "a long, b long")


def simhash_groups(docs: DataFrame, words: int = 4, errors: int = ERRORS, limit: int | None = None) -> DataFrame:
    """Per document row: doc_id, fingerprint (16 hexadecimal digits), component_id, kept."""
    signed = materialise(doc_columns(docs).mapInArrow(lambda b: _sign(words, b), "doc_id long, fp long"))
    entries = materialise(signed.filter("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep")))
    labels = materialise(component_labels(fingerprint_links(entries.select("fp"), errors, limit)).toDF("fp", "root"))
    led = materialise(entries.join(labels, "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root")))
    least = led.groupBy("root").agg(F.min("rep").alias("component"))
    of_print = materialise(led.select("fp", "root").join(materialise(least), "root").select("fp", "component"))
    out = signed.join(of_print, "fp", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.col("component"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
