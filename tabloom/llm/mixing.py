"""Mixing sources to target weights by Pfair scheduling.

Each source is a task whose weight is its target share, and its documents form blocks. Block i
(from 1) of a source of weight w is released at slot floor((i-1)/w) and due by ceil(i/w); the
earliest deadline first among released blocks fills one slot after the other. Weights are the exact
ratios of the targets as whole numbers, never rounded to a period, so at every slot up to the end of
the mix each source is less than one block from its target share, however long the mix.

What has been placed before any slot t follows from the weights alone (``Schedule.done``): all
blocks due by t and, of those whose window holds t, the earliest deadlines that there was room for.
So tasks lay out ranges of slots independently of each other: no sequential pass over the corpus.

When a source has no blocks left its slots stay empty: the mix is exact up to the first such slot
(``in_mix``), later documents keep their order and are flagged, so that no row is dropped.

Defined results: documents of a source are ordered by a hash of doc_id and text; equal rows may
swap places among themselves; a null source is a source of its own; a source without a weight
gets weight 0: it follows the mix (slot null, ``in_mix`` false), as do blocks due past slot 2**63;
extra columns stay; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

BLOCK_DOCS = 16
#: Documents that one ranking task sorts, about, and buckets whose sizes one task adds up.
BUCKET_DOCS = 1_000
SPAN_BUCKETS = 4_096
#: Slots that a sweep runs on for one block, and as many more for every source.
FAR, FAR_SOURCE = 4_096, 16
_LAST = (1 << 63) - 1


def exact_weights(targets: dict) -> dict:
    """The ratios of the positive targets as whole numbers, without rounding."""
    live = {k: Fraction(v if isinstance(v, (int, Fraction)) else float(v)) for k, v in targets.items() if v and v > 0}
    scale = math.lcm(*(v.denominator for v in live.values()))
    whole = {k: int(v * scale) for k, v in live.items()}
    common = math.gcd(*whole.values())
    return {k: v // common for k, v in whole.items()}


def rounded_weights(targets: dict, parts: int) -> dict:
    """Largest-remainder rounding to ``parts`` parts, one at least for every positive weight."""
    live = {k: float(v) for k, v in targets.items() if v and v > 0}
    if not live:
        return {}
    if len(live) > parts:
        raise ValueError(f"{len(live)} weighted sources need more than {parts} parts")
    total = sum(live.values())
    exact = {k: v / total * parts for k, v in live.items()}
    out = {k: max(1, math.floor(v)) for k, v in exact.items()}
    order = sorted(live, key=lambda k: (out[k] - exact[k], str(k)))
    while sum(out.values()) < parts:
        for k in order[:parts - sum(out.values())]:
            out[k] += 1
    while sum(out.values()) > parts:
        k = max(out, key=lambda k: (out[k] - exact[k] if out[k] > 1 else -math.inf, str(k)))
        out[k] -= 1
    return out


class Schedule:
    """Earliest deadline first for whole-number weights; sources are numbered by name, which settles ties."""

    def __init__(self, weights: dict):
        self.names = sorted(weights, key=str)
        self.weights = [weights[s] for s in self.names]
        self.parts = sum(self.weights)
        self.number = {s: k for k, s in enumerate(self.names)}
        self.far = FAR + FAR_SOURCE * len(self.names)

    def release(self, k: int, j: int) -> int:
        return j * self.parts // self.weights[k]

    def due(self, k: int, j: int) -> int:
        return -(-(j + 1) * self.parts // self.weights[k])

    def done(self, t: int) -> list[int]:
        """Blocks of every source placed before slot t. A block that is due by t is among them. Of the
        others released before t (one a source at most) the earliest deadline goes first, as long as
        the blocks released at u or later fit the slots u to t, for every u; before the first release of
        the others there is room for all that are left to choose."""
        done = [w * t // self.parts for w in self.weights]
        others = [(self.due(k, j), k, self.release(k, j)) for k, j in enumerate(done) if self.weights[k] * t % self.parts]
        if not others:
            return done
        start = min(r for _, _, r in others)
        due = [j * self.parts // w for w, n in zip(self.weights, done) for j in range(-(-w * start // self.parts), n)]
        due = np.sort(np.array(due, dtype=np.int64))
        at = np.unique(np.r_[due, np.array([r for _, _, r in others], dtype=np.int64)])
        room = t - at - (due.size - np.searchsorted(due, at))
        left = t - sum(done)
        for _, k, r in sorted(others):
            if not left:
                break
            upto = int(np.searchsorted(at, r)) + 1
            if room[:upto].min() > 0:
                room[:upto] -= 1
                done[k] += 1
                left -= 1
        return done

    def sweep(self, start: int):
        """(source number, block, slot) of the slots from ``start`` on."""
        ready, waiting = [], [(self.release(k, j), k, j) for k, j in enumerate(self.done(start))]
        heapq.heapify(waiting)
        slot = start
        while True:
            while waiting and waiting[0][0] <= slot:
                _, k, j = heapq.heappop(waiting)
                heapq.heappush(ready, (self.due(k, j), k, j))
            _, k, j = heapq.heappop(ready)
            yield k, j, slot
            slot += 1
            heapq.heappush(waiting, (max(slot, self.release(k, j + 1)), k, j + 1))

    def slot(self, k: int, j: int) -> int:
        """The slot of one block, by bisection of its window."""
        low, high = self.release(k, j), self.due(k, j)
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (low, mid) if self.done(mid)[k] > j else (mid, high)
        return low

    def slots(self, blocks):
        """Slots of (source number, block) pairs that come by release: one sweep, begun anew after a
        gap; a block with a window of very many slots is looked for by bisection."""
        seen, run, now = {}, None, 0
        for k, j in blocks:
            release = self.release(k, j)
            if self.due(k, j) - release > self.far:
                yield self.slot(k, j)
                continue
            if run is None or release > now + self.far:
                run, seen = self.sweep(release), {}
            elif len(seen) > 4 * self.far:
                seen = {x: slot for x, slot in seen.items() if slot >= release}
            while (k, j) not in seen:
                a, b, now = next(run)
                seen[a, b] = now
            yield seen[k, j]


def period(weights: dict) -> list[tuple]:
    """(source, j, release, deadline, slot) of the blocks of the slots until every source has had exactly its share."""
    plan = Schedule(weights)
    return [(plan.names[k], j, plan.release(k, j), plan.due(k, j), slot) for (k, j, slot), _ in zip(plan.sweep(0), range(plan.parts))]


def temperature_targets(docs: DataFrame, alpha: float = 0.5) -> dict:
    """Weights that grow as a source's document count to the power ``alpha``. Sources are the named
    parts of a mixture: their table of weights is driver-sized by nature."""
    rows = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["source"]: r["n"] ** alpha for r in rows}


def mix_sources(docs: DataFrame, targets: dict, block_docs: int = BLOCK_DOCS, parts: int | None = None) -> DataFrame:
    """``docs`` with mix_block (0-based in its source), mix_release, mix_deadline, mix_slot, in_mix.
    ``parts``: follow the targets rounded to so many parts instead of the targets themselves."""
    weights = exact_weights(targets) if parts is None else rounded_weights(targets, parts)
    # A null source has the key None; keys are tagged so that it meets no real name.
    tag = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))
    tagged = {("n" if s is None else f"s{s}"): w for s, w in weights.items()}
    buckets = max(1, math.ceil(docs.count() / BUCKET_DOCS))
    order = F.xxhash64("doc_id", "text")
    df = docs.withColumns({"__mix_src": tag, "__mix_order": order}).withColumn("__mix_bucket", F.pmod("__mix_order", F.lit(buckets)))
    # Rank in the source = documents of earlier buckets + rank in the bucket: a hot source is as many buckets as it fills.
    sizes = materialise(df.groupBy("__mix_src", "__mix_bucket").agg(F.count(F.lit(1)).alias("__mix_n")))
    earlier = _documents_before(sizes)
    laid = materialise(_laid(earlier, sizes, tagged, block_docs))
    plan = F.sort_array(F.collect_list(F.struct("block", "r", "d", "s"))).alias("__mix_plan")  # some BUCKET_DOCS / block_docs entries
    plans = laid.filter("__mix_bucket IS NOT NULL").groupBy("__mix_src", "__mix_bucket").agg(plan)
    inside = F.row_number().over(Window.partitionBy("__mix_src", "__mix_bucket").orderBy("__mix_order", "doc_id")) - 1
    ranked = df.withColumn("__mix_rank", inside).join(earlier.join(plans, ["__mix_src", "__mix_bucket"], "left"), ["__mix_src", "__mix_bucket"])
    placed = ranked.withColumn("mix_block", F.floor((F.col("__mix_before") + F.col("__mix_rank")) / block_docs))
    at = F.get("__mix_plan", (F.col("mix_block") - F.floor(F.col("__mix_before") / block_docs)).cast("int"))
    placed = placed.withColumns({"mix_release": at["r"], "mix_deadline": at["d"], "mix_slot": at["s"]})
    # The first slot that some source can no longer fill: that of the block after its last.
    first = laid.filter("__mix_bucket IS NULL").agg(F.min("s")).first()[0]
    horizon = (_LAST if first is None else first) if weights else 0
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in _OUT]
    return placed.select(*kept, *_OUT[:-1], (F.coalesce(F.col("mix_slot"), F.lit(horizon)) < horizon).alias("in_mix"))


_OUT = ["mix_block", "mix_release", "mix_deadline", "mix_slot", "in_mix"]


def _documents_before(sizes: DataFrame) -> DataFrame:
    """For every bucket the documents of its source in earlier buckets: running sums inside spans of
    buckets, plus running sums over the spans."""
    spans = sizes.withColumn("__mix_span", F.floor(F.col("__mix_bucket") / SPAN_BUCKETS))
    totals = spans.groupBy("__mix_src", "__mix_span").agg(F.sum("__mix_n").alias("__mix_t"))
    outer = F.sum("__mix_t").over(Window.partitionBy("__mix_src").orderBy("__mix_span")) - F.col("__mix_t")
    inner = F.sum("__mix_n").over(Window.partitionBy("__mix_src", "__mix_span").orderBy("__mix_bucket")) - F.col("__mix_n")
    here = spans.withColumn("__mix_inner", inner).join(totals.withColumn("__mix_outer", outer), ["__mix_src", "__mix_span"])
    return here.select("__mix_src", "__mix_bucket", (F.col("__mix_outer") + F.col("__mix_inner")).alias("__mix_before"), "__mix_n")


_BLOCKS = "__mix_src string, __mix_bucket long, block long, r long, d long"


def _laid(earlier: DataFrame, sizes: DataFrame, weights: dict, block_docs: int) -> DataFrame:
    """Release, deadline and slot of the blocks of every bucket, and of the block after the last of each
    source (bucket null). Blocks are dealt to tasks by release."""
    plan = Schedule(weights)
    held = sizes.groupBy("__mix_src").agg(F.ceil(F.sum("__mix_n") / block_docs).alias("n"))
    sources = sizes.sparkSession.createDataFrame([(s,) for s in weights], "__mix_src string").join(held, "__mix_src", "left")
    after = sources.select("__mix_src", F.lit(None).cast("long"), F.coalesce("n", F.lit(0)) * block_docs, F.lit(1).cast("long"))
    buckets = earlier.select("__mix_src", "__mix_bucket", "__mix_before", "__mix_n").union(after)
    blocks = buckets.mapInArrow(lambda b: _blocks_of_buckets(plan, block_docs, b), _BLOCKS)
    dealt = blocks.repartitionByRange("r").sortWithinPartitions("r")
    return dealt.mapInArrow(lambda b: _slots_of_blocks(plan, b), _BLOCKS + ", s long")


def _blocks_of_buckets(plan: Schedule, block_docs: int, batches):
    for batch in batches:
        for src, bucket, before, n in zip(*(c.to_pylist() for c in batch.columns)):
            k = plan.number.get(src)
            if k is None:
                continue
            blocks = range(before // block_docs, (before + n - 1) // block_docs + 1)
            rows = [(src, bucket, j, plan.release(k, j), d) for j in blocks if (d := plan.due(k, j)) < _LAST]
            if rows:
                kinds = (pa.string(), *[pa.int64()] * 4)
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["__mix_src", "__mix_bucket", "block", "r", "d"])


def _slots_of_blocks(plan: Schedule, batches):
    asked = []  # the batches come one by one, the sweep goes on over them

    def blocks():
        for batch in batches:
            asked.append(batch)
            yield from zip(map(plan.number.get, batch.column(0).to_pylist()), batch.column(2).to_pylist())

    found = []
    for slot in plan.slots(blocks()):
        found.append(slot)
        while asked and not asked[0].num_rows:
            asked.pop(0)
        if len(found) == asked[0].num_rows:
            batch = asked.pop(0)
            yield pa.record_batch([*batch.columns, pa.array(found, pa.int64())], names=[*batch.schema.names, "s"])
            found = []
