"""Global ranks and running aggregates without a one-partition window (pattern B5).

``ordered_scan`` range-partitions rows on (group keys, order keys), sorts inside each
partition and checkpoints that layout to the shared folder. Pass 1 reads one summary
row per partition (first/last group key and the tail aggregate of the last group);
the driver folds those few rows into per-partition carries; pass 2 adds the carry to
local running counts/sums/maxima. Work and memory per task stay bounded by the
partition size, also when one group holds a third of all rows: a hot group simply
spans several range partitions and is stitched together by the carries.
"""

from __future__ import annotations

import json
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

_RANGE, _KEY = "__range", "__key"
OrderSpec = list  # list of (column name, ascending: bool)


def _sort_exprs(by: list[str], order: OrderSpec) -> list[Column]:
    exprs = [F.col(c).asc() for c in by]
    for c, asc in order:
        exprs.append(F.col(c).asc() if asc else F.col(c).desc())
    return exprs


def group_key(df: DataFrame, by: list[str]) -> Column:
    """A text that two rows share exactly if Spark groups them together: every value with its length, a null
    apart from any text, -0.0 as 0.0. Made in Spark, before pandas can turn whole numbers beside a null into floats."""
    parts = []
    for c in by:
        kind = df.schema[c].dataType
        v = F.col(f"`{c}`")
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            v = F.when(v == 0, F.lit(0.0).cast(kind)).otherwise(v)
        elif isinstance(kind, T.BinaryType):
            v = F.hex(v)
        elif isinstance(kind, (T.StructType, T.ArrayType)):
            v = F.to_json(F.struct(v.alias("v")), {"ignoreNullFields": "false"})
        v = v.cast("string")
        parts.append(F.when(F.col(f"`{c}`").isNull(), F.lit("n;")).otherwise(F.concat(F.length(v).cast("string"), F.lit(":"), v, F.lit(";"))))
    return F.concat(*parts) if parts else F.lit("")


def _one_range_each(batches):
    """Record batches cut where the range of the rows changes, with the range."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ranges = batch.column(batch.schema.get_field_index(_RANGE)).to_numpy()
        edges = np.flatnonzero(np.diff(ranges)) + 1
        for lo, hi in zip([0, *edges], [*edges, len(ranges)]):
            yield int(ranges[lo]), batch.slice(lo, hi - lo)


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _floats(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A column as doubles, null as NaN."""
    return _column(batch, name).cast(pa.float64()).to_numpy(zero_copy_only=False)


def _starts(keys: pa.Array) -> np.ndarray:
    """Where a run of equal keys starts."""
    differ = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)
    return np.r_[0, np.flatnonzero(differ) + 1]


def lay_out(df: DataFrame, order: OrderSpec, by: list[str], num_partitions: int | None = None) -> DataFrame:
    """The rows sorted by (``by``, ``order``), cut into ranges and checkpointed, with the number of their range and
    the text of their group key. The range stays with the row: later unions or coalesces cannot mix up the ranges."""
    exprs = _sort_exprs(by, order)
    # Without a given number Spark joins small neighbouring ranges at run time.
    ranged = df.repartitionByRange(num_partitions, *exprs) if num_partitions else df.repartitionByRange(*exprs)
    return cut_lineage(ranged.sortWithinPartitions(*exprs).withColumns({_RANGE: F.spark_partition_id(), _KEY: group_key(df, by)}))


def ordered_scan(df: DataFrame, order: OrderSpec, by: list[str] | None = None,
                 sums: list[str] = (), maxes: list[str] = (), rank_col: str = "rank",
                 num_partitions: int | None = None, leads: list[str] = ()) -> DataFrame:
    """Add ``rank_col`` (1-based row number in ``order`` within ``by``), ``cum_<c>``
    (inclusive running sum) for ``sums``, ``cmax_<c>`` (running max) for ``maxes`` and
    ``<c>_next`` (value of the next row of the group, null at its end) for ``leads``.

    ``order`` must be a total order (add a unique tie-break column, trap T29).
    """
    by = list(by or [])
    sums, maxes, leads = list(sums), list(maxes), list(leads)
    laid = lay_out(df, order, by, num_partitions)

    # ---- pass 1: one summary row per range ------------------------------------------
    sum_fields = [T.StructField(f"s_{i}", T.DoubleType()) for i in range(len(sums))]
    max_fields = [T.StructField(f"m_{i}", T.DoubleType()) for i in range(len(maxes))]
    summary_schema = T.StructType([
        T.StructField("pid", T.IntegerType()), T.StructField("first_key", T.StringType()),
        T.StructField("last_key", T.StringType()), T.StructField("last_n", T.LongType()),
    ] + sum_fields + max_fields)

    def summarize(batches):
        pid, first_key, last_key = None, None, None
        last_n, last_s, last_m = 0, [0.0] * len(sums), [np.nan] * len(maxes)
        for pid, batch in _one_range_each(batches):
            keys = _column(batch, _KEY)
            at = int(_starts(keys)[-1])
            if first_key is None:
                first_key = keys[0].as_py()
            tail_key = keys[-1].as_py()
            if tail_key != last_key:
                last_n, last_s, last_m = 0, [0.0] * len(sums), [np.nan] * len(maxes)
            last_key = tail_key
            last_n += len(keys) - at
            last_s = [a + float(np.nansum(_floats(batch, c)[at:])) for a, c in zip(last_s, sums)]
            last_m = [float(np.fmax(a, np.fmax.reduce(_floats(batch, c)[at:]))) for a, c in zip(last_m, maxes)]
        if first_key is not None:
            row = [pid, first_key, last_key, last_n, *last_s, *last_m]
            kinds = [pa.int32(), pa.string(), pa.string(), pa.int64()] + [pa.float64()] * (len(sums) + len(maxes))
            yield pa.record_batch([pa.array([v], t) for v, t in zip(row, kinds)], names=[f.name for f in summary_schema.fields])

    # Bounded by the number of ranges, never by the data.
    rows = sorted(laid.select(_RANGE, _KEY, *dict.fromkeys(sums + maxes)).mapInArrow(summarize, summary_schema).collect(), key=lambda r: r["pid"])
    carries: dict[int, tuple] = {}
    open_key, open_agg = None, None
    for r in rows:
        agg = (r["last_n"], [r[f"s_{i}"] for i in range(len(sums))], [r[f"m_{i}"] for i in range(len(maxes))])
        carry = open_agg if (open_agg is not None and r["first_key"] == open_key) else None
        if carry is not None:
            carries[r["pid"]] = (r["first_key"], carry)
        if r["first_key"] == r["last_key"] and carry is not None:
            open_agg = (carry[0] + agg[0], [a + b for a, b in zip(carry[1], agg[1])],
                        [float(np.fmax(a, b)) for a, b in zip(carry[2], agg[2])])
        else:
            open_agg = agg
        open_key = r["last_key"]
    carries_json = json.dumps({str(k): v for k, v in carries.items()})
    heads = _range_heads(laid, leads) if leads else {}

    # ---- pass 2: local running aggregates plus carries -----------------------------
    own_fields = [f for f in laid.schema.fields if f.name not in (_RANGE, _KEY)]
    out_fields = own_fields + [T.StructField(rank_col, T.LongType())]
    out_fields += [T.StructField(f"cum_{c}", T.DoubleType()) for c in sums]
    out_fields += [T.StructField(f"cmax_{c}", T.DoubleType()) for c in maxes]
    out_fields += [T.StructField(f"{c}_next", laid.schema[c].dataType) for c in leads]

    def scan(batches):
        carries = json.loads(carries_json)
        cur_pid = cur_key = None
        cur_n, cur_s, cur_m = 0, [0.0] * len(sums), [np.nan] * len(maxes)
        batches = ((pid, batch, []) for pid, batch in _one_range_each(batches))
        for pid, batch, following in _add_leads(batches, leads, heads) if leads else batches:
            if pid != cur_pid:
                cur_pid = pid
                cur_key, (cur_n, cur_s, cur_m) = carries.get(str(pid), (None, (0, [0.0] * len(sums), [np.nan] * len(maxes))))
            keys = _column(batch, _KEY)
            starts = _starts(keys)
            group = np.zeros(len(keys), dtype=np.int64)
            group[starts[1:]] = 1
            group = np.cumsum(group)
            first = (group == 0) & (keys[0].as_py() == cur_key)  # rows that go on with the group of the batch before
            rank = np.arange(1, len(keys) + 1) - starts[group] + np.where(first, cur_n, 0)
            new = [rank]
            for i, c in enumerate(sums):
                new.append(pd.Series(np.nan_to_num(_floats(batch, c))).groupby(group).cumsum().to_numpy() + np.where(first, cur_s[i], 0.0))
            for i, c in enumerate(maxes):
                top = pd.Series(_floats(batch, c)).groupby(group).cummax().groupby(group).ffill().to_numpy()
                new.append(np.where(first, np.fmax(top, cur_m[i]), top))
            cur_key, cur_n = keys[-1].as_py(), int(rank[-1])
            cur_s, cur_m = [float(x[-1]) for x in new[1:1 + len(sums)]], [float(x[-1]) for x in new[1 + len(sums):]]
            # A running maximum of nulls only is null.
            arrays = [_column(batch, f.name) for f in own_fields] + [pa.array(x, from_pandas=True) for x in new] + following
            yield pa.record_batch(arrays, names=[f.name for f in out_fields])

    return laid.mapInArrow(scan, T.StructType(out_fields))


def _range_heads(laid: DataFrame, cols: list[str]) -> dict[int, tuple]:
    """range -> (group key, one-row arrays of ``cols``) of the first row of the range after it: one entry a range."""
    own = F.struct(F.monotonically_increasing_id().alias("at"), F.col(_KEY).alias("key"), *[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(cols)])
    first = laid.select(_RANGE, own.alias("head")).groupBy(_RANGE).agg(F.min_by("head", "head.at").alias("head"))
    table = first.select(_RANGE, "head.*").toArrow().sort_by(_RANGE).combine_chunks()
    pids, keys = table.column(0).to_pylist(), table.column(2).to_pylist()
    row = lambda j: [table.column(3 + i).slice(j, 1).combine_chunks() for i in range(len(cols))]
    return {pid: (keys[j], row(j)) for j, pid in enumerate(pids[:-1], 1)}


def _add_leads(batches, leads: list[str], heads: dict[int, tuple]):
    """(range, batch, arrays of the next rows' values); the last row of a batch waits for the batch or the range after it."""
    def ended(pid, batch, key, values):
        keys = _column(batch, _KEY)
        last = np.zeros(len(keys), dtype=bool)
        last[_starts(keys)[1:] - 1] = True
        last[-1] = keys[-1].as_py() != key
        ahead = []
        for c, v in zip(leads, values):
            column = _column(batch, c)
            moved = pa.concat_arrays([column.slice(1), pa.nulls(1, column.type) if v is None else v.cast(column.type)])
            ahead.append(pc.if_else(pa.array(last), pa.scalar(None, column.type), moved))
        return pid, batch, ahead

    nothing = (None, [None] * len(leads))
    held = None
    for pid, batch, _ in batches:
        if held is not None:
            yield ended(*held, *((_column(batch, _KEY)[0].as_py(), [_column(batch, c).slice(0, 1) for c in leads]) if held[0] == pid else heads.get(held[0], nothing)))
        held = (pid, batch)
    if held is not None:
        yield ended(*held, *heads.get(held[0], nothing))


def global_rank(df: DataFrame, order: OrderSpec, by: list[str] | None = None, rank_col: str = "rank",
                sums: list[str] = ()) -> DataFrame:
    """Row number over ``order`` (within ``by``) without a single-partition window."""
    return ordered_scan(df, order, by=by, sums=sums, rank_col=rank_col)


def plateau_stops(df: DataFrame, order: OrderSpec, value: str, patience: int, delta: float = 0.0,
                  by: list[str] | None = None, num_partitions: int | None = None) -> DataFrame:
    """(``by``, stop_rank): the row of each group at which early stopping stops, for the groups where it does.

    The first row is the best so far. A row below best + ``delta`` counts, any other becomes the best and
    starts the count anew; the row at which the count reaches ``patience`` stops. Null and NaN values count.

    A best row is replaced or stops within ``patience`` rows. So what enters a range is a best value and a
    count below ``patience``, and it lands on one of the range's first ``patience`` rows or passes them: a
    range is summed up by its first ``patience`` values and, for each of them, where a best there leads.
    The driver folds these few numbers a range; a hot group spans many ranges.
    """
    by = list(by or [])
    laid = lay_out(df.select(*by, F.col(value).cast("double").alias("__value"), *[c for c, _ in order if c not in (*by, value)],
                             *([F.col(value)] if value in [c for c, _ in order] else [])), order, by, num_partitions)
    key_fields = [laid.schema[c] for c in by]
    schema = T.StructType([*key_fields, T.StructField("stop_rank", T.LongType()), T.StructField("pid", T.IntegerType()), T.StructField("state", T.StringType())])

    def chase(x: np.ndarray, start: int) -> tuple[int | None, int | None]:
        """From a best at ``start``: (index of the stopping row, None) or (None, index of the last best)."""
        at = start
        while True:
            ahead = x[at + 1:at + 1 + patience]
            up = np.flatnonzero(ahead >= x[at] + delta) if x[at] == x[at] else np.flatnonzero(ahead == ahead)
            if len(up):
                at += 1 + int(up[0])
            elif len(ahead) == patience:
                return at + patience, None
            else:
                return None, at

    def walk(batches):
        group, values, pid, first, kinds = None, [], None, True, None

        def closed(last: bool):
            """Rows for the group that ended, or that the range's end cuts."""
            x = np.concatenate(values)
            if not first and not last:
                stop, _ = chase(x, 0)
                return [] if stop is None else [(*group[1], stop + 1, pid, None)]
            said = {"key": group[0], "n": len(x), "first": first, "head": [None if v != v else v for v in x[:patience].tolist()], "leads": []}
            for start in range(min(len(x), patience)):
                stop, best = chase(x, start)
                said["leads"].append([stop, None if best is None or x[best] != x[best] else float(x[best]), None if best is None else len(x) - 1 - best])
            return [(*group[1], None, pid, json.dumps(said))]

        def table(rows):
            return pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=[f.name for f in schema.fields])

        for here, batch in _one_range_each(batches):
            out, kinds = [], [*[batch.schema.field(c).type for c in by], pa.int64(), pa.int32(), pa.string()]
            if pid is not None and here != pid:
                out += closed(True)
                group, values, first = None, [], True
            pid = here
            keys, x = _column(batch, _KEY), _floats(batch, "__value")
            starts = _starts(keys)
            for lo, hi in zip(starts, np.r_[starts[1:], len(x)]):
                key = keys[int(lo)].as_py()
                if group is not None and group[0] != key:
                    out += closed(False)
                    group, values, first = None, [], False
                if group is None:
                    group = (key, [_column(batch, c)[int(lo)].as_py() for c in by])
                values.append(x[lo:hi])
            yield table(out)
        if group is not None:
            yield table(closed(True))

    walked = cut_lineage(laid.mapInArrow(walk, schema))
    at_edges = walked.filter("state IS NOT NULL").select(F.struct(*by).alias("names") if by else F.lit(None).cast("string").alias("names"), "pid", "state").collect()
    found: list[tuple] = []
    open_: dict | None = None
    for r in sorted(at_edges, key=lambda r: (r["pid"], not json.loads(r["state"])["first"])):  # two rows a range at most
        s = json.loads(r["state"])
        s["head"] = [math.nan if v is None else v for v in s["head"]]
        if open_ is None or open_["key"] != s["key"]:
            open_ = {"key": s["key"], "rank": 0, "stopped": False, "lead": s["leads"][0], "fresh": True}
        if open_["stopped"]:
            continue
        landed, stop = None, None
        if open_.pop("fresh", False):
            landed = 0
        else:
            best, count = open_["best"], open_["count"]
            for i, v in enumerate(s["head"][:patience - count]):
                if (v >= best + delta) if best == best else v == v:
                    landed = i
                    break
            else:
                if len(s["head"]) >= patience - count:
                    stop = open_["rank"] + patience - count
                else:
                    open_["count"] += s["n"]
        if landed is not None:
            at, best, count = s["leads"][landed]
            if at is not None:
                stop = open_["rank"] + at + 1
            else:
                open_["best"], open_["count"] = math.nan if best is None else best, count
        open_["rank"] += s["n"]
        if stop is not None:
            open_["stopped"] = True
            found.append((*(r["names"] or ()), stop))
    edges = df.sparkSession.createDataFrame(found, T.StructType([*key_fields, T.StructField("stop_rank", T.LongType())]))
    return walked.filter("state IS NULL").select(*by, "stop_rank").unionByName(edges)


def top_k_per_group(df: DataFrame, by: list[str], order: list[Column], k: int, rank_col: str = "rn") -> DataFrame:
    """Keep the first ``k`` rows per group.

    ``row_number() <= k`` lets Catalyst insert a partial WindowGroupLimit before the
    shuffle, so each map task forwards at most k rows per group: a hot group costs
    k x (map tasks) rows in its final task, not the group size.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)
