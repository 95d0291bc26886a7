"""Batch scoring with given weights (M6-M8, M12-M14, D5, D6) and input arrays.

The FM score (M6) is pure SQL: explode (field, index) pairs, join the weight table
and aggregate per row. Heads that need dense maths (M7
FM + MLP with batch-norm) run in one ``mapInPandas`` per partition with weights
shipped once per task; rows never pass through the driver.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import sparse_overlay
from .rank import ordered_scan

# Base shape of the demo scorer (our own choice, not a reference value): types and counts beyond it get
# fields and indices after these.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
SLOTS = 100
BASE = len(EVENT_TYPES) * SLOTS
K = 4


def fm_weights(spark: SparkSession, n_fields: int = len(EVENT_TYPES), k: int = K, n_index: int | None = None) -> DataFrame:
    """Deterministic weight table (idx, w, v0..v{k-1}) generated by a rule, for ``n_index`` indices."""
    r = spark.range(n_index or n_fields * SLOTS).select(F.col("id").alias("idx"))
    cols = [(F.lit(0.01) * F.sin(F.col("idx").cast("double"))).alias("w")]
    cols += [(F.lit(0.05) * F.cos(F.col("idx").cast("double") * F.lit(float(j + 1)))).alias(f"v{j}") for j in range(k)]
    return r.select("idx", *cols)


def _type_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


def value_index(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tables fitted on the events: (event_type, field, idx0) of every type, where idx0 is the index of
    count 0, and (event_type, n, idx) of every count found. The base types and counts below 100 have
    field*100 + count; other types get the fields, and all other pairs the indices, that follow, in order."""
    base = F.create_map(*[x for i, t in enumerate(EVENT_TYPES) for x in (F.lit(t), F.lit(i))])
    pairs = _type_counts(events).filter("event_type IS NOT NULL").select("event_type", "n").distinct()
    pairs = pairs.withColumn("code", F.try_element_at(base, F.col("event_type")))
    others = pairs.filter("code IS NULL").select("event_type").distinct()
    fields = ordered_scan(others, [("event_type", True)]).select("event_type", (F.col("rank") + (len(EVENT_TYPES) - 1)).cast("int").alias("field"))
    beyond = pairs.filter((F.col("n") >= SLOTS) | F.col("code").isNull()).select("event_type", "n")
    beyond = beyond.union(others.select("event_type", F.lit(0).cast("long")))
    placed = ordered_scan(beyond, [("event_type", True), ("n", True)]).select("event_type", "n", (F.col("rank") + (BASE - 1)).cast("int").alias("idx"))
    inside = pairs.filter((F.col("n") < SLOTS) & F.col("code").isNotNull())
    index = placed.union(inside.select("event_type", "n", (F.col("code") * SLOTS + F.col("n")).cast("int")))
    known = events.sparkSession.createDataFrame([(t, i, i * SLOTS) for i, t in enumerate(EVENT_TYPES)], "event_type string, field int, idx0 int")
    zero = placed.filter("n = 0").select("event_type", F.col("idx").alias("idx0"))
    return known.unionByName(fields.join(zero, "event_type")), index


def user_sparse_features(events: DataFrame) -> DataFrame:
    """Per user the sparse string 'field:index ...' of their counts by type (``value_index`` of these
    events) laid over the default vector (count 0) -> (user_id, xi ARRAY<INT>, xv ARRAY<FLOAT>).
    A null type is no type; a user who has no other stays, with the default vector."""
    fields, index = value_index(events)
    c = _type_counts(events).join(index, ["event_type", "n"], "left").join(fields.select("event_type", "field"), "event_type", "left")
    pair = F.when(F.col("idx").isNotNull(), F.concat(F.col("field").cast("string"), F.lit(":"), F.col("idx").cast("string")))
    # at most one entry per event type: a bounded list per user
    s = c.groupBy("user_id").agg(F.concat_ws(" ", F.collect_list(pair)).alias("feat"))
    default = fields.agg(F.sort_array(F.collect_list(F.struct("field", "idx0")))["idx0"].alias("zero"))
    xi = F.when(F.col("feat") == "", F.col("zero")).otherwise(sparse_overlay(F.col("feat"), F.col("zero")))
    s = s.crossJoin(default).select("user_id", xi.alias("xi"))  # the default vector is one row
    return s.withColumn("xv", F.transform("xi", lambda x: F.lit(1.0).cast("float")))


def index_size(feats: DataFrame) -> int:
    """Indices that weights are needed for."""
    return max(BASE, (feats.agg(F.max(F.array_max("xi"))).first()[0] or 0) + 1)


def fm_score(feats: DataFrame, weights: DataFrame, key: str = "user_id", k: int = K) -> DataFrame:
    """M6: sigmoid(sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2))."""
    z = feats.select(key, F.posexplode(F.arrays_zip("xi", "xv")).alias("field", "p"))
    z = z.select(key, F.col("p.xi").cast("long").alias("idx"), F.col("p.xv").cast("double").alias("x"))
    j = z.join(weights, "idx")
    aggs = [F.sum(F.col("w") * F.col("x")).alias("lin")]
    for f in range(k):
        aggs += [F.sum(F.col(f"v{f}") * F.col("x")).alias(f"s{f}"), F.sum(F.pow(F.col(f"v{f}") * F.col("x"), 2)).alias(f"q{f}")]
    s = j.groupBy(key).agg(*aggs)
    inter = sum((F.col(f"s{f}") * F.col(f"s{f}") - F.col(f"q{f}")) for f in range(k)) * 0.5
    return s.select(key, (1.0 / (1.0 + F.exp(-(F.col("lin") + inter)))).alias("score"))


# SQL twin of ``value_index``: fields (event_type, field, idx0) and places (event_type, n, idx), from cnt (user_id, event_type, n).
VALUE_INDEX_SQL = f"""base AS (SELECT * FROM (VALUES {", ".join(f"('{t}', {i})" for i, t in enumerate(EVENT_TYPES))}) t(event_type, code)),
pairs AS (SELECT DISTINCT c.event_type, c.n, b.code FROM cnt c LEFT JOIN base b USING (event_type) WHERE c.event_type IS NOT NULL),
others AS (SELECT DISTINCT event_type FROM pairs WHERE code IS NULL),
beyond AS (SELECT event_type, n, row_number() OVER (ORDER BY event_type, n) + {BASE - 1} AS idx FROM (
  SELECT event_type, n FROM pairs WHERE n >= {SLOTS} OR code IS NULL UNION ALL SELECT event_type, 0 FROM others)),
places AS (SELECT event_type, n, idx FROM beyond UNION ALL SELECT event_type, n, code * {SLOTS} + n FROM pairs WHERE n < {SLOTS} AND code IS NOT NULL),
fields AS (SELECT event_type, code AS field, code * {SLOTS} AS idx0 FROM base
  UNION ALL SELECT o.event_type, row_number() OVER (ORDER BY o.event_type) + {len(EVENT_TYPES) - 1}, b.idx FROM others o JOIN beyond b ON b.event_type = o.event_type AND b.n = 0)"""
SUMS_SQL = ", ".join(f"sum(v{j}) AS s{j}, sum(v{j} * v{j}) AS q{j}" for j in range(K))
PAIRS_SQL = " + ".join(f"(s{j} * s{j} - q{j})" for j in range(K))


def weights_sql(indices: str) -> str:
    """SQL twin of ``fm_weights`` for the indices (column i) of a query."""
    vs = ", ".join(f"0.05 * cos(CAST(i AS DOUBLE) * {float(j + 1)}) AS v{j}" for j in range(K))
    return f"SELECT i AS idx, 0.01 * sin(CAST(i AS DOUBLE)) AS w, {vs} FROM ({indices})"


FM_SQL = f"""
WITH cnt AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2),
{VALUE_INDEX_SQL},
x AS (SELECT u.user_id, coalesce(i.idx, f.idx0) AS idx FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN fields f
      LEFT JOIN cnt c ON c.user_id IS NOT DISTINCT FROM u.user_id AND c.event_type = f.event_type LEFT JOIN places i ON i.event_type = c.event_type AND i.n = c.n),
s AS (SELECT user_id, sum(w) AS lin, {SUMS_SQL} FROM x JOIN ({weights_sql("SELECT DISTINCT idx AS i FROM x")}) w USING (idx) GROUP BY 1)
SELECT user_id, round(1.0 / (1.0 + exp(-(lin + 0.5 * ({PAIRS_SQL})))), 6) AS score FROM s"""


# ------------------------------------------------------------------ M7 ------------
def deepfm_params(n_index: int = len(EVENT_TYPES) * SLOTS, n_fields: int = len(EVENT_TYPES), k: int = K,
                  hidden: tuple = (8,), seed: int = 7) -> dict:
    """Deterministic FM + MLP (+ batch-norm running stats) weights for scoring. Indices and fields beyond
    the base shape draw from a stream of their own, so that the weights of the base stay the same."""
    rs, more = np.random.RandomState(seed), np.random.RandomState(seed + 1)
    base_fields, base_index = min(n_fields, len(EVENT_TYPES)), min(n_index, BASE)
    p = {"w": rs.normal(0, 0.01, base_index), "emb": rs.normal(0, 0.05, (base_index, k)), "layers": []}
    p["w"] = np.r_[p["w"], more.normal(0, 0.01, n_index - base_index)]
    p["emb"] = np.r_[p["emb"], more.normal(0, 0.05, (n_index - base_index, k))]
    d, extra = base_fields * k, (n_fields - base_fields) * k
    for h in hidden:
        w = np.r_[rs.normal(0, 0.3, (d, h)), more.normal(0, 0.3, (extra, h))]
        p["layers"].append({"W": w, "b": np.zeros(h), "mean": rs.normal(0, 0.01, h),
                            "var": np.abs(rs.normal(1, 0.1, h)), "gamma": np.ones(h), "beta": np.zeros(h)})
        d, extra = h, 0
    p["out"] = {"W": np.r_[rs.normal(0, 0.3, (d, 1)), more.normal(0, 0.3, (extra, 1))], "b": np.zeros(1)}
    return p


def deepfm_forward(p: dict, xi: np.ndarray, xv: np.ndarray) -> np.ndarray:
    """sigmoid(w.x + sum over i < j of <e_i, e_j> + MLP(e)) with e_i = x_i * embedding_i; the pair sum is
    half of |sum e|^2 - sum |e|^2, a batch-norm is folded into one scale and shift per unit."""
    rows, fields = xi.shape
    e = np.einsum("nf,nfk->nfk", xv, p["emb"][xi])
    logit = np.einsum("nf,nf->n", xv, p["w"][xi])
    logit += (np.square(np.einsum("nfk->nk", e)).sum(1) - np.einsum("nfk,nfk->n", e, e)) / 2
    act = e.reshape(rows, fields * e.shape[2])
    for unit in p["layers"]:
        scale = unit["gamma"] / np.sqrt(unit["var"] + 1e-5)
        act = np.clip(act @ unit["W"] + unit["b"], 0, None) * scale + (unit["beta"] - unit["mean"] * scale)
    logit += act @ p["out"]["W"][:, 0] + p["out"]["b"][0]
    return 1.0 / (1.0 + np.exp(-logit))


def batch_scorer(params: dict, key: str, max_records: int | None = None):
    """Per-partition scorer factory. The parameters travel once per task in
    the closure (they are small); rows are scored in Arrow batches."""
    def score_batches(it):
        for pdf in it:
            if pdf.empty:
                continue
            xi = np.stack(pdf["xi"].to_numpy()).astype(np.int64)
            xv = np.stack(pdf["xv"].to_numpy()).astype(np.float64)
            yield pd.DataFrame({key: pdf[key].to_numpy(), "score": deepfm_forward(params, xi, xv)})
    return score_batches


def deepfm_score(feats: DataFrame, key: str = "user_id", params: dict | None = None) -> DataFrame:
    """M7: FM + MLP scoring of (key, xi, xv) rows via mapInPandas."""
    if params is None:
        n_fields = feats.agg(F.max(F.size("xi"))).first()[0] or 0
        params = deepfm_params(index_size(feats), max(len(EVENT_TYPES), n_fields))
    key_type = feats.schema[key].dataType.simpleString()
    return feats.select(key, "xi", "xv").mapInPandas(batch_scorer(params, key), f"{key} {key_type}, score double")
