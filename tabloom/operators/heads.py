"""Scoring heads over field embeddings (M8-M11): attention-pooled pairs, compressed interactions, cross network with MLP,
self-attention over fields.

Rows are (key, xi, xv). Linear weights and embeddings are a table (idx, w, v0, v1, ...) as for ``score.fm_score``: entries
meet it by a join, so it may have any size, and come back as one matrix a row (fields are few). The small dense weights of
a head travel with the task; rows are scored in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def wave(seed: int, *shape: int, size: float = 0.3) -> np.ndarray:
    """Deterministic dense weights: a wave over the places."""
    at = sum(step * np.arange(n).reshape([-1 if d == i else 1 for d in range(len(shape))]) for i, (n, step) in enumerate(zip(shape, (1.7, 0.9, 2.3))))
    return size * np.sin(seed + at)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


def _softmax(x: np.ndarray, axis: int) -> np.ndarray:
    e = np.exp(x - x.max(axis=axis, keepdims=True))
    return e / e.sum(axis=axis, keepdims=True)


def _relu(x: np.ndarray) -> np.ndarray:
    return np.maximum(x, 0)


def _centred(x: np.ndarray, eps: float = 1e-12) -> np.ndarray:
    """Layer normalisation of the last axis."""
    d = x - x.mean(axis=-1, keepdims=True)
    return d / np.sqrt((d * d).mean(axis=-1, keepdims=True) + eps)


# ------------------------------------------------------------------ M8 --------------
def pooled_pairs_params(fields: int, k: int, factor: int = 3) -> dict:
    return {"W": wave(1, factor, k), "b": wave(2, factor), "h": wave(3, factor, size=1.0), "p": wave(4, k, size=1.0)}


def pooled_pairs(e: np.ndarray, p: dict) -> np.ndarray:
    """M8, logit of the pairs: products of two fields, weighted by a softmax of h.relu(W x + b), summed and projected."""
    i, j = np.triu_indices(e.shape[1], 1)
    x = e[:, i] * e[:, j]
    share = _softmax(_relu(x @ p["W"].T + p["b"]) @ p["h"], axis=1)
    return np.einsum("np,npk->nk", share, x) @ p["p"]


# ------------------------------------------------------------------ M9 --------------
def compressed_params(fields: int, k: int, layers: tuple = (4, 4)) -> dict:
    out, height = {"filters": []}, fields
    for n, size in enumerate(layers):
        out["filters"].append(wave(11 + n, fields * height, size))
        height = size // 2
    width = sum(size // 2 for size in layers[:-1]) + layers[-1]
    return out | {"w": wave(21, width, size=1.0), "b": 0.1}


def compressed(e: np.ndarray, p: dict) -> np.ndarray:
    """M9, logit of the compressed interactions: each layer multiplies the fields with the layer before, place by place of the
    embedding, and filters the products; half of an inner layer goes on, half to the output."""
    now, outs = e, []
    for n, f in enumerate(p["filters"]):
        z = np.einsum("nik,njk->nijk", e, now).reshape(len(e), -1, e.shape[2])
        layer = _relu(np.einsum("nik,ih->nhk", z, f))
        if n < len(p["filters"]) - 1:
            half = f.shape[1] // 2
            now, layer = layer[:, :half], layer[:, half:]
        outs.append(layer)
    return np.concatenate(outs, axis=1).sum(axis=2) @ p["w"] + p["b"]


# ------------------------------------------------------------------ M10 -------------
def cross_params(fields: int, k: int, layers: int = 2, hidden: tuple = (6,)) -> dict:
    d = fields * k
    deep, width = [], d
    for n, h in enumerate(hidden):
        deep.append((wave(31 + n, width, h), wave(41 + n, h, size=0.1)))
        width = h
    return {"cross": [(wave(51 + n, d), wave(61 + n, d, size=0.05)) for n in range(layers)], "deep": deep, "w": wave(71, d + width), "b": 0.05}


def cross_and_deep(e: np.ndarray, p: dict) -> np.ndarray:
    """M10, logit of x' = x0 (x.w) + b + x, layer on layer, beside an MLP of the same input."""
    x0 = e.reshape(len(e), -1)
    x, h = x0, x0
    for w, b in p["cross"]:
        x = x0 * (x @ w)[:, None] + b + x
    for w, b in p["deep"]:
        h = _relu(h @ w + b)
    return np.concatenate([x, h], axis=1) @ p["w"] + p["b"]


# ------------------------------------------------------------------ M11 -------------
def attention_params(fields: int, k: int, layers: int = 1, heads: int = 2, inner: int = 6) -> dict:
    one = lambda n: {"q": wave(81 + n, k, k, size=1.0), "k": wave(91 + n, k, k, size=1.0), "v": wave(101 + n, k, k), "o": wave(111 + n, k, k), "up": wave(121 + n, k, inner), "down": wave(131 + n, inner, k)}
    return {"heads": heads, "layers": [one(n) for n in range(layers)], "w": wave(141, fields * k), "b": -0.05}


def self_attention(e: np.ndarray, p: dict) -> np.ndarray:
    """M11, logit of encoder layers over the fields: scaled dot-product attention in ``heads`` heads, residual and layer
    normalisation, a two-layer network, residual and normalisation; the fields' outputs are projected."""
    x, heads = e, p["heads"]
    n, fields, k = x.shape
    split = lambda a: a.reshape(n, fields, heads, k // heads).transpose(0, 2, 1, 3)
    for w in p["layers"]:
        q, key, v = split(x @ w["q"]), split(x @ w["k"]), split(x @ w["v"])
        seen = _softmax(q @ key.transpose(0, 1, 3, 2) / np.sqrt(k // heads), axis=3) @ v
        x = _centred(x + seen.transpose(0, 2, 1, 3).reshape(n, fields, k) @ w["o"])
        x = _centred(x + _relu(x @ w["up"]) @ w["down"])
    return x.reshape(n, -1) @ p["w"] + p["b"]


HEADS: dict[str, tuple[Callable, Callable]] = {"pooled_pairs": (pooled_pairs, pooled_pairs_params), "compressed": (compressed, compressed_params),
                                               "cross": (cross_and_deep, cross_params), "attention": (self_attention, attention_params)}


# ------------------------------------------------------------------ scoring ---------
def embedded(rows: DataFrame, weights: DataFrame, key: str, k: int) -> DataFrame:
    """(key, linear, e): the linear part and the embeddings, field by field, of every row; indices without weights count 0."""
    z = rows.select(key, F.posexplode(F.arrays_zip("xi", "xv")).alias("field", "p")).select(key, "field", F.col("p.xi").cast("long").alias("idx"), F.col("p.xv").cast("double").alias("x"))
    at = lambda c: F.coalesce(F.col(c), F.lit(0.0)) * F.col("x")
    j = z.join(weights, "idx", "left").select(key, at("w").alias("w"), F.struct("field", F.array(*[at(f"v{f}") for f in range(k)]).alias("v")).alias("e"))
    return j.groupBy(key).agg(F.sum("w").alias("linear"), F.transform(F.sort_array(F.collect_list("e")), lambda s: s["v"]).alias("e"))


def head_score(rows: DataFrame, weights: DataFrame, head: str, params: dict | None = None, key: str = "user_id", k: int = 4) -> DataFrame:
    """(key, score): sigmoid of the linear part plus the head's logit. All rows have the same number of fields; without
    ``params`` the head's deterministic weights for that number are taken."""
    forward, make = HEADS[head]
    whole = embedded(rows, weights, key, k)
    params = params or make(rows.agg(F.max(F.size("xi"))).first()[0] or 0, k)

    def score(batches):
        for batch in batches:
            flat = batch.column(2).flatten().flatten().to_numpy(zero_copy_only=False)
            e = flat.reshape(batch.num_rows, -1, k)
            logit = batch.column(1).to_numpy(zero_copy_only=False) + (forward(e, params) if batch.num_rows else 0)
            yield pa.record_batch([batch.column(0), pa.array(sigmoid(logit))], names=[key, "score"])

    return whole.mapInArrow(score, f"{key} {whole.schema[key].dataType.simpleString()}, score double")
