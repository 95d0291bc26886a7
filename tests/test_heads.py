"""The heads against loops over rows, fields and places."""

import math

import numpy as np
import pytest

from tabloom.operators import heads

RNG = np.random.default_rng(4)
E_ = RNG.normal(0, 1, (6, 5, 4))


def plain_pooled(e, p):
    xs, scores = [], []
    for i in range(len(e)):
        for j in range(i + 1, len(e)):
            x = [a * b for a, b in zip(e[i], e[j])]
            xs.append(x)
            scores.append(sum(h * max(0.0, sum(w * a for w, a in zip(row, x)) + b) for row, b, h in zip(p["W"], p["b"], p["h"])))
    share = [math.exp(s) for s in scores]
    return sum(s / sum(share) * sum(a * b for a, b in zip(x, p["p"])) for s, x in zip(share, xs))


def plain_compressed(e, p):
    now, total, at = [list(v) for v in e], p["b"], 0
    for n, f in enumerate(p["filters"]):
        layer = [[max(0.0, sum(f[i * len(now) + j][h] * e[i][d] * now[j][d] for i in range(len(e)) for j in range(len(now)))) for d in range(len(e[0]))] for h in range(f.shape[1])]
        out = layer
        if n < len(p["filters"]) - 1:
            now, out = layer[:f.shape[1] // 2], layer[f.shape[1] // 2:]
        for row in out:
            total += p["w"][at] * sum(row)
            at += 1
    return total


def plain_cross(e, p):
    x0 = [a for v in e for a in v]
    x, h = list(x0), list(x0)
    for w, b in p["cross"]:
        s = sum(a * c for a, c in zip(x, w))
        x = [a * s + c + d for a, c, d in zip(x0, b, x)]
    for w, b in p["deep"]:
        h = [max(0.0, sum(h[i] * w[i][j] for i in range(len(h))) + b[j]) for j in range(len(b))]
    return sum(a * b for a, b in zip(x + h, p["w"])) + p["b"]


def plain_attention(e, p):
    def times(x, m):
        return [[sum(r[i] * m[i][j] for i in range(len(r))) for j in range(len(m[0]))] for r in x]

    def normal(x):
        out = []
        for r in x:
            mean = sum(r) / len(r)
            out.append([(a - mean) / math.sqrt(sum((b - mean) ** 2 for b in r) / len(r) + 1e-12) for a in r])
        return out

    x, size = [list(v) for v in e], len(e[0]) // p["heads"]
    for w in p["layers"]:
        q, k, v = times(x, w["q"]), times(x, w["k"]), times(x, w["v"])
        seen = [[] for _ in x]
        for h in range(p["heads"]):
            lo, hi = h * size, (h + 1) * size
            for i in range(len(x)):
                s = [math.exp(sum(a * b for a, b in zip(q[i][lo:hi], k[j][lo:hi])) / math.sqrt(size)) for j in range(len(x))]
                seen[i] += [sum(s[j] * v[j][c] for j in range(len(x))) / sum(s) for c in range(lo, hi)]
        x = normal([[a + b for a, b in zip(r, o)] for r, o in zip(x, times(seen, w["o"]))])
        up = [[max(0.0, a) for a in r] for r in times(x, w["up"])]
        x = normal([[a + b for a, b in zip(r, o)] for r, o in zip(x, times(up, w["down"]))])
    return sum(a * b for a, b in zip([a for r in x for a in r], p["w"])) + p["b"]


@pytest.mark.parametrize("head, plain", [("pooled_pairs", plain_pooled), ("compressed", plain_compressed), ("cross", plain_cross), ("attention", plain_attention)])
def test_heads_are_their_formulas(head, plain):
    forward, make = heads.HEADS[head]
    p = make(5, 4)
    assert forward(E_, p) == pytest.approx([plain(e, p) for e in E_.tolist()])


def test_scores_of_rows(spark):
    rows = spark.createDataFrame([(1, [0, 2], [1.0, 1.0]), (2, [1, 9], [0.5, 1.0]), (3, [0, 2], [1.0, 1.0])], "user_id long, xi array<int>, xv array<float>").repartition(3)
    weights = spark.createDataFrame([(i, 0.1 * i, 0.2, -0.3 * i) for i in range(3)], "idx long, w double, v0 double, v1 double")
    got = {r["user_id"]: r["score"] for r in heads.head_score(rows, weights, "cross", k=2).collect()}
    p = heads.cross_params(2, 2)
    one = plain_cross([[0.2, 0.0], [0.2, -0.6]], p) + 0.2
    two = plain_cross([[0.1, -0.15], [0.0, 0.0]], p) + 0.05  # index 9 has no weights
    assert got == {1: pytest.approx(1 / (1 + math.exp(-one))), 2: pytest.approx(1 / (1 + math.exp(-two))), 3: got[1]}
    assert heads.head_score(rows.limit(0), weights, "attention", k=2).count() == 0
