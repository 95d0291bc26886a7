"""Scores of the heads M8-M11 for every user, and their SQL: dense weights as literals, matrices as nested lists."""

from __future__ import annotations

import numpy as np

from ..operators import heads, score
from .fixtures import table
from .registry import register, round_doubles

FIELDS, K = len(score.EVENT_TYPES), score.K


def lit(x) -> str:
    """An array as nested list literals."""
    return repr(float(x)) + "::DOUBLE" if np.ndim(x) == 0 else "[" + ", ".join(map(lit, x)) + "]"


EMBEDDED_SQL = f"""WITH cnt AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2),
{score.VALUE_INDEX_SQL},
x AS (SELECT u.user_id, f.field, coalesce(i.idx, f.idx0) AS idx FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN fields f
      LEFT JOIN cnt c ON c.user_id IS NOT DISTINCT FROM u.user_id AND c.event_type = f.event_type LEFT JOIN places i ON i.event_type = c.event_type AND i.n = c.n),
xe AS (SELECT user_id, field, w, [{', '.join(f'v{j}' for j in range(K))}] AS e FROM x JOIN ({score.weights_sql('SELECT DISTINCT idx AS i FROM x')}) USING (idx)),
u AS MATERIALIZED (SELECT user_id, sum(w) AS linear, list(e ORDER BY field) AS e FROM xe GROUP BY 1)"""
FINAL = "SELECT user_id, round(1.0 / (1.0 + exp(-(linear + logit))), 6) AS score FROM r"
dot = "list_dot_product"


def _scores(head):
    def run(spark, sf):
        feats = score.user_sparse_features(table(spark, sf, "events"))
        weights = score.fm_weights(spark, n_index=score.index_size(feats))
        return round_doubles(heads.head_score(feats, weights, head))
    return run


def _pooled_sql() -> str:
    p = heads.pooled_pairs_params(FIELDS, K)
    return f"""{EMBEDDED_SQL},
p AS (SELECT a.user_id, list_transform(range(1, {K + 1}), lambda i: a.e[i] * b.e[i]) AS x FROM xe a JOIN xe b ON a.user_id = b.user_id AND a.field < b.field),
s AS (SELECT user_id, x, {dot}(list_transform(list_zip({lit(p['W'])}, {lit(p['b'])}), lambda z: greatest({dot}(z[1], x) + z[2], 0.0)), {lit(p['h'])}) AS s FROM p),
a AS (SELECT user_id, {dot}(x, {lit(p['p'])}) AS y, exp(s - max(s) OVER (PARTITION BY user_id)) AS share FROM s),
r AS (SELECT user_id, any_value(linear) AS linear, sum(share * y) / sum(share) AS logit FROM a JOIN u USING (user_id) GROUP BY 1)
{FINAL}"""


def _compressed_sql() -> str:
    p = heads.compressed_params(FIELDS, K)
    f1, f2 = p["filters"]
    outer = lambda a, b: f"flatten(list_transform({a}, lambda s: list_transform({b}, lambda t: s * t)))"
    layer = lambda f, z: f"list_transform({lit(f.T)}, lambda c: greatest({dot}(c, {z}), 0.0))"
    half = f1.shape[1] // 2
    return f"""{EMBEDDED_SQL},
d AS (SELECT user_id, linear, list_transform(e, lambda v: v[k]) AS x FROM u, (SELECT unnest(range(1, {K + 1})) AS k)),
z AS (SELECT *, {outer('x', 'x')} AS z FROM d),
l AS (SELECT *, {layer(f1, 'z')} AS l FROM z),
z2 AS (SELECT *, {outer('x', f'l[1:{half}]')} AS z2 FROM l),
o AS (SELECT user_id, linear, {dot}(list_concat(l[{half + 1}:], {layer(f2, 'z2')}), {lit(p['w'])}) AS o FROM z2),
r AS (SELECT user_id, any_value(linear) AS linear, sum(o) + {p['b']} AS logit FROM o GROUP BY 1)
{FINAL}"""


def _cross_sql() -> str:
    p = heads.cross_params(FIELDS, K)
    d = FIELDS * K
    parts, x = ["c0 AS (SELECT user_id, linear, flatten(e) AS x0, flatten(e) AS x FROM u)"], "c0"
    for n, (w, b) in enumerate(p["cross"]):
        parts.append(f"c{n + 1} AS (SELECT user_id, linear, x0, list_transform(list_zip(x0, x, {lit(b)}), lambda z: z[1] * s + z[3] + z[2]) AS x FROM (SELECT *, {dot}(x, {lit(w)}) AS s FROM {x}))")
        x = f"c{n + 1}"
    (w, b), = p["deep"]
    return f"""{EMBEDDED_SQL},
{', '.join(parts)},
r AS (SELECT user_id, linear, {dot}(list_concat(x, list_transform(list_zip({lit(w.T)}, {lit(b)}), lambda z: greatest({dot}(z[1], x0) + z[2], 0.0))), {lit(p['w'])}) + {p['b']} AS logit FROM {x})
{FINAL}"""


def _attention_sql() -> str:
    p = heads.attention_params(FIELDS, K)
    w, = p["layers"]
    size = K // p["heads"]
    times = lambda x, m: f"list_transform({x}, lambda row_: list_transform({lit(m.T)}, lambda col_: {dot}(row_, col_)))"
    plus = lambda a, b: f"list_transform(list_zip({a}, {b}), lambda z: list_transform(list_zip(z[1], z[2]), lambda y: y[1] + y[2]))"
    normal = lambda x: f"list_transform({x}, lambda v: list_transform(v, lambda t: (t - list_avg(v)) / sqrt(list_avg(list_transform(v, lambda s: (s - list_avg(v)) * (s - list_avg(v)))) + 1e-12)))"
    heads_ = []
    for h in range(p["heads"]):
        cut = f"[{h * size + 1}:{(h + 1) * size}]"
        scores = f"list_transform(q, lambda a: list_transform(k, lambda b: exp({dot}(a{cut}, b{cut}) / sqrt({size}.0))))"
        heads_.append(f"list_transform({scores}, lambda s: list_transform(range({h * size + 1}, {(h + 1) * size + 1}), lambda i: {dot}(s, list_transform(v, lambda t: t[i])) / list_sum(s)))")
    seen = f"list_transform(list_zip({', '.join(heads_)}), lambda z: list_concat(z[1], z[2]))"
    return f"""{EMBEDDED_SQL},
a AS (SELECT *, {times('e', w['q'])} AS q, {times('e', w['k'])} AS k, {times('e', w['v'])} AS v FROM u),
b AS (SELECT user_id, linear, e, {seen} AS seen FROM a),
b2 AS (SELECT user_id, linear, e, {times('seen', w['o'])} AS o FROM b),
b3 AS (SELECT user_id, linear, {plus('e', 'o')} AS x FROM b2),
c AS (SELECT user_id, linear, {normal('x')} AS x FROM b3),
c2 AS (SELECT user_id, linear, x, list_transform({times('x', w['up'])}, lambda v: list_transform(v, lambda t: greatest(t, 0.0))) AS up FROM c),
c3 AS (SELECT user_id, linear, x, {times('up', w['down'])} AS down FROM c2),
c4 AS (SELECT user_id, linear, {plus('x', 'down')} AS x FROM c3),
d AS (SELECT user_id, linear, flatten({normal('x')}) AS x FROM c4),
r AS (SELECT user_id, linear, {dot}(x, {lit(p['w'])}) + {p['b']} AS logit FROM d)
{FINAL}"""


register("afm_score_users", ["M8"], sql=_pooled_sql())(_scores("pooled_pairs"))
register("cin_score_users", ["M9"], sql=_compressed_sql())(_scores("compressed"))
register("dcn_score_users", ["M10"], sql=_cross_sql())(_scores("cross"))
register("attention_score_users", ["M11"], sql=_attention_sql())(_scores("attention"))
