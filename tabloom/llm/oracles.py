"""DuckDB SQL for the queries that SQL can express."""

OP1 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP4 = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.*, f.last IS NOT NULL AND f.last <> k.doc_id AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""



def _lloyd(k: int, rounds: int, width: int) -> str:
    """Components in long form: x (row, i, v), and a pair of tables a round: c (cluster, i, v), n (row, cluster, distance)."""
    near = """n{i} AS MATERIALIZED (
  SELECT row, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM (
    SELECT x.row, c.cluster, CAST(sum((x.v - c.v) * (x.v - c.v)) AS BIGINT) AS d FROM x JOIN c{i} c USING (i) GROUP BY ALL) GROUP BY row)"""
    move = """c{j} AS MATERIALIZED (
  SELECT c.cluster, c.i, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN (
    SELECT n.cluster, x.i, (sum(x.v) - (sum(x.v) % count(*) + count(*)) % count(*)) // count(*) AS v FROM x JOIN n{i} n USING (row) GROUP BY ALL) m USING (cluster, i))"""
    parts = [f"""q AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0)""",
             f"x AS MATERIALIZED (SELECT row, unnest(v) AS v, unnest(range({width})) AS i FROM q)",
             f"""f AS (SELECT *, row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS cluster FROM q WHERE vec_id IS NOT NULL QUALIFY cluster < {k})""",
             f"c0 AS MATERIALIZED (SELECT cluster, unnest(v) AS v, unnest(range({width})) AS i FROM f)"]
    for i in range(rounds):
        parts += [near.format(i=i), move.format(i=i, j=i + 1)]
    parts.append(near.format(i=rounds))
    parts.append(f"h AS (SELECT cluster, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)")
    return "WITH " + ",\n".join(parts) + f"""
SELECT q.vec_id, CAST(n.cluster AS INTEGER) AS cluster, n.distance, CAST(sum(n.distance) OVER (PARTITION BY n.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(n.distance) OVER () AS BIGINT) AS inertia, h.centroid_sha256
FROM n{rounds} n JOIN q USING (row) JOIN h USING (cluster)"""


OP11 = _lloyd(40, 5, 64)

SQL = {"op1_exact_topk": OP1, "op4_line_dedup": OP4, "op11_centroids": OP11}
