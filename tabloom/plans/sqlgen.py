"""Small SQL text builders for oracle statements (DuckDB dialect)."""

from __future__ import annotations


def ew_bucket_sql(x: str, lo: str, hi: str, bins: int) -> str:
    """SQL twin of ``stats.equal_width_bucket``: edges k*((hi-lo)/bins) + lo."""
    step = f"(({hi}) - ({lo})) / {float(bins)}"
    parts = [f"(CASE WHEN {x} > {k} * ({step}) + ({lo}) THEN 1 ELSE 0 END)" for k in range(1, bins)]
    mid = bins // 2 if bins % 2 else bins // 2 - 1
    return (f"(CASE WHEN {x} IS NULL THEN NULL WHEN ({hi}) = ({lo}) THEN {mid} "
            f"ELSE {' + '.join(parts)} END)")


def r6(expr: str, alias: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) AS {alias}"


def edges_bucket_sql(x: str, edges: list[float]) -> str:
    """SQL twin of ``encode.bucket_by_edges`` (right-closed, lowest edge included)."""
    if len(edges) < 2:
        return "NULL"
    inner = " + ".join([f"(CASE WHEN {x} > {e!r} THEN 1 ELSE 0 END)" for e in edges[1:-1]]) or "0"
    return f"(CASE WHEN {x} >= {edges[0]!r} AND {x} <= {edges[-1]!r} THEN {inner} END)"
