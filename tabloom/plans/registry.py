"""Named queries: a Spark callable ``(spark, sf_dir) -> DataFrame`` plus, where the
semantics are expressible, the equivalent DuckDB SQL used as the oracle."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Query:
    name: str
    fn: Callable
    sql: str | None
    ids: list[str] = field(default_factory=list)


QUERIES: dict[str, Query] = {}


def register(name: str, ids: list[str] | str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, sql, [ids] if isinstance(ids, str) else list(ids))
        return fn
    return deco


def r6(c) -> Column:
    """Round doubles to 6 places in query outputs (the oracle does the same)."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    out = []
    for f in df.schema.fields:
        if f.dataType.simpleString() in ("double", "float"):
            out.append(F.round(F.col(f"`{f.name}`").cast("double"), places).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def load_all():
    """Import every query module so that registration runs."""
    from . import q_binning, q_core, q_encode, q_eval, q_func, q_graph, q_guide, q_heads, q_io, q_select, q_stream, q_topics, q_train  # noqa: F401
    return QUERIES
