"""Column statistics in one pass (B2) and the long count table (B1).

Everything here is a single aggregate over the input (partial aggregation runs
map-side) followed by a reshape of a result whose size is bounded by the number of
columns or (column, bucket) pairs, never by the number of rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Columns whose Spark type is numeric."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    """Categorical (string) columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def columns_by_type_prefix(df: DataFrame, prefixes=("int", "float", "double", "bigint")) -> list[str]:
    """Pick columns whose simple type name starts with one of ``prefixes``."""
    return [f.name for f in df.schema.fields if f.dataType.simpleString().startswith(tuple(prefixes))]


def _stack(df: DataFrame, per_col: dict[str, list[tuple[str, Column]]], metrics: list[str]) -> DataFrame:
    """Run one aggregate and reshape its single row to (feature, metric...)."""
    aggs = []
    for c, items in per_col.items():
        for m, expr in items:
            aggs.append(expr.alias(f"{m}\x1f{c}"))
    row = df.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("feature"),
                        *[F.col(f"`{m}\x1f{c}`").alias(m) for m in metrics]) for c in per_col]
    return row.select(F.inline(F.array(*structs)))


def null_share(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Share of nulls per column, as (feature, null_ratio)."""
    cols = cols or df.columns
    per = {c: [("null_ratio", F.sum(F.col(c).isNull().cast("long")) / F.count(F.lit(1)))] for c in cols}
    return _stack(df, per, ["null_ratio"])


def distinct_counts(df: DataFrame, cols: list[str] | None = None, dropna: bool = False) -> DataFrame:
    """Distinct values per column; with ``dropna=False`` null counts as a value."""
    cols = cols or df.columns
    per = {}
    for c in cols:
        e = F.count_distinct(F.col(c))
        if not dropna:
            e = e + F.max(F.col(c).isNull().cast("long"))
        per[c] = [("n_distinct", e)]
    return _stack(df, per, ["n_distinct"])


def sample_skewness(c: str) -> Column:
    """Pandas-style (sample-adjusted) skewness; Spark's ``skewness`` is population."""
    n = F.count(F.col(c)).cast("double")
    return F.skewness(F.col(c)) * F.sqrt(n * (n - 1)) / (n - 2)


def column_stats(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """B2: count, nulls, mean, sample std, min, max, sample skew per numeric column."""
    cols = cols or numeric_columns(df)
    per = {}
    for c in cols:
        x = F.col(c).cast("double")
        per[c] = [("n", F.count(F.lit(1))), ("nulls", F.sum(F.col(c).isNull().cast("long"))),
                  ("mean", F.avg(x)), ("std", F.stddev_samp(x)), ("min", F.min(x)), ("max", F.max(x)),
                  ("skew", sample_skewness(c))]
    return _stack(df, per, ["n", "nulls", "mean", "std", "min", "max", "skew"])


def fit_minmax(df: DataFrame, cols: list[str], fill=None) -> dict[str, tuple[float, float]]:
    """Small fitted state: (min, max) per column, one aggregate row brought to the driver."""
    if not cols:
        return {}

    def v(c):
        x = F.col(c).cast("double")
        return F.coalesce(x, F.lit(float(fill))) if fill is not None else x
    row = df.agg(*[F.min(v(c)).alias(f"mn{i}") for i, c in enumerate(cols)],
                 *[F.max(v(c)).alias(f"mx{i}") for i, c in enumerate(cols)]).first()
    return {c: (row[f"mn{i}"], row[f"mx{i}"]) for i, c in enumerate(cols)}


def equal_width_bucket(x: Column, lo: float, hi: float, bins: int) -> Column:
    """Bucket 0..bins-1 of an equal-width cut on [lo, hi] with right-closed bins.

    Edges follow ``k*step + lo`` (the lowest edge is lowered by 0.1 % of the range,
    trap T6), so x == lo falls in bucket 0 and x == hi in the last bucket.
    """
    if lo is None or hi is None:
        return F.lit(None).cast("int")
    if hi == lo:
        # degenerate range: a single bucket in the middle (pandas widens the range)
        return F.when(x.isNotNull(), F.lit(bins // 2 if bins % 2 else bins // 2 - 1)).cast("int")
    step = (hi - lo) / bins
    parts = [F.when(x > F.lit(k) * F.lit(step) + F.lit(lo), 1).otherwise(0) for k in range(1, bins)]
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return F.when(x.isNotNull(), out)


def long_counts(df: DataFrame, label: str, buckets: dict[str, Column]) -> DataFrame:
    """B1: (feature, bucket, n, pos) from one explode + one grouped aggregate."""
    kv = F.explode(F.array(*[F.struct(F.lit(name).alias("feature"), e.cast("string").alias("bucket"))
                             for name, e in buckets.items()]))
    long = df.select(F.col(label).cast("long").alias("_y"), kv.alias("kv"))
    return (long.groupBy(F.col("kv.feature").alias("feature"), F.col("kv.bucket").alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("pos")))


def label_totals(df: DataFrame, label: str) -> tuple[int, int]:
    """Global (positives, negatives): one tiny aggregate row."""
    r = df.agg(F.sum(F.col(label).cast("long")).alias("p"), F.count(F.lit(1)).alias("n")).first()
    p = int(r["p"] or 0)
    return p, int(r["n"]) - p


def safe_ln(x: Column) -> Column:
    """Natural log that yields null instead of failing for x <= 0."""
    return F.when(x > 0, F.ln(x))


def isfinite(v) -> bool:
    return v is not None and not (isinstance(v, float) and (math.isnan(v) or math.isinf(v)))
