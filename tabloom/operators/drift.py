"""Population stability (E13, E14) from one long count table per comparison.

Rows are bucketed with expressions fitted on the base part (quantile or
equal-width edges, or the base's categories), counted per (part, feature, bucket)
in one grouped aggregate, and compared on the small count table.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .encode import quantile_edges
from .stats import equal_width_bucket

NAN_BUCKET = "__nan__"


def _share_table(df: DataFrame, part: str, buckets: dict[str, Column]) -> DataFrame:
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), e.cast("string").alias("bucket"))
                             for c, e in buckets.items()]))
    cnt = (df.select(F.col(part).alias("part"), kv.alias("kv"))
           .groupBy("part", F.col("kv.feature").alias("feature"), F.col("kv.bucket").alias("bucket"))
           .agg(F.count(F.lit(1)).alias("n")))
    return cnt


def monthly_psi(df: DataFrame, month: str, cat_cols: list[str], num_cols: list[str], time_span: int = 4,
                bins: int = 10, eps: float = 1e-6) -> DataFrame:
    """Newest month is the base, compared with each of the previous
    ``time_span - 1`` months. Numeric: equal-width bins of the base range (values
    outside fall in the null bucket); categorical: values with null as a value.
    A bucket present on one side only drops out of the sum (trap T15)."""
    months = [r[0] for r in df.select(month).distinct().orderBy(F.desc(month)).limit(time_span).collect()]
    base_m = months[0]
    sub = df.filter(F.col(month).isin(months))
    base = sub.filter(F.col(month) == base_m)
    mm = base.agg(*[F.min(F.col(c).cast("double")).alias(f"lo_{c}") for c in num_cols],
                  *[F.max(F.col(c).cast("double")).alias(f"hi_{c}") for c in num_cols]).first() if num_cols else {}
    buckets = {c: F.coalesce(F.col(c).cast("string"), F.lit(NAN_BUCKET)) for c in cat_cols}
    grid = []
    for c in num_cols:
        lo, hi = mm[f"lo_{c}"], mm[f"hi_{c}"]
        x = F.col(c).cast("double")
        e0 = lo - (hi - lo) * 0.001
        inside = (x > F.lit(e0)) & (x <= F.lit(hi))
        buckets[c] = F.when(inside, equal_width_bucket(x, lo, hi, bins).cast("string")).otherwise(F.lit(NAN_BUCKET))
        grid += [(c, str(i)) for i in range(bins)]
    cnt = _share_table(sub, month, buckets)
    spark = df.sparkSession
    if grid:
        g = (spark.createDataFrame(grid, "feature string, bucket string")
             .withColumn("part", F.explode(F.array(*[F.lit(m) for m in months]))))
        rest = cnt.filter(~F.col("feature").isin(num_cols) | (F.col("bucket") == NAN_BUCKET))
        cnt = g.join(cnt, ["part", "feature", "bucket"], "left").fillna(0, ["n"]).unionByName(rest)
    tot = cnt.groupBy("part", "feature").agg(F.sum("n").alias("tot"))
    sh = cnt.join(tot, ["part", "feature"]).withColumn("share", F.col("n") / F.col("tot"))
    b = sh.filter(F.col("part") == base_m).select("feature", "bucket", F.col("share").alias("b"))
    o = sh.filter(F.col("part") != base_m).select("part", "feature", "bucket", F.col("share").alias("c"))
    j = o.join(b, ["feature", "bucket"])  # inner: one-sided buckets vanish
    psi = j.groupBy("part", "feature").agg(F.sum((F.col("b") - F.col("c")) * F.ln((F.col("b") + eps) / (F.col("c") + eps))).alias("psi"))
    label = {m: f"N-{i}" for i, m in enumerate(months) if i > 0}
    lab = F.create_map(*[x for m, n in label.items() for x in (F.lit(m), F.lit(n))])
    out = psi.withColumn("lag", lab[F.col("part")]).groupBy("feature").pivot("lag", list(label.values())).agg(F.first("psi"))
    return out.withColumn("avg", sum(F.coalesce(F.col(n), F.lit(0.0)) for n in label.values()) / F.lit(float(len(label))))


MISSING = "_missing"


@dataclass
class PsiBase:
    """What later rows are compared with: the inner edges of continuous columns (a few each) and the table
    (feature, bucket, n) of the base rows, empty bins and ``_missing`` included."""

    edges: dict
    discrete: list
    counts: DataFrame


def _buckets(df: DataFrame, edges: dict, discrete: list[str]) -> dict[str, Column]:
    """Bucket of every column as a text: the number of a bin, or a discrete value as it is; null is ``_missing`` but for
    texts, where it is the value 'nan'."""
    out = {}
    for c, inner in edges.items():
        x = F.col(c).cast("double")
        place = sum((F.when(x > F.lit(v), 1).otherwise(0) for v in inner), F.lit(0))
        out[c] = F.when(x.isNull(), F.lit(MISSING)).otherwise(place.cast("string"))
    for c in discrete:
        out[c] = F.coalesce(F.col(c).cast("string"), F.lit("nan" if df.schema[c].dataType.simpleString() == "string" else MISSING))
    return out


def psi_base(base: DataFrame, continuous: list[str] = (), discrete: list[str] = (), bins: int = 10) -> PsiBase:
    """Quantile bins of the base rows, open at both ends, and their counts; the values of a discrete column stay a table."""
    found = {c: quantile_edges(base.filter(F.col(c).isNotNull()), c, bins) for c in continuous}
    edges = {c: e[1:-1] if len(e) > 1 else [] for c, e in found.items()}
    spark = base.sparkSession
    counted = _share_table(base.withColumn("__part", F.lit(0)), "__part", _buckets(base, edges, list(discrete))).select("feature", "bucket", "n")
    grid = [(c, str(i)) for c, e in edges.items() for i in range(len(e) + 1)] + [(c, MISSING) for c in [*edges, *discrete]]
    empty = spark.createDataFrame(grid, "feature string, bucket string").withColumn("n", F.lit(0).cast("long"))
    whole = counted.unionByName(empty).groupBy("feature", "bucket").agg(F.sum("n").alias("n"))
    return PsiBase(edges, list(discrete), cut_lineage(whole))


def save_base(base: PsiBase, path: str) -> None:
    base.counts.write.mode("overwrite").parquet(f"{path}/counts")
    said = json.dumps({"edges": base.edges, "discrete": base.discrete})
    base.counts.sparkSession.createDataFrame([(said,)], "base string").coalesce(1).write.mode("overwrite").text(f"{path}/base")


def load_base(spark: SparkSession, path: str) -> PsiBase:
    said = json.loads(spark.read.text(f"{path}/base").first()[0])
    return PsiBase(said["edges"], said["discrete"], spark.read.parquet(f"{path}/counts"))


def psi_detail(df: DataFrame, part: str, base: PsiBase, parts: list, minimal: int = 1) -> DataFrame:
    """(var, part, bucket, n, share, base_share, term) of every bucket of the base in every part; a part's psi is the sum
    of its terms. Values the base has not are ``_missing``. Empty buckets count ``minimal``; ``_missing`` is left out
    where neither the base nor a part has any. The parts are given; buckets are joined, never collected."""
    kind = df.schema[part].dataType
    seen = _share_table(df.filter(F.col(part).isin(parts)), part, _buckets(df, base.edges, base.discrete))
    known = base.counts.select("feature", "bucket", F.lit(True).alias("known"))
    seen = (seen.join(known, ["feature", "bucket"], "left").withColumn("bucket", F.when(F.col("known"), F.col("bucket")).otherwise(F.lit(MISSING)))
            .groupBy("part", "feature", "bucket").agg(F.sum("n").alias("n")))
    grid = base.counts.select("feature", "bucket", F.col("n").alias("base_n"), F.explode(F.array(*[F.lit(p).cast(kind) for p in parts])).alias("part"))
    full = cut_lineage(grid.join(seen, ["part", "feature", "bucket"], "left").fillna(0, ["n"]))
    any_missing = full.filter(F.col("bucket") == MISSING).groupBy("feature").agg((F.max("n") + F.max("base_n") > 0).alias("has"))
    full = full.join(any_missing, "feature").filter((F.col("bucket") != MISSING) | F.col("has"))
    at_least = lambda c: F.when(F.col(c) == 0, F.lit(minimal)).otherwise(F.col(c)).cast("double")
    full = full.select("part", "feature", "bucket", at_least("n").alias("n"), at_least("base_n").alias("base_n"))
    total = full.groupBy("part", "feature").agg(F.sum("n").alias("t"), F.sum("base_n").alias("bt"))
    share, base_share = F.col("n") / F.col("t"), F.col("base_n") / F.col("bt")
    return full.join(total, ["part", "feature"]).select(F.col("feature").alias("var"), "part", "bucket", F.col("n").cast("long").alias("n"), share.alias("share"), base_share.alias("base_share"),
                                                        ((base_share - share) * F.ln(base_share / share)).alias("term"))


def psi_table(df: DataFrame, part: str, continuous: list[str] = (), discrete: list[str] = (), bins: int = 10,
              minimal: int = 1, part_values: list | None = None) -> DataFrame:
    """(var, part, psi) of every part against the first one."""
    parts = part_values or [r[0] for r in df.select(part).distinct().orderBy(part).collect()]
    base = psi_base(df.filter(F.col(part) == parts[0]), continuous, discrete, bins)
    return psi_detail(df, part, base, parts, minimal).groupBy("var", "part").agg(F.sum("term").alias("psi"))
