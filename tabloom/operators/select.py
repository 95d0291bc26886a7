"""Feature selection (X1-X6) and one-to-many feature synthesis.

Selection decisions come from single-pass statistics (B2) and the IV table (B1);
the result of each step is a small report DataFrame (feature, metric, dropped) and
the list of columns to drop. Synthesis is a generated ``groupBy(parent key).agg``
per relation, joined back to the parent (no per-row Python).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stats import distinct_counts, null_share, numeric_columns, string_columns


# ------------------------------------------------------------------ X1 ------------
def null_report(df: DataFrame, null_percent: float = 0.8, cols=None) -> DataFrame:
    """(feature, null_ratio, dropped) with dropped = null_ratio >= threshold."""
    return null_share(df, cols).withColumn("dropped", (F.col("null_ratio") >= null_percent).cast("int"))


# ------------------------------------------------------------------ X2 ------------
def category_report(df: DataFrame, category_threshold: int = 50, int_encoded: list[str] = ()) -> DataFrame:
    """Categoricals with > threshold or exactly one value (null counts), numerics
    with one value -> dropped."""
    cats = string_columns(df) + [c for c in int_encoded if c in df.columns]
    nums = [c for c in numeric_columns(df) if c not in cats]
    parts = []
    if cats:
        parts.append(distinct_counts(df, cats).withColumn("kind", F.lit("category"))
                     .withColumn("dropped", ((F.col("n_distinct") > category_threshold) | (F.col("n_distinct") == 1)).cast("int")))
    if nums:
        parts.append(distinct_counts(df, nums).withColumn("kind", F.lit("numeric"))
                     .withColumn("dropped", (F.col("n_distinct") == 1).cast("int")))
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------ X3/X4 ---------
def iv_report(iv: DataFrame, iv_threshold: float = 0.02) -> DataFrame:
    """Drop columns whose IV <= threshold."""
    return iv.withColumn("dropped", (F.col("iv") <= iv_threshold).cast("int"))


def importance_report(imp: DataFrame, score_quantile: float | None = None, score_threshold: float | None = None,
                      drop_less: bool = False, feature: str = "feature", score: str = "score") -> DataFrame:
    """Threshold from a quantile of the scores (``is not None``, trap T37) or given;
    drop_less drops listed-and-low, else keeps only listed-and-high."""
    if score_quantile is None and score_threshold is None:
        raise ValueError("give score_threshold or score_quantile")
    thr = (imp.select(F.percentile(F.col(score), score_quantile)).scalar() if score_quantile is not None
           else F.lit(float(score_threshold)))
    if drop_less:
        dropped = F.col(score) < thr
    else:
        dropped = ~(F.col(score) >= thr)
    return imp.select(F.col(feature).alias("feature"), F.col(score).alias("score"), thr.alias("threshold"),
                      dropped.cast("int").alias("dropped"))


# ------------------------------------------------------------------ X5 ------------
def correlation_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """All pairwise Pearson correlations (pairwise-complete, T8) in ONE aggregate:
    (col1, col2, corr) for i < j. Work is rows x pairs, output is pairs."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    row = df.agg(*[F.corr(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    structs = [F.struct(F.lit(a).alias("col1"), F.lit(b).alias("col2"), F.col(f"`{i}`").alias("corr"))
               for i, (a, b) in enumerate(pairs)]
    return row.select(F.inline(F.array(*structs)))


def correlation_prune(df: DataFrame, cols: list[str], threshold: float = 0.99) -> tuple[list[str], list[tuple]]:
    """Walk |r| > t pairs in upper-triangle order; keep the earlier column unless it
    was already dropped. Returns (dropped columns, [(kept, dropped, r)])."""
    rows = correlation_pairs(df, cols).collect()  # bounded: k*(k-1)/2 rows
    pos = {c: i for i, c in enumerate(cols)}
    hits = sorted([r for r in rows if r["corr"] is not None and abs(r["corr"]) > threshold],
                  key=lambda r: (pos[r["col1"]], pos[r["col2"]]))
    dropped, report = [], []
    for r in hits:
        if r["col1"] not in dropped:
            dropped.append(r["col2"])
            report.append((r["col1"], r["col2"], r["corr"]))
    return sorted(set(dropped), key=pos.get), report


# ------------------------------------------------------------------ X6 ------------
def feature_extract(df: DataFrame, label: str, null_percent: float = 0.8, category_threshold: int = 50,
                    iv: DataFrame | None = None, iv_threshold: float = 0.02, imp: DataFrame | None = None,
                    imp_threshold: float | None = None, drop_less: bool = False, unuse: list[str] = ()) -> DataFrame:
    """X1 -> X2 -> X3 -> X4 -> explicit drops. Returns (feature, step) for every
    dropped column; the kept columns are the rest."""
    steps = []
    cur = df
    feats = [c for c in df.columns if c != label]
    nr = null_report(cur, null_percent, feats).filter("dropped = 1").select("feature").collect()
    d1 = [r[0] for r in nr]
    steps += [(c, "null") for c in d1]
    cur = cur.drop(*d1)
    cr = category_report(cur.drop(label), category_threshold).filter("dropped = 1").select("feature").collect()
    d2 = [r[0] for r in cr]
    steps += [(c, "category") for c in d2]
    cur = cur.drop(*d2)
    if iv is not None:
        d3 = [r[0] for r in iv_report(iv, iv_threshold).filter("dropped = 1").collect() if r[0] in cur.columns]
        steps += [(c, "iv") for c in d3]
        cur = cur.drop(*d3)
    if imp is not None and imp_threshold is not None:
        rep = importance_report(imp, score_threshold=imp_threshold, drop_less=drop_less)
        if drop_less:
            d4 = [r[0] for r in rep.filter("dropped = 1").collect() if r[0] in cur.columns]
        else:
            keep = {r[0] for r in rep.filter("dropped = 0").collect()}
            d4 = [c for c in cur.columns if c not in keep and c != label]
        steps += [(c, "importance") for c in d4]
        cur = cur.drop(*d4)
    d5 = [c for c in unuse if c in cur.columns]
    steps += [(c, "unused") for c in d5]
    return df.sparkSession.createDataFrame(steps or [("", "none")], "feature string, step string").filter("feature != ''")


# ------------------------------------------------------------------ X10-X14 -------
PRIMITIVES: dict[str, callable] = {
    "count": lambda c: F.count(F.lit(1)),
    "mean": lambda c: F.avg(c),
    "sum": lambda c: F.sum(c),
    "max": lambda c: F.max(c),
    "min": lambda c: F.min(c),
    "std": lambda c: F.stddev_samp(c),
    "percent_true": lambda c: F.avg(c.cast("double")),
}
TRANSFORMS: dict[str, callable] = {
    "month": lambda c: F.month(c),
    "year": lambda c: F.year(c),
    "weekday": lambda c: F.dayofweek(c),
}


PAIRS: dict[str, callable] = {}


def register_primitive(name: str, fn, kind: str = "agg"):
    """User primitive: "agg" many rows to one, "trans" one column, "trans2" two columns (Columns -> Column)."""
    {"agg": PRIMITIVES, "trans": TRANSFORMS, "trans2": PAIRS}[kind][name] = fn


def encode_top(df: DataFrame, col: str, n: int) -> tuple[DataFrame, list[str]]:
    """A 0/1 column ``<col>_<value>`` for each of the ``n`` most frequent values (ties: the smaller), and those values."""
    found = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("__n")).orderBy(F.desc("__n"), col).limit(n).collect()
    top = [str(r[col]) for r in found]
    return df.withColumns({f"{col}_{v}": (F.col(col).cast("string") == v).cast("int") for v in top}), top


def dfs(parent: DataFrame, parent_key: str, child: DataFrame, child_key: str, child_name: str,
        numeric: list[str] = (), booleans: dict[str, Column] | None = None, seeds: dict[str, Column] | None = None,
        where: dict[str, tuple[str, list]] | None = None, aggs=("mean", "max", "min"),
        trans: dict[str, str] | None = None, ignore: list[str] = (), max_features: int | None = None,
        pairs: dict[tuple[str, str], str] | None = None) -> DataFrame:
    """Depth-1 deep feature synthesis: COUNT(child), <agg>(child.numeric),
    PERCENT_TRUE(child.boolean), seed features (boolean exprs), WHERE primitives
    (count per interesting value) and transforms of one or two columns (``pairs``) on the
    parent. ``max_features`` caps the aggregates, in this order."""
    feats: dict[str, Column] = {f"COUNT({child_name})": F.count(F.lit(1))}
    for c in numeric:
        if c in ignore:
            continue
        for a in aggs:
            feats[f"{a.upper()}({child_name}.{c})"] = PRIMITIVES[a](F.col(c))
    for name, e in (booleans or {}).items():
        feats[f"PERCENT_TRUE({child_name}.{name})"] = PRIMITIVES["percent_true"](e)
    for name, e in (seeds or {}).items():
        feats[f"PERCENT_TRUE({child_name}.{name})"] = F.avg(e.cast("double"))
    for col, (_, values) in (where or {}).items():
        for v in values:
            feats[f"COUNT({child_name} WHERE {col} = {v})"] = F.count_if(F.col(col) == F.lit(v))
    names = list(feats)
    if max_features is not None:
        names = names[:max_features]
    agg = child.groupBy(F.col(child_key).alias(parent_key)).agg(*[feats[n].alias(n) for n in names])
    out = parent.join(agg, parent_key, "left").fillna(0, [f"COUNT({child_name})"])
    for col, t in (trans or {}).items():
        out = out.withColumn(f"{t.upper()}({col})", TRANSFORMS[t](F.col(col)))
    for (a, b), t in (pairs or {}).items():
        out = out.withColumn(f"{t.upper()}({a}, {b})", PAIRS[t](F.col(a), F.col(b)))
    return out
