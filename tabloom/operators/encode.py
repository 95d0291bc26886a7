"""Encoders as fit -> transform.

Fitted state is a DataFrame written once to the shared folder (or, for a few scalars,
a dict brought back from one aggregate row). Transforms are native column expressions
and left joins on the fitted table; they start no jobs of their own. No Python runs
per row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .rank import ordered_scan
from .stats import equal_width_bucket, fit_minmax, label_totals

def _str(c) -> Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def lookup(df: DataFrame, col: str, table: DataFrame, key: str, value: str, out: str,
           default=None, key_expr: Column | None = None) -> DataFrame:
    """Add ``out`` = table[value] looked up by ``key_expr`` (default: the column): one left join on a
    fitted table of unique keys, for which Spark picks the strategy from its runtime size."""
    k = key_expr if key_expr is not None else F.col(col)
    t = table.select(F.col(key).alias("_lk"), F.col(value).alias(out))
    res = df.withColumn("_lk", k).join(t, "_lk", "left").drop("_lk")
    if default is not None:
        res = res.withColumn(out, F.coalesce(F.col(out), default if isinstance(default, Column) else F.lit(default)))
    return res


# ---------------------------------------------------------------- N1 normalise ----
def normalize_fit(df: DataFrame, cols: list[str], ddof: int = 1) -> dict:
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"mean{i}"), (F.stddev_samp(x) if ddof == 1 else F.stddev_pop(x)).alias(f"std{i}"),
                 F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}")]
    r = df.agg(*aggs).first()
    return {c: {"mean": r[f"mean{i}"], "std": r[f"std{i}"], "min": r[f"min{i}"], "max": r[f"max{i}"]}
            for i, c in enumerate(cols)}


def normalize_transform(df: DataFrame, scaler: dict, kind: str = "z-score", epsilon: float = 1e-8,
                        lbound: float = 0.0, hbound: float = 1.0) -> DataFrame:
    """F9 arithmetic: nulls take the fitted mean, then z-score or clamped min-max."""
    cols = {}
    for c, s in scaler.items():
        x = F.coalesce(F.col(c).cast("double"), F.lit(s["mean"]))
        if kind == "z-score":
            cols[c] = (x - F.lit(s["mean"])) / (F.lit(s["std"]) + F.lit(epsilon))
        else:
            v = F.lit(lbound) + F.coalesce(F.try_divide(x - F.lit(s["min"]), F.lit(s["max"]) - F.lit(s["min"])), F.lit(0.0)) * F.lit(hbound - lbound)
            cols[c] = F.least(F.greatest(v, F.lit(lbound)), F.lit(hbound))
    return df.withColumns(cols)


# ------------------------------------------------------------ N2 target encode ----
def target_fit(df: DataFrame, label: str, cols: list[str], min_samples_leaf: int = 1, smoothing: float = 1.0,
               handle_missing: str = "encoder") -> DataFrame:
    """(feature, value, n, mean, code); value null is the missing category."""
    prior = df.agg(F.avg(F.col(label).cast("double"))).first()[0]
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), _str(c).alias("value")) for c in cols]))
    g = (df.select(F.col(label).cast("double").alias("_y"), kv.alias("kv"))
         .groupBy("kv.feature", "kv.value").agg(F.count(F.lit(1)).alias("n"), F.avg("_y").alias("mean")))
    s = 1.0 / (1.0 + F.exp(-(F.col("n") - F.lit(min_samples_leaf)) / F.lit(float(smoothing))))
    code = F.when(F.col("n") <= 1, F.lit(prior)).otherwise(F.lit(prior) * (1 - s) + F.col("mean") * s)
    if handle_missing == "mean":
        code = F.when(F.col("value").isNull(), F.lit(prior)).otherwise(code)
    elif handle_missing == "coerce":
        code = F.when(F.col("value").isNull(), F.lit(None)).otherwise(code)
    return cut_lineage(g.withColumn("code", code).withColumn("prior", F.lit(prior)))


def target_transform(df: DataFrame, fitted: DataFrame, cols: list[str], handle_unknown: str = "mean") -> DataFrame:
    prior = fitted.agg(F.max("prior")).scalar()
    out = df
    for c in cols:
        t = fitted.filter(F.col("feature") == c)
        nulls = t.filter(F.col("value").isNull())
        # A fitted null category counts even if its code is null; without one the prior stands in.
        null_code = F.when(nulls.agg(F.count(F.lit(1))).scalar() > 0, nulls.agg(F.max("code")).scalar()).otherwise(prior)
        known = t.filter(F.col("value").isNotNull())
        out = lookup(out, c, known, "value", "code", f"_{c}_code", key_expr=_str(c))
        unknown = {"mean": prior, "coerce": F.lit(None).cast("double"),
                   "error": F.raise_error(F.lit(f"unknown category in {c}")).cast("double")}[handle_unknown]
        out = out.withColumn(c, F.when(F.col(c).isNull(), null_code.cast("double"))
                             .otherwise(F.coalesce(F.col(f"_{c}_code"), unknown))).drop(f"_{c}_code")
    return out


# ---------------------------------------------------------------- N6 WOE ----------
def woe_fit(df: DataFrame, label: str, cols: list[str], reg: float = 1.0, dummy_na: bool = True,
            replace_na: str = "-99") -> DataFrame:
    """(feature, value, pos, neg, woe) with woe = ln((pos+r)/(neg+r)) - ln((P+2r)/(N+2r))."""
    P, N = label_totals(df, label)
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"),
                                      F.coalesce(_str(c), F.lit(replace_na)).alias("value")) for c in cols]))
    g = (df.select(F.col(label).cast("long").alias("_y"), kv.alias("kv"))
         .groupBy(F.col("kv.feature").alias("feature"), F.col("kv.value").alias("value"))
         .agg(F.sum("_y").alias("pos"), (F.count(F.lit(1)) - F.sum("_y")).alias("neg")))
    woe = (F.ln((F.col("pos") + reg) / (F.col("neg") + reg))
           - F.lit(math.log((P + 2 * reg) / (N + 2 * reg))))
    if not dummy_na:
        woe = F.when(F.col("value") == replace_na, F.lit(0.0)).otherwise(woe)
    return cut_lineage(g.withColumn("woe", woe))


def woe_transform(df: DataFrame, fitted: DataFrame, cols: list[str], handle_unknown: str = "coerce",
                  replace_na: str = "-99") -> DataFrame:
    """Unknown: 'coerce' -> null, 'zero' -> 0, 'error' -> raise."""
    out = df
    for c in cols:
        t = fitted.filter(F.col("feature") == c)
        out = lookup(out, c, t, "value", "woe", f"_{c}_w", key_expr=F.coalesce(_str(c), F.lit(replace_na)))
        unk = {"coerce": F.lit(None).cast("double"), "zero": F.lit(0.0),
               "error": F.raise_error(F.lit(f"unknown category in {c}")).cast("double")}[handle_unknown]
        out = out.withColumn(c, F.coalesce(F.col(f"_{c}_w"), unk)).drop(f"_{c}_w")
    return out


# ---------------------------------------------------------------- N4 label --------
def label_fit(df: DataFrame, cols: list[str], na_value: str = "-99") -> DataFrame:
    """(feature, value, code): codes follow sorted *string* order (trap T4)."""
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"),
                                      F.coalesce(_str(c), F.lit(na_value)).alias("value")) for c in cols]))
    vals = df.select(kv.alias("kv")).select("kv.*").distinct()
    ranked = ordered_scan(vals, [("value", True)], by=["feature"], rank_col="_r")
    return cut_lineage(ranked.select("feature", "value", (F.col("_r") - 1).alias("code")))


def label_transform(df: DataFrame, fitted: DataFrame, cols: list[str], handle_unknown: str = "uk",
                    na_value: str = "-99") -> DataFrame:
    out = df
    for c in cols:
        t = fitted.filter(F.col("feature") == c)
        top = t.agg(F.max("code")).scalar()
        out = lookup(out, c, t, "value", "code", f"_{c}_c", key_expr=F.coalesce(_str(c), F.lit(na_value)))
        unk = (top + 1 if handle_unknown == "uk"
               else F.raise_error(F.lit(f"unknown category in {c}")).cast("long"))
        out = out.withColumn(c, F.coalesce(F.col(f"_{c}_c"), unk).cast("long")).drop(f"_{c}_c")
    return out


# ---------------------------------------------------------------- N3 one-hot ------
def onehot_fit(df: DataFrame, cols: list[str], category_threshold: int = 50, dummy_na: bool = True,
               replace_na: str = "-99") -> dict[str, list[str]]:
    """Categories per kept column; columns with > threshold or one category are dropped."""
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"),
                                      (F.coalesce(_str(c), F.lit(replace_na)) if dummy_na else _str(c)).alias("value"))
                             for c in cols]))
    vals = df.select(kv.alias("kv")).select("kv.*").dropna().distinct()
    counts = vals.groupBy("feature").count()
    keep = counts.filter((F.col("count") <= category_threshold) & (F.col("count") > 1)).select("feature")
    # bounded: at most threshold values per kept column
    rows = vals.join(keep, "feature").collect()
    cats: dict[str, list[str]] = {}
    for r in rows:
        cats.setdefault(r["feature"], []).append(r["value"])
    return {c: sorted(cats[c]) for c in cols if c in cats}


def onehot_transform(df: DataFrame, cats: dict[str, list[str]], drop_source: bool = True,
                     replace_na: str = "-99") -> DataFrame:
    cols = {}
    for c, values in cats.items():
        x = F.coalesce(_str(c), F.lit(replace_na))
        for v in values:
            cols[f"{c}_{v}"] = (x == F.lit(v)).cast("int")
    out = df.withColumns(cols)
    return out.drop(*cats.keys()) if drop_source else out


# ---------------------------------------------------------------- N5 mean ---------
def mean_fit(df: DataFrame, label: str, cols: list[str], n_critical: float = 1, scale_factor: float = 1,
             dummy_na: bool = True, replace_na: str = "-99") -> DataFrame:
    """(feature, value, cls, code): smoothed by the *cell* count (trap T33), row-normalised."""
    total = df.count()
    prior = df.groupBy(F.col(label).alias("cls")).agg((F.count(F.lit(1)) / F.lit(total)).alias("prior"))
    classes = [r[0] for r in prior.select("cls").collect()]  # bounded: number of classes
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"),
                                      F.coalesce(_str(c), F.lit(replace_na)).alias("value")) for c in cols]))
    cell = (df.select(F.col(label).alias("cls"), kv.alias("kv"))
            .groupBy(F.col("kv.feature").alias("feature"), F.col("kv.value").alias("value"), "cls")
            .agg(F.count(F.lit(1)).alias("cnt")))
    values = cell.select("feature", "value").distinct()
    # complete the (value, class) grid by exploding the (bounded) class list
    full = (values.withColumn("cls", F.explode(F.array(*[F.lit(c) for c in classes])))
            .join(cell, ["feature", "value", "cls"], "left").fillna(0, ["cnt"])
            .join(prior, "cls"))
    w = Window.partitionBy("feature", "value")
    post = F.col("cnt") / F.sum("cnt").over(w)
    smooth = 1.0 / (1.0 + F.exp(-(F.col("cnt") - F.lit(n_critical)) / F.lit(float(scale_factor))))
    raw = (1 - smooth) * F.col("prior") + smooth * post
    out = full.withColumn("raw", raw).withColumn("code", F.col("raw") / F.sum("raw").over(w))
    if not dummy_na:
        out = out.withColumn("code", F.when(F.col("value") == replace_na, F.col("prior")).otherwise(F.col("code")))
    return out.select("feature", "value", "cls", "cnt", "code")


def mean_transform(df: DataFrame, fitted: DataFrame, cols: list[str], drop_last: bool = False, replace_na: str = "-99") -> DataFrame:
    """Each column of ``cols`` becomes ``<column>_<class>``, one a class (the last one left out with ``drop_last``);
    a value that was not there at the fit gets the prior. ``fitted``: the table of ``mean_fit``, looked up by a join."""
    some = fitted.filter(F.col("feature") == fitted.select(F.min("feature")).scalar()).groupBy("cls").agg(F.sum("cnt").alias("n")).collect()  # a row a class
    total = sum(r["n"] for r in some)
    prior = {str(r["cls"]): r["n"] / total for r in some} if total else {}
    classes = sorted(prior)[:-1] if drop_last else sorted(prior)
    out = df
    for c in cols:
        wide = fitted.filter(F.col("feature") == c).groupBy(F.col("value").alias("__value")).agg(*[F.max(F.when(F.col("cls").cast("string") == k, F.col("code"))).alias(f"__{k}") for k in classes])
        out = out.withColumn("__value", F.coalesce(_str(c), F.lit(replace_na))).join(wide, "__value", "left")
        out = out.withColumns({f"{c}_{k}": F.coalesce(F.col(f"__{k}"), F.lit(prior[k])) for k in classes}).drop("__value", *[f"__{k}" for k in classes])
    return out.drop(*cols)


# ---------------------------------------------------------------- N7 factorise ----
def factorize(df: DataFrame, col: str, order_col: str, out: str | None = None, na_sentinel: int = -1) -> DataFrame:
    """Codes by first appearance along ``order_col`` (trap T3: an explicit order)."""
    out = out or col
    first = (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.min(order_col).alias("_first")))
    codes = ordered_scan(first, [("_first", True), (col, True)], rank_col="_code")
    codes = codes.select(col, (F.col("_code") - 1).alias("_code"))
    res = df.join(codes, col, "left")
    return res.withColumn(out, F.coalesce(F.col("_code"), F.lit(na_sentinel)).cast("long")).drop("_code")


# ---------------------------------------------------------------- N8/N11/N13 -------
def cast_to_numeric(df: DataFrame, cols: list[str], errors: str = "raise") -> DataFrame:
    """Raise (ANSI cast), coerce (null on failure), ignore (leave column when any fails)."""
    if errors == "raise":
        return df.withColumns({c: F.col(c).cast("double") for c in cols})
    if errors == "coerce":
        return df.withColumns({c: F.col(c).try_cast("double") for c in cols})
    bad = df.agg(*[F.sum((F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()).cast("long")).alias(c)
                   for c in cols]).first()
    return df.withColumns({c: F.col(c).cast("double") for c in cols if not bad[c]})


INT_RANGES = [("tinyint", -128, 127), ("smallint", -32768, 32767),
              ("int", -2147483648, 2147483647), ("bigint", -9223372036854775808, 9223372036854775807)]


def downcast_integer_type(lo, hi, strict: bool = False) -> str | None:
    for name, a, b in INT_RANGES:
        if (strict and a < lo and hi < b) or (not strict and a <= lo and hi <= b):
            return name
    return None


def float_to_int_if_integral(df: DataFrame, cols: list[str], replace_na: int = -99) -> tuple[DataFrame, list[str]]:
    """After filling nulls, an integral float column becomes an integer *string*."""
    checks = df.agg(*[F.bool_and(F.coalesce(F.col(c), F.lit(float(replace_na))) ==
                                 F.floor(F.coalesce(F.col(c), F.lit(float(replace_na))))).alias(c) for c in cols]).first()
    ok = [c for c in cols if checks[c]]
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(float(replace_na))).cast("bigint").cast("string")
                           for c in ok}), ok


def narrow_types(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Smallest type from observed min/max with strict bounds (T27); floats -> float
    when inside float32 range (float16 has no Spark type)."""
    from .stats import numeric_columns
    cols = cols or numeric_columns(df)
    mm = fit_minmax(df, cols)
    new = {}
    for c in cols:
        lo, hi = mm[c]
        if lo is None:
            continue
        t = df.schema[c].dataType.simpleString()
        if t in ("tinyint", "smallint", "int", "bigint"):
            new[c] = F.col(c).cast(downcast_integer_type(lo, hi, strict=True) or "bigint")
        else:
            f32 = 3.4028234663852886e38
            new[c] = F.col(c).cast("float" if (-f32 < lo and hi < f32) else "double")
    return df.withColumns(new)


# ---------------------------------------------------------------- N9/N10 ----------
def cut(df: DataFrame, cols: list[str], bins: int = 8) -> DataFrame:
    """Equal-width cut labelled C0..C{bins-1}."""
    mm = fit_minmax(df, cols)
    return df.withColumns({c: F.concat(F.lit("C"), equal_width_bucket(F.col(c).cast("double"), *mm[c], bins)
                                       .cast("string")) for c in cols})


def quantile_edges(df: DataFrame, col: str, q: int) -> list[float]:
    """Edges at i/q quantiles with linear interpolation (T7), duplicates dropped.

    Ranks come from a scan over the counted distinct values; only the values at the 2 * (q + 1)
    ranks needed reach the driver.
    """
    counts = (df.select(F.col(col).cast("double").alias("x")).filter(F.col("x").isNotNull())
              .groupBy("x").agg(F.count(F.lit(1)).alias("c")))
    scanned = ordered_scan(counts, [("x", True)], sums=["c"], rank_col="_r")
    n = int(scanned.agg(F.max("cum_c")).first()[0] or 0)
    if not n:
        return []
    at = [(n - 1) * (i / q) for i in range(q + 1)]
    ranks = sorted({r for p in at for r in (math.floor(p), math.ceil(p))})
    needed = F.exists(F.array(*[F.lit(float(r)) for r in ranks]), lambda r: (F.col("cum_c") - F.col("c") <= r) & (r < F.col("cum_c")))
    rows = scanned.filter(needed).select("x", "c", "cum_c").collect()
    value = {r: next(v["x"] for v in rows if v["cum_c"] - v["c"] <= r < v["cum_c"]) for r in ranks}
    edges = [value[math.floor(p)] if p == math.floor(p) else
             (math.ceil(p) - p) * value[math.floor(p)] + (p - math.floor(p)) * value[math.ceil(p)] for p in at]
    out = []
    for e in edges:
        if not out or e != out[-1]:
            out.append(float(e))
    return out


def bucket_by_edges(x: Column, edges: list[float], right: bool = True, include_lowest: bool = True) -> Column:
    """Index of the interval of ``edges`` holding x (right-closed like pandas.cut); null outside."""
    k = len(edges) - 1
    idx = F.lit(0)
    for e in edges[1:-1]:
        idx = idx + F.when((x > F.lit(e)) if right else (x >= F.lit(e)), 1).otherwise(0)
    lo_ok = (x >= F.lit(edges[0])) if (include_lowest or not right) else (x > F.lit(edges[0]))
    hi_ok = (x <= F.lit(edges[-1])) if right else (x < F.lit(edges[-1]))
    return F.when(lo_ok & hi_ok & F.lit(k > 0), idx)


def qcut(df: DataFrame, cols: list[str], q: int = 4) -> DataFrame:
    """Equal-frequency cut labelled C0.. from exact quantile edges."""
    out = {}
    for c in cols:
        e = quantile_edges(df, c, q)
        out[c] = F.concat(F.lit("C"), bucket_by_edges(F.col(c).cast("double"), e).cast("string"))
    return df.withColumns(out)


# ---------------------------------------------------------------- N14/N15 ---------
def bin_cdf_fit(df: DataFrame, col: str, number_bins: int = 100) -> DataFrame:
    """Edges at sorted positions int(n*i/bins) (+ last), deduplicated; bin means.

    Returns (bin, edge, mean, n_edges): one row per kept edge except the last.
    """
    x = df.select(F.col(col).cast("double").alias("x")).filter(F.col("x").isNotNull())
    ranked = ordered_scan(x.withColumn("_t", F.monotonically_increasing_id()), [("x", True), ("_t", True)],
                          rank_col="_pos").withColumn("_pos", F.col("_pos") - 1)
    n = ranked.count()
    idx = sorted({int(n * i / number_bins) for i in range(number_bins)} | {n - 1})
    picked = {r["_pos"]: r["x"] for r in ranked.filter(F.col("_pos").isin(idx)).select("_pos", "x").collect()}
    starts, edges, prev = [0], [picked[0]], picked[0]
    for i in idx[1:]:
        if picked[i] != prev:
            starts.append(i)
            edges.append(picked[i])
            prev = picked[i]
    nb = len(starts) - 1
    # bin of each sorted position: last bin also takes the final element
    b = F.lit(0)
    for s in starts[1:-1]:
        b = b + F.when(F.col("_pos") >= F.lit(s), 1).otherwise(0)
    means = (ranked.filter(F.col("_pos") < F.lit(starts[-1])).withColumn("bin", b)
             .unionByName(ranked.filter(F.col("_pos") == F.lit(starts[-1])).withColumn("bin", F.lit(max(nb - 1, 0))))
             .groupBy("bin").agg(F.avg("x").alias("mean")))
    edge_df = df.sparkSession.createDataFrame([(i, float(e)) for i, e in enumerate(edges)], "bin int, edge double")
    return edge_df.join(means, "bin", "left").withColumn("n_edges", F.lit(len(edges)))


def bin_cdf_transform(df: DataFrame, col: str, fitted: DataFrame, out: str = "cdf") -> DataFrame:
    rows = sorted(fitted.collect(), key=lambda r: r["bin"])  # bounded by number_bins
    edges = [r["edge"] for r in rows]
    key_max = max(len(edges) - 2, 0)
    x = F.col(col).cast("double")
    idx = F.lit(-1)
    for e in edges:
        idx = idx + F.when(x >= F.lit(e), 1).otherwise(0)
    idx = F.least(F.greatest(idx, F.lit(0)), F.lit(key_max))
    return df.withColumn(out, idx / F.lit(float(len(edges) - 1)))


def bin_cdf_inverse(df: DataFrame, col: str, fitted: DataFrame, out: str = "value") -> DataFrame:
    """N14 backwards: the mean of the bin whose cumulative share is nearest to ``col``."""
    rows = sorted(fitted.collect(), key=lambda r: r["bin"])  # bounded by number_bins
    last = max(len(rows) - 2, 0)
    means = F.array(*[F.lit(r["mean"]).cast("double") for r in rows[:last + 1]])
    at = F.least(F.greatest(F.round(F.col(col) * F.lit(float(len(rows) - 1))), F.lit(0.0)), F.lit(float(last))).cast("int")
    return df.withColumn(out, means[at])


def ecdf_quantize(df: DataFrame, col: str, q: int, out: str = "qnorm") -> DataFrame:
    """Empirical CDF (share of rows <= x) then floor(q*cdf)/q; ties share a value."""
    counts = df.groupBy(F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_v").isNotNull())
    scanned = ordered_scan(counts, [("_v", True)], sums=["_c"], rank_col="_r")
    total = df.filter(F.col(col).isNotNull()).count()
    cdf = scanned.select(F.col("_v"), (F.col("cum__c") / F.lit(float(total))).alias("_cdf"))
    res = df.join(cdf, df[col] == cdf["_v"], "left").drop("_v")
    return res.withColumn(out, F.floor(F.col("_cdf") * q) / F.lit(float(q))).drop("_cdf")


# ---------------------------------------------------------------- N22 -------------
def label_smoothing(y: Column, eps: float, classes: int = 2) -> Column:
    return y.cast("double") * (1 - eps) + F.lit(eps / classes)
