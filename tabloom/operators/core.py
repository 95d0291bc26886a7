"""Guide-level dataflow operators (P*, J*, A*, O*, U*, S*, V*) as DataFrame code.

Most are one Spark call; the helpers here are the ones whose scalable form is not
the obvious one: hash-seeded sampling that does not depend on partitioning, key
grouping that never builds an unbounded array, co-group as pre-aggregated outer
join, positional zip through ranks, and histogram with zero-filled buckets.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .rank import global_rank, ordered_scan, top_k_per_group

TWO32 = 4294967296.0


# ------------------------------------------------------------------ hashing -------
def hash_uniform(cols: list[str] | str, seed: int = 0) -> Column:
    """Uniform [0, 1) from md5 of the decimal key text and a seed (H8).

    Independent of partitioning and reproducible in any engine that has md5.
    """
    cols = [cols] if isinstance(cols, str) else cols
    key = F.concat_ws(":", *[F.col(c).cast("string") for c in cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(TWO32)


def hash_uniform_sql(cols: list[str] | str, seed: int = 0) -> str:
    cols = [cols] if isinstance(cols, str) else cols
    key = " || ':' || ".join([f"CAST({c} AS VARCHAR)" for c in cols] + [f"'{seed}'"])
    return f"(CAST(('0x' || substr(md5({key}), 1, 8)) AS BIGINT) / {TWO32})"


# ------------------------------------------------------------------ P* ------------
def prefix_bucket(c: Column, prefixes: list[str], other: str = "other") -> Column:
    """First matching prefix wins, else ``other``; lower-case first."""
    low = F.lower(c)
    expr = None
    for p in prefixes:
        cond = low.startswith(p)
        expr = F.when(cond, F.lit(p)) if expr is None else expr.when(cond, F.lit(p))
    return expr.otherwise(F.lit(other))


# The prefix list of the reference's device-model bucketing, in order.
MODEL_PREFIXES = ["a", "reno", "k", "find", "r"]


def three_sigma_filter(df: DataFrame, col: str) -> DataFrame:
    """Keep rows with mean - 3 sd <= x <= mean + 3 sd (sample sd, bounds inclusive).

    The two bounds are scalar subqueries: evaluated once, no join with the data.
    """
    s = df.select(F.avg(col).alias("m"), F.stddev_samp(col).alias("s"))
    lo = s.select(F.col("m") - 3 * F.col("s")).scalar()
    hi = s.select(F.col("m") + 3 * F.col("s")).scalar()
    return df.filter((F.col(col) >= lo) & (F.col(col) <= hi))


def drop_sparse_columns(df: DataFrame, min_share: float = 0.005, also: list[str] = ()) -> DataFrame:
    """P20: drop columns whose non-null share is below ``min_share`` plus a fixed list."""
    n = F.count(F.lit(1))
    row = df.agg(*[(F.count(F.col(c)) / n).alias(c) for c in df.columns]).first()
    drop = [c for c in df.columns if (row[c] or 0.0) < min_share] + [c for c in also if c in df.columns]
    return df.drop(*drop)


def zip_by_position(left: DataFrame, left_order: list, right: DataFrame, right_order: list) -> DataFrame:
    """Pair rows of two tables by position in the given orders (ranks + equi-join)."""
    lr = global_rank(left, left_order, rank_col="_pos")
    rr = global_rank(right, right_order, rank_col="_pos")
    return lr.join(rr, "_pos").withColumn("_pos", F.col("_pos") - 1).withColumnRenamed("_pos", "idx")


def with_index(df: DataFrame, order: list, col: str = "idx") -> DataFrame:
    """P25: zipWithIndex in a given order (0-based), without one-partition windows."""
    return global_rank(df, order, rank_col=col).withColumn(col, F.col(col) - 1)


# ------------------------------------------------------------------ J* ------------
def cogroup_agg(left: DataFrame, right: DataFrame, key: str, left_aggs: list[Column],
                right_aggs: list[Column]) -> DataFrame:
    """Co-group as two keyed partial aggregates and a full outer join; keys found
    on one side only are kept with the other side's aggregates null (empty group)."""
    return left.groupBy(key).agg(*left_aggs).join(right.groupBy(key).agg(*right_aggs), key, "full")


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on every common column name."""
    common = [c for c in left.columns if c in right.columns]
    return left.join(right, common, how)


def copartitioned_join(left: DataFrame, right: DataFrame, key: str, n: int, how: str = "inner") -> DataFrame:
    """Hash-partition both sides once on the key; the join reuses that layout."""
    return left.repartition(n, key).join(right.repartition(n, key), key, how)


# ------------------------------------------------------------------ A* ------------
def group_values(df: DataFrame, key: str, value: str, chunk: int = 10_000, order: str | None = None) -> DataFrame:
    """Values per key as arrays of at most ``chunk`` items: (key, part, values).

    A hot key yields many bounded rows instead of one unbounded array.
    """
    order = order or value
    ranked = ordered_scan(df.select(key, value, *([order] if order != value else [])),
                          [(order, True)], by=[key], rank_col="_r")
    return (ranked.groupBy(key, ((F.col("_r") - 1) / chunk).cast("long").alias("part"))
            .agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))).alias("_a"))
            .select(key, "part", F.transform("_a", lambda s: s["v"]).alias("values")))


def histogram(df: DataFrame, col: str, buckets: int | list[float]) -> DataFrame:
    """Equal-width ``buckets`` on [min, max] or given edges; last bucket closed;
    every bucket appears (zero-filled). Returns (bucket, lo, hi, count)."""
    x = F.col(col).cast("double")
    if isinstance(buckets, int):
        r = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
        lo, hi = r["lo"], r["hi"]
        edges = [lo + (hi - lo) * i / buckets for i in range(buckets)] + [hi]
        idx = F.least(F.floor((x - F.lit(lo)) / F.lit((hi - lo) / buckets)), F.lit(buckets - 1)).cast("int")
        idx = F.when((x >= F.lit(lo)) & (x <= F.lit(hi)), idx)
    else:
        edges = list(buckets)
        idx = F.lit(0)
        for e in edges[1:-1]:
            idx = idx + F.when(x >= F.lit(e), 1).otherwise(0)
        idx = F.when((x >= F.lit(edges[0])) & (x <= F.lit(edges[-1])), idx)
    nb = len(edges) - 1
    counts = df.select(idx.alias("bucket")).filter(F.col("bucket").isNotNull()).groupBy("bucket").count()
    spark = df.sparkSession
    grid = spark.createDataFrame([(i, float(edges[i]), float(edges[i + 1])) for i in range(nb)],
                                 "bucket int, lo double, hi double")
    return grid.join(counts, "bucket", "left").fillna(0, ["count"])


def summary_stats(df: DataFrame, col: str) -> DataFrame:
    """Count, mean, sum, min, max, population/sample variance and std."""
    x = F.col(col).cast("double")
    return df.agg(F.count(x).alias("count"), F.avg(x).alias("mean"), F.sum(x).alias("sum"), F.min(x).alias("min"),
                  F.max(x).alias("max"), F.var_pop(x).alias("variance"), F.var_samp(x).alias("sample_variance"),
                  F.stddev_pop(x).alias("stdev"), F.stddev_samp(x).alias("sample_stdev"))


def crosstab(df: DataFrame, a: str, b: str, values: list | None = None) -> DataFrame:
    """Pair counts as a wide table keyed by ``a_b``; ``values`` fixes b's columns."""
    piv = df.groupBy(F.col(a).cast("string").alias(f"{a}_{b}"))
    piv = piv.pivot(b, values) if values is not None else piv.pivot(b)
    out = piv.count()
    return out.fillna(0, [c for c in out.columns if c != f"{a}_{b}"])


def posterior_by_group(df: DataFrame, label: str, groups: list[str]) -> DataFrame:
    """p(y | group) with counts and the ratio to the base rate."""
    base = df.agg(F.avg(F.col(label).cast("double"))).first()[0]
    return (df.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("p_y"))
            .withColumn("base_rate", F.lit(base)).withColumn("ratio", F.col("p_y") / F.lit(base)))


def value_samples(df: DataFrame, cols: list[str], k: int = 5, seed: int = 0) -> DataFrame:
    """Per column, k sample values (smallest md5 rank of distinct values), type and
    cardinality. Bounded: each column contributes k values, not its whole set."""
    parts = []
    for c in cols:
        d = df.select(F.col(c).cast("string").alias("value")).distinct()
        h = d.withColumn("_h", F.md5(F.concat_ws(":", F.coalesce(F.col("value"), F.lit("\x00null")), F.lit(str(seed)))))
        top = h.orderBy("_h").limit(k).agg(F.sort_array(F.collect_list(F.coalesce("value", F.lit("null")))).alias("samples"))
        card = d.select(F.count(F.lit(1))).scalar()  # scalar subquery, evaluated once
        dtype = df.schema[c].dataType.simpleString()
        parts.append(top.select(F.lit(c).alias("feature"), F.lit(dtype).alias("dtype"),
                                card.alias("cardinality"), "samples"))
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------ S* ------------
def hash_sample(df: DataFrame, key: list[str] | str, fraction: float, seed: int = 0) -> DataFrame:
    """S1 (Bernoulli): keep rows whose hash uniform is below ``fraction``."""
    return df.filter(hash_uniform(key, seed) < F.lit(fraction))


def poisson_cdf(rate: float) -> list[float]:
    """Cumulative Poisson probabilities until a double cannot tell them from 1."""
    if not 0 < rate <= 700:
        raise ValueError("rate must be above 0 and at most 700 (e**-rate must be a normal double)")
    term = total = math.exp(-rate)
    out = []
    while total < 1 - 1e-15:
        out.append(total)
        term *= rate / len(out)
        if len(out) > rate and total + term == total:
            break
        total += term
    return out


def poisson_copies(df: DataFrame, key: list[str] | str, rate: float, seed: int = 0, col: str = "copies") -> DataFrame:
    """S1 (with replacement): the rows drawn at least once, with their number of copies, Poisson(``rate``) by hash.

    The hash is one array item that a lambda compares with the thresholds, and rows without copies leave in the
    generator: one hash a row, however many thresholds there are."""
    steps = F.array(*[F.lit(p) for p in poisson_cdf(rate)])
    count = F.transform(F.array(hash_uniform(key, seed)), lambda u: F.size(F.filter(steps, lambda p: p <= u)))
    return df.withColumn(col, F.explode(F.filter(count, lambda n: n > 0)))


def poisson_replicate(df: DataFrame, key: list[str] | str, rate: float, seed: int = 0) -> DataFrame:
    """S1 (with replacement): every row as often as ``poisson_copies`` says."""
    return poisson_copies(df, key, rate, seed, "_n").withColumn("_n", F.explode(F.sequence(F.lit(1), "_n"))).drop("_n")


def exact_sample(df: DataFrame, key: list[str] | str, n: int, seed: int = 0) -> DataFrame:
    """Exactly n rows, the n smallest hash ranks (take-ordered, a bounded top-n)."""
    keys = [key] if isinstance(key, str) else key
    return df.withColumn("_h", hash_uniform(keys, seed)).orderBy("_h", *keys).limit(n).drop("_h")


def stratified_sample(df: DataFrame, col: str, fractions: dict, key: list[str] | str, seed: int = 0) -> DataFrame:
    """S3: per-stratum Bernoulli fraction; unlisted strata get 0."""
    frac = F.lit(0.0)
    for v, f in fractions.items():
        frac = F.when(F.col(col) == F.lit(v), F.lit(float(f))).otherwise(frac)
    return df.filter(hash_uniform(key, seed) < frac)


def random_split(df: DataFrame, weights: list[float], key: list[str] | str, seed: int = 0) -> DataFrame:
    """Adds ``split`` 0..k-1 from normalised cumulative weights of the hash uniform."""
    tot = float(sum(weights))
    bounds, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / tot
        bounds.append(acc)
    u = hash_uniform(key, seed)
    s = F.lit(0)
    for b in bounds:
        s = s + F.when(u >= F.lit(b), 1).otherwise(0)
    return df.withColumn("split", s)


def _positions(df: DataFrame, key: str, seed: int, by: list[str], rank_col: str) -> DataFrame:
    """``df`` with the rank of every row by hash of its unique ``key`` (within ``by``). Only key, hash and group go
    through the scan; other columns meet the ranks by the key."""
    narrow = df.select(key, *[c for c in by if c != key]).withColumn("_h", hash_uniform(key, seed))
    ranked = ordered_scan(narrow, [("_h", True), (key, True)], by=by, rank_col=rank_col).drop("_h")
    if set(df.columns) <= set(narrow.columns):
        return ranked.select(*df.columns, rank_col)
    ranked = ranked.select(F.col(key).alias("_key"), rank_col)
    return df.join(ranked, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")


#: Strata up to which their cut rows are sent to all tasks.
FEW_STRATA = 10_000


def holdout(df: DataFrame, key: str, ratio: float, seed: int = 0, stratify: str | None = None) -> DataFrame:
    """Rank by hash of the unique ``key`` (within ``stratify``); the last int(n*ratio) rows are test. A null
    stratum is a stratum.

    Only (stratum, hash, key) go through the scan. It yields one row a stratum, the last training row, and each row of
    the table is test if it comes after that: rows are compared where they lie."""
    by = [stratify] if stratify else []
    narrow = df.select(key, *[c for c in by if c != key]).withColumn("_h", hash_uniform(key, seed))
    ranked = ordered_scan(narrow, [("_h", True), (key, True)], by=by, rank_col="_r")
    counts = narrow.groupBy(*[F.col(c).alias("_g") for c in by]).agg(F.count(F.lit(1)).alias("_n"))
    train = lambda n: n - F.floor(n * F.lit(ratio))
    after = lambda cut: F.struct(hash_uniform(key, seed), F.col(key)) > cut
    if not by:
        cut = ranked.filter(F.col("_r") == train(counts.select("_n").scalar())).select(F.struct("_h", key))
        return df.withColumn("is_test", F.coalesce(after(cut.scalar()), F.lit(True)).cast("int"))
    cuts = ranked.join(counts, F.col(stratify).eqNullSafe(F.col("_g"))).filter(F.col("_r") == train(F.col("_n")))
    cuts = cut_lineage(cuts.select("_g", F.struct("_h", key).alias("_cut")))
    # A shuffle by stratum would put all rows of a class into one task; only many strata are worth one.
    cuts = F.broadcast(cuts) if cuts.count() <= FEW_STRATA else cuts
    marked = df.join(cuts, F.col(stratify).eqNullSafe(F.col("_g")), "left")
    return marked.withColumn("is_test", F.coalesce(after(F.col("_cut")), F.lit(True)).cast("int")).drop("_g", "_cut")


def stratified_kfold(df: DataFrame, key: str, label: str, k: int, seed: int = 0) -> DataFrame:
    """Position by hash of the unique ``key`` within label, modulo k -> fold."""
    return _positions(df, key, seed, [label], "_r").withColumn("fold", ((F.col("_r") - 1) % k).cast("int")).drop("_r")


def rebalance(df: DataFrame, label: str, key: str, pn_ratio: float, method: str = "down", seed: int = 0) -> DataFrame:
    """Reach positives/negatives = pn_ratio by sampling negatives down or
    replicating positives up (hash-driven, so reruns give the same rows)."""
    r = df.agg(F.sum(F.col(label).cast("long")).alias("p"), F.count(F.lit(1)).alias("n")).first()
    P, N = int(r["p"]), int(r["n"]) - int(r["p"])
    if method == "down":
        keep = min(1.0, P / (pn_ratio * N)) if N else 1.0
        return df.filter((F.col(label) == 1) | (hash_uniform(key, seed) < F.lit(keep)))
    times = pn_ratio * N / P if P else 1.0
    whole = int(times)
    extra = times - whole
    n = F.when(F.col(label) == 1, F.lit(whole) + F.when(hash_uniform(key, seed) < F.lit(extra), 1).otherwise(0)).otherwise(1)
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.greatest(n, F.lit(1))))).filter(n > 0).drop("_copy")


def shuffle_rows(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """A seeded full shuffle: the new position of every row (``key`` is unique)."""
    return _positions(df, key, seed, [], "pos").withColumn("pos", F.col("pos") - 1)


def priority_draw(df: DataFrame, key: str, weight: Column, b: int, seed: int = 0) -> DataFrame:
    """Total weight cut into ``b`` equal segments, one uniform point per segment,
    each point located by cumulative weight. Rows are (draw, key...) - exactly b.

    Range join made exact and bounded: a row can only hold draws whose segment its
    interval touches, so each row explodes only those candidate segment ids and the
    equi-join on the segment id needs no cross product.
    """
    w = df.withColumn("_w", weight.cast("double"))
    sc = ordered_scan(w, [(key, True)], sums=["_w"], rank_col="_r")
    total = w.agg(F.sum("_w")).first()[0]
    seg = total / b
    spark = df.sparkSession
    draws = (spark.range(b).select(F.col("id").alias("draw"))
             .withColumn("u", (F.col("draw").cast("double") + hash_uniform("draw", seed)) * F.lit(seg)))
    lo = F.col("cum__w") - F.col("_w")
    cand = sc.withColumn("draw", F.explode(F.sequence(F.floor(lo / F.lit(seg)).cast("long"),
                                                      F.least(F.floor(F.col("cum__w") / F.lit(seg)).cast("long"),
                                                              F.lit(b - 1)))))
    hit = cand.join(draws, "draw").filter((F.col("u") > lo) & (F.col("u") <= F.col("cum__w")))
    return hit.drop("_r", "cum__w")


def newest_n(df: DataFrame, ts: str, key: str, n: int, by: list[str] | None = None) -> DataFrame:
    """The newest n rows (per ``by``; ties: the larger ``key`` first). Every task keeps its own n newest rows (of a
    group) before any row moves."""
    newest = [F.col(ts).desc(), F.col(key).desc()]
    return top_k_per_group(df, by, newest, n, "_age").drop("_age") if by else df.orderBy(*newest).limit(n)


def rare_to_other(df: DataFrame, col: str, min_count: int, other: str = "__rare__") -> DataFrame:
    """Values seen fewer than ``min_count`` times become ``other``."""
    frequent = df.groupBy(col).count().filter(F.col("count") >= min_count).select(F.col(col).alias("_v"))
    j = df.join(frequent, df[col] == frequent["_v"], "left")
    return j.withColumn(col, F.when(F.col("_v").isNotNull(), F.col(col).cast("string")).otherwise(F.lit(other))).drop("_v")
