"""Mixed-column processors as fitted specs: index / scale for embeddings (N16-N19), one-hot input of a network (N20),
index and value arrays of a factorisation machine (N21).

A fit is a few aggregates: one over all columns, one for every skewed column's quantiles, one scan that numbers the
distinct values. Scalars and edges (a few a column) come to the driver; value indexes stay a table (feature, value, idx)
that transforms look up by a join, so a column may have any number of values. Train and serve share the transforms.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import log_squash
from ..session import cut_lineage
from .encode import lookup, normalize_fit, normalize_transform, onehot_fit, quantile_edges
from .rank import ordered_scan
from .stats import numeric_columns, sample_skewness, string_columns

# Fixed defaults of the reference's preprocessing config.
DEFAULTS = {"drop_cat_na_ratio": 0.98, "drop_double_na_ratio": 0.8, "cat_na_sentinel": "-999",
            "skew_double": False, "skew_threshold": 5.0, "skew_bins": 30, "log_transform": True}


@dataclass
class FeatureSpec:
    cat_cols: list = field(default_factory=list)
    double_cols: list = field(default_factory=list)
    skew_cols: list = field(default_factory=list)
    drop_cols: list = field(default_factory=list)
    scaler: dict = field(default_factory=dict)
    skew_bins: dict = field(default_factory=dict)
    start: dict = field(default_factory=dict)     # first id of every column
    size: dict = field(default_factory=dict)      # ids of every column
    conf: dict = field(default_factory=dict)
    values: DataFrame | None = None               # feature, value, idx from 0

    @property
    def feature_dim(self) -> int:
        return sum(self.size.values())

    @property
    def field_dim(self) -> int:
        return len(self.size)


def value_index(df: DataFrame, cols: list[str], null_as: str) -> DataFrame:
    """(feature, value, idx): the distinct values of each column as texts, numbered from 0 in their order (trap T3)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(x).alias("feature"), F.coalesce(F.col(f"`{x}`").cast("string"), F.lit(null_as)).alias("value")) for x in cols]))
    found = df.select(pairs.alias("p")).select("p.feature", "p.value").distinct()
    ranked = ordered_scan(found, [("value", True)], by=["feature"], rank_col="_r")
    return cut_lineage(ranked.select("feature", "value", (F.col("_r") - 1).cast("int").alias("idx")))


def _shares(df: DataFrame, cols: list[str], nums: list[str]) -> dict:
    """Null share of every column and skewness of the numeric ones: one aggregate row."""
    n = F.count(F.lit(1))
    return df.agg(*[F.try_divide(F.sum(F.col(f"`{x}`").isNull().cast("double")), n).alias(f"null_{x}") for x in cols], *[sample_skewness(x).alias(f"skew_{x}") for x in nums]).first().asDict()


def fit(df: DataFrame, exclude=(), manual_cat=(), conf: dict | None = None, shared_ids: bool = False) -> FeatureSpec:
    """N16. ``shared_ids``: ids go on from column to column, else each column starts at 0. A numeric column has one id, a
    skewed one an id for every place among its edges and one for null."""
    c = dict(DEFAULTS, **(conf or {}))
    cols = [x for x in df.columns if x not in exclude]
    cats = [x for x in cols if x in string_columns(df) or x in manual_cat]
    nums = [x for x in numeric_columns(df) if x in cols and x not in cats]
    st = _shares(df, cols, nums if c["skew_double"] else [])
    drop = [x for x in cats if (st[f"null_{x}"] or 0.0) > c["drop_cat_na_ratio"]]
    drop += [x for x in nums if (st[f"null_{x}"] or 0.0) > c["drop_double_na_ratio"]]
    cats = [x for x in cats if x not in drop]
    nums = [x for x in nums if x not in drop]
    skew, bins = [], {}
    if c["skew_double"]:
        for x in [x for x in nums if abs(st[f"skew_{x}"] or 0.0) > c["skew_threshold"]]:
            e = quantile_edges(df, x, min(c["skew_bins"], _distinct(df, x)))
            nums.remove(x)
            if len(e) < 3:
                drop.append(x)
            else:
                bins[x] = e
                skew.append(x)
    squashed = df.select(*[(log_squash(F.col(x), "fit") if c["log_transform"] else F.col(x).cast("double")).alias(x) for x in nums])
    scaler = normalize_fit(squashed, nums) if nums else {}
    single = [x for x in nums if scaler[x]["std"] is None or scaler[x]["min"] == scaler[x]["max"]]
    nums = [x for x in nums if x not in single]
    values = value_index(df, cats, c["cat_na_sentinel"]) if cats else None
    size = {r["feature"]: r["n"] for r in values.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()} if cats else {}
    size = {x: size.get(x, 0) if x in cats else len(bins[x]) + 2 if x in skew else 1 for x in cols if x in cats or x in skew or x in nums}
    start, at = {}, 0
    for x, n in size.items():
        start[x] = at if shared_ids else 0
        at += n
    return FeatureSpec(cats, nums, skew, drop + single, {x: scaler[x] for x in nums}, bins, start, size, c, values)


def _distinct(df: DataFrame, col: str) -> int:
    """Distinct values, null counted as one."""
    r = df.agg(F.count_distinct(F.col(col)).alias("n"), F.max(F.col(col).isNull().cast("int")).alias("null")).first()
    return r["n"] + (r["null"] or 0)


def _place(x: Column, edges: list[float]) -> Column:
    """Edges below x: the place of a left search (trap T9)."""
    return sum((F.when(x > F.lit(e), 1).otherwise(0) for e in edges), F.lit(0))


def transform(df: DataFrame, spec: FeatureSpec, double_type: str = "normal", epsilon: float = 1e-8, log_mode: str = "fit") -> DataFrame:
    """N17, and N18 with ``log_mode`` "serve": squash, mean fill, normalise; ids of categories (null where the value was
    not there at the fit) and of skewed columns. Other columns stay, dropped ones go."""
    missing = [x for x in spec.cat_cols + spec.double_cols + spec.skew_cols if x not in df.columns]
    if missing:
        raise ValueError(f"missing features: {missing}")
    new = {}
    for x in spec.double_cols:
        sc = spec.scaler[x]
        v = log_squash(F.col(x), log_mode) if spec.conf.get("log_transform", True) else F.col(x).cast("double")
        v = F.coalesce(F.nanvl(v, F.lit(None).cast("double")), F.lit(sc["mean"]))  # the serving squash makes null NaN
        new[x] = ((v - F.lit(sc["mean"])) / (F.lit(sc["std"]) + F.lit(epsilon)) if double_type == "normal"
                  else (v - F.lit(sc["min"])) / (F.lit(sc["max"]) - F.lit(sc["min"])))
    for x in spec.skew_cols:
        e, v = spec.skew_bins[x], F.col(x).cast("double")
        new[x] = F.lit(spec.start[x]) + F.when(v.isNull(), F.lit(len(e) + 1)).otherwise(_place(v, e))
    out = df.select(*[new[x].alias(x) if x in new else F.col(f"`{x}`") for x in df.columns if x not in spec.drop_cols])
    order = out.columns
    for x in spec.cat_cols:
        key = F.coalesce(F.col(f"`{x}`").cast("string"), F.lit(spec.conf["cat_na_sentinel"]))
        out = lookup(out, x, spec.values.filter(F.col("feature") == x), "value", "idx", "__idx", key_expr=key)
        out = out.withColumn(x, F.col("__idx") + F.lit(spec.start[x])).drop("__idx")
    return out.select(*[F.col(f"`{x}`") for x in order])


def model_input(df: DataFrame, spec: FeatureSpec, key: str) -> DataFrame:
    """(key, xi ARRAY<INT>, xv ARRAY<FLOAT>) of transformed rows: categories and skewed columns carry (id, 1.0), a
    value that was not there at the fit id -1; numbers (their id, value). Kept as two arrays (trap T35)."""
    coded = spec.cat_cols + spec.skew_cols
    xi = F.array(*[F.coalesce(F.col(x), F.lit(-1)).cast("int") for x in coded], *[F.lit(spec.start[x]).cast("int") for x in spec.double_cols])
    xv = F.array(*[F.lit(1.0).cast("float") for _ in coded], *[F.col(x).cast("float") for x in spec.double_cols])
    return df.select(key, xi.alias("xi"), xv.alias("xv"))


def save(spec: FeatureSpec, path: str, spark: SparkSession) -> None:
    """The spec as a folder: its scalars as JSON, its values as a table."""
    said = {f.name: getattr(spec, f.name) for f in fields(spec) if f.name != "values"}
    spark.createDataFrame([(json.dumps(said),)], "spec string").coalesce(1).write.mode("overwrite").text(f"{path}/spec")
    if spec.values is not None:
        spec.values.write.mode("overwrite").parquet(f"{path}/values")


def load(spark: SparkSession, path: str) -> FeatureSpec:
    spec = FeatureSpec(**json.loads(spark.read.text(f"{path}/spec").first()[0]))
    spec.values = spark.read.parquet(f"{path}/values") if spec.cat_cols else None
    return spec


# ------------------------------------------------------------------ letters ---------
@dataclass
class LetterBins:
    """Equal-frequency bins of skewed columns, named a, b, c, ...; null is a bin where its share was large enough."""

    edges: dict = field(default_factory=dict)
    names: dict = field(default_factory=dict)
    dropped: list = field(default_factory=list)


def letter_bins(df: DataFrame, cols: list[str], shares: dict, threshold: float, buckets: int, null_share: float) -> LetterBins:
    out = LetterBins()
    for x in [x for x in cols if abs(shares[f"skew_{x}"] or 0.0) > threshold]:
        e = quantile_edges(df, x, buckets) if _distinct(df, x) >= buckets else []
        if len(e) < 3:
            out.dropped.append(x)
            continue
        out.edges[x] = e
        out.names[x] = [chr(ord("a") + i) for i in range(len(e) - 1)] + (["null"] if shares[f"null_{x}"] > null_share else [])
    return out


def letter_of(x: str, bins: LetterBins) -> Column:
    """The bin's letter; null for a null of a column without a bin for it."""
    e, v = bins.edges[x], F.col(x).cast("double")
    last = len(e) - 2
    at = F.least(F.greatest(_place(v, e) - 1, F.lit(0)), F.lit(last))
    letters = F.array(*[F.lit(chr(ord("a") + i)) for i in range(last + 1)])
    return F.when(v.isNull(), F.lit("null" if "null" in bins.names[x] else None)).otherwise(letters[at])


# ------------------------------------------------------------------ N20 -------------
@dataclass
class NetworkSpec:
    double_cols: list
    categories: dict
    bins: LetterBins
    drop_cols: list
    scaler: dict
    kind: str
    null_as: str


def network_fit(df: DataFrame, exclude=(), numeric_cats=(), drop_na_ratio: float = 0.8, most_categories: int = 30, dummy_na: bool = True, null_as: str = "-99",
                discretize: bool = True, skew_threshold: float = 5.0, buckets: int = 5, kind: str = "z-score") -> NetworkSpec:
    """Columns with a null share of ``drop_na_ratio`` or more go; texts (and ``numeric_cats``) with 2 to
    ``most_categories`` values, null among them, become one-hot, other texts go; skewed numbers become letters, 'null'
    one of them where its share is over 0.01; the other numbers are scaled ("z-score" or "min-max")."""
    cols = [x for x in df.columns if x not in exclude]
    texts = [x for x in cols if x in string_columns(df) or x in numeric_cats]
    nums = [x for x in numeric_columns(df) if x in cols and x not in texts]
    st = _shares(df, cols, nums)
    drop = [x for x in cols if (st[f"null_{x}"] or 0.0) >= drop_na_ratio]
    texts, nums = ([x for x in group if x not in drop] for group in (texts, nums))
    categories = onehot_fit(df, texts, most_categories, dummy_na, null_as) if texts else {}
    drop += [x for x in texts if x not in categories]
    bins = letter_bins(df, nums, st, skew_threshold, buckets, 0.01) if discretize else LetterBins()
    nums = [x for x in nums if x not in bins.edges and x not in bins.dropped]
    return NetworkSpec(nums, categories, bins, drop + bins.dropped, normalize_fit(df, nums) if nums else {}, kind, null_as)


def network_transform(df: DataFrame, spec: NetworkSpec, keep=()) -> DataFrame:
    """``keep`` columns, scaled numbers, then a 0/1 column ``<column>_<value>`` for every category and letter. A value that
    was not there at the fit has zeros only."""
    scaled = normalize_transform(df.withColumns({f"__{x}": F.col(f"`{x}`") for x in keep}) if keep else df, spec.scaler, spec.kind) if spec.scaler else df.withColumns({f"__{x}": F.col(f"`{x}`") for x in keep})
    hot = []
    for x, values in spec.categories.items():
        v = F.coalesce(F.col(f"`{x}`").cast("string"), F.lit(spec.null_as))
        hot += [(v == F.lit(value)).cast("int").alias(f"{x}_{value}") for value in values]
    for x, names in spec.bins.names.items():
        letter = letter_of(x, spec.bins)
        hot += [F.coalesce((letter == F.lit(n)).cast("int"), F.lit(0)).alias(f"{x}_{n}") for n in names]
    return scaled.select(*[F.col(f"`__{x}`").alias(x) for x in keep], *[F.col(f"`{x}`") for x in spec.double_cols], *hot)


# ------------------------------------------------------------------ N21 -------------
@dataclass
class FmSpec:
    order: list
    double_cols: list
    ids: dict          # column -> {value: id} of texts and letters, or the id of a number
    bins: LetterBins
    drop_cols: list
    scaler: dict
    kind: str
    null_as: str
    feature_dim: int


def fm_fit(df: DataFrame, exclude=(), numeric_cats=(), drop_na_ratio: float = 0.95, most_categories: int = 20, null_as: str = "-99", skew_threshold: float = 5.0,
           buckets: int = 5, kind: str = "z-score") -> FmSpec:
    """As N20 with other limits (null share 0.95, up to 20 categories, 'null' a letter where its share is over 0.05;
    numbers with a single value go); ids go on from column to column, a number has one."""
    cols = [x for x in df.columns if x not in exclude]
    texts = [x for x in cols if x in string_columns(df) or x in numeric_cats]
    nums = [x for x in numeric_columns(df) if x in cols and x not in texts]
    st = _shares(df, cols, nums)
    drop = [x for x in cols if (st[f"null_{x}"] or 0.0) >= drop_na_ratio]
    texts, nums = ([x for x in group if x not in drop] for group in (texts, nums))
    bins = letter_bins(df, nums, st, skew_threshold, buckets, 0.05)
    nums = [x for x in nums if x not in bins.edges and x not in bins.dropped]
    scaler = normalize_fit(df, nums) if nums else {}
    single = [x for x in nums if scaler[x]["std"] is None or scaler[x]["min"] == scaler[x]["max"]]
    nums = [x for x in nums if x not in single]
    # One value is a category here too; columns of more than the limit go before their values are read.
    values = value_index(df, texts, null_as) if texts else None
    small = values.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") <= most_categories) if texts else None
    found: dict[str, list] = {}
    for r in values.join(small, "feature").orderBy("feature", "idx").collect() if texts else []:  # most_categories a column
        found.setdefault(r["feature"], []).append(r["value"])
    ids, at = {}, 0
    for x in cols:
        names = found.get(x) or bins.names.get(x)
        if names:
            ids[x] = {v: at + i for i, v in enumerate(names)}
            at += len(names)
        elif x in nums:
            ids[x] = at
            at += 1
    drop += bins.dropped + single + [x for x in texts if x not in found]
    return FmSpec([x for x in cols if x in ids], nums, ids, bins, drop, {x: scaler[x] for x in nums}, kind, null_as, at)


def fm_transform(df: DataFrame, spec: FmSpec, key: str) -> DataFrame:
    """(key, xi, xv) in the order of the columns: a category's id with 1.0, or with a value that was not there at the fit
    the column's smallest id with 0.0; a number's id with the scaled value."""
    scaled = normalize_transform(df.withColumn("__key", F.col(f"`{key}`")), spec.scaler, spec.kind) if spec.scaler else df.withColumn("__key", F.col(f"`{key}`"))
    xi, xv = [], []
    for x in spec.order:
        ids = spec.ids[x]
        if not isinstance(ids, dict):
            xi.append(F.lit(ids))
            xv.append(F.col(f"`{x}`").cast("float"))
            continue
        v = letter_of(x, spec.bins) if x in spec.bins.edges else F.coalesce(F.col(f"`{x}`").cast("string"), F.lit(spec.null_as))
        at = F.try_element_at(F.create_map(*[e for value, i in ids.items() for e in (F.lit(value), F.lit(i))]), F.coalesce(v, F.lit("")))  # a few names a column
        xi.append(F.coalesce(at, F.lit(min(ids.values()))))
        xv.append(F.when(at.isNull(), F.lit(0.0)).otherwise(F.lit(1.0)).cast("float"))
    return scaled.select(F.col("__key").alias(key), F.array(*[x.cast("int") for x in xi]).alias("xi"), F.array(*xv).alias("xv"))
