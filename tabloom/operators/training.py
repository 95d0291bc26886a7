"""Fitting models on Spark and reporting on them: boosted trees (M1), cross-validation (M2), leaves as inputs of a
linear model (M3), parameter search (M4), importance tables (X7, X8, X9), partial dependence (E17).

Fitting uses all rows it is given, through Spark ML pipelines; nothing but fitted trees, weights and report rows
reaches the driver. Splits and permutations come from md5 of the row key and a seed, so they do not depend on the
partitioning. Rows with a null label are left out; null inputs become ``FILL``; texts become indices, unseen ones
an index of their own.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path, written
from . import evaluate
from .core import hash_uniform, holdout, stratified_kfold
from .rank import ordered_scan
from .stats import string_columns

#: What a null number becomes before fitting.
FILL = -999.0
#: Values of a text column up to which trees take it as a category.
CATEGORIES = 60
#: Rows a partition that fitting reads, some 200 bytes a row once it is a vector in memory.
PART_ROWS = 200_000
#: Rows of a range that a scan goes over.
RANGE_ROWS = 1_000_000
_VALIDATION = "is_validation"


def dealt(df: DataFrame, key: str | None = None) -> DataFrame:
    """The rows dealt (by a hash of ``key``) into partitions of some ``PART_ROWS`` rows, a core's worth of them at least:
    files of few bytes a row come in partitions of many rows, and fitting goes over each of them dozens of times."""
    n = max(math.ceil(df.count() / PART_ROWS), df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(n, key) if key else df.repartition(n)


def inputs(df: DataFrame, cols: list[str]) -> list:
    """Pipeline stages from columns to the vector ``features`` (one place a column, in the order of ``cols``). A text column
    of up to ``CATEGORIES`` values is a category; one of more becomes a number, its place by falling frequency."""
    texts = string_columns(df.select(*cols))
    stages, name = [], {c: c for c in cols}
    if texts:
        found = df.agg(*[F.count_distinct(c).alias(c) for c in texts]).first()
        stages.append(StringIndexer(inputCols=texts, outputCols=[f"{c}__index" for c in texts], handleInvalid="keep"))
        name.update({c: f"{c}__index" for c in texts})
        many = [c for c in texts if found[c] > CATEGORIES]
        if many:  # a sum is a plain number, no category any more
            stages.append(SQLTransformer(statement="SELECT *, " + ", ".join(f"`{c}__index` + 0.0D AS `{c}__number`" for c in many) + " FROM __THIS__"))
            name.update({c: f"{c}__number" for c in many})
    return [*stages, VectorAssembler(inputCols=[name[c] for c in cols], outputCol="features", handleInvalid="keep")]


def prepared(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """Rows with a label; numbers as doubles without nulls, texts without nulls, the label as a double."""
    texts = set(string_columns(df.select(*cols)))
    filled = {c: F.coalesce(F.col(c), F.lit("")) if c in texts else F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(FILL)), F.lit(FILL)) for c in cols}
    return df.filter(F.col(label).isNotNull()).withColumns({**filled, label: F.col(label).cast("double")})


def scored_rows(model, df: DataFrame, output: str = "p") -> DataFrame:
    """``df`` with the probability of label 1."""
    out = model.transform(df)
    return out.select(*df.columns, vector_to_array(F.col("probability"))[1].alias(output))


# ------------------------------------------------------------------ M1 / X7 ---------
def fit_gbt(df: DataFrame, cols: list[str], label: str, key: str, rounds: int = 20, depth: int = 4, step: float = 0.2,
            validation: float = 0.1, seed: int = 42, tolerance: float = 0.0) -> PipelineModel:
    """Boosted trees with a stratified hold-out of ``validation`` of the rows: growing stops when the loss on it no
    longer falls by ``tolerance``. Both classes must be there."""
    rows = holdout(dealt(prepared(df, cols, label).select(key, label, *cols), key), key, validation, seed=seed, stratify=label)
    rows = cut_lineage(rows.select(label, *cols, (F.col("is_test") == 1).alias(_VALIDATION)))  # read once a stage and more
    booster = GBTClassifier(featuresCol="features", labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=step, seed=seed,
                            validationIndicatorCol=_VALIDATION, validationTol=tolerance, maxBins=64)
    return Pipeline(stages=[*inputs(df, cols), booster]).fit(rows)


def gbt_of(model: PipelineModel) -> GBTClassificationModel:
    return model.stages[-1]


def importance_table(models: list[PipelineModel], cols: list[str], spark) -> DataFrame:
    """(feature, importance, share, rank): split gains of each model normalised to 1, averaged over the models."""
    mean = [sum(float(gbt_of(m).featureImportances[i]) for m in models) / len(models) for i in range(len(cols))]
    total = sum(mean) or 1.0
    order = sorted(range(len(cols)), key=lambda i: (-mean[i], cols[i]))
    return spark.createDataFrame([(cols[i], mean[i], mean[i] / total, r) for r, i in enumerate(order, 1)], "feature string, importance double, share double, rank int")


def train_report(df: DataFrame, cols: list[str], label: str, key: str, test: float = 0.2, seed: int = 42, **more) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """M1: the model, the scored test rows (key, label, p) and a report row: trees, train_auc, test_auc, hit_rate, top_k, cover."""
    parts = cut_lineage(holdout(dealt(df.select(key, label, *cols).filter(F.col(label).isNotNull()), key), key, test, seed=seed + 1, stratify=label))
    train, held = parts.filter("is_test = 0").drop("is_test"), parts.filter("is_test = 1").drop("is_test")
    model = fit_gbt(train, cols, label, key, seed=seed, **more)
    score = lambda rows: cut_lineage(scored_rows(model, prepared(rows, cols, label)).select(key, label, "p"))
    seen, unseen = score(train), score(held)
    auc = lambda rows: evaluate.auc(rows, "p", label).first()["auc"]
    hit = evaluate.top_ratio_hit_rate(unseen, "p", label, key).first()
    report = df.sparkSession.createDataFrame([(gbt_of(model).getNumTrees, auc(seen), auc(unseen), hit["hit_rate"], hit["top_k"], hit["cover"])],
                                             "trees int, train_auc double, test_auc double, hit_rate double, top_k long, cover double")
    return model, unseen, report


# ------------------------------------------------------------------ M2 --------------
def cross_validate(df: DataFrame, cols: list[str], label: str, key: str, k: int = 5, seed: int = 1, **more) -> tuple[list[PipelineModel], DataFrame]:
    """M2: a model for each stratified fold and (key, label, fold, p): every row scored once, by the model that did not see it."""
    folds = cut_lineage(stratified_kfold(df.select(key, label, *cols).filter(F.col(label).isNotNull()), key, label, k, seed=seed))
    models, scored = [], None
    for i in range(k):
        models.append(fit_gbt(folds.filter(F.col("fold") != i), cols, label, key, seed=seed, **more))
        part = scored_rows(models[-1], prepared(folds.filter(F.col("fold") == i), cols, label)).select(key, label, "fold", "p")
        scored = part if scored is None else scored.unionByName(part)
    return models, cut_lineage(scored)


def fold_report(scored: DataFrame, label: str, key: str, top_ratio: float = 0.001) -> DataFrame:
    """(metric, mean, std): auc, log loss and hit rate over the folds of a scored table, with the population std."""
    spark = scored.sparkSession
    rows = []
    for i in sorted(r["fold"] for r in scored.select("fold").distinct().collect()):  # k folds
        part = scored.filter(F.col("fold") == i)
        loss = part.agg(F.avg(evaluate.log_loss(F.col("p"), F.col(label)))).first()[0]
        rows.append((i, evaluate.auc(part, "p", label).first()["auc"], loss, evaluate.top_ratio_hit_rate(part, "p", label, key, top_ratio).first()["hit_rate"]))
    return evaluate.mean_std(spark.createDataFrame(rows, "fold int, auc double, log_loss double, hit_rate double"), ["auc", "log_loss", "hit_rate"])


# ------------------------------------------------------------------ M3 --------------
def leaf_columns(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with ``leaf_0``, ``leaf_1``, ...: the leaf of each tree that the row falls in."""
    booster = gbt_of(model).copy().setLeafCol("__leaves")
    out = df
    for stage in model.stages[:-1]:
        out = stage.transform(out)
    out = booster.transform(out)
    places = vector_to_array(F.col("__leaves"))
    return out.select(*df.columns, *[places[i].cast("int").alias(f"leaf_{i}") for i in range(booster.getNumTrees)])


def leaf_counts(model: PipelineModel) -> list[int]:
    """Leaves of each tree."""
    return [(t.numNodes + 1) // 2 for t in gbt_of(model).trees]  # a binary tree


def fit_leaf_regression(model: PipelineModel, df: DataFrame, cols: list[str], label: str, l2: float = 0.01) -> PipelineModel:
    """M3: logistic regression on one-hot leaves. A leaf that no row of ``df`` falls in gets no place of its own.

    The fitted pipeline is saved and read back: a fresh regression keeps its training summary, and that the session, which
    tasks cannot take once any query of the session was observed."""
    rows = leaf_columns(model, dealt(prepared(df, cols, label)))
    leaves = [c for c in rows.columns if c.startswith("leaf_")]
    rows = cut_lineage(rows.select(label, *leaves))  # read once a stage and more
    stages = [StringIndexer(inputCols=leaves, outputCols=[f"{c}__index" for c in leaves], handleInvalid="keep"),
              OneHotEncoder(inputCols=[f"{c}__index" for c in leaves], outputCols=[f"{c}__hot" for c in leaves], dropLast=True),
              VectorAssembler(inputCols=[f"{c}__hot" for c in leaves], outputCol="leaf_vector"),
              LogisticRegression(featuresCol="leaf_vector", labelCol=label, regParam=l2, maxIter=50)]
    path = scratch_path(df.sparkSession, "leaf-regression")
    Pipeline(stages=stages).fit(rows).write().save(path)
    return PipelineModel.load(path)


def leaf_scores(model: PipelineModel, regression: PipelineModel, df: DataFrame, cols: list[str], label: str) -> DataFrame:
    rows = leaf_columns(model, prepared(df, cols, label))
    return scored_rows(regression, rows).drop(*[c for c in rows.columns if c.startswith("leaf_")])


# ------------------------------------------------------------------ M4 --------------
def search(df: DataFrame, cols: list[str], label: str, key: str, grid: list[dict], metric: Callable[[DataFrame], float], test: float = 0.2,
           seed: int = 42, max_gap: float = 0.02) -> DataFrame:
    """M4: one fit for each setting of ``grid``; (trial, setting, score, train_loss, test_loss, accepted, best). A trial whose losses on
    train and test rows differ by ``max_gap`` or more is rejected; the best is the accepted one with the highest score."""
    parts = cut_lineage(holdout(dealt(df.select(key, label, *cols).filter(F.col(label).isNotNull()), key), key, test, seed=seed, stratify=label))
    train, held = parts.filter("is_test = 0").drop("is_test"), parts.filter("is_test = 1").drop("is_test")
    rows = []
    for i, setting in enumerate(grid):
        model = fit_gbt(train, cols, label, key, seed=seed, **setting)
        seen, unseen = (scored_rows(model, prepared(x, cols, label)).select(key, label, "p") for x in (train, held))
        loss = lambda x: x.agg(F.avg(evaluate.log_loss(F.col("p"), F.col(label)))).first()[0]
        a, b = loss(seen), loss(unseen)
        rows.append((i, ", ".join(f"{k}={v}" for k, v in sorted(setting.items())), metric(unseen), a, b, abs(a - b) < max_gap))
    best = max((r for r in rows if r[5]), key=lambda r: (r[2], -r[0]), default=None)
    return df.sparkSession.createDataFrame([(*r, r is best) for r in rows], "trial int, setting string, score double, train_loss double, test_loss double, accepted boolean, best boolean")


# ------------------------------------------------------------------ X8 / X9 ---------
def _by_key(df: DataFrame, key: str) -> DataFrame:
    """``df`` with ``__rank``: the rank by key, which no permutation changes."""
    return written(ordered_scan(df, [(key, True)], rank_col="__rank", num_partitions=_ranges(df)), "ranked")


def _ranges(df: DataFrame) -> int:
    """Ranges of some ``RANGE_ROWS`` rows, a core's worth of them at least: a scan is more work than its bytes tell."""
    return max(math.ceil(df.count() / RANGE_ROWS), df.sparkSession.sparkContext.defaultParallelism)


def permuted(df: DataFrame, cols: list[str], key: str, seed: int) -> DataFrame:
    """``df`` with ``<c>__permuted``: the values of ``cols`` dealt to other rows, the same exchange for all of them. The
    row with rank r by key gets the values of the row with rank r by a hash of the key; the ranks meet in an equi-join.
    Rows that have their rank by key already (``__rank``) are not ranked again."""
    to = df if "__rank" in df.columns else _by_key(df, key)
    source = to.select(key, *cols).withColumn("__hash", hash_uniform(key, seed))
    source = ordered_scan(source, [("__hash", True), (key, True)], rank_col="__rank", num_partitions=_ranges(to))
    return to.join(source.select("__rank", *[F.col(c).alias(f"{c}__permuted") for c in cols]), "__rank").drop("__rank")


def permutation_importance(df: DataFrame, cols: list[str], label: str, key: str, scorer: Callable[[DataFrame], DataFrame], folds: int = 3, seed: int = 5) -> DataFrame:
    """(feature, baseline, mean, std): how far the area under precision-recall falls when a column is permuted, over
    ``folds`` permutations (sample std). ``scorer`` adds ``p`` to rows that have the columns ``key``, ``label``, ``cols``.
    A column that the scorer does not read falls by 0. Rows are ranked by key once; the scorer of a column reads the
    columns it needs of the written permutation."""
    rows = _by_key(df.select(key, label, *cols), key)
    ranges = _ranges(rows)
    area = lambda x: evaluate.aucpr(x, "p", label, ranges).first()["aucpr"]
    baseline = area(scorer(rows.select(key, label, *cols)).select("p", label))
    out = []
    for fold in range(folds):
        moved = written(permuted(rows, cols, key, seed + fold), "permuted")
        for c in cols:
            other = moved.withColumn(c, F.col(f"{c}__permuted")).select(key, label, *cols)
            out.append((c, fold, baseline, round(baseline - area(scorer(other).select("p", label)), 12)))
    drops = df.sparkSession.createDataFrame(out, "feature string, fold int, baseline double, fall double")
    return drops.groupBy("feature").agg(F.first("baseline").alias("baseline"), F.avg("fall").alias("mean"), F.stddev_samp("fall").alias("std"))


def single_feature_auc(df: DataFrame, cols: list[str], label: str, key: str, rounds: int = 10, test: float = 0.2, seed: int = 42) -> DataFrame:
    """(feature, auc) of a model fitted on that column alone, on a held-out share; near 0.5: of little use."""
    rows = []
    for c in cols:  # one small model a column
        _, scored, _ = train_report(df, [c], label, key, test=test, seed=seed, rounds=rounds, depth=3)
        rows.append((c, evaluate.auc(scored, "p", label).first()["auc"]))
    return df.sparkSession.createDataFrame(rows, "feature string, auc double")


# ------------------------------------------------------------------ E17 -------------
def grid_rows(df: DataFrame, grids: dict[str, list[float]]) -> DataFrame:
    """Every row once for each value of each grid: columns ``feature``, ``value``, and the feature set to the value."""
    points = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(float(v)).alias("value")) for c, values in grids.items() for v in values])
    out = df.withColumn("__point", F.explode(points)).withColumns({"feature": F.col("__point.feature"), "value": F.col("__point.value")}).drop("__point")
    return out.withColumns({c: F.when(F.col("feature") == c, F.col("value").cast(df.schema[c].dataType)).otherwise(F.col(c)) for c in grids})


def partial_dependence(df: DataFrame, grids: dict[str, list[float]], scorer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(feature, value, mean, n): the mean score of all rows with the feature set to each value of its grid. Rows are
    copied once a grid point (the grids are given, so bounded) and scored in one pass; nothing is joined."""
    return scorer(grid_rows(df, grids)).groupBy("feature", "value").agg(F.avg("p").alias("mean"), F.count(F.lit(1)).alias("n"))


def individual_expectation(df: DataFrame, key: str, grids: dict[str, list[float]], scorer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """E17, a curve a row: (key, feature, value, p)."""
    return scorer(grid_rows(df, grids)).select(key, "feature", "value", "p")
