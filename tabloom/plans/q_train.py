"""Queries that fit models: boosted trees, cross-validation, leaves as inputs, parameter search, factorisation machine,
permutation and single-feature importance, partial dependence.

Fitted trees have no SQL twin: those queries return what must hold of them (rows scored once, shares that sum to 1, areas
above a floor that pure chance does not reach) beside counts that SQL takes from the same splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate, fm, score, training
from ..operators.core import hash_uniform_sql
from ..session import cut_lineage
from .fixtures import SCORED_SQL, scored, table, with_sql
from .registry import register, round_doubles

FEATURES = ["signal", "price", "custkey", "priority", "app_month"]


def train_rows(spark, sf):
    return scored(spark, sf).select("id", "y", F.col("p").alias("signal"), "price", "custkey", "priority", "app_month")


def _split_sql(seed: int, ratio: float) -> str:
    return f"""part AS (SELECT *, rk > n - floor(n * {ratio}) AS held FROM (
  SELECT id, y, row_number() OVER (PARTITION BY y ORDER BY {hash_uniform_sql('id', seed)}, id) AS rk, count(*) OVER (PARTITION BY y) AS n FROM scored))"""


@register("gbt_report", ["M1", "X7", "E6"], sql=with_sql(SCORED_SQL, _split_sql(43, 0.2)) + """
SELECT count(*) AS n_test, CAST(sum(y) AS BIGINT) AS pos_test, true AS several_trees, true AS beats_chance, true AS hits, 5 AS n_features, 1.0 AS share_total, 'signal' AS strongest
FROM part WHERE held""")
def gbt_report(spark, sf):
    """Trees on 0.8 of the orders, 0.1 of those held back to stop growing; the rest scored."""
    model, held, report = training.train_report(train_rows(spark, sf), FEATURES, "y", "id", rounds=10, depth=3)
    shares = training.importance_table([model], FEATURES, spark)
    about = shares.agg(F.count(F.lit(1)).cast("int").alias("n_features"), F.round(F.sum("share"), 6).alias("share_total"), F.min_by("feature", "rank").alias("strongest"))
    counts = held.agg(F.count(F.lit(1)).alias("n_test"), F.sum(F.col("y").cast("long")).alias("pos_test"))
    facts = report.select((F.col("trees") > 1).alias("several_trees"), (F.col("test_auc") > 0.58).alias("beats_chance"), (F.col("hit_rate") > 0.5).alias("hits"))
    one = F.lit(1).alias("_one")  # three rows of one each
    return counts.select("*", one).join(facts.select("*", one), "_one").join(about.select("*", one), "_one").drop("_one")


@register("gbt_cross_validation", ["M2", "S7", "E19"], sql=with_sql(SCORED_SQL) + f"""
SELECT fold, count(*) AS n, CAST(sum(y) AS BIGINT) AS pos, true AS beats_chance, true AS in_range FROM (
  SELECT y, CAST((row_number() OVER (PARTITION BY y ORDER BY {hash_uniform_sql('id', 1)}, id) - 1) % 3 AS INTEGER) AS fold FROM scored) GROUP BY 1""")
def gbt_cross_validation(spark, sf):
    """Three folds; every row is scored by the model that did not see it."""
    _, rows = training.cross_validate(train_rows(spark, sf), FEATURES, "y", "id", k=3, rounds=6, depth=3)
    report = {r["metric"]: r["mean"] for r in training.fold_report(rows, "y", "id").collect()}
    return rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("y").cast("long")).alias("pos"), F.lit(report["auc"] > 0.58).alias("beats_chance"),
                                    F.min((F.col("p") >= 0) & (F.col("p") <= 1)).alias("in_range"))


@register("gbt_leaf_regression", ["M3", "N3"], sql=with_sql(SCORED_SQL) + """
SELECT count(*) AS n, true AS a_leaf_a_tree, true AS as_good_as_trees FROM scored""")
def gbt_leaf_regression(spark, sf):
    rows = cut_lineage(training.dealt(train_rows(spark, sf), "id"))
    model = training.fit_gbt(rows, FEATURES, "y", "id", rounds=6, depth=3)
    leaves = training.leaf_columns(model, training.prepared(rows, FEATURES, "y"))
    counts = training.leaf_counts(model)
    seen = leaves.agg(*[F.count_distinct(f"leaf_{i}").alias(f"leaf_{i}") for i in range(len(counts))]).first()
    regression = training.fit_leaf_regression(model, rows, FEATURES, "y")
    trees = evaluate.auc(training.scored_rows(model, training.prepared(rows, FEATURES, "y")), "p", "y").first()["auc"]
    scores = training.leaf_scores(model, regression, rows, FEATURES, "y")
    linear = evaluate.auc(scores, "p", "y").first()["auc"]
    fits = all(1 < seen[f"leaf_{i}"] <= n for i, n in enumerate(counts))
    return scores.agg(F.count("p").alias("n"), F.lit(fits).alias("a_leaf_a_tree"), F.lit(linear >= trees - 0.02).alias("as_good_as_trees"))


@register("gbt_search", ["M4", "E9"], sql="SELECT i AS trial, true AS scored, true AS consistent FROM range(3) t(i) WHERE (SELECT count(*) FROM orders) > 0")
def gbt_search(spark, sf):
    grid = [{"rounds": 3, "depth": 2}, {"rounds": 6, "depth": 3}, {"rounds": 3, "depth": 4, "step": 0.4}]
    found = training.search(train_rows(spark, sf), FEATURES, "y", "id", grid, lambda x: evaluate.aucpr(x, "p", "y").first()["aucpr"])
    top = found.filter("accepted").agg(F.max("score")).first()[0]
    best = F.col("accepted") & (F.col("score") == F.lit(top)) if top is not None else F.lit(False)
    return found.select(F.col("trial").cast("long").alias("trial"), F.col("score").between(0, 1).alias("scored"), (best | ~F.col("best")).alias("consistent"))


@register("single_feature_auc", ["X9", "E8"], sql="SELECT feature, useful FROM (VALUES ('signal', true), ('custkey', false)) t(feature, useful) WHERE (SELECT count(*) FROM orders) > 0")
def single_feature_auc(spark, sf):
    found = training.single_feature_auc(train_rows(spark, sf), ["signal", "custkey"], "y", "id", rounds=4)
    return found.select("feature", (F.col("auc") > 0.58).alias("useful"))


# ------------------------------------------------------------------ X8 --------------
PERMUTE = ["signal", "price", "custkey"]


def _logistic(x):
    z = 4 * F.col("signal") - 2 + F.coalesce(F.col("price"), F.lit(0.0)) / 1e6
    return x.withColumn("p", 1.0 / (1.0 + F.exp(-z)))


def _permutation_sql(folds: int = 2, seed: int = 5) -> str:
    score_ = "1.0 / (1.0 + exp(-(4 * {signal} - 2 + coalesce({price}, 0.0) / 1e6)))"
    runs = ["SELECT 'base' AS feature, -1 AS fold, y, " + score_.format(signal="signal", price="price") + " AS s FROM t"]
    parts = ["t AS (SELECT id, y, p AS signal, price, custkey, row_number() OVER (ORDER BY id) AS r FROM scored)"]
    for f in range(folds):
        parts.append(f"m{f} AS (SELECT a.*, b.signal AS signal_, b.price AS price_ FROM t a JOIN (SELECT *, row_number() OVER (ORDER BY {hash_uniform_sql('id', seed + f)}, id) AS r2 FROM t) b ON a.r = b.r2)")
        for c in PERMUTE:
            cols = {x: f"{x}_" if x == c else x for x in ("signal", "price")}
            runs.append(f"SELECT '{c}', {f}, y, {score_.format(**cols)} FROM m{f}")
    return with_sql(SCORED_SQL, *parts, f"""runs AS ({' UNION ALL '.join(runs)}),
per AS (SELECT feature, fold, s, sum(y) AS pos, sum(1 - y) AS neg FROM runs GROUP BY 1, 2, 3),
c AS (SELECT feature, fold, row_number() OVER w AS r, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM per WINDOW w AS (PARTITION BY feature, fold ORDER BY s DESC ROWS UNBOUNDED PRECEDING)),
pts AS (SELECT feature, fold, r, tp / (tp + fp) AS prec, tp / (SELECT sum(y) FROM scored) AS rec, tp FROM c),
las AS (SELECT feature, fold, min(r) AS lr FROM pts WHERE tp >= (SELECT sum(y) FROM scored) GROUP BY 1, 2),
j AS (SELECT *, coalesce(lag(prec) OVER w, 1.0) AS prec0, coalesce(lag(rec) OVER w, 0.0) AS rec0 FROM pts WINDOW w AS (PARTITION BY feature, fold ORDER BY r)),
au AS (SELECT feature, fold, sum(0.5 * (prec + prec0) * (rec - rec0)) AS a FROM j JOIN las USING (feature, fold) WHERE r <= lr GROUP BY 1, 2)""") + """
SELECT feature, round((SELECT a FROM au WHERE feature = 'base'), 6) AS baseline, round(avg((SELECT a FROM au WHERE feature = 'base') - a), 6) AS mean,
       round(stddev_samp((SELECT a FROM au WHERE feature = 'base') - a), 6) AS std FROM au WHERE feature <> 'base' GROUP BY 1"""


@register("permutation_importance", ["X8", "E9"], sql=_permutation_sql())
def permutation_importance(spark, sf):
    """A given scorer that reads two of three columns: permuting the third changes nothing."""
    rows = train_rows(spark, sf)
    return round_doubles(training.permutation_importance(rows, PERMUTE, "y", "id", _logistic, folds=2))


# ------------------------------------------------------------------ M5 --------------
def fm_rows(spark, sf):
    """Orders as entries: customer group, month and priority; whether the order is finished."""
    o = table(spark, sf, "orders")
    xi = F.array((F.col("o_custkey") % 50).cast("int"), (F.lit(49) + F.month("o_orderdate")).cast("int"), (F.lit(61) + F.substring("o_orderpriority", 1, 1).cast("int")).cast("int"))
    xv = F.array(F.lit(1.0), F.lit(1.0), F.col("o_totalprice").cast("double") / 500000.0).cast("array<float>")
    return o.select(F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "F").cast("int").alias("y"), xi.alias("xi"), xv.alias("xv"))


def _fm_training_sql(k: int = 2, passes: int = 3, step: float = 1.0, spread: float = 0.01) -> str:
    names = ["w"] + [f"v{f}" for f in range(k)]
    sums = ", ".join([f"sum(v{f} * x) AS s{f}" for f in range(k)])
    squares = " + ".join(f"v{f} * x * v{f} * x" for f in range(k))
    pairs = " + ".join(f"s{f} * s{f}" for f in range(k))
    parts = ["""z AS MATERIALIZED (SELECT o_orderkey AS id, CAST(o_orderstatus = 'F' AS DOUBLE) AS y, unnest([o_custkey % 50, 49 + month(o_orderdate), 61 + CAST(substr(o_orderpriority, 1, 1) AS BIGINT)]) AS idx,
  unnest([1.0::DOUBLE, 1.0::DOUBLE, CAST(CAST(CAST(o_totalprice AS DOUBLE) / 500000.0 AS FLOAT) AS DOUBLE)]) AS x FROM orders)""",
             "w0 AS MATERIALIZED (SELECT idx, CAST(0 AS DOUBLE) AS w, " + ", ".join(f"{spread} * sin(CAST(idx + 1 AS DOUBLE) * {f + 1}) AS v{f}" for f in range(k)) + " FROM (SELECT DISTINCT idx FROM z))"]
    for i in range(passes + 1):
        parts.append(f"r{i} AS MATERIALIZED (SELECT *, 1.0 / (1.0 + exp(-(lin + ({pairs} - q) / 2))) AS p FROM (SELECT id, max(y) AS y, sum(w * x) AS lin, sum({squares}) AS q, {sums} FROM z JOIN w{i} USING (idx) GROUP BY id))")
        if i < passes:
            grads = ", ".join(["sum((p - r.y) * x) / (SELECT count(*) FROM orders) AS gw"] + [f"sum((p - r.y) * x * (s{f} - v{f} * x)) / (SELECT count(*) FROM orders) AS gv{f}" for f in range(k)])
            moved = ", ".join(f"{c} - {step} * g{c} AS {c}" for c in names)
            parts.append(f"w{i + 1} AS MATERIALIZED (SELECT idx, {moved} FROM (SELECT idx, {grads}, {', '.join(f'max({c}) AS {c}' for c in names)} FROM z JOIN r{i} r USING (id) JOIN w{i} USING (idx) GROUP BY idx))")
    out = " UNION ALL ".join(f"SELECT {i} AS pass, avg(-(y * ln(p) + (1 - y) * ln(1 - p))) AS loss FROM r{i}" for i in range(passes + 1))
    return "WITH " + ",\n".join(parts) + f"\nSELECT CAST(pass AS INTEGER) AS pass, round(loss, 8) AS loss FROM ({out})"


@register("fm_training", ["M5"], sql=_fm_training_sql())
def fm_training(spark, sf):
    """Mean log loss before the first and after each of three passes over all orders."""
    _, losses = fm.train(fm_rows(spark, sf), "id", "y", k=2, passes=3, step=1.0)
    return round_doubles(spark.createDataFrame(list(enumerate(losses)), "pass int, loss double"), 8)


# ------------------------------------------------------------------ E17 -------------
GRID_COUNTS = [0, 1, 5, 20]


@register("partial_dependence_fm", ["E17", "M6"], sql=f"""
WITH cnt AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2),
{score.VALUE_INDEX_SQL},
x AS (SELECT u.user_id, f.field, coalesce(i.idx, f.idx0) AS idx FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN fields f
      LEFT JOIN cnt c ON c.user_id = u.user_id AND c.event_type = f.event_type LEFT JOIN places i ON i.event_type = c.event_type AND i.n = c.n),
g AS (SELECT t AS field, t * {score.SLOTS} + c AS value FROM range({len(score.EVENT_TYPES)}) r(t), (SELECT unnest({GRID_COUNTS}) AS c)),
e AS (SELECT x.user_id, g.field AS feature, g.value, CASE WHEN x.field = g.field THEN g.value ELSE x.idx END AS idx FROM x CROSS JOIN g),
s AS (SELECT user_id, feature, value, sum(w) AS lin, {score.SUMS_SQL} FROM e JOIN (SELECT DISTINCT idx FROM e) d USING (idx) JOIN ({score.weights_sql('SELECT DISTINCT idx AS i FROM e')}) w USING (idx) GROUP BY 1, 2, 3)
SELECT 'c' || feature AS feature, CAST(value AS DOUBLE) AS value, round(avg(1.0 / (1.0 + exp(-(lin + 0.5 * ({score.PAIRS_SQL}))))), 6) AS mean, count(*) AS n FROM s GROUP BY 1, 2""")
def partial_dependence_fm(spark, sf):
    """Mean score of all users with the count of one event type set to 0, 1, 5 and 20, for each of the base types."""
    feats = score.user_sparse_features(table(spark, sf, "events"))
    size = score.index_size(feats)
    n = feats.agg(F.max(F.size("xi"))).first()[0] or 0
    wide = feats.select("user_id", *[F.col("xi")[i].alias(f"c{i}") for i in range(n)])

    def scorer(rows):
        keyed = rows.withColumns({"key": F.struct("user_id", "feature", "value"), "xi": F.array(*[f"c{i}" for i in range(n)]), "xv": F.array_repeat(F.lit(1.0).cast("float"), n)})
        return score.fm_score(keyed, score.fm_weights(spark, n_index=size), key="key").select("key.*", F.col("score").alias("p"))

    grids = {f"c{i}": [i * score.SLOTS + c for c in GRID_COUNTS] for i in range(len(score.EVENT_TYPES))}
    return round_doubles(training.partial_dependence(wide, grids, scorer))
