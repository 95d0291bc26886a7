"""Training a factorisation machine (M5) for the scorer of ``score.fm_score``.

Rows are (key, label, xi, xv) as the scorer reads them. A pass is one full gradient of the mean log loss: entries meet
the weight table by index, are added up to a row's sums, and go back to the indices as gradients. The weights stay a
table (idx, w, v0, v1, ...) from start to end, so a vocabulary of any size is trained; only the loss and the step reach
the driver. The table is checkpointed after each pass.

An index that most rows hold is added up on the map side first; its weights meet the entries by a join that Spark may
split or broadcast. Passes take the step that was given; if a pass would raise the loss, the step is halved and the
pass repeated, so the loss falls with every pass kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def entries(rows: DataFrame, key: str, label: str) -> DataFrame:
    """(key, y, idx, x): a row for every index of every labelled row."""
    pairs = F.explode(F.arrays_zip("xi", "xv"))
    z = rows.filter(F.col(label).isNotNull()).select(F.col(key).alias("key"), F.col(label).cast("double").alias("y"), pairs.alias("p"))
    return z.select("key", "y", F.col("p.xi").cast("long").alias("idx"), F.col("p.xv").cast("double").alias("x"))


def start_weights(found: DataFrame, k: int, spread: float = 0.01) -> DataFrame:
    """(idx, w, v0...) for every index of ``found``, from a rule: w 0, v a small wave of the index."""
    wave = [(F.lit(spread) * F.sin((F.col("idx") + 1).cast("double") * (j + 1))).alias(f"v{j}") for j in range(k)]
    return found.select("idx").distinct().select("idx", F.lit(0.0).alias("w"), *wave)


def row_scores(z: DataFrame, weights: DataFrame, k: int) -> DataFrame:
    """(key, y, s0..., e): sums and error (probability minus label) of each row."""
    j = z.join(weights, "idx")
    sums = [F.sum(F.col(f"v{f}") * F.col("x")).alias(f"s{f}") for f in range(k)]
    squares = sum((F.pow(F.col(f"v{f}") * F.col("x"), 2) for f in range(k)), F.lit(0.0))
    per = j.groupBy("key").agg(F.first("y").alias("y"), F.sum(F.col("w") * F.col("x")).alias("linear"), F.sum(squares).alias("q"), *sums)
    logit = F.col("linear") + (sum((F.col(f"s{f}") * F.col(f"s{f}") for f in range(k)), F.lit(0.0)) - F.col("q")) / 2
    return per.withColumn("p", 1.0 / (1.0 + F.exp(-logit))).select("key", "y", "p", (F.col("p") - F.col("y")).alias("e"), *[f"s{f}" for f in range(k)])


def log_loss_of(scores: DataFrame) -> tuple[float, int]:
    p = F.least(F.greatest(F.col("p"), F.lit(1e-15)), F.lit(1 - 1e-15))
    r = scores.agg(F.avg(-(F.col("y") * F.ln(p) + (1 - F.col("y")) * F.ln(1 - p))), F.count(F.lit(1))).first()
    return r[0], r[1]


def gradient(z: DataFrame, scores: DataFrame, weights: DataFrame, k: int, n: int, l2: float) -> DataFrame:
    """(idx, gw, gv0...): the gradient of the mean loss plus l2/2 of the squared weights."""
    j = z.join(scores.drop("y", "p"), "key").join(weights, "idx")
    e, x = F.col("e"), F.col("x")
    parts = [F.sum(e * x).alias("gw")] + [F.sum(e * x * (F.col(f"s{f}") - F.col(f"v{f}") * x)).alias(f"gv{f}") for f in range(k)]
    g = j.groupBy("idx").agg(*parts).join(weights, "idx")
    names = ["w"] + [f"v{f}" for f in range(k)]
    return g.select("idx", *[(F.col("g" + c) / n + l2 * F.col(c)).alias("g" + c) for c in names], *names)


def train(rows: DataFrame, key: str, label: str, k: int = 4, passes: int = 5, step: float = 1.0, l2: float = 0.0, spread: float = 0.01) -> tuple[DataFrame, list[float]]:
    """M5: the weight table for ``score.fm_score`` and the mean log loss before the first and after every pass.
    Without rows the table is empty and there is no loss."""
    z = cut_lineage(entries(rows, key, label))
    weights = cut_lineage(start_weights(z, k, spread))
    scores = cut_lineage(row_scores(z, weights, k))
    loss, n = log_loss_of(scores)
    if not n:
        return weights, []
    losses, names = [loss], ["w"] + [f"v{f}" for f in range(k)]
    for _ in range(passes):
        g = cut_lineage(gradient(z, scores, weights, k, n, l2))
        while True:
            moved = cut_lineage(g.select("idx", *[(F.col(c) - step * F.col("g" + c)).alias(c) for c in names]))
            after = cut_lineage(row_scores(z, moved, k))
            loss, _ = log_loss_of(after)
            if loss < losses[-1] or step < 1e-9:
                break
            step /= 2
        if loss >= losses[-1]:
            break  # no step lowers the loss any more
        weights, scores = moved, after
        losses.append(loss)
    return weights, losses
