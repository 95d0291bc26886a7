"""Quality classifier: regularised quadratic discriminant analysis on document statistics.

One pass over the texts makes a short vector of transformed statistics per document (lengths,
shares of character classes, repetition, marks around words; never labels, language, source or
id). Class means and covariances come from one Spark aggregate over all labelled training rows;
each covariance is shrunk towards its diagonal and the identity, factorised once (Cholesky), and a
document's odds are the difference of the two log densities plus the log prior odds. Densities of
many dependent statistics are overconfident, so the score is a logistic of the odds whose slope and
offset are fitted to the training rows' odds (a histogram of a bounded number of buckets).

Defined results: null or empty texts get the statistics of an empty text and a score; several
labels of a doc_id each count as a training row; labels that are null or not 0/1 and labels
without a document are left out; with no training row of some class every score is the share of
label 1 (0.5 without any); repeated rows give a row each; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import doc_columns, materialise, restored, text_bytes, text_chunks

FOLDS = 5
THRESHOLD = 0.3
#: Weights of the diagonal and of the identity in the shrunk covariance.
SHRINK_DIAGONAL = 0.15
SHRINK_IDENTITY = 0.02
#: Odds beyond this count as this in the calibration: 2 * REACH + 1 buckets of width 1.
REACH = 1000

_KINDS = np.zeros(256, dtype=np.int64)  # 0 other ASCII, 1 lower, 2 upper, 3 digit, 4 space, 5 line break, 6 sentence marks, 7 beyond ASCII
for _b in range(256):
    _c = chr(_b)
    _KINDS[_b] = (7 if _b >= 128 else 1 if _c.islower() else 2 if _c.isupper() else 3 if _c.isdigit() else 5 if _c == "\n"
                  else 4 if _c.isspace() else 6 if _c in ".,;:?'\"-()" else 0)
FEATURES = ("log_chars", "log_words", "word_length", "upper", "digits", "odd_marks", "sentence_marks", "line_breaks", "beyond_ascii", "distinct",
            "neighbours_equal", "top_word", "marked_words", "upper_words", "lone_marks", "repeated_lines", "line_words", "compression")


def statistics(raw: bytes) -> list[float]:
    """The transformed statistics of a text, in the order of FEATURES."""
    n = len(raw)
    kinds = np.bincount(_KINDS[np.frombuffer(raw, dtype=np.uint8)], minlength=8) if n else np.zeros(8, dtype=np.int64)
    words = raw.split()
    w = len(words)
    counts: dict[bytes, int] = {}
    equal = marked = upper = lone = 0
    before = None
    for word in words:
        counts[word] = counts.get(word, 0) + 1
        equal += word == before
        before = word
        tail = word[-1]
        if _KINDS[tail] == 0:
            marked += 1
            lone += len(word) == 1
        upper += len(word) > 1 and word.isupper()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    share = lambda a, b: np.log((a + 0.5) / (b + 10.0))  # noqa: E731  a share on a log scale, steady for short texts
    return [np.log1p(n), np.log1p(w), np.log1p((n - kinds[4] - kinds[5]) / max(w, 1)), share(kinds[2], n), share(kinds[3], n), share(kinds[0], n), share(kinds[6], n),
            share(kinds[5], n), share(kinds[7], n), share(len(counts), w), share(equal, w), share(max(counts.values(), default=0), w),
            share(marked, w), share(upper, w), share(lone, w), share(len(lines) - len(set(lines)), len(lines)),
            np.log1p(w / max(len(lines), 1)), np.log((len(zlib.compress(raw, 1)) + 8.0) / (n + 16.0))]


def _features(batches):
    for part in text_chunks(batches):
        yield pa.record_batch([part.column(0), pa.array([statistics(t) for t in text_bytes(part)], pa.list_(pa.float64()))], names=["doc_id", "x"])


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 0 modulo FOLDS; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


class QuadraticDiscriminant:
    """Two Gaussian classes with shrunk covariances and cached Cholesky factors; score = logistic(slope * odds + offset)."""

    slope, offset = 1.0, 0.0

    def __init__(self, counts, means, covariances):
        self.prior = (counts[1] + 1.0) / (counts[0] + counts[1] + 2.0)
        self.usable = min(counts) > 0
        if not self.usable:
            return
        pooled = sum(n * c for n, c in zip(counts, covariances)) / sum(counts)
        self.scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
        self.means, self.factors, self.log_det = [], [], []
        for mean, cov in zip(means, covariances):
            z = cov / np.outer(self.scale, self.scale)
            z = (1 - SHRINK_DIAGONAL - SHRINK_IDENTITY) * z + SHRINK_DIAGONAL * np.diag(np.diag(z)) + SHRINK_IDENTITY * np.eye(len(mean))
            factor = np.linalg.cholesky(z)
            self.means.append(mean / self.scale)
            self.factors.append(np.linalg.inv(factor))
            self.log_det.append(2 * np.log(np.diag(factor)).sum())

    def odds(self, x: np.ndarray) -> np.ndarray:
        z = x / self.scale
        density = [-0.5 * (((z - m) @ f.T) ** 2).sum(axis=1) - 0.5 * d for m, f, d in zip(self.means, self.factors, self.log_det)]
        return density[1] - density[0] + np.log(self.prior / (1 - self.prior))

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.usable:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.odds(x) + self.offset, -500, 500)))

    def calibrate(self, odds: np.ndarray, ones: np.ndarray, zeros: np.ndarray) -> None:
        """Slope and offset by Newton steps on counts of both classes at given odds; targets a little
        inside 0 and 1 keep the slope finite when the classes part cleanly."""
        high, low = (ones.sum() + 1) / (ones.sum() + 2), 1 / (zeros.sum() + 2)
        total, aim = ones + zeros, ones * high + zeros * low
        centre, spread = np.average(odds, weights=total), max(np.sqrt(np.cov(odds, fweights=total.astype(int), ddof=0)), 1e-6)
        u = np.stack([(odds - centre) / spread, np.ones(len(odds))], axis=1)
        loss = lambda w: np.sum(total * np.logaddexp(0, u @ w) - aim * (u @ w)) + 1e-3 * w[0] ** 2
        w = np.array([1.0, 0.0])
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(u @ w, -500, 500)))
            gradient = u.T @ (total * p - aim) + [2e-3 * w[0], 0]
            step = np.linalg.solve((u * (total * p * (1 - p))[:, None]).T @ u + np.diag([2e-3, 1e-9]), gradient)
            size = 1.0
            while size > 1e-8 and loss(w - size * step) > loss(w):
                size /= 2
            w = w - size * step
            if np.abs(size * step).max() < 1e-9:
                break
        if w[0] > 0:
            self.slope, self.offset = w[0] / spread, w[1] - w[0] * centre / spread


def fit(features: DataFrame, labels: DataFrame) -> QuadraticDiscriminant:
    """One aggregate over every labelled row outside the held-out fold: counts, sums and products;
    then a histogram of the same rows' odds."""
    k = len(FEATURES)
    marked = (labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("quality").cast("int").alias("quality"))
              .filter(F.col("quality").isin(0, 1) & ~held_out(F.col("label_id"))))
    rows = features.join(marked, F.col("doc_id") == F.col("label_id")).select("quality", "x")
    sums = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(k)]
    products = [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"p{i}_{j}") for i in range(k) for j in range(i + 1)]
    found = {r["quality"]: r for r in rows.groupBy("quality").agg(F.count(F.lit(1)).alias("n"), *sums, *products).collect()}  # two rows
    counts, means, covariances = [], [], []
    for c in (0, 1):
        r = found.get(c)
        n = r["n"] if r else 0
        mean = np.array([r[f"s{i}"] for i in range(k)]) / n if n else np.zeros(k)
        cov = np.zeros((k, k))
        for i in range(k if n else 0):
            for j in range(i + 1):
                cov[i, j] = cov[j, i] = r[f"p{i}_{j}"] / n - mean[i] * mean[j]
        counts.append(n)
        means.append(mean)
        covariances.append(cov)
    model = QuadraticDiscriminant(counts, means, covariances)
    if model.usable:
        def bucketed(batches):
            for batch in batches:
                x = np.array(batch.column(1).to_pylist(), dtype=float).reshape(-1, k)
                yield pa.record_batch([batch.column(0), pa.array(np.clip(np.rint(model.odds(x)), -REACH, REACH).astype(np.int32))], names=["quality", "bucket"])

        seen = rows.mapInArrow(bucketed, "quality int, bucket int").groupBy("bucket").agg(F.sum("quality").alias("ones"), F.count(F.lit(1)).alias("n")).collect()
        odds, ones, n = (np.array([float(r[c]) for r in sorted(seen)]) for c in ("bucket", "ones", "n"))
        model.calibrate(odds, ones, n - ones)
    return model


def _scored(model: QuadraticDiscriminant, threshold: float, batches):
    """Batches with the text (and what it carries) to the same with score and predicted."""
    for part in text_chunks(batches):
        x = np.array([statistics(t) for t in text_bytes(part)]).reshape(-1, len(FEATURES))
        score = model.score(x)
        yield pa.record_batch([*part.columns, pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32), pa.int32())],
                              names=[*part.schema.names, "score", "predicted"])


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document row: doc_id, held_out, score (higher: label 1 likelier), predicted."""
    features = materialise(doc_columns(docs).mapInArrow(_features, "doc_id long, x array<double>"))
    model = fit(features, labels)

    def scored(batches):
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), dtype=float).reshape(-1, len(FEATURES))
            yield pa.record_batch([batch.column(0), pa.array(model.score(x), pa.float64())], names=["doc_id", "score"])

    out = features.mapInArrow(scored, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject; texts are not shuffled."""
    model = fit(materialise(doc_columns(docs).mapInArrow(_features, "doc_id long, x array<double>")), labels)
    df = doc_columns(docs, carry=True)
    schema = T.StructType([*df.schema.fields, *T.StructType.fromDDL("score double, predicted int").fields])
    return restored(df.mapInArrow(lambda b: _scored(model, threshold, b), schema).filter("predicted = 1"), docs)
