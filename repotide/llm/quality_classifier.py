"""Quality scores by a regularised quadratic discriminant over document statistics.

Each whole text is reduced to transformed statistics. The means and covariances of both
classes come from all labelled training rows, aggregated in each task before one shuffle of
two rows. A covariance is shrunk towards the pooled one and towards its diagonal; its Cholesky
factor is inverted once, so that a row costs one triangular product per class. The score is
the logistic function of the log-density difference plus the log prior ratio, softened by a
temperature.

Rows without a label or with a null one teach nothing; a doc_id that has several labels counts
once for each. Null and empty texts have the statistics of no words and get a score like any
other. Without training rows of both classes the score is the share of label 1 (0.5 if there
are none). A null doc_id counts as the empty string in the split.
"""

import math
import re

import numpy as np
from pyspark.sql import functions as F

from repotide.llm.common import map_rows
from repotide.llm.quality_rules import statistics_of
from repotide.scratch import write_table

#: Weights of the pooled covariance and of the diagonal in each class covariance.
POOLED, DIAGONAL = 0.05, 0.1
#: Least standard deviation of a statistic.
FLOOR = 0.02
TEMPERATURE = 4.0
DIMENSIONS = 10
MARK = re.compile(r"[^\w\s]")
PAIRS = [(i, j) for i in range(DIMENSIONS) for j in range(i, DIMENSIONS)]


def features_of(text):
    n, chars, _, _, _, features = statistics_of(text)
    text = text or ""
    lines = text.count("\n") + 1
    return [
        *features,
        math.log(n + 1),
        math.log((chars + 1) / lines),
        math.sqrt(len(MARK.findall(text)) / max(len(text), 1)),
    ]


def held_out():
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(3)) == 1


def document_features(docs):
    def make():
        def each(doc_id, text):
            yield doc_id, features_of(text)

        return each

    return map_rows(docs.select("doc_id", "text"), make, "doc_id long, features array<double>")


class Discriminant:
    """Means, inverse Cholesky factors and log determinants of two shrunken class densities."""

    def __init__(self, moments):
        """`moments`: {class: (rows, mean, covariance matrix)} of both classes."""
        total = sum(m[0] for m in moments.values())
        pooled = sum(m[0] * m[2] for m in moments.values()) / total
        self.classes = {}
        for label, (rows, mean, cov) in moments.items():
            mixed = (1 - POOLED) * cov + POOLED * pooled
            mixed = (1 - DIAGONAL) * mixed + DIAGONAL * np.diag(np.diag(mixed)) + FLOOR**2 * np.eye(len(mean))
            factor = np.linalg.cholesky(mixed)
            self.classes[label] = (np.asarray(mean), np.linalg.inv(factor), 2 * np.log(np.diag(factor)).sum())
        self.prior = math.log(moments[1][0] / moments[0][0])

    def log_ratio(self, x):
        """Log-density difference and prior, for rows of statistics."""
        out = np.full(len(x), self.prior)
        for label, sign in ((1, 1), (0, -1)):
            mean, white, determinant = self.classes[label]
            out -= sign * 0.5 * (np.square((x - mean) @ white.T).sum(1) + determinant)
        return out


def fitted(features, labels):
    """(discriminant or None, share of label 1) from the training rows."""
    known = features.where(~held_out()).join(
        labels.where(F.col("quality").isin(0, 1)).select("doc_id", "quality"), "doc_id"
    )
    x = [F.element_at("features", k + 1) for k in range(DIMENSIONS)]
    got = known.groupBy("quality").agg(
        F.count("*").alias("rows"),
        F.array(*(F.avg(v) for v in x)).alias("mean"),
        F.array(*(F.covar_pop(x[i], x[j]) for i, j in PAIRS)).alias("cov"),
    )
    moments = {}
    for row in got.collect():  # two rows at most
        cov = np.zeros((DIMENSIONS, DIMENSIONS))
        for (i, j), v in zip(PAIRS, row["cov"], strict=True):
            cov[i, j] = cov[j, i] = v
        moments[row["quality"]] = (row["rows"], np.array(row["mean"]), cov)
    rows = sum(m[0] for m in moments.values())
    share = moments[1][0] / rows if 1 in moments else 0.0 if rows else 0.5
    return (Discriminant(moments) if len(moments) == 2 else None), share


def scores(docs, labels):
    """doc_id, held_out, score, predicted, log_ratio of each row of `docs`."""
    features = write_table(document_features(docs), "features")
    model, share = fitted(features, labels)

    def make():
        def each(doc_id, x):
            if model is None:
                ratio, score = None, share
            else:
                ratio = float(model.log_ratio(np.array([x]))[0])
                score = 1 / (1 + math.exp(-max(-700.0, min(700.0, ratio / TEMPERATURE))))
            yield doc_id, score, ratio

        return each

    rows = map_rows(features, make, "doc_id long, score double, log_ratio double")
    return rows.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "log_ratio"
    )
