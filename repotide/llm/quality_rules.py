"""Quality rules: base statistics of a text, and robust outliers by language and source.

`text_statistics` walks each whole text once. `robust_outliers` then fits, for each (lang,
source), the minimum covariance determinant of the transformed statistics: from medians and
median deviations it repeats concentration steps, each of which re-estimates mean and
covariance from the half of the rows that lie nearest. Every step is one partially aggregated
pass over the narrow statistics table, so a hot source never meets in one task. Groups of
fewer than MIN_ROWS rows use the estimate of their language, and languages of fewer the one of
all rows. A row is rejected if its squared Mahalanobis distance passes CUT.

Nulls: a null text has no words; null lang or source are groups of their own. An empty table
gives an empty result. Rows are judged one by one, so repeated ids or rows are kept apart.
"""

import math
import re

import numpy as np
from pyspark.sql import functions as F

from repotide.llm.common import map_rows
from repotide.scratch import write_table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOL = re.compile(r"[#*$%&|<>]")
MIN_ROWS = 200
STEPS = 3
#: Squared distance beyond which a row is an outlier: far beyond the chi-square quantile of
#: 1 - 1e-9 at seven degrees of freedom (about 58), as texts are not normally distributed.
CUT = 150.0
#: Smallest standard deviation of each transformed statistic, so that a group of equal texts
#: does not reject everything else.
FLOOR = (0.15, 0.1, 0.02, 0.03, 0.06, 0.15, 0.15)
NAMES = ("word_length", "variety", "symbols", "upper", "digits", "repeats", "duplicates")
DIMENSIONS = len(NAMES)
#: What an estimate is for: level 0 by language and source, 1 by language, 2 of all rows.
KEYS = ("level", "lang", "source")
STATISTICS_DDL = (
    "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, "
    "n_dup_lines long, n_repeat_words long, features array<double>"
)


def repeated_words(numbers):
    """Words inside three-word windows that occur twice or more."""
    if len(numbers) < 3:
        return 0
    a = np.asarray(numbers, np.int64)
    n = int(a.max()) + 1
    pair = a[:-1] * n + a[1:]
    _, pair = np.unique(pair, return_inverse=True)
    _, window, times = np.unique(pair[:-1] * n + a[2:], return_inverse=True, return_counts=True)
    again = times[window] > 1
    inside = np.zeros(len(a), bool)
    for k in range(3):
        inside[k : len(a) - 2 + k] |= again
    return int(inside.sum())


def statistics_of(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, transformed statistics)."""
    text = text or ""
    words = WORD.findall(text)
    n, chars, symbols = len(words), sum(map(len, words)), len(SYMBOL.findall(text))
    seen, duplicates, lines = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += 1
            duplicates += line in seen
            seen.add(line)
    number = {}
    repeats = repeated_words([number.setdefault(w, len(number)) for w in words])
    upper = sum(map(len, re.findall(r"[A-Z]+", text)))
    digits = sum(map(len, re.findall(r"[0-9]+", text)))
    share = lambda part, whole: math.sqrt(part / max(whole, 1))
    features = [
        math.log((chars + 1) / (n + 1)),
        # Variety falls with length in any text; against the square root of length it is level.
        math.log((len(number) + 1) / (n + 1)) + 0.15 * math.log(n + 1),
        share(symbols, chars),
        share(upper, chars),
        share(digits, chars),
        share(repeats, n),
        share(duplicates, lines),
    ]
    return n, chars, symbols, duplicates, repeats, features


def text_statistics(docs):
    def make():
        def each(doc_id, text, lang, source):
            *counts, features = statistics_of(text)
            yield doc_id, lang, source, *counts, features

        return each

    return map_rows(docs.select("doc_id", "text", "lang", "source"), make, STATISTICS_DDL)


def base_rules(statistics):
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return statistics.withColumn("base_failed", failed)


def _moments():
    """Aggregates of a group: rows, means and the upper triangle of the covariances."""
    x = [F.element_at("features", k + 1) for k in range(DIMENSIONS)]
    pairs = [(i, j) for i in range(DIMENSIONS) for j in range(i, DIMENSIONS)]
    return (
        F.count("*").alias("rows"),
        F.array(*(F.avg(v) for v in x)).alias("mean"),
        F.array(*(F.covar_pop(x[i], x[j]) for i, j in pairs)).alias("cov"),
    )


def _whitener(cov):
    """Rows of the inverse Cholesky factor of a covariance, flat."""
    full = np.zeros((DIMENSIONS, DIMENSIONS))
    full[np.triu_indices(DIMENSIONS)] = cov
    full = full + np.triu(full, 1).T
    floor = np.square(FLOOR)
    # Correlations are shrunk a little; a variance is never below its floor.
    scale = np.sqrt(np.maximum(np.diag(full), 1e-12))
    correlation = 0.9 * full / np.outer(scale, scale) + 0.1 * np.eye(DIMENSIONS)
    np.fill_diagonal(correlation, 1.0)
    wide = np.sqrt(np.maximum(np.diag(full), floor))
    return np.linalg.inv(np.linalg.cholesky(correlation * np.outer(wide, wide))).ravel().tolist()


def _fitted(moments):
    """Adds the whitening matrix to each row of estimates."""

    def make():
        def each(level, lang, source, rows, mean, cov):
            yield level, lang, source, rows, mean, _whitener(cov)

        return each

    ddl = "level int, lang string, source string, rows long, mean array<double>, white array<double>"
    return map_rows(moments.select(*KEYS, "rows", "mean", "cov"), make, ddl)


def _distance():
    """Squared Mahalanobis distance of `features` from `mean` under `white`."""
    d = DIMENSIONS
    x = [F.element_at("features", k + 1) - F.element_at("mean", k + 1) for k in range(d)]
    total = F.lit(0.0)
    for i in range(d):
        z = F.lit(0.0)
        for j in range(i + 1):
            z = z + F.element_at("white", i * d + j + 1) * x[j]
        total = total + z * z
    return total


def _with_estimates(rows, estimates, names=("mean", "white")):
    """Null-safe left join on the keys. Estimates are one row per group; Spark may split hot ones."""
    right = estimates.select(*(F.col(k).alias(f"_{k}") for k in KEYS), *names)
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEYS]
    return rows.join(right, same, "left").drop(*(f"_{k}" for k in KEYS))


def covariance_determinant(rows, steps=STEPS):
    """One robust estimate (mean, whitening matrix) per group of `rows` (KEYS, features)."""
    x = [F.element_at("features", k + 1) for k in range(DIMENSIONS)]
    median = F.array(*(F.percentile_approx(v, 0.5, 1000) for v in x)).alias("mean")
    middle = write_table(rows.groupBy(*KEYS).agg(median), "mcd")
    # At first a diagonal matrix from the median deviations (1.4826 times them is a standard deviation).
    off = [F.abs(v - F.element_at("mean", k + 1)) for k, v in enumerate(x)]
    spread = F.array(*(F.percentile_approx(v, 0.5, 1000) for v in off))
    wide = _with_estimates(rows, middle, ["mean"]).groupBy(*KEYS).agg(
        F.count("*").alias("rows"), F.first("mean").alias("mean"), spread.alias("mad")
    )
    variance = {i: F.pow(1.4826 * F.element_at("mad", i + 1), 2) for i in range(DIMENSIONS)}
    cov = F.array(*(variance[i] if i == j else F.lit(0.0) for i, j in _pairs())).alias("cov")
    fit = write_table(_fitted(wide.select(*KEYS, "rows", "mean", cov)), "mcd")
    for _ in range(steps):
        near = _with_estimates(rows, fit).withColumn("d", _distance()).drop("mean", "white")
        half = near.groupBy(*KEYS).agg(F.percentile_approx("d", 0.5, 1000).alias("half"))
        inner = _with_estimates(near, half, ["half"]).where(F.col("d") <= F.col("half"))
        fit = write_table(_fitted(inner.groupBy(*KEYS).agg(*_moments())), "mcd")
    # The half with the smallest distances understates the spread; its median distance is set
    # to the median of the chi-square distribution.
    near = _with_estimates(rows, fit).withColumn("d", _distance())
    scale = near.groupBy(*KEYS).agg(
        F.count("*").alias("rows"),
        F.first("mean").alias("mean"),
        F.first("white").alias("white"),
        F.percentile_approx("d", 0.5, 1000).alias("half"),
    )
    usual = F.lit(chi_square_median(DIMENSIONS))
    ratio = F.sqrt(usual / F.greatest("half", usual))
    return write_table(
        scale.select(*KEYS, "rows", "mean", F.transform("white", lambda w: w * ratio).alias("white")), "mcd"
    )


def _pairs():
    return [(i, j) for i in range(DIMENSIONS) for j in range(i, DIMENSIONS)]


def chi_square_median(d):
    return d * (1 - 2 / (9 * d)) ** 3


def robust_outliers(statistics, min_rows=MIN_ROWS, cut=CUT):
    """Adds `distance` (squared) and `outlier` to text statistics; estimates use rows that pass
    the base rules. Groups by source, by language and of all rows are estimated side by side."""
    rows = base_rules(statistics)
    none = F.lit(None).cast("string")
    levels = [(F.col("lang"), F.col("source")), (F.col("lang"), none), (none, none)]
    structs = [
        F.struct(F.lit(k).alias("level"), lang.alias("lang"), source.alias("source"))
        for k, (lang, source) in enumerate(levels)
    ]
    usable = rows.where(~F.col("base_failed")).select(F.inline(F.array(*structs)), "features")
    fit = covariance_determinant(usable)
    fit = fit.where((F.col("rows") >= min_rows) | (F.col("level") == len(levels) - 1))
    out = rows.withColumnsRenamed({"lang": "_own_lang", "source": "_own_source"})
    for k, keys in enumerate((["_own_lang", "_own_source"], ["_own_lang"])):
        own = {c: F.col(keys[i]) if i < len(keys) else none for i, c in enumerate(("lang", "source"))}
        placed = _with_estimates(out.withColumns({"level": F.lit(k), **own}), fit)
        out = placed.withColumn(f"d{k}", _distance()).drop("mean", "white", *KEYS)
    last = fit.where(F.col("level") == len(levels) - 1).first()  # one row, or none without usable rows
    for name in ("mean", "white"):
        out = out.withColumn(name, F.lit(last[name] if last else None).cast("array<double>"))
    out = out.withColumn("d2", _distance()).drop("mean", "white")
    distance = F.coalesce("d0", "d1", "d2", F.lit(0.0))
    out = out.withColumn("distance", distance).withColumn("outlier", distance > cut).drop("d0", "d1", "d2")
    return out.withColumnsRenamed({"_own_lang": "lang", "_own_source": "source"})


def judged(docs, min_rows=MIN_ROWS, cut=CUT):
    """Statistics, base verdict, distance and `kept` for each row of `docs`."""
    statistics = write_table(text_statistics(docs), "statistics")
    return robust_outliers(statistics, min_rows, cut).withColumn(
        "kept", ~F.col("base_failed") & ~F.col("outlier")
    )
