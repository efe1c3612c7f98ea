"""Linear models as Spark aggregates.

For squared loss the loss and the gradient at any weights are linear in the second
moments of the (features, target) table.  ``gradient_descent`` therefore reads the data
once -- one aggregate computing the Gram matrix sum(x x^T), sum(x y), sum(y^2) and n --
and runs the epochs on that (d+1)x(d+1) summary: exactly the per-epoch mean-over-rows
updates of the reference loop, without a pass per epoch and without a plan that grows
with the epoch count.  ``method="passes"`` instead runs one aggregate per epoch over the
cached rows (for checking and for losses that have no such summary).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import linear_prediction

HISTORY_SCHEMA = "epoch int, loss double, weights array<double>"


def standardize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - mean) / sample std for each column; one aggregate for the statistics."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c), F.stddev_samp(c)]
    r = df.agg(*aggs).first()
    return df.select(*[F.try_divide(F.col(c) - F.lit(r[2 * i]), F.lit(r[2 * i + 1])).alias(c)
                       for i, c in enumerate(cols)])


def _design(features: Sequence[str], intercept: bool):
    cols = [F.lit(1.0)] if intercept else []  # P10: all-ones column as feature 0
    return cols + [F.col(f).cast("double") for f in features]


def gram_summary(df: DataFrame, features: Sequence[str], label: str, intercept: bool = True):
    """n, X^T X, X^T y, y^T y in one distributed aggregate."""
    x = _design(features, intercept)
    y = F.col(label).cast("double")
    d = len(x)
    aggs = [F.count(F.lit(1))]
    aggs += [F.sum(x[i] * x[j]) for i in range(d) for j in range(i, d)]
    aggs += [F.sum(x[i] * y) for i in range(d)]
    aggs += [F.sum(y * y)]
    r = df.dropna(subset=[*features, label]).agg(*aggs).first()  # rows with any null left out
    n = r[0]
    g = np.zeros((d, d))
    k = 1
    for i in range(d):
        for j in range(i, d):
            g[i, j] = g[j, i] = r[k]
            k += 1
    b = np.array([r[k + i] for i in range(d)])
    yy = r[k + d]
    return n, g, b, yy


def gradient_descent(df: DataFrame, features: Sequence[str], label: str, rate: float,
                     epochs: int, intercept: bool = True, init: float = 1.0,
                     method: str = "gram") -> list[tuple[int, float, list[float]]]:
    """Weights start at ``init``; returns (epoch, loss, weights) before each update.

    loss = mean((Xw - y)^2); gradient = mean((Xw - y) x_j) (the mean over rows).
    """
    d = len(features) + (1 if intercept else 0)
    w = np.full(d, float(init))
    hist = []
    if method == "gram":
        n, g, b, yy = gram_summary(df, features, label, intercept)
        for e in range(1, epochs + 1):
            loss = (w @ g @ w - 2 * w @ b + yy) / n
            grad = (g @ w - b) / n
            hist.append((e, float(loss), [float(v) for v in w]))
            w = w - rate * grad
        return hist
    x = _design(features, intercept)
    rows = df.dropna(subset=[*features, label]).select(*[c.alias(f"__x{i}") for i, c in enumerate(x)],
                     F.col(label).cast("double").alias("__y")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        xs = [F.col(f"__x{i}") for i in range(d)]
        for e in range(1, epochs + 1):
            err = linear_prediction(xs, w) - F.col("__y")  # P11
            r = rows.agg(F.avg(err * err), *[F.avg(err * xs[j]) for j in range(d)]).first()
            hist.append((e, float(r[0]), [float(v) for v in w]))
            w = w - rate * np.array([r[1 + j] for j in range(d)])
    finally:
        rows.unpersist()
    return hist


def least_squares(df: DataFrame, x: str, y: str) -> DataFrame:
    """Exact simple regression from SQL aggregates."""
    return df.agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"),
                  F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
                  F.regr_r2(F.col(y), F.col(x)).alias("r2"),
                  F.regr_count(F.col(y), F.col(x)).alias("n"))
