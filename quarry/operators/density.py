"""Density estimates on an even grid.

Gaussian kernel density without pairing every point with every grid node: each value
within reach of the grid emits only the nodes within ``h * sqrt(2 * 750)`` of it, and the
sums per node are partially aggregated, so that a task shuffles one row per node at most.  Beyond that distance exp(-d^2 / 2h^2) is exactly 0.0 in double precision, so the
sum over the band equals the sum over all points.  Grid nodes nothing reaches get 0.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.scalar import grid_point
from quarry.operators.indexing import materialize
from quarry.operators.profile import exact_quantiles

# exp(-z) is exactly 0.0 in IEEE double for z > ~745.13; 750 leaves a margin.
_EXP_ZERO = 750.0


def grid(spark, lo: float, hi: float, n: int) -> DataFrame:
    """N evenly spaced points from lo to hi (ends included)."""
    return spark.range(n).select(F.col("id").cast("int").alias("grid_idx"),
                                 grid_point("id", lo, hi, n).alias("x"))


def gaussian_kde(values: DataFrame, col: str, lo: float, hi: float, n: int,
                 bandwidth: float) -> DataFrame:
    """(grid_idx, x, density) with density = mean over points of the Gaussian
    kernel with the given bandwidth."""
    spark = values.sparkSession
    step = (hi - lo) / (n - 1)
    reach = bandwidth * math.sqrt(2 * _EXP_ZERO)
    v = F.col(col).cast("double")
    present = values.where(v.isNotNull() & ~F.isnan(v)).select(v.alias("v"))  # NaN counts as missing
    close = present.where((F.col("v") >= lo - reach) & (F.col("v") <= hi + reach))
    first = F.greatest(F.lit(0), F.floor((F.col("v") - F.lit(reach) - F.lit(lo)) / F.lit(step)).cast("int"))
    last = F.least(F.lit(n - 1), F.ceil((F.col("v") + F.lit(reach) - F.lit(lo)) / F.lit(step)).cast("int"))
    near = (close.where(first <= last)
                 .select("v", F.explode(F.sequence(first, last)).alias("grid_idx")))
    g = grid_point("grid_idx", lo, hi, n)
    two_h2 = 2 * bandwidth * bandwidth
    k = F.exp(-((g - F.col("v")) * (g - F.col("v"))) / F.lit(two_h2))
    sums = near.groupBy("grid_idx").agg(F.sum(k).alias("s"))
    n_points = present.select(F.count(F.lit(1))).scalar()
    norm = n_points * F.lit(bandwidth * math.sqrt(2 * math.pi))
    return (grid(spark, lo, hi, n).join(sums, "grid_idx", "left")
            .select("grid_idx", "x", F.try_divide(F.coalesce(F.col("s"), F.lit(0.0)), norm).alias("density")))


def interpolate(points: DataFrame, col: str, curve: DataFrame, lo: float, hi: float,
                n: int, value: str = "density", out: str = "interpolated") -> DataFrame:
    """Linear blend between the two grid nodes around each point (outside the grid:
    null).  Node i and its successor come from ``lead`` over the grid (n rows)."""
    step = (hi - lo) / (n - 1)
    nodes = curve.select("grid_idx", F.col("x").alias("__x0"), F.col(value).alias("__y0"),
                         F.lead("x").over(Window.orderBy("grid_idx")).alias("__x1"),
                         F.lead(value).over(Window.orderBy("grid_idx")).alias("__y1"))
    idx = F.floor((F.col(col) - F.lit(lo)) / F.lit(step)).cast("int")
    p = points.withColumn("grid_idx", F.when((F.col(col) >= lo) & (F.col(col) <= hi),
                                             F.least(idx, F.lit(n - 2))))
    j = p.join(F.broadcast(nodes), "grid_idx", "left")
    t = (F.col(col) - F.col("__x0")) / (F.col("__x1") - F.col("__x0"))
    return j.withColumn(out, F.col("__y0") + t * (F.col("__y1") - F.col("__y0"))) \
            .drop("grid_idx", "__x0", "__y0", "__x1", "__y1")


VARIANCE_FLOOR = 1e-6
# The fit ends once a step raises the mean log-likelihood of a value by no more than this.
TOLERANCE = 1e-5


def _starts(counted: DataFrame, x: DataFrame, k: int) -> list[float]:
    """k means at even ranks of the values; of the distinct values where a hot value holds
    several ranks."""
    probs = [(j + 0.5) / k for j in range(k)]
    found = exact_quantiles(x, ["v"], probs)
    if len(set(found.values())) < k:
        found = exact_quantiles(counted, ["v"], probs)
    return [found["v", p] for p in probs]


Parts = list[tuple[float, float, float]]  # weight, mean, variance


def _step(counted: DataFrame, n: float, parts: Parts) -> tuple[float, Parts]:
    """One expectation-maximization step: the mean log-likelihood of ``parts`` and the
    parts after the step.  One aggregate without grouping: a task sends one row."""
    k = range(len(parts))
    # the parameters are an array literal, so that all steps share their compiled code
    given = ", ".join(f"named_struct('a', double('{math.log(w / math.sqrt(2 * math.pi * s)) if w else -math.inf!r}'), "
                      f"'m', double('{m!r}'), 'h', double('{0.5 / s!r}'))" for w, m, s in parts)
    rows = counted.select("v", "c", F.expr(f"array({given})").alias("p"))
    rows = rows.selectExpr("v", "c", "p", "transform(p, q -> q.a - (v - q.m) * (v - q.m) * q.h) AS e")
    rows = rows.selectExpr("v", "c", "p", "e", "array_max(e) AS top")
    rows = rows.selectExpr("v", "c", "p", "top", "transform(e, y -> exp(y - top)) AS d")
    rows = rows.selectExpr("v", "c", "p", "top", "d", "aggregate(d, 0D, (x, y) -> x + y) AS t")
    sums = [F.expr(f"sum(c * d[{j}] / t" + f" * (v - p[{j}].m)" * power + ")") for power in range(3) for j in k]
    got = rows.agg(F.expr("sum(c * (top + log(t)))"), *sums).first()
    likelihood, new = got[0] / n, []
    if math.isnan(likelihood):
        raise ValueError("values so far apart that their squared distance is no double")
    for j, (_, m, s) in enumerate(parts):
        r, by, sq = got[1 + j], got[1 + len(parts) + j], got[1 + 2 * len(parts) + j]
        new.append((r / n, m + by / r, max(0.0, sq / r - (by / r) ** 2) + VARIANCE_FLOOR) if r else (0.0, m, s))
    return likelihood, new


def _free(parts: Parts) -> list[float]:
    """Parameters without bounds: logarithms of weights and variances."""
    return [math.log(max(w, 1e-300)) for w, _, _ in parts] + [m for _, m, _ in parts] + [math.log(s) for *_, s in parts]


def _extrapolated(p: Parts, p1: Parts, p2: Parts, longest: float) -> tuple[float, Parts]:
    """Squared extrapolation of two steps p, p1, p2: the step length, from 1 (no more than
    the two steps) to ``longest``, and the parts it leads to."""
    a, b, c = _free(p), _free(p1), _free(p2)
    r = [y - x for x, y in zip(a, b)]
    u = [z - y - d for y, z, d in zip(b, c, r)]
    ratio = math.sqrt(sum(x * x for x in r) / max(sum(x * x for x in u), 1e-300))
    length = max(1.0, min(ratio, longest))
    far = [x + 2 * length * d + length * length * e for x, d, e in zip(a, r, u)]
    k = len(p)
    top = max(far[:k])
    w = [math.exp(x - top) for x in far[:k]]
    total = sum(w)
    return length, [(x / total, m, max(math.exp(min(s, 700.0)), VARIANCE_FLOOR)) for x, m, s in zip(w, far[k:2 * k], far[2 * k:])]


def gaussian_mixture(values: DataFrame, col: str, k: int, iterations: int | None = None,
                     tolerance: float = TOLERANCE) -> Parts:
    """(weight, mean, variance) of a k-component Gaussian mixture by expectation
    maximization, from means at the values' quantiles, equal weights and one shared
    variance, until a step raises the mean log-likelihood by ``tolerance`` or less (no bound
    on the steps; ``iterations`` asks for so many plain steps instead).

    Each two steps are extrapolated (squared extrapolation, on the logarithms of weights and
    variances); the place it leads to counts only if its likelihood is no lower, and the
    allowed length grows fourfold when it is used up and shrinks when it fails.  That takes
    about a third of the passes of plain steps to the same tolerance.

    Equal values are counted once, before the first step; a step is one aggregate over the
    counted rows, so the result does not depend on how the rows are laid out.  Nulls, NaN
    and infinities are left out; every other value counts at any distance (shares are taken
    relative to the largest).  No values: no components."""
    v = F.col(col).cast("double")
    x = values.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))).select(v.alias("v"))
    counted = materialize(x.groupBy("v").agg(F.count(F.lit(1)).cast("double").alias("c")), "counted")
    n = counted.agg(F.sum("c")).first()[0]
    if not n:
        return []
    starts = _starts(counted, x, k)
    p = [(1.0 / k, m, ((starts[-1] - starts[0]) / k) ** 2 + VARIANCE_FLOOR) for m in starts]
    if iterations is not None:
        for _ in range(iterations):
            _, p = _step(counted, n, p)
        return p
    longest = 4.0
    before, p1 = _step(counted, n, p)
    while True:
        now, p2 = _step(counted, n, p1)
        if now - before <= tolerance:
            return p1
        length, far = _extrapolated(p, p1, p2, longest)
        if length > 1:
            reached, after = _step(counted, n, far)
            if reached >= now:
                longest *= 4 if length == longest else 1
                p, before, p1 = far, reached, after
                continue
            longest = max(2.0, longest / 4)
        p = p2
        before, p1 = _step(counted, n, p)


def gaussian_mixture_density(values: DataFrame, col: str, k: int, lo: float, hi: float, n: int,
                             iterations: int | None = None) -> DataFrame:
    """The fitted mixture's density on the grid."""
    x, dens = F.col("x"), F.lit(0.0)
    for w, m, s in gaussian_mixture(values, col, k, iterations):
        dens = dens + F.lit(w / math.sqrt(2 * math.pi * s)) * F.exp(-((x - F.lit(m)) * (x - F.lit(m))) / F.lit(2 * s))
    return grid(values.sparkSession, lo, hi, n).withColumn("density", dens)
