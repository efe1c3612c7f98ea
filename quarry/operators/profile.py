"""Column profiling: describe, info / missing-value report, histograms, correlations,
2-D bin counts and the rows at a column's extremes.

Exact quantiles without gathering a column into one task: a quantile sketch brackets each
wanted rank in one pass, and a second pass counts what lies inside the brackets; the counts
are sorted in ranges, never in one task, and only the values at the wanted ranks reach the
driver.  The result equals linear-interpolated quantiles (``percentile`` / DuckDB
``quantile_cont``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.indexing import materialize

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def _long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(ci, v) rows: one per non-null value of each listed column."""
    arr = F.array(*[F.struct(F.lit(i).alias("ci"), F.col(c).cast("double").alias("v"))
                    for i, c in enumerate(cols)])
    return (df.select(F.explode(arr).alias("s")).select("s.ci", "s.v")
              .where(F.col("v").isNotNull() & ~F.isnan("v")))


# A rank is bracketed within BRACKET / k of the rows, several times the sketch's error.
SKETCH_K, BRACKET = 4096, 8.0


def _present(col: str) -> Column:
    """The value as a double; NaN counts as missing."""
    return F.nanvl(F.col(col).cast("double"), F.lit(None).cast("double"))


def _bracket(n: Column, sketch: Column, p: float, k: int) -> Column:
    """(lo, hi) around the values at the ranks next to (n - 1) * p: four ranks to each side
    or more, so all values of fewer than k / 2 rows; null without values."""
    def at(rank: float) -> Column:
        return F.kll_sketch_get_quantile_double(sketch, F.lit(rank))

    wide = n < k / 2
    return F.when(n > 0, F.array(F.when(wide, at(0.0)).otherwise(at(max(0.0, p - BRACKET / k))),
                                 F.when(wide, at(1.0)).otherwise(at(min(1.0, p + BRACKET / k)))))


def quantile_brackets(df: DataFrame, cols: Sequence[str], probs: Sequence[float], k: int = SKETCH_K,
                      *more: Column):
    """One row from one pass: ``more`` aggregates, then per column its count and the
    brackets of its quantiles, read off a mergeable sketch."""
    aggs = [x for i, c in enumerate(cols) for x in (F.count(_present(c)).alias(f"__n{i}"),
                                                    F.kll_sketch_agg_double(_present(c), F.lit(k)).alias(f"__s{i}"))]
    found = [F.struct(F.col(f"__n{i}").alias("n"),
                      F.array(*[_bracket(F.col(f"__n{i}"), F.col(f"__s{i}"), p, k) for p in probs]).alias("ends")).alias(f"__b{i}")
             for i in range(len(cols))]
    own = [x.alias(f"__m{i}") for i, x in enumerate(more)]
    return df.agg(*own, *aggs).select(*[f"__m{i}" for i in range(len(more))], *found).first()


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], k: int = SKETCH_K,
                    brackets: Sequence | None = None) -> dict[tuple[str, float], float | None]:
    """Linear-interpolated quantiles, exact, in two passes whatever the distribution.

    The first pass builds a quantile sketch (``brackets``: what a caller's own pass found);
    the second counts the distinct values inside the brackets and the rows below each.
    These counts are sorted in ranges, and running sums within a range on top of the ranges
    before it give every value its ranks.  Were a bracket to miss its rank, its whole column
    would be counted in one more pass."""
    cols, probs, spark = list(cols), list(probs), df.sparkSession
    if brackets is None:
        brackets = list(quantile_brackets(df, cols, probs, k))
    wanted = {}  # (column, prob) -> (bracket, ranks)
    for i, c in enumerate(cols):
        for j, p in enumerate(probs):
            if brackets[i].n:
                h = (brackets[i].n - 1) * p
                wanted[i, j] = (tuple(brackets[i].ends[j]), {math.floor(h), math.ceil(h)})
    found: dict[tuple[int, int, int], float] = {}
    while wanted:
        names = sorted(wanted)
        found |= {(*names[r.b], r.rank): r.v for r in _ranked(df, cols, [(i, *wanted[i, j][0], wanted[i, j][1]) for i, j in names], spark)}
        wanted = {(i, j): ((-math.inf, math.inf), ranks) for (i, j), (_, ranks) in wanted.items() if any((i, j, r) not in found for r in ranks)}
    out: dict[tuple[str, float], float | None] = {}
    for i, c in enumerate(cols):
        for j, p in enumerate(probs):
            h = (brackets[i].n - 1) * p
            out[c, p] = _between(found[i, j, math.floor(h)], found[i, j, math.ceil(h)], h - math.floor(h)) if brackets[i].n else None
    return out


def _ranked(df: DataFrame, cols: list[str], targets: list[tuple], spark: SparkSession) -> list:
    """b (number of the target), rank, v: values at the wanted ranks of each target (column,
    lo, hi, ranks), where they lie in its bracket."""
    held = spark.createDataFrame([(b, ci, lo, hi) for b, (ci, lo, hi, _) in enumerate(targets)], "b int, ci int, lo double, hi double")
    ranks = spark.createDataFrame([(b, r) for b, t in enumerate(targets) for r in sorted(t[3])], "b int, rank long")
    # both tables have a few rows a column; a null value stands for all rows below the bracket
    inside = (_long_values(df, cols).join(F.broadcast(held), "ci").where(F.col("v") <= F.col("hi"))
              .groupBy("b", F.when(F.col("v") >= F.col("lo"), F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("c")))
    ordered = materialize(inside.repartitionByRange("b", "v").sortWithinPartitions("b", "v")
                                .withColumn("part", F.spark_partition_id()), "ranks")
    earlier = Window.partitionBy("b").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = (ordered.groupBy("b", "part").agg(F.sum("c").alias("n"))
              .select("b", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))
    upto = Window.partitionBy("b", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ends = ordered.withColumn("end", F.sum("c").over(upto)).join(before, ["b", "part"]).withColumn("end", F.col("end") + F.col("before"))
    return (ends.join(F.broadcast(ranks), "b").where((F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("c")) & F.col("v").isNotNull())
                .select("b", "rank", "v").collect())


def _between(a: float, b: float, share: float) -> float:
    """The point a ``share`` of the way from a to b."""
    if a == b or not share:
        return a
    return a + share * (b - a) if math.isfinite(b - a) else (1 - share) * a + share * b


DESCRIBE_SCHEMA = ("column string, count bigint, mean double, std double, min double, "
                   "q25 double, q50 double, q75 double, max double")


def describe(df: DataFrame, cols: Sequence[str] | None = None,
             digits: int | None = None) -> DataFrame:
    """A4: count, mean, sample std, min, 25/50/75% (exact, interpolated), max."""
    cols = list(cols or numeric_columns(df))
    aggs = []
    for c in cols:
        x = _present(c)
        aggs += [F.count(x), F.avg(x), F.stddev_samp(x), F.min(x), F.max(x)]
    probs = (0.25, 0.5, 0.75)
    row = quantile_brackets(df, cols, probs, SKETCH_K, *aggs)
    qs = exact_quantiles(df, cols, probs, brackets=row[len(aggs):])

    def rnd(v):
        return None if v is None or digits is None else round(v, digits)

    rows = []
    for i, c in enumerate(cols):
        n, mean, std, mn, mx = row[5 * i: 5 * i + 5]
        quartiles = [qs[(c, p)] for p in (0.25, 0.5, 0.75)]
        shown = [v if digits is None else rnd(v) for v in (mean, std, *quartiles)]
        rows.append((c, n, *shown[:2], mn, *shown[2:], mx))
    return df.sparkSession.createDataFrame(rows, DESCRIBE_SCHEMA)


def missing_report(df: DataFrame) -> DataFrame:
    """A5 + A17: per column its type, non-null count, row count and non-null share.

    One aggregate pass computes every count; the result is unpivoted with ``stack``.
    """
    names = df.columns
    counted = df.agg(F.count(F.lit(1)).alias("__rows"),
                     *[F.count(F.col(f"`{c}`")).alias(f"__nn{i}") for i, c in enumerate(names)])
    types = dict(df.dtypes)
    parts = ", ".join(f"'{c}', '{types[c]}', __nn{i}" for i, c in enumerate(names))
    return counted.selectExpr(
        f"stack({len(names)}, {parts}) as (column, dtype, non_null)", "__rows as rows"
    ).withColumn("non_null_share", F.try_divide(F.col("non_null"), F.col("rows")))


def drop_sparse_columns(df: DataFrame, min_share: float) -> DataFrame:
    """Drop the columns whose non-null share is below ``min_share`` (one aggregate;
    the decision is made on one number per column)."""
    shares = {r["column"]: r["non_null_share"] for r in missing_report(df).collect()}
    return df.drop(*[c for c, v in shares.items() if v is not None and v < min_share])


def _finite(c: str) -> Column:
    """The column as a double; NaN and infinities, which no bin can hold, as null."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def _min_max(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple]:
    r = df.agg(*[F.min(_finite(c)) for c in cols], *[F.max(_finite(c)) for c in cols]).first()
    k = len(cols)
    return {c: (r[i], r[k + i]) for i, c in enumerate(cols)}


def bin_expr(c: str, lo: float, hi: float, bins: int) -> Column:
    """Equal-width bin index in [0, bins-1]; the maximum lands in the last bin."""
    x = _finite(c)
    if lo is None or hi is None or hi == lo:
        return F.when(x.isNotNull(), F.lit(0))
    width = (F.lit(hi) - F.lit(lo)) / F.lit(bins)
    return F.when(x.isNotNull(), F.least(F.floor((x - F.lit(lo)) / width), F.lit(bins - 1)).cast("int"))


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 30) -> DataFrame:
    """(column, bin, count) over equal-width bins between each column's min and max."""
    cols = list(cols)
    mm = _min_max(df, cols)
    arr = F.array(*[F.struct(F.lit(c).alias("column"),
                             bin_expr(c, *mm[c], bins).alias("bin")) for c in cols])
    return (df.select(F.explode(arr).alias("s")).select("s.column", "s.bin")
              .where(F.col("bin").isNotNull())
              .groupBy("column", "bin").count())


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A10: Pearson correlation of every ordered column pair, in one aggregate pass."""
    cols = list(cols)
    x = {c: F.col(c).cast("double") for c in cols}
    half = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]  # symmetric
    one = df.agg(*[F.corr(x[a], x[b]).alias(f"__c{i}") for i, (a, b) in enumerate(half)])
    at = {p: f"__c{i}" for i, (a, b) in enumerate(half) for p in ((a, b), (b, a))}
    return one.select(F.inline(F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(at[a, b]).alias("corr"))
                                         for a in cols for b in cols])))


def pair_bins(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """For each column pair (a < b in list order) the 2-D equal-width bin counts."""
    cols = list(cols)
    mm = _min_max(df, cols)
    b = {c: bin_expr(c, *mm[c], bins) for c in cols}
    arr = F.array(*[F.struct(F.lit(x).alias("col_a"), F.lit(y).alias("col_b"),
                             b[x].alias("bin_a"), b[y].alias("bin_b"))
                    for i, x in enumerate(cols) for y in cols[i + 1:]])
    return (df.select(F.explode(arr).alias("s")).select("s.*")
              .where(F.col("bin_a").isNotNull() & F.col("bin_b").isNotNull())
              .groupBy("col_a", "col_b", "bin_a", "bin_b").count())


def extreme_rows(df: DataFrame, measure: str, tie: str, n: int = 3) -> DataFrame:
    """A8 + T1 + T2: the n rows with the smallest and the largest measure (ties by the
    numeric ``tie`` column, ascending), plus the arg-min / arg-max rows from
    ``min_by`` / ``max_by``.  ``orderBy().limit()`` plans as a per-partition top-n."""
    from pyspark.sql import Window as W
    cols = df.columns
    order = ["kind", "rank", *cols]
    parts = []
    for kind, o in (("first", F.col(measure).asc()), ("last", F.col(measure).desc())):
        top = df.orderBy(o, F.col(tie).asc()).limit(n).withColumn("kind", F.lit(kind))
        parts.append(top.withColumn("rank", F.row_number().over(
            W.partitionBy("kind").orderBy(o, F.col(tie).asc()))).select(*order))
    arg = df.agg(F.min_by(F.struct(*cols), F.struct(F.col(measure), F.col(tie))).alias("lo"),
                 F.max_by(F.struct(*cols), F.struct(F.col(measure), -F.col(tie))).alias("hi"))
    parts.append(arg.select(F.lit("argmin").alias("kind"), F.lit(1).alias("rank"), "lo.*"))
    parts.append(arg.select(F.lit("argmax").alias("kind"), F.lit(1).alias("rank"), "hi.*"))
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out
