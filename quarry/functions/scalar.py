"""Scalar column functions: weights and units, dates, casts, small math."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Pounds per unit.
POUNDS_PER_OUNCE = 0.0625
POUNDS_PER_GRAM = 0.00220462


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nth_or_null(arr: Column, i: int) -> Column:
    """0-based element or null when the array is shorter (``get`` never raises)."""
    return F.get(arr, i)


def to_double_or_null(c: str | Column) -> Column:
    """Text to double; bad text gives null instead of an ANSI error."""
    return as_col(c).try_cast("double")


def weight_in_pounds(df: DataFrame, weight_col: str) -> DataFrame:
    """D1 + P5-P7 + X1 + X3 + X4: '16 ounces' -> 1.0 lbs.

    Adds ``weight_tokens`` (split on one space), ``raw_units`` (second token),
    ``weight_value`` (first token as double, converted to pounds) and ``units`` ('lbs',
    set on every row as the reference does).  Null weight gives null values.
    """
    toks = F.split(F.col(weight_col), " ")
    value = to_double_or_null(nth_or_null(toks, 0))
    unit = nth_or_null(toks, 1)
    pounds = (F.when(unit == "ounces", value * F.lit(POUNDS_PER_OUNCE))
               .when(unit == "grams", value * F.lit(POUNDS_PER_GRAM))
               .otherwise(value))
    return df.withColumns({"weight_tokens": toks, "raw_units": unit,
                           "weight_value": pounds, "units": F.lit("lbs")})


def dashed_day(c: str | Column) -> Column:
    """X8 + X9: 'yyyyMMdd' -> 'yyyy-MM-dd' from substrings at 1, 5 and 7 (Spark reads a
    start of 0 as 1; DuckDB does not, so 1 is written)."""
    c = as_col(c)
    return F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))


def day_key_to_date(c: str | Column) -> Column:
    """Day key to date through the dashed text; a bad key gives null (try_ form,
    ANSI-safe).  Characters after the eighth are ignored, as the substrings do."""
    return F.try_to_date(dashed_day(c), "yyyy-MM-dd")


def text_to_timestamp(c: str | Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """X11: one fixed format; unparsable text gives null."""
    return F.try_to_timestamp(as_col(c), F.lit(fmt))


def year_of_key(c: str | Column) -> Column:  # X12, stays text
    return F.substring(as_col(c), 1, 4)


def current_year() -> Column:  # X13
    return F.year(F.current_date())


def scale_by(c: str | Column, divisor: int = 10) -> Column:  # P8
    return as_col(c).try_cast("int") / F.lit(divisor)


def linear_prediction(features: Sequence[str | Column], weights: Sequence[float]) -> Column:
    """sum_j w_j * x_j with the weights as literals (codegen, no array allocation)."""
    out = F.lit(0.0)
    for x, w in zip(features, weights):
        out = out + as_col(x) * F.lit(float(w))
    return out


# The five-part Cauchy mixture (centre, width, weight).
CAUCHY_MIXTURE = ((5.0, 1.0, 0.1), (7.0, 0.5, 0.5), (9.0, 0.1, 0.1),
                  (12.0, 0.5, 0.2), (14.0, 1.0, 0.1))


def cauchy_pdf(x: Column, centre: float, width: float) -> Column:
    """1 / (pi * g * (1 + ((x - m) / g)^2))."""
    z = (x - F.lit(centre)) / F.lit(width)
    return F.lit(1.0) / (F.lit(math.pi * width) * (F.lit(1.0) + z * z))


def cauchy_mixture_pdf(x: str | Column, parts=CAUCHY_MIXTURE) -> Column:
    x = as_col(x)
    out = F.lit(0.0)
    for m, g, w in parts:
        out = out + F.lit(w) * cauchy_pdf(x, m, g)
    return out


def grid_point(idx: str | Column, lo: float, hi: float, n: int) -> Column:
    """Even grid, point i = lo + i * (hi - lo) / (n - 1)."""
    return F.lit(lo) + as_col(idx).cast("double") * F.lit((hi - lo) / (n - 1))
