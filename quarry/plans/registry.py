"""Query registry: name -> (spark, sf_dir) -> DataFrame, and name -> DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# Registered outputs that come from floating-point sums (whose order differs between
# engines) are rounded to this many decimals, in the query and in its oracle SQL alike;
# Spark's and DuckDB's round() give identical doubles for identical inputs.
DIGITS = 9


def rounded(df: DataFrame, *cols: str, digits: int = DIGITS) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})
