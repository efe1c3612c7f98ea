"""Plain relational operators: projection, filters, set operations, sorts, joins.

Every function maps DataFrame(s) to a DataFrame and stays inside Catalyst, so filters
and column pruning reach the scan.  Joins to tables of unknown size carry no hint: the
planner and AQE broadcast by measured bytes or shuffle with skew splitting.  Only literal
tables (code tables) are broadcast by hint.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def col_ref(name: str) -> Column:
    """Column by exact name, also for names containing dots."""
    return F.col(f"`{name}`")


def keep_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:  # P1
    return df.select(*[col_ref(n) for n in names])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:  # P2
    return df.withColumnsRenamed(dict(mapping))


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:  # P3, absent names ignored
    return df.drop(*names)


def join_on_dimension_keys(facts: DataFrame, dim: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Inner join facts to a dimension projected to its key; key kept once.

    Duplicated dimension keys multiply fact rows (plain inner-join semantics).
    """
    keys = [key] if isinstance(key, str) else list(key)
    return facts.join(dim.select(*keys), keys, "inner")


def decode_codes(df: DataFrame, column: str, codes: DataFrame, code_col: str,
                 desc_col: str, out: str) -> DataFrame:
    """Left join to a small code table (fixed size, so broadcast is safe)."""
    table = codes.select(F.col(code_col).alias("__code"), F.col(desc_col).alias(out))
    return (df.join(F.broadcast(table), F.col(column) == F.col("__code"), "left")
              .drop("__code"))


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:  # F4, F5
    return df.dropna(subset=list(subset))


def open_range(c: str | Column, lo, hi) -> Column:  # both ends excluded
    c = F.col(c) if isinstance(c, str) else c
    return (c > F.lit(lo)) & (c < F.lit(hi))


def multiple_of(c: str | Column, *divisors: int) -> Column:  # F7, F8 as one conjunction
    c = F.col(c) if isinstance(c, str) else c
    cond = F.lit(True)
    for d in divisors:
        cond = cond & ((c % F.lit(d)) == 0)
    return cond


def contains_regex(c: str | Column, pattern: str) -> Column:  # match anywhere
    c = F.col(c) if isinstance(c, str) else c
    return c.rlike(pattern)


def intersect_distinct(a: DataFrame, b: DataFrame) -> DataFrame:  # U1
    return a.intersect(b)


def concat_rows(*dfs: DataFrame) -> DataFrame:  # U2: by name, missing columns null
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def first_n(df: DataFrame, n: int, *order: str | Column) -> DataFrame:  # T1 (top-k is the feature)
    return df.orderBy(*order).limit(n)


def last_n(df: DataFrame, n: int, *order: str) -> DataFrame:  # T2
    return df.orderBy(*[F.col(o).desc() for o in order]).limit(n)


def first_value(df: DataFrame):  # T3: first row, first field (an action)
    row = df.head()
    return None if row is None else row[0]


def distinct_values(df: DataFrame, column: str) -> DataFrame:  # A6, null kept
    return df.select(column).distinct()


def count_by(df: DataFrame, *keys: str) -> DataFrame:  # A1
    return df.groupBy(*keys).count()


def drop_exact_duplicates(df: DataFrame) -> DataFrame:  # A7
    return df.dropDuplicates()
