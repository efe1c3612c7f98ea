"""Price lists held as text (a list of dicts) -> one row per price observation.

X14 parses the whole list with ``from_json`` into ARRAY<STRUCT>; keys missing from an
element come out null (X15) and the schema holds the union of fields seen.  D3 turns
each element into a row keyed by the product id, X16 unnests the two list fields with
``explode_outer`` (null or empty lists keep one null row; two lists give their cross
product), A7 drops exact duplicates and P3 drops the sparse columns -- dedupe first, as
the reference does, so duplicates may remain after the drop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PRICE_LIST_DDL = (
    "array<struct<amountMax:double, amountMin:double, availability:string, condition:string, "
    "currency:string, dateAdded:string, dateSeen:array<string>, isSale:string, "
    "merchant:string, offer:string, returnPolicy:string, shipping:string, "
    "sourceURLs:array<string>, warranty:string>>")

# Columns dropped as too sparse.
SPARSE_PRICE_COLUMNS = ("condition", "offer", "returnPolicy", "warranty", "availability")


_JSON_OPTS = {"allowSingleQuotes": "true"}
# a bare Python literal in value position: after ':' '[' or ',' and before ',' '}' or ']'
_VALUE_BEFORE = r"([:\[,]\s*)"
_VALUE_AFTER = r"(?=\s*[,}\]])"


def python_literals_to_json(c):
    """Rewrite bare True / False / None values to JSON true / false / null; words
    inside quoted strings are not in value position and stay as they are."""
    for py, js in (("True", "true"), ("False", "false"), ("None", "null")):
        c = F.regexp_replace(c, _VALUE_BEFORE + py + _VALUE_AFTER, "$1" + js)
    return c


# Fields that hold lists.
LIST_FIELDS = ("dateSeen", "sourceURLs")
_SCALAR_DDL = "array<struct<" + ", ".join(f"{f}:string" for f in LIST_FIELDS) + ">>"


def parse_price_list(text_col: str):
    """Text of a list of dicts -> ARRAY<STRUCT>; single quotes accepted.  Text that
    does not parse as JSON is retried with Python literals rewritten (only for those
    rows: ``coalesce`` stops at the first non-null); what still fails is null.  A scalar
    where a list field is expected counts as a list of one: lists with an element that
    lacks such a field are read once more for it."""
    c = F.col(text_col)

    def read(text):
        scalars = F.from_json(text, _SCALAR_DDL, _JSON_OPTS)

        def filled(found):
            def with_scalars(e, one):
                for f in LIST_FIELDS:
                    e = e.withField(f, F.coalesce(e[f], F.when(one[f].isNotNull(), F.array(one[f]))))
                return e

            lacking = F.exists(found, lambda e: e[LIST_FIELDS[0]].isNull() | e[LIST_FIELDS[1]].isNull())
            each = F.transform(F.array(scalars), lambda s: F.transform(found, lambda e, i: with_scalars(e, s[i])))[0]
            return F.when(lacking, each).otherwise(found)

        # through one-element arrays, so that a text is parsed once
        return F.transform(F.array(F.from_json(text, PRICE_LIST_DDL, _JSON_OPTS)), filled)[0]

    return F.coalesce(read(c), read(python_literals_to_json(c)))


def read_prices(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id, ``prices`` (parsed) and ``reason`` (null for accepted rows) from one parse;
    rejected rows keep their id and say why."""
    out = df.select(id_col, F.col(text_col).alias("__t"), parse_price_list(text_col).alias("prices"))
    reason = (F.when(F.col("__t").isNull(), "no text").when(F.trim("__t") == "", "empty text")
               .when(F.col("prices").isNull(), "not a list of dicts"))
    return out.select(id_col, "prices", reason.alias("reason"))


def unnest_prices(df: DataFrame, id_col: str, text_col: str, drop_sparse: bool = True) -> DataFrame:
    """D3 + X16 + A7: one row per element, list fields unnested, exact duplicates dropped.

    Rows can only be equal if their elements agree in the id and all plain fields.  The
    elements are dealt out and counted by these before they are unnested, so that an element
    moves once and not once per row; one that is alone has distinct rows as soon as its
    lists do, and only the rows of the others are compared."""
    # the filter that explode implies stays above the inner explode: one parse a text
    parsed = df.select(id_col, F.explode(F.array(parse_price_list(text_col))).alias("__p"))
    elements = parsed.select(id_col, F.explode("__p").alias("__e")).select(id_col, "__e.*")
    order = elements.columns
    plain = [c for c in order if c not in LIST_FIELDS]
    # -0.0 and 0.0 are one value to the comparison of rows
    elements = elements.select(*[(F.col(c) + F.lit(0.0)).alias(c) if t == "double" and c != id_col else F.col(c)
                                 for c, t in elements.dtypes])
    counted = elements.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*plain)))

    def unnested(some: DataFrame) -> DataFrame:
        for f in LIST_FIELDS:
            some = some.withColumn(f, F.explode_outer(F.array_distinct(f)))
        return some.select(*order)

    rows = unnested(counted.where("__n = 1")).unionByName(unnested(counted.where("__n > 1")).dropDuplicates())
    return rows.drop(*SPARSE_PRICE_COLUMNS) if drop_sparse else rows


def price_parse_report(df: DataFrame, text_col: str) -> DataFrame:
    """One row: lists present, lists parsed, lists rejected (from one parse)."""
    got = df.agg(F.count(text_col).alias("lists"), F.count(parse_price_list(text_col)).alias("parsed"))
    return got.withColumn("rejected", F.col("lists") - F.col("parsed"))


def bad_price_lists(df: DataFrame, text_col: str) -> DataFrame:
    """Rows whose price text is present but does not parse (reported, not dropped silently)."""
    return df.where(F.col(text_col).isNotNull() & parse_price_list(text_col).isNull())
