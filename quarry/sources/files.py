"""File sources: CSV (inferred / declared / quoted multi-line), directories and yearly
files (gzip decoded, not splittable), fixed-width text, tab-separated labelled text and
numbered text lines.

Readers only build lazy scans; nothing is collected.  Unsplittable inputs (gzip) come
back through ``spread`` so later per-row work is not stuck in one task per file.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions.text import strip_unicode
from quarry.sources.tables import spread

# The text tokens a pandas CSV reader turns into missing values by default.
PANDAS_NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                      "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                      "n/a", "nan", "null")


def read_csv_inferred(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Header row, types inferred (an extra pass over the data; avoid on big inputs)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_csv_quoted(spark: SparkSession, path: str | Sequence[str], schema: str | None = None,
                    header: bool = True) -> DataFrame:
    """Free text with quotes, embedded commas and line breaks (pandas-like); an empty
    field, quoted or not, is missing.

    Multi-line CSV files cannot be split, so each is read by one task; the result is
    spread when there are fewer files than the cluster's parallelism."""
    r = (spark.read.option("header", header).option("multiLine", True)
         .option("quote", '"').option("escape", '"'))
    r = r.schema(schema) if schema else r.option("inferSchema", True)
    return spread(r.csv(path))


def read_csv_schema(spark: SparkSession, path: str | Sequence[str], schema: str,
                    header: bool = True) -> DataFrame:
    """Declared schema, columns matched by position.  With ``header`` the first
    line of every file is skipped whatever it holds.  A directory reads every file in
    it; ``.gz`` files are decoded."""
    return spark.read.schema(schema).option("header", header).csv(path)


def read_csv_directory(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """A folder of (possibly gzip) CSV files as one table, spread over the cluster
    when the files cannot be split."""
    return spread(read_csv_schema(spark, path, schema, header))


def normalize_null_tokens(df: DataFrame, columns: Sequence[str] | None = None,
                          tokens: Sequence[str] = PANDAS_NULL_TOKENS) -> DataFrame:
    """Turn pandas' missing-value spellings in string columns into null."""
    cols = columns or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    toks = list(tokens)
    return df.withColumns({c: F.when(F.col(c).isin(toks), F.lit(None)).otherwise(F.col(c))
                           for c in cols})


def read_fixed_width(spark: SparkSession, path: str, widths: Sequence[int],
                     names: Sequence[str], types: Sequence[str] | None = None) -> DataFrame:
    """Cut each line at fixed widths, trim the padding, cast with ``try_cast``
    (an unparsable field becomes null)."""
    types = types or ["string"] * len(names)
    cols, start = [], 1
    for w, n, t in zip(widths, names, types):
        field = F.trim(F.substring("value", start, w))
        field = F.when(field == "", F.lit(None)).otherwise(field)
        cols.append((field if t == "string" else field.try_cast(t)).alias(n))
        start += w
    return spark.read.text(path).select(*cols)


# Widths and names of the station list.
STATION_WIDTHS = (11, 9, 10, 7, 4, 30)
STATION_NAMES = ("station_id", "latitude", "longitude", "elevation", "state", "extra_info")
STATION_TYPES = ("string", "double", "double", "double", "string", "string")


def read_stations(spark: SparkSession, path: str, id_pattern: str | None = None) -> DataFrame:
    """S5 + F9: the fixed-width station list, optionally kept to ids matching a regex
    anywhere in the id (not a prefix test)."""
    df = read_fixed_width(spark, path, STATION_WIDTHS, STATION_NAMES, STATION_TYPES)
    return df.where(F.col("station_id").rlike(id_pattern)) if id_pattern else df


LABELLED_DDL = "id string, label int, title string, body string"


def read_labelled_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated id, label, (empty) title, text."""
    return spark.read.schema(LABELLED_DDL).option("sep", "\t").option("header", False).csv(path)


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, line_no, value) with each line stripped of Unicode whitespace and
    line numbers dense from 0 in file order.

    Rows of one file split arrive in order inside one task, and
    ``monotonically_increasing_id`` counts up inside a task, so the position within a
    split is id - min(id of that split).  Split sizes (one row per split) give each
    split's first line number through a window per file.  The scan is deterministic,
    so both reads of it assign the same ids.
    """
    raw = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__mid"))
    splits = raw.groupBy("file", "__block").agg(F.count(F.lit(1)).alias("__n"),
                                                F.min("__mid").alias("__first"))
    before = Window.partitionBy("file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offs = splits.select("file", "__block", "__first",
                         F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    # one row per file split: broadcast by its bytes, else a shuffle join
    out = raw.join(offs, ["file", "__block"])
    return out.select("file", (F.col("__off") + F.col("__mid") - F.col("__first")).alias("line_no"),
                      strip_unicode("value").alias("value"))


def number_across_files(lines: DataFrame) -> DataFrame:
    """The files of ``read_lines`` as one text: (line_no, value) with line numbers that run
    on from file to file in the order of the file names.  The window is over one row per
    file."""
    sizes = lines.groupBy("file").agg((F.max("line_no") + 1).alias("__n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offs = sizes.select("file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    return lines.join(offs, "file").select((F.col("__off") + F.col("line_no")).alias("line_no"), "value")


def pair_lines(left: DataFrame, right: DataFrame, left_name: str = "src",
               right_name: str = "tgt", strict: bool = True) -> DataFrame:
    """Pair two line tables by line number.  Extra lines of the right side are
    ignored; with ``strict`` a left line without partner raises (the right file is
    shorter)."""
    l_ = left.select("line_no", F.col("value").alias(left_name))
    r_ = right.select("line_no", F.col("value").alias(right_name))
    if strict and l_.join(r_, "line_no", "left_anti").limit(1).count() > 0:
        raise ValueError("second file has fewer lines than the first")
    return l_.join(r_, "line_no", "inner")


def read_years(spark: SparkSession, base: str, years: Sequence[int] | None, schema: str,
               pattern: str = "{year}.csv.gz", header: bool = False) -> DataFrame:
    """A list of yearly files (or folders) as one table, with the year taken from the
    part of the path that ``pattern`` stands for; ``years=None`` loads the current year (X13)."""
    if years is None:
        years = [spark.range(1).select(F.year(F.current_date())).first()[0]]
    paths = [f"{base.rstrip('/')}/{pattern.format(year=y)}" for y in years]
    df = read_csv_schema(spark, paths, schema, header)
    before, after = (re.escape(p) for p in pattern.split("{year}"))
    return spread(df.withColumn("file_year", F.regexp_extract(
        F.col("_metadata.file_path"), rf"/{before}(\d{{4}}){after}(?:/[^/]*)?$", 1).cast("int")))
