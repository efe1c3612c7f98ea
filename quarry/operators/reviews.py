"""Composite pipelines: review preparation and parallel-text preparation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import scalar
from quarry.functions.text import clean_sentence
from quarry.operators.relational import col_ref
from quarry.sources.files import number_across_files, pair_lines, read_lines

# Raw review columns kept, and their new names.
REVIEW_COLUMNS = ("id", "categories", "dateAdded", "dateUpdated", "dimension", "weight",
                  "manufacturer", "name", "prices", "reviews.date", "reviews.numHelpful",
                  "reviews.rating", "reviews.title", "reviews.text", "reviews.username")
REVIEW_RENAMES = {"reviews.date": "reviewsDate", "reviews.numHelpful": "helpfullness",
                  "reviews.rating": "rating", "reviews.title": "reviewsTitle",
                  "reviews.text": "customerReviews", "reviews.username": "username"}
TIMESTAMP_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'")


def with_timestamps(df: DataFrame, columns, ts_formats: tuple[str, ...] = TIMESTAMP_FORMATS) -> DataFrame:
    """X11: text columns as timestamps, by the first format that fits, else null."""
    return df.withColumns({c: F.coalesce(*[scalar.text_to_timestamp(col_ref(c), f) for f in ts_formats]) for c in columns})


def prepare_reviews(raw: DataFrame, ts_formats: tuple[str, ...] = TIMESTAMP_FORMATS) -> DataFrame:
    """P1 (names with dots) + X11 (timestamps, first format that fits, else null) + D1/P5-P7 (weight in
    pounds) + P2 (renames) + typed helpfulness and rating.  Narrow: no shuffle."""
    df = raw.select(*[col_ref(c).alias(c) for c in REVIEW_COLUMNS if c in raw.columns])
    df = with_timestamps(df, [c for c in ("dateAdded", "dateUpdated", "reviews.date") if c in df.columns], ts_formats)
    if "weight" in df.columns:
        df = scalar.weight_in_pounds(df, "weight").drop("raw_units")
    df = df.withColumnsRenamed({k: v for k, v in REVIEW_RENAMES.items() if k in df.columns})
    casts = {"helpfullness": "bigint", "rating": "double"}
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in casts.items() if c in df.columns})


def prepare_parallel_text(spark: SparkSession, src_path: str, tgt_path: str,
                          src: str = "en", tgt: str = "vi") -> DataFrame:
    """S7 + J2 + L4: read two line files (or folders of them, in order of their names), pair
    them by line number (a shorter second file is an error), clean both sides; one row per
    pair (line_no, src, tgt)."""
    sides = [number_across_files(read_lines(spark, p)) for p in (src_path, tgt_path)]
    pairs = pair_lines(*sides, src, tgt)
    return pairs.select("line_no", clean_sentence(src).alias(src), clean_sentence(tgt).alias(tgt))
