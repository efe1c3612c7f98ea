"""The driver-generated parquet tables (one file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Inputs of fewer splits than this may be dealt out anew; larger ones never are.
SPREAD_SPLITS = 16


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition of an input with fewer than ``SPREAD_SPLITS`` splits (one
    unsplittable file, a single row group), so that per-row heavy work such as tokenising
    does not run in one task.  The bound is fixed: it does not grow with the cluster, and
    at 128 MB a split no input above 2 GB is shuffled for it.
    """
    target = min(min_partitions or df.sparkSession.sparkContext.defaultParallelism, SPREAD_SPLITS)
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def load_spread(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """``load`` + column pruning + ``spread`` (prune first so only used columns move)."""
    df = load(spark, sf_dir, name)
    if cols:
        df = df.select(*cols)
    return spread(df)


def register_views(spark: SparkSession, sf_dir: str) -> None:
    for t in TABLES:
        load(spark, sf_dir, t).createOrReplaceTempView(t)
