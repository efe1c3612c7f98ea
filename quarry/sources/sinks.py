"""Sinks: CSV, parquet (partitioned), managed tables, and a persist scope for
intermediates written more than once."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite",
              doubled_quotes: bool = False, partition_by: Sequence[str] = (), **options: str) -> None:
    """K1/K2: CSV with a header row; no row-index column is written.  White space at the
    ends of a field is kept.  ``doubled_quotes`` writes a quote inside a field as two
    (what ``read_csv_quoted`` expects) instead of with a backslash."""
    w = (df.write.mode(mode).option("header", header).options(**options)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if doubled_quotes:
        w = w.option("escape", '"')
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                  partitions: int | None = None, mode: str = "overwrite",
                  max_records_per_file: int = 5_000_000) -> None:
    """K3: parquet, optionally partitioned by columns (e.g. year) with dynamic overwrite,
    so rewriting some partitions leaves the others in place.

    ``partitions`` gives a round-robin fan-out before writing (the reference used 512);
    round-robin keeps a hot partition value spread over many writers.
    """
    if partitions:
        df = df.repartition(partitions)
    w = (df.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
         .option("partitionOverwriteMode", "dynamic"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_table(df: DataFrame, name: str, mode: str = "overwrite", path: str | None = None) -> None:
    """K4: table in the session catalog, managed unless a ``path`` for its files is given."""
    w = df.write.mode(mode)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """K6: keep an intermediate for several writes; released afterwards.  Lost blocks
    are recomputed from lineage."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def save_bucketed_table(df: DataFrame, name: str, key: str, buckets: int,
                        mode: str = "overwrite") -> None:
    """K4 for repeated joins: a managed table bucketed and sorted by ``key``.  Two tables
    bucketed the same way join on ``key`` without shuffling either side."""
    df.write.mode(mode).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
