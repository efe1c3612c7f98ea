"""G1 without re-reading: the daily pivot kept as a versioned table, each micro-batch merged in.

The maximum is mergeable: a day's row is the greatest of its stored row and the batch's.
So a batch pivots its own new files, reads only the stored years it touches, and writes
these years into a new version folder; no landing file is read a second time.

``<out>/data/version=<v>/part=y<year>/``  the years that version ``v`` wrote
``<out>/versions/``                       one file a version: each year and the folder it is read from

A version is published by its one file under ``versions``, which the commit of the write
moves into place whole, after the data are complete.  A batch that fails before that leaves
the last version as it was, and its half-written folder is never read.  A batch that is run
again (after a failure between publishing and the stream's own commit) is merged a second
time, which the maximum makes harmless.  One load at a time may write to a folder.

Differences from ``daily.run_incremental_daily``, which re-pivots touched years from the
landing folder: the station list is applied to rows as they arrive, so a station that is
listed later keeps only its later rows; date keys are trimmed before days are grouped; the
measurement types must stay the same (a changed list raises ``ValueError``).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.indexing import materialize
from quarry.operators.weather import MEASUREMENT_DDL, daily_table
from quarry.sources.sinks import write_parquet

VERSION_DDL = "number long, year string, version string, ddl string"
KEYS = ("station_id", "date_key")


def _published(spark: SparkSession, out_dir: str) -> DataFrame | None:
    try:
        return spark.read.schema(VERSION_DDL).parquet(f"{out_dir}/versions")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _version(spark: SparkSession, out_dir: str, number: int | None = None) -> list:
    """Rows (number, year, version, ddl) of a version, the newest if no number is given: one a
    stored year."""
    found = _published(spark, out_dir)
    if found is None:
        return []
    wanted = F.lit(number) if number is not None else found.select(F.max("number")).scalar()
    return found.where(F.col("number") == wanted).collect()


def _stored(spark: SparkSession, out_dir: str, entries: list) -> DataFrame:
    """The years named by ``entries``; other folders are pruned by their names."""
    years: dict[str, list[str]] = {}
    for e in entries:
        years.setdefault(e.version, []).append("y" + e.year)
    named = reduce(lambda a, b: a | b, [(F.col("version") == v) & F.col("part").isin(p) for v, p in years.items()])
    return (spark.read.schema(f"{entries[0].ddl}, version string, part string").parquet(f"{out_dir}/data")
                 .where(named).drop("version", "part"))


def read_daily(spark: SparkSession, out_dir: str, number: int | None = None) -> DataFrame:
    """The newest published version of the table, or version ``number`` (from 1)."""
    entries = _version(spark, out_dir, number)
    if not entries:
        raise ValueError(f"no such version under {out_dir}")
    return _stored(spark, out_dir, entries)


def unused_versions(spark: SparkSession, out_dir: str, keep: int = 1) -> list[str]:
    """Published data folders that none of the newest ``keep`` versions reads, oldest first;
    whoever owns the folder may delete them (and the older version files)."""
    found = _published(spark, out_dir)
    if found is None:
        return []
    newest = found.select(F.max("number")).scalar()
    gone = found.groupBy("version").agg(F.max("number").alias("last")).where(F.col("last") <= newest - keep)
    return [f"{out_dir}/data/version={r.version}" for r in gone.orderBy("version").collect()]


def merge_batch(batch: DataFrame, stations: DataFrame, out_dir: str, types: Sequence[str],
                scaled: Sequence[str] = (), partitions: int | None = None) -> None:
    """Merge long measurements into the table under ``out_dir`` and publish a new version; a
    batch without a row for a listed station publishes nothing."""
    spark = batch.sparkSession
    rows = batch.withColumn("date_key", F.trim("date_key"))
    new = materialize(daily_table(rows, stations, types, scaled=scaled), "batch")   # the one read of the batch
    touched = {r.year for r in new.select("year").distinct().collect()}             # years: a small set
    if not touched:
        return
    before = _version(spark, out_dir)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new.schema.fields)
    if before and before[0].ddl != ddl:
        raise ValueError(f"the stored table has other columns: {before[0].ddl}")
    old = [e for e in before if e.year in touched]
    merged = new
    if old:
        both = new.unionByName(_stored(spark, out_dir, old))
        merged = both.groupBy(*KEYS).agg(*[F.max(c).alias(c) for c in new.columns if c not in KEYS]).select(new.columns)
    number = max((e.number for e in before), default=0) + 1
    version = f"v{number:09d}-{uuid.uuid4().hex}"
    write_parquet(merged.withColumn("part", F.concat(F.lit("y"), "year")), f"{out_dir}/data/version={version}",
                  partition_by=("part",), partitions=partitions, mode="error")
    entries = [(number, e.year, e.version, ddl) for e in before if e.year not in touched]
    entries += [(number, y, version, ddl) for y in sorted(touched)]
    spark.createDataFrame(entries, VERSION_DDL).coalesce(1).write.mode("append").parquet(f"{out_dir}/versions")


def run_merged_daily(spark: SparkSession, landing_dir: str, stations: DataFrame, out_dir: str,
                     checkpoint_location: str, types: Sequence[str], scaled: Sequence[str] = (),
                     header: bool = True, partitions: int | None = None, year_folder: str | None = None,
                     files_per_batch: int | None = None) -> None:
    """Merge the landing folder's new files into the table and stop.  ``year_folder`` names a
    partition column of the landing folder; ``files_per_batch`` bounds a batch (a version each)."""
    schema = MEASUREMENT_DDL + (f", {year_folder} string" if year_folder else "")
    source = spark.readStream.schema(schema).option("header", header)
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    out_dir = out_dir.rstrip("/")
    q = (source.csv(landing_dir).writeStream.trigger(availableNow=True)
         .option("checkpointLocation", checkpoint_location)
         .foreachBatch(lambda batch, epoch: merge_batch(batch, stations, out_dir, types, scaled, partitions)).start())
    q.awaitTermination()
