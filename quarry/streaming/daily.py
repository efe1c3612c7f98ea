"""G1: incremental daily pivot over a landing folder of measurement CSV files.

``readStream`` picks up only new files (the checkpoint remembers what was read);
``trigger(availableNow=True)`` processes what is there and stops, which suits a weekly
job.  Each micro-batch finds the years its rows touch, re-pivots those years from the
whole landing folder (late files may change old days) and overwrites just those year
partitions (dynamic overwrite).  Re-running a batch rewrites the same partitions, so a
retried batch leaves the same result.

With ``year_folder`` the files lie in one folder per year (``<year_folder>=2024/``), as the
year of their date keys says: the re-read of a touched year then lists and scans that
year's folder only, instead of filtering every file by its date keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.weather import MEASUREMENT_DDL, daily_table
from quarry.sources.files import read_csv_schema
from quarry.sources.sinks import write_parquet


def run_incremental_daily(spark: SparkSession, landing_dir: str, stations: DataFrame,
                          out_dir: str, checkpoint_location: str, types: Sequence[str],
                          scaled: Sequence[str] = (), header: bool = True,
                          partitions: int | None = None, year_folder: str | None = None) -> None:
    schema = MEASUREMENT_DDL + (f", {year_folder} string" if year_folder else "")
    year = F.substring(F.trim("date_key"), 1, 4)
    stream = spark.readStream.schema(schema).option("header", header).csv(landing_dir)

    def process(batch: DataFrame, epoch_id: int) -> None:
        # the distinct years of one batch: a handful of values
        years = [r[0] for r in batch.select(year.alias("y"))
                 .where(F.col("y").isNotNull()).distinct().collect()]
        if not years:
            return
        full = read_csv_schema(batch.sparkSession, landing_dir, schema, header)
        full = full.where((F.col(year_folder) if year_folder else year).isin(years))
        table = daily_table(full, stations, types, scaled=scaled)
        write_parquet(table, out_dir, partition_by=("year",), partitions=partitions)

    q = (stream.writeStream.trigger(availableNow=True)
         .option("checkpointLocation", checkpoint_location)
         .foreachBatch(process).start())
    q.awaitTermination()
