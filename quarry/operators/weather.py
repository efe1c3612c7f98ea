"""Long daily measurements -> one wide row per (station, day).

The reference job scans the same folder four times, caches each type subset and
pivots each separately.  Here one scan is filtered to the requested types (the IN list
is pushed into the parquet/CSV scan), joined to the station keys and pivoted with the
values given up front, so Spark runs no discovery job and plans one aggregation with
map-side partial aggregation (max is combinable, so a hot station/day collapses before
the shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import day_key_to_date, scale_by

MEASURE_FIELDS = ("measurement_value", "measurement_flag", "qc_flag", "source_flag")

MEASUREMENT_DDL = ("station_id string, date_key string, measurement_type string, "
                   "measurement_value double, measurement_flag string, qc_flag string, "
                   "source_flag string, hour string")

STATION_DDL = ("station_id string, latitude double, longitude double, elevation double, "
               "state string, extra_info string")

# The measurement types of the four published daily tables.
PRECIPITATION_TYPES = ("PRCP",)
TEMPERATURE_TYPES = ("TAVG", "TMIN", "TMAX")
WIND_TYPES = ("AWND",)
SUNSHINE_TYPES = ("TSUN",)


def measurements_from_events(events: DataFrame) -> DataFrame:
    """View the driver ``events`` table in the daily-measurement shape.

    station = user, date_key = UTC day of ts (yyyyMMdd), type = event_type,
    value = value, measurement flag = props.k, qc flag 'L' for values below 1,
    source flag = first letter of the type in upper case.
    """
    return events.select(
        F.col("user_id").alias("station_id"),
        F.date_format("ts", "yyyyMMdd").alias("date_key"),
        F.col("event_type").alias("measurement_type"),
        F.col("value").alias("measurement_value"),
        F.get_json_object("props", "$.k").alias("measurement_flag"),
        F.when(F.col("value") < 1, F.lit("L")).alias("qc_flag"),
        F.upper(F.substring("event_type", 1, 1)).alias("source_flag"),
    )


def pivot_daily(long_df: DataFrame, types: Sequence[str],
                keys: Sequence[str] = ("station_id", "date_key"), presence: bool = False) -> DataFrame:
    """A2: max of value and of each flag per (station, day, type), one column per type.

    Written as conditional aggregates over the given type list: one hash aggregate
    with partial aggregation and a single shuffle on the keys.  A type absent from the
    data gives null columns, as a pivot with given values does.  ``presence`` adds one
    boolean per type: whether the (station, day) has a row of it, null values included.
    """
    aggs = []
    for t in types:
        hit = F.col("measurement_type") == F.lit(t)
        for f in MEASURE_FIELDS:
            aggs.append(F.max(F.when(hit, F.col(f))).alias(f"{t}_{f}"))
        if presence:
            aggs.append((F.count(F.when(hit, F.lit(1))) > 0).alias(f"{t}_present"))
    return long_df.groupBy(*keys).agg(*aggs)


def add_day_columns(df: DataFrame) -> DataFrame:
    """Trimmed key, year text and parsed date; rows without a key dropped."""
    key = F.trim(F.col("date_key"))
    return (df.withColumn("date_key", key)
              .withColumn("year", F.substring("date_key", 1, 4))
              .withColumn("date", day_key_to_date("date_key"))
              .filter(F.col("date_key").isNotNull()))


def scale_tenths(df: DataFrame, types: Sequence[str], divisor: int = 10) -> DataFrame:
    """Value.cast('int') / 10 -- fraction cut toward zero first (-55.9 -> -5.5);
    a value beyond the int range gives null."""
    return df.withColumns({
        f"{t}_measurement_value": scale_by(f"{t}_measurement_value", divisor) for t in types})


def daily_table(measurements: DataFrame, stations: DataFrame, types: Sequence[str],
                scaled: Sequence[str] = (), station_key: str = "station_id",
                presence: bool = False) -> DataFrame:
    """Filter to types (F2), keep listed stations (J1), pivot (A2), day columns.

    Max is insensitive to repeated rows, so keeping the listed stations is a semi join
    and gives the inner join's result.  It is written after the aggregation: the pivot
    shuffles on (station, day) with partial aggregation, so a station holding a third of
    the rows is spread over its days and only one row per (station, day) meets the
    station join.  A list that the planner can broadcast by its bytes is pushed below the
    aggregation by the optimizer (the join key is a grouping key).
    """
    facts = measurements.filter(F.col("measurement_type").isin(list(types)))
    wide = pivot_daily(facts, types, presence=presence).join(stations.select(station_key), station_key, "left_semi")
    if scaled:
        wide = scale_tenths(wide, scaled)
    return add_day_columns(wide)


TABLE_TYPES = {"precipitation": PRECIPITATION_TYPES, "temperature": TEMPERATURE_TYPES,
               "wind": WIND_TYPES, "sunshine": SUNSHINE_TYPES}


def daily_tables(measurements: DataFrame, stations: DataFrame, groups: dict = TABLE_TYPES,
                 scaled: Sequence[str] = TEMPERATURE_TYPES) -> dict[str, DataFrame]:
    """The four published tables from one scan/join/pivot; each is a projection of it
    (a (station, day) belongs to a table when it has any row of that table's types, also
    one whose value is null)."""
    all_types = [t for g in groups.values() for t in g]
    return _split_daily(daily_table(measurements, stations, all_types, scaled, presence=True), groups)


# Code tables for the flags of the daily climate files (public format
# description; where its text and the common short wording differ, as for W and X of the
# quality flags, the description's is kept).  code -> meaning.
MEASUREMENT_FLAG_CODES = {
    "B": "precipitation total formed from two 12-hour totals",
    "D": "precipitation total formed from four six-hour totals",
    "H": "represents highest or lowest hourly temperature",
    "K": "converted from knots",
    "L": "temperature appears to be lagged with respect to reported hour of observation",
    "O": "converted from oktas",
    "P": "identified as missing presumed zero",
    "T": "trace of precipitation, snowfall, or snow depth",
    "W": "converted from 16-point WBAN code (for wind direction)",
}
QC_FLAG_CODES = {
    "D": "failed duplicate check",
    "G": "failed gap check",
    "I": "failed internal consistency check",
    "K": "failed streak/frequent-value check",
    "L": "failed check on length of multiday period",
    "M": "failed megaconsistency check",
    "N": "failed naught check",
    "O": "failed climatological outlier check",
    "R": "failed lagged range check",
    "S": "failed spatial consistency check",
    "T": "failed temporal consistency check",
    "W": "temperature too warm for snow",
    "X": "failed bounds check",
    "Z": "flagged as a result of an official Datzilla investigation",
}


# code -> meaning; codes are case-sensitive.
SOURCE_FLAG_CODES = {
    "0": "US Cooperative Summary of the Day",
    "6": "CDMP Cooperative Summary of the Day",
    "7": "US Cooperative Summary of the Day Transmitted via WxCoder3",
    "A": "Automated Surface Observing System real time data since January 1 2006",
    "a": "Australian data from the Australian Bureau of Meteorology",
    "B": "US ASOS data for October 2000 to December 2005",
    "b": "Belarus update",
    "C": "Environment Canada",
    "E": "European Climate Assessment and Dataset",
    "F": "US Fort data",
    "G": "Official Global Climate Observing System",
    "H": "High Plains Regional Climate Center real time data",
    "I": "International collection non U.S. data received through personal contacts",
    "K": "US Cooperative Summary of the Day data digitized from paper observer forms",
    "M": "Monthly METAR Extract",
    "N": "Community Collaborative Rain Hail and Snow",
    "Q": "Data from several African countries that had been quarantined",
    "R": "Climate Reference Network and Historical Climatology Network Modernized",
    "r": "All Russian Research Institute of Hydrometeorological Information World Data Center",
    "S": "Global Summary of the Day",
    "s": "China Meteorological Administration National Meteorological Information Center",
    "T": "SNOwpack TELemtry data obtained from the Western Regional Climate Center",
    "U": "Remote Automatic Weather Station data obtained from the Western Regional Climate Center",
    "u": "Ukraine update",
    "W": "WBAN ASOS Summary of the Day from Integrated Surface Data ISD",
    "X": "US First Order Summary of the Day",
    "Z": "Datzilla official additions or replacements",
    "z": "Uzbekistan update",
}


def code_table(spark, codes: dict[str, str], code_col: str = "code",
               desc_col: str = "description") -> DataFrame:
    return spark.createDataFrame(sorted(codes.items()), f"{code_col} string, {desc_col} string")


def write_daily_tables(measurements: DataFrame, stations: DataFrame, out_base: str,
                       partitions: int | None = None) -> dict[str, str]:
    """K3 + K6: the four daily tables as parquet partitioned by year, from one pivot
    that is persisted for the four writes and released afterwards."""
    from quarry.sources.sinks import persisted, write_parquet
    groups = TABLE_TYPES
    all_types = [t for g in groups.values() for t in g]
    wide = daily_table(measurements, stations, all_types, scaled=TEMPERATURE_TYPES, presence=True)
    paths = {}
    with persisted(wide):
        for name, df in _split_daily(wide, groups).items():
            path = f"{out_base.rstrip('/')}/{name}"
            write_parquet(df, path, partition_by=("year",), partitions=partitions)
            paths[name] = path
    return paths


def _split_daily(wide: DataFrame, groups) -> dict[str, DataFrame]:
    out = {}
    for name, ts in groups.items():
        cols = ["station_id", "date_key"] + [f"{t}_{f}" for t in ts for f in MEASURE_FIELDS]
        has = F.col(f"{ts[0]}_present")
        for t in ts[1:]:
            has = has | F.col(f"{t}_present")
        out[name] = wide.where(has).select(*cols, "year", "date")
    return out
