"""Registered round trips: given tables are written by a sink under the shared folder, read
back by a source, and the oracle states what must come back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.operators import relational as rel, reviews, weather
from quarry.plans.registry import register
from quarry.plans.tabular import EVENT_TYPES, _pivot_sql, _quoted
from quarry.session import shared_folder
from quarry.sources import files, sinks
from quarry.sources.tables import load
from quarry.streaming.merged import read_daily, run_merged_daily


def _as(df, like):
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema.fields])


@register("csv_round_trip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_round_trip(spark, sf_dir):
    """K1 + S1: CSV with a header row, types inferred."""
    t, path = load(spark, sf_dir, "customer"), shared_folder(spark, "csv")
    sinks.write_csv(t, path)
    return _as(files.read_csv_inferred(spark, path), t)


@register("quoted_csv_round_trip", "SELECT doc_id, nullif(lang, '') AS lang, nullif(text, '') AS text FROM documents")
def quoted_csv_round_trip(spark, sf_dir):
    """K2 + S2: whole texts with quotes, commas and line breaks; an empty field reads as
    missing, as in pandas."""
    t, path = load(spark, sf_dir, "documents").select("doc_id", "lang", "text"), shared_folder(spark, "quoted")
    sinks.write_csv(t, path, doubled_quotes=True)
    return files.read_csv_quoted(spark, path, "doc_id bigint, lang string, text string")


@register("gzip_folder_round_trip", """
SELECT CAST(user_id AS VARCHAR) AS station_id, strftime(ts, '%Y%m%d') AS date_key, event_type AS measurement_type,
       value AS measurement_value, json_extract_string(props, '$.k') AS measurement_flag,
       CASE WHEN value < 1 THEN 'L' END AS qc_flag, upper(substr(event_type, 1, 1)) AS source_flag
FROM events""")
def gzip_folder_round_trip(spark, sf_dir):
    """S3 + S4: a folder of gzip files read with a declared schema."""
    m, path = weather.measurements_from_events(load(spark, sf_dir, "events")), shared_folder(spark, "gzip")
    sinks.write_csv(m.withColumn("hour", F.lit(None).cast("string")), path, compression="gzip")
    return files.read_csv_directory(spark, path, weather.MEASUREMENT_DDL).drop("hour")


@register("yearly_round_trip", """
SELECT l_orderkey, l_linenumber, l_quantity, CAST(year(l_shipdate) AS INTEGER) AS file_year FROM lineitem""")
def yearly_round_trip(spark, sf_dir):
    """One folder of gzip files per year, the year taken from the path."""
    t = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                               F.year("l_shipdate").alias("year"))
    path = shared_folder(spark, "years")
    sinks.write_csv(t, path, header=False, partition_by=("year",), compression="gzip")
    years = [r[0] for r in t.select("year").distinct().collect()]   # one row per calendar year
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in t.schema.fields[:3])
    return files.read_years(spark, path, years, ddl, pattern="year={year}")


@register("fixed_width_round_trip", """
SELECT 'SU' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS station_id, s_acctbal AS latitude,
       CAST(s_nationkey AS DOUBLE) AS longitude,
       CASE WHEN s_nationkey % 5 <> 0 THEN CAST(s_nationkey AS DOUBLE) END AS elevation,
       CASE WHEN s_nationkey % 2 = 0 THEN 'EV' END AS state, s_name AS extra_info
FROM supplier""")
def fixed_width_round_trip(spark, sf_dir):
    """S5 + F9: the station layout; an unparsable number and a blank field give null."""
    odd = F.col("s_nationkey") % 5 == 0
    fields = (F.concat(F.lit("SU"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0")),
              F.col("s_acctbal").cast("string"), F.col("s_nationkey").cast("string"),
              F.when(odd, F.lit("n/a")).otherwise(F.col("s_nationkey").cast("string")),
              F.when(F.col("s_nationkey") % 2 == 0, F.lit("EV")).otherwise(F.lit("")), F.col("s_name"))
    line = F.concat(*[F.rpad(c, w, " ") for c, w in zip(fields, files.STATION_WIDTHS)])
    path = shared_folder(spark, "fixed")
    load(spark, sf_dir, "supplier").select(line.alias("value")).write.text(path)
    return files.read_stations(spark, path, id_pattern="SU")


@register("labelled_round_trip", r"""
SELECT CAST(doc_id AS VARCHAR) AS id, CAST(quality AS INTEGER) AS label, CAST(NULL AS VARCHAR) AS title,
       nullif(regexp_replace(text, '[\t\r\n]', ' ', 'g'), '') AS body
FROM documents JOIN labels USING (doc_id)""")
def labelled_round_trip(spark, sf_dir):
    """Tab-separated id, label, empty title, text."""
    t = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id")
    t = t.select(F.col("doc_id").alias("id"), F.col("quality").alias("label"),
                 F.lit(None).cast("string").alias("title"),
                 F.regexp_replace("text", r"[\t\r\n]", " ").alias("body"))
    path = shared_folder(spark, "labelled")
    sinks.write_csv(t, path, header=False, sep="\t")
    return files.read_labelled_tsv(spark, path)


@register("paired_lines", """
SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS line_no, c_name AS src,
       c_mktsegment || ' ' || CAST(c_nationkey AS VARCHAR) AS tgt FROM customer""")
def paired_lines(spark, sf_dir):
    """S7 + J2: two texts of numbered lines, paired by line position."""
    ordered = load(spark, sf_dir, "customer").orderBy("c_custkey")
    sides = []
    for tag, value in (("src", F.col("c_name")),
                       ("tgt", F.concat_ws(" ", "c_mktsegment", F.col("c_nationkey").cast("string")))):
        path = shared_folder(spark, tag)
        ordered.select(value.alias("value")).write.text(path)
        sides.append(files.number_across_files(files.read_lines(spark, path)))
    return files.pair_lines(*sides)


_CLEAN_LINE = r"""array_to_string(list_filter(list_transform(
         list_filter(regexp_split_to_array(lower(line), '\s+'), lambda w: w <> ''),
         lambda w: regexp_replace(w, '[!-/:-@\[-`{-~]', '', 'g')),
       lambda w: regexp_matches(w, '^\p{L}+$')), ' ')"""


@register("parallel_text", f"""
WITH s AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS line_no, regexp_replace(text, '[\r\n]+', ' ', 'g') AS line,
                  source || ' ' || lang AS other FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL)
SELECT line_no, {_CLEAN_LINE} AS src, {_CLEAN_LINE.replace('line', 'other')} AS tgt FROM s""")
def parallel_text(spark, sf_dir):
    """S7 + J2 + L4, the whole preparation: two folders of lines (each document's text, its
    source and language), paired by line number and cleaned."""
    d = load(spark, sf_dir, "documents").where(F.col("text").isNotNull() & F.col("lang").isNotNull()).orderBy("doc_id")
    paths = []
    for tag, value in (("src", F.regexp_replace("text", r"[\r\n]+", " ")), ("tgt", F.concat("source", F.lit(" "), "lang"))):
        paths.append(shared_folder(spark, tag))
        d.select(value.alias("value")).write.text(paths[-1])
    return reviews.prepare_parallel_text(spark, *paths, "src", "tgt")


# Event types standing for the measurement types of the four published tables; views are
# wind for even users and sunshine for odd ones.
STANDS_FOR = {"click": "PRCP", "error": "TAVG", "purchase": "TMIN", "signup": "TMAX"}


def _published_sql() -> str:
    kinds = ", ".join(f"({_quoted(name)}, {_quoted(t)}, {10 if t in weather.TEMPERATURE_TYPES else 0})"
                      for name, types in weather.TABLE_TYPES.items() for t in types)
    case = " ".join(f"WHEN {_quoted(e)} THEN {_quoted(t)}" for e, t in STANDS_FOR.items())
    return f"""WITH kinds("table", kind, tenths) AS (VALUES {kinds}),
m AS (SELECT user_id AS station_id, strftime(ts, '%Y%m%d') AS date_key, json_extract_string(props, '$.k') AS flag,
             CASE event_type {case} WHEN 'view' THEN CASE WHEN user_id % 2 = 0 THEN 'AWND' ELSE 'TSUN' END END AS kind,
             CASE WHEN value >= 5 THEN value END AS value
      FROM events WHERE user_id IN (SELECT c_custkey FROM customer)),
days AS (SELECT DISTINCT "table", station_id, date_key FROM m JOIN kinds USING (kind)),
top AS (SELECT station_id, date_key, kind, max(value) AS value, max(flag) AS flag FROM m GROUP BY ALL)
SELECT "table", station_id, date_key, substr(date_key, 1, 4) AS year, kind,
       CASE WHEN tenths > 0 THEN CAST(trunc(value) AS INTEGER) / tenths ELSE value END AS value, flag
FROM days JOIN kinds USING ("table") LEFT JOIN top USING (station_id, date_key, kind)"""


@register("published_tables", _published_sql())
def published_tables(spark, sf_dir):
    """The four daily tables written by year, read back, one row per type;
    days whose rows of a type have null values stay."""
    m = weather.measurements_from_events(load(spark, sf_dir, "events"))
    kind = F.when(F.col("measurement_type") == "view", F.when(F.col("station_id") % 2 == 0, "AWND").otherwise("TSUN"))
    for event, stands_for in STANDS_FOR.items():
        kind = kind.when(F.col("measurement_type") == event, stands_for)
    m = m.withColumns({"measurement_type": kind,
                       "measurement_value": F.when(F.col("measurement_value") >= 5, F.col("measurement_value"))})
    stations = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("station_id"))
    found = []
    for name, path in weather.write_daily_tables(m, stations, shared_folder(spark, "daily")).items():
        each = [F.struct(F.lit(t).alias("kind"), F.col(f"{t}_measurement_value").cast("double").alias("value"),
                         F.col(f"{t}_measurement_flag").alias("flag")) for t in weather.TABLE_TYPES[name]]
        found.append(spark.read.parquet(path).select(
            F.lit(name).alias("table"), "station_id", "date_key", F.col("year").cast("string").alias("year"),
            F.inline(F.array(*each))))
    return rel.concat_rows(*found)


@register("catalog_table", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def catalog_table(spark, sf_dir):
    """K4: saved to the session catalog, read back by name; the name is released again
    (the files stay for the lazy result)."""
    name, path = f"quarry_{uuid.uuid4().hex}", shared_folder(spark, "table")
    sinks.save_table(load(spark, sf_dir, "supplier"), name, path=path)
    found = spark.table(name)
    schema = found.schema
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(schema).parquet(path)


def _cycle(codes: dict[str, str]) -> str:
    return "".join(codes) + "?"


_FLAGS = {"measurement": (weather.MEASUREMENT_FLAG_CODES, 1), "qc": (weather.QC_FLAG_CODES, 3),
          "source": (weather.SOURCE_FLAG_CODES, 7)}


def _flag_sql() -> str:
    cols, joins = [], []
    for k, (codes, step) in _FLAGS.items():
        cycle = _cycle(codes)
        flag = f"substr({_quoted(cycle)}, CAST((event_id * {step}) % {len(cycle)} + 1 AS INTEGER), 1)"
        values = ", ".join(f"({_quoted(c)}, {_quoted(d)})" for c, d in codes.items())
        cols.append(f"{flag} AS {k}_flag, {k}.meaning AS {k}_meaning")
        joins.append(f"LEFT JOIN (VALUES {values}) {k}(code, meaning) ON {k}.code = {flag}")
    return f"SELECT event_id, {', '.join(cols)} FROM events {' '.join(joins)}"


@register("climate_flags", _flag_sql())
def climate_flags(spark, sf_dir):
    """Measurement, quality and source flags decoded; codes are case-sensitive and an
    unknown one keeps its row with a null meaning."""
    rows = load(spark, sf_dir, "events").select("event_id")
    for k, (codes, step) in _FLAGS.items():
        cycle = _cycle(codes)
        at = ((F.col("event_id") * step) % len(cycle) + 1).cast("int")
        rows = rows.withColumn(f"{k}_flag", F.substring(F.lit(cycle), at, F.lit(1)))
        rows = rel.decode_codes(rows, f"{k}_flag", weather.code_table(spark, codes, "code", "meaning"),
                                "code", "meaning", f"{k}_meaning")
    return rows


@register("incremental_daily", _pivot_sql(EVENT_TYPES))
def incremental_daily(spark, sf_dir):
    """G1: the daily pivot by two runs of the merging load; the second run's files hold late
    rows of days that the first run has written."""
    m = weather.measurements_from_events(load(spark, sf_dir, "events"))
    m = m.withColumns({"hour": F.lit(None).cast("string"), "landing_year": F.substring("date_key", 1, 4)})
    stations = load(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("station_id"))
    base = shared_folder(spark, "landing")
    late = F.coalesce(F.col("measurement_flag"), F.lit("")).endswith("7")
    for part in (m.where(~late), m.where(late)):
        sinks.write_csv(part, f"{base}/in", mode="append", partition_by=("landing_year",))
        run_merged_daily(spark, f"{base}/in", stations, f"{base}/out", f"{base}/state", EVENT_TYPES,
                         year_folder="landing_year")
    return read_daily(spark, f"{base}/out").withColumn("station_id", F.col("station_id").cast("long"))
