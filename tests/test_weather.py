"""Daily pivot (A2, J1, P8, X7-X12, L10-L13), four-table writer (K3, K6) and the
incremental stream (G1)."""

import os


from quarry.operators import weather
from quarry.streaming.daily import run_incremental_daily

ROWS = [
    ("S1", "20240105", "PRCP", 5.0, "B", None, "7", None),
    ("S1", "20240105", "PRCP", 7.0, "T", None, "A", None),   # two values: max wins
    ("S1", "20240105", "TMIN", -55.9, None, "G", "7", None),  # tenths, cut toward zero
    ("S2", " 20240106 ", "TMAX", 123.0, None, None, "S", None),  # padded key
    ("S2", "20241341", "PRCP", 1.0, None, None, None, None),    # bad date
    ("S3", "20240105", "PRCP", 3.0, None, None, None, None),    # station not listed
    ("S1", None, "PRCP", 1.0, None, None, None, None),          # no key
    ("S1", "20240105", "SNOW", 9.0, None, None, None, None),    # type not asked for
]


def _facts(spark):
    return spark.createDataFrame(ROWS, weather.MEASUREMENT_DDL)


def _stations(spark):
    return spark.createDataFrame([("S1",), ("S2",)], "station_id string")


def test_daily_table_semantics(spark):
    types = ["PRCP", "TMIN", "TMAX", "TAVG"]
    out = weather.daily_table(_facts(spark), _stations(spark), types,
                              scaled=["TMIN", "TMAX", "TAVG"])
    rows = {(r.station_id, r.date_key): r for r in out.collect()}
    assert set(rows) == {("S1", "20240105"), ("S2", "20240106"), ("S2", "20241341")}
    r = rows[("S1", "20240105")]
    assert r.PRCP_measurement_value == 7.0
    assert r.PRCP_measurement_flag == "T"
    assert r.PRCP_source_flag == "A"
    assert r.TMIN_measurement_value == -5.5
    assert r.TMIN_qc_flag == "G"
    assert r.TAVG_measurement_value is None          # type absent from the data
    assert str(r.date) == "2024-01-05" and r.year == "2024"
    assert rows[("S2", "20240106")].TMAX_measurement_value == 12.3
    bad = rows[("S2", "20241341")]
    assert bad.date is None and bad.year == "2024"
    assert "SNOW_measurement_value" not in out.columns


def test_pivot_row_count_equals_distinct_keys(spark):
    from quarry.sources.tables import load
    m = weather.measurements_from_events(load(spark, "/root/testdata/sf0.001", "events"))
    types = ["click", "error", "purchase", "signup", "view"]
    wide = weather.pivot_daily(m, types)
    assert wide.count() == m.select("station_id", "date_key").distinct().count()


def test_daily_tables_one_scan(spark):
    tables = weather.daily_tables(_facts(spark), _stations(spark))
    assert set(tables) == {"precipitation", "temperature", "wind", "sunshine"}
    assert tables["wind"].count() == 0
    assert tables["temperature"].count() == 2
    plan = tables["precipitation"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") <= 2


def test_write_daily_tables(spark, tmp_dir):
    paths = weather.write_daily_tables(_facts(spark), _stations(spark), tmp_dir, partitions=2)
    back = spark.read.parquet(paths["precipitation"])
    assert back.count() == 2
    assert {r.year for r in back.select("year").collect()} == {2024}
    assert os.path.isdir(os.path.join(paths["precipitation"], "year=2024"))


def _write_csv(path, rows):
    with open(path, "w") as f:
        f.write("station_id,date_key,measurement_type,measurement_value,measurement_flag,"
                "qc_flag,source_flag,hour\n")
        for r in rows:
            f.write(",".join("" if v is None else str(v) for v in r) + "\n")


def test_incremental_stream_rewrites_touched_years(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    out = os.path.join(tmp_dir, "out")
    ckpt = os.path.join(tmp_dir, "ckpt")
    _write_csv(os.path.join(landing, "a.csv"), [
        ("S1", "20230105", "PRCP", 5.0, None, None, "7", None),
        ("S1", "20240105", "PRCP", 1.0, None, None, "7", None)])
    run_incremental_daily(spark, landing, _stations(spark), out, ckpt, ["PRCP"])
    first = {(r.date_key, r.PRCP_measurement_value) for r in spark.read.parquet(out).collect()}
    assert first == {("20230105", 5.0), ("20240105", 1.0)}
    # a late file for an old day: only 2023 is rewritten, 2024 stays
    _write_csv(os.path.join(landing, "b.csv"), [
        ("S1", "20230105", "PRCP", 9.0, None, None, "7", None),
        ("S2", "20230107", "PRCP", 2.0, None, None, "7", None)])
    run_incremental_daily(spark, landing, _stations(spark), out, ckpt, ["PRCP"])
    second = {(r.station_id, r.date_key, r.PRCP_measurement_value)
              for r in spark.read.parquet(out).collect()}
    assert second == {("S1", "20230105", 9.0), ("S2", "20230107", 2.0), ("S1", "20240105", 1.0)}


def test_flag_code_tables(spark):
    codes = weather.code_table(spark, weather.QC_FLAG_CODES)
    df = spark.createDataFrame([("G",), ("Q",), (None,)], "qc string")
    from quarry.operators.relational import decode_codes
    out = {r.qc: r.meaning for r in decode_codes(df, "qc", codes, "code", "description", "meaning").collect()}
    assert out["G"] == "failed gap check" and out["Q"] is None and out[None] is None


def test_large_station_list_path_same_result(spark):
    types = ["PRCP", "TMIN", "TMAX", "TAVG"]
    small = weather.daily_table(_facts(spark), _stations(spark), types)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = weather.daily_table(_facts(spark), _stations(spark), types)
        rows = sorted(map(tuple, big.select(*small.columns).collect()))
        plan = big._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(tuple, small.collect())) == rows
    assert "LeftSemi" in plan
