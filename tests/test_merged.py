"""The versioned, merging incremental load (G1)."""

import glob
import os

import pytest

from quarry.operators import weather
from quarry.sources import sinks
from quarry.streaming import merged


@pytest.fixture
def load(spark, tmp_dir):
    stations = spark.createDataFrame([("S1",), ("S2",), ("S2",)], "station_id string")

    def land(*rows, types=("PRCP", "TMIN"), **options):
        full = [(*r, *[None] * (8 - len(r))) for r in rows]
        df = spark.createDataFrame(full, weather.MEASUREMENT_DDL)
        sinks.write_csv(df.coalesce(1), f"{tmp_dir}/in", mode="append")
        merged.run_merged_daily(spark, f"{tmp_dir}/in", stations, f"{tmp_dir}/out", f"{tmp_dir}/state", types,
                                scaled=("TMIN",), **options)
        return df

    return land


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_batches_equal_one_pivot_of_all_rows(spark, tmp_dir, load):
    batches = [
        [("S1", "20230105", "PRCP", 5.0, "A"), ("S1", "20240105", "TMIN", -55.9, None, "x"), ("S9", "20240105", "PRCP", 1.0)],
        [("S1", "20230105", "PRCP", 9.0, None, None, "7"), ("S2", "20230107", "PRCP", None, "T")],
        [("S9", "20250101", "PRCP", 1.0)],                                    # no listed station: no version
        [("S1", "20230105", "TMIN", 14.0), ("S1", "20240105", "TMIN", -50.0, "B"), ("S2", "20250101", "PRCP", 0.0),
         ("S2", None, "PRCP", 3.0), ("S1", "0099", "PRCP", 2.0)],
        [("S1", "20230105", "PRCP", 5.0, "A")]]                               # repeated rows change nothing
    every = None
    for b in batches:
        df = load(*b)
        every = df if every is None else every.unionByName(df)
    stations = spark.createDataFrame([("S1",), ("S2",)], "station_id string")
    want = weather.daily_table(every, stations, ("PRCP", "TMIN"), scaled=("TMIN",))
    got = merged.read_daily(spark, f"{tmp_dir}/out")
    assert got.columns == want.columns and rows(got) == rows(want)
    assert got.where("date_key = '20230105'").first().PRCP_measurement_value == 9.0
    # earlier versions stay readable
    assert merged.read_daily(spark, f"{tmp_dir}/out", 1).count() == 2
    assert merged.read_daily(spark, f"{tmp_dir}/out", 4).count() == got.count()
    with pytest.raises(ValueError):
        merged.read_daily(spark, f"{tmp_dir}/out", 5)
    # version 1 wrote 2023 and 2024, both rewritten since
    unused = merged.unused_versions(spark, f"{tmp_dir}/out")
    assert [os.path.basename(p)[:18] for p in unused] == ["version=v000000001", "version=v000000002"]
    assert merged.unused_versions(spark, f"{tmp_dir}/out", keep=4) == []


def test_a_failed_batch_leaves_the_published_version(spark, tmp_dir, load, monkeypatch):
    load(("S1", "20230105", "PRCP", 5.0))
    before = rows(merged.read_daily(spark, f"{tmp_dir}/out"))

    def torn(df, path, **kw):
        sinks.write_parquet(df, path, **kw)
        raise OSError("lost after the data, before the version file")

    with monkeypatch.context() as m:
        m.setattr(merged, "write_parquet", torn)
        with pytest.raises(Exception, match="lost after the data"):
            load(("S1", "20230105", "PRCP", 8.0), ("S1", "20230106", "PRCP", 1.0))
    assert len(glob.glob(f"{tmp_dir}/out/data/version=*")) == 2
    assert rows(merged.read_daily(spark, f"{tmp_dir}/out")) == before
    load(("S2", "20230106", "PRCP", 2.0))          # the stream offers the failed batch's files again
    got = merged.read_daily(spark, f"{tmp_dir}/out")
    assert sorted((r.station_id, r.date_key, r.PRCP_measurement_value) for r in got.collect()) == \
        [("S1", "20230105", 8.0), ("S1", "20230106", 1.0), ("S2", "20230106", 2.0)]


def test_bounded_batches_changed_types_and_a_repeated_batch(spark, tmp_dir, load):
    stations = spark.createDataFrame([("S1",)], "station_id string")
    for v in (1.0, 2.0, 3.0):
        sinks.write_csv(spark.createDataFrame([("S1", " 20230105 ", "PRCP", v, None, None, None, None)], weather.MEASUREMENT_DDL).coalesce(1),
                        f"{tmp_dir}/in", mode="append")
    load(("S2", "20230105", "PRCP", 4.0), files_per_batch=1)
    got = merged.read_daily(spark, f"{tmp_dir}/out")
    assert sorted((r.station_id, r.PRCP_measurement_value) for r in got.collect()) == [("S1", 3.0), ("S2", 4.0)]
    batch = spark.createDataFrame([("S1", "20230105", "PRCP", 7.0, None, None, None, None)], weather.MEASUREMENT_DDL)
    for _ in range(2):
        merged.merge_batch(batch, stations, f"{tmp_dir}/out", ("PRCP", "TMIN"), ("TMIN",))
    got = merged.read_daily(spark, f"{tmp_dir}/out")
    assert sorted((r.station_id, r.PRCP_measurement_value) for r in got.collect()) == [("S1", 7.0), ("S2", 4.0)]
    with pytest.raises(ValueError, match="other columns"):
        merged.merge_batch(batch, stations, f"{tmp_dir}/out", ("PRCP",))
    # an empty batch publishes nothing
    newest = len(os.listdir(f"{tmp_dir}/out/data"))
    merged.merge_batch(batch.limit(0), stations, f"{tmp_dir}/out", ("PRCP", "TMIN"), ("TMIN",))
    assert len(os.listdir(f"{tmp_dir}/out/data")) == newest


def test_landing_files_are_read_once(spark, tmp_dir, load, monkeypatch):
    """Each batch's rows leave the landing folder in a single Spark read."""
    seen = spark.sparkContext.accumulator(0)

    def counting(long_df, types, **kw):
        def note(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b
        return pivot(long_df.mapInArrow(note, long_df.schema), types, **kw)

    pivot = weather.pivot_daily
    load(("S1", "20230105", "PRCP", 5.0), ("S1", "20240105", "PRCP", 6.0))
    with monkeypatch.context() as m:
        m.setattr(weather, "pivot_daily", counting)
        load(("S1", "20230106", "PRCP", 7.0))
    assert seen.value == 1     # not the earlier files of the touched year, and the new row once
