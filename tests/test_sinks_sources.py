"""Sinks (append, replace, idempotent per batch) and file / bus sources."""

import os

import pytest
from conftest import SF_SMALL

from agrosense.operators.parse import weather_records
from agrosense.operators.readings import weather_readings
from agrosense.plans.pipeline import stored_weather
from agrosense.plans.suite import batch_results, run_batch_suite
from agrosense.session import fresh_path, local_path
from agrosense.sinks.results import (
    append_results,
    batch_writer,
    read_batches,
    read_replaced,
    replace_results,
)
from agrosense.sources.events_adapter import (
    channel_records,
    stored_soil_records,
    stored_weather_records,
)
from agrosense.operators.parse import soil_records
from agrosense.sources.files import csv_import, csv_replay
from agrosense.sources.kafka import kafka_channel
from agrosense.sources.tables import table


def test_append_stamps_each_run(spark):
    path = fresh_path(spark, "t-append")
    df = spark.range(3)
    append_results(df, path)
    append_results(df, path)
    out = spark.read.parquet(path)
    assert out.count() == 6 and "run_ts" in out.columns


def test_replace_switches_versions_and_keeps_empty_results(spark):
    path = fresh_path(spark, "t-replace")
    replace_results(spark.range(3), path)
    assert read_replaced(spark, path).count() == 3
    replace_results(spark.range(5), path)
    assert read_replaced(spark, path).count() == 5
    replace_results(spark.range(0), path)
    assert read_replaced(spark, path).count() == 0


def test_batch_writer_is_idempotent_by_batch_id(spark):
    out = fresh_path(spark, "t-batches")
    write = batch_writer({"double": lambda b: b.selectExpr("id * 2 AS v")}, out)
    write(spark.range(4), 0)
    write(spark.range(4), 0)        # replayed batch
    write(spark.range(2), 1)
    got = read_batches(spark, out, "double", keep_batch_id=True)
    assert got.count() == 6
    assert sorted(r.batch_id for r in got.select("batch_id").distinct().collect()) == [0, 1]


def test_stored_record_view_equals_parsed_lines(spark):
    ev = table(spark, SF_SMALL, "events")
    ch = channel_records(ev)
    a, b = weather_records(ch), stored_weather_records(ev)
    assert a.count() == 398 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    a, b = soil_records(ch), stored_soil_records(ev)
    assert a.count() == 602 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_batch_suite_writes_all_five_results(spark):
    out = fresh_path(spark, "t-suite")
    readings = stored_weather(spark, SF_SMALL)
    paths = run_batch_suite(readings, out)
    assert set(paths) == {"last_3_days_trend", "days_to_water", "top10_humid_days",
                          "top10_hot_days", "top10_cold_days"}
    assert read_replaced(spark, paths["top10_hot_days"]).count() == 10
    assert spark.read.parquet(paths["last_3_days_trend"]).count() == 1
    d, results = batch_results(readings)
    assert results["top10_cold_days"].count() == 10
    d.unpersist()


def test_csv_replay_round_trip(spark):
    folder = local_path(fresh_path(spark, "t-csv"))
    os.makedirs(folder)
    header = ";".join(f"c{i}" for i in range(20))
    lines = [header,
             "1;2020-01-02 03:04:05;12.5;;;60;;;;0.0;;;;;;;;;;",
             "2;2020-01-02 03:09:05;13.5;;;61;;;;0.2;;;;;;;;;;"]
    with open(os.path.join(folder, "meteo.csv"), "w") as f:
        f.write("\n".join(lines) + "\n")
    ch = csv_replay(spark, folder, "meteo_2020")
    assert {r.topic for r in ch.collect()} == {"iotData_meteo_2020"}
    rd = weather_readings(weather_records(ch)).orderBy("_id").collect()
    assert [(r._id, r.temp1_media, r.ur1_media, r.pioggia_mm) for r in rd] == [
        ("1", 12.5, 60.0, 0.0), ("2", 13.5, 61.0, 0.2)]
    stream = csv_replay(spark, folder, "meteo_2020", streaming=True, max_files_per_trigger=1)
    assert stream.isStreaming and stream.columns == ["topic", "value"]


def test_csv_import_infers_types_and_replaces(spark):
    folder = local_path(fresh_path(spark, "t-import"))
    os.makedirs(folder)
    with open(os.path.join(folder, "suolo.csv"), "w") as f:
        f.write("id,timestamp,water\n1,2020-01-02 03:04:05,0.25\n2,2020-01-02 04:04:05,0.5\n")
    target = fresh_path(spark, "t-import-table")
    df = csv_import(spark, folder, target)
    types = dict(df.dtypes)
    assert types["id"] == "int" and types["water"] == "double"
    assert df.count() == 2
    assert csv_import(spark, folder, target).count() == 2    # replaced, not appended


def test_kafka_source_needs_the_connector(spark):
    with pytest.raises(Exception) as err:
        kafka_channel(spark, "localhost:9092", ["iotData_meteo_x"], streaming=True)
    assert "kafka" in str(err.value).lower()
