"""The three command-line roles, end to end: replay -> stream -> batch."""

import os

from conftest import SF_SMALL

from agrosense import cli
from agrosense.plans import daily
from agrosense.plans.pipeline import stored_weather
from agrosense.session import fresh_path, local_path
from agrosense.sinks.results import read_batches, read_replaced
from agrosense.sources.events_adapter import channel_records
from agrosense.sinks.log import read_table
from agrosense.sources.tables import stored_readings, table
from agrosense.streaming.per_topic import closed_hours


def test_replay_stream_batch(spark):
    # replay: a sensor CSV becomes channel records
    folder = local_path(fresh_path(spark, "t-cli-csv"))
    os.makedirs(folder)
    with open(os.path.join(folder, "meteo.csv"), "w") as f:
        f.write(";".join(f"c{i}" for i in range(20)) + "\n")
        f.write("1;2020-01-02 03:04:05;12.5;;;60;;;;0.0;;;;;;;;;;\n")
    replayed = fresh_path(spark, "t-cli-replayed")
    cli.main(["replay", "--csv", folder, "--source", "meteo_2020", "--out", replayed], spark)
    assert spark.read.parquet(replayed).first().topic == "iotData_meteo_2020"

    # stream: the whole archive and hourly side over files of channel records
    src = fresh_path(spark, "t-cli-src")
    channel_records(table(spark, SF_SMALL, "events")).write.parquet(src)
    out = fresh_path(spark, "t-cli-out")
    cli.main(["stream", "--files", src, "--out", out, "--available-now",
              "--state-partitions", "4"], spark)
    assert read_batches(spark, f"{out}/raw", "meteo").count() == 398
    assert read_batches(spark, out, "temperature_alert").count() > 0

    # batch: daily results from the archive, and from the daily partials
    want = {tuple(r) for r in daily.top10_hot_days(stored_weather(spark, SF_SMALL)).collect()}
    for extra in ([], ["--from-partials"]):
        res = fresh_path(spark, "t-cli-batch")
        cli.main(["batch", "--archive", f"{out}/raw", "--out", res, *extra], spark)
        got = {tuple(r) for r in read_replaced(spark, f"{res}/top10_hot_days").collect()}
        assert got == want


def test_log_archive_roles(spark):
    """stream --log, compact, and batch from the kept daily table, each result once per run id."""
    src, out = fresh_path(spark, "t-cli-log-src"), fresh_path(spark, "t-cli-log")
    channel_records(table(spark, SF_SMALL, "events")).write.parquet(src)
    cli.main(["stream", "--files", src, "--out", out, "--available-now", "--log"], spark)
    cli.main(["compact", "--archive", f"{out}/raw"], spark)
    assert stored_readings(spark, f"{out}/raw/meteo", "meteo").count() == 398
    assert closed_hours(spark, out, "suolo").count() > 0
    want = {tuple(r) for r in daily.top10_hot_days(stored_weather(spark, SF_SMALL)).collect()}
    res = fresh_path(spark, "t-cli-log-batch")
    for extra in (["--daily", f"{out}/daily"], ["--from-partials"], []):
        for _ in range(2):
            cli.main(["batch", "--archive", f"{out}/raw", "--out", res, "--run-id", f"run{extra}", *extra], spark)
        assert {tuple(r) for r in read_table(spark, f"{res}/top10_hot_days").collect()} == want
    assert read_table(spark, f"{res}/last_3_days_trend").count() == 3
