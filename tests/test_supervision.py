"""Supervision of streams, and the suite committed once per run."""

from datetime import datetime

import pytest
from conftest import SF_SMALL, rows, weather_channel

from agrosense.params import StreamSettings
from agrosense.plans.pipeline import stored_weather
from agrosense.plans.suite import SUITE, batch_results, run_batch_suite, run_suite_once
from agrosense.session import fresh_path
from agrosense.sinks import log
from agrosense.sinks.results import read_batches
from agrosense.sources.files import channel_files
from agrosense.sources.kafka import kafka_channel
from agrosense.streaming.jobs import await_all, kind_topics, start_hourly, start_raw_archive
from agrosense.streaming.supervise import Supervisor

NOW = StreamSettings(available_now=True)


def source(spark, loads):
    src = fresh_path(spark, "t-supervised")
    for k, load in enumerate(loads):
        weather_channel(spark, load).coalesce(1).write.mode("append").parquet(src)
    return src


def test_totals_count_rows_and_late_rows(spark):
    base = fresh_path(spark, "t-totals")
    src = fresh_path(spark, "t-totals-in")
    loads = [[("2020-01-01 05:00:00", 1.0)], [("2020-01-01 01:00:00", 1.0), ("2020-01-01 01:30:00", 2.0)],
             [("2020-01-01 09:00:00", 1.0)]]
    late = read = 0
    with Supervisor(spark) as s:
        for load in loads:
            weather_channel(spark, load).coalesce(1).write.mode("append").parquet(src)
            q = start_hourly(channel_files(spark, src, streaming=True), "meteo", f"{base}/out", f"{base}/ckpt", NOW)
            totals = await_all([q], 300, supervisor=s)["meteo_hourly"]
            assert totals.ended and totals.failure is None
            read, late = read + totals.input_rows, late + totals.late_rows
    # both readings of 01 h fall into one late group, which the aggregate drops before it is kept
    assert read == 4 and late >= 1
    assert read_batches(spark, f"{base}/out", "hourly_meteo").where("hour like '%01'").count() == 0


def test_a_failing_query_is_named_and_the_others_stop(spark):
    base = fresh_path(spark, "t-fail")
    src = source(spark, [[("2020-01-01 05:00:00", 1.0)]])
    endless = StreamSettings(trigger_seconds=1)
    with Supervisor(spark) as s:
        good = start_raw_archive(channel_files(spark, src, streaming=True), f"{base}/out", f"{base}/a", endless)

        def broken(batch, batch_id):
            raise ValueError("broken sink")
        bad = (channel_files(spark, src, streaming=True).writeStream.foreachBatch(broken).queryName("bad")
               .option("checkpointLocation", f"{base}/b").start())
        with pytest.raises(RuntimeError, match="bad.*"):
            await_all([good, bad], 300)
        assert not good.isActive
        assert "broken sink" in s.of(bad).failure and s.of(good).failure is None


def test_the_default_trigger_is_twelve_seconds(spark):
    """The second micro-batch starts twelve seconds after the first."""
    src = source(spark, [[("2020-01-01 05:00:00", 1.0)]])
    base = fresh_path(spark, "t-trigger")
    q = start_raw_archive(channel_files(spark, src, streaming=True), f"{base}/out", f"{base}/ckpt")
    try:
        q.processAllAvailable()
        weather_channel(spark, [("2020-01-01 06:00:00", 1.0)]).write.mode("append").parquet(src)
        q.processAllAvailable()
        first, *_, last = [p for p in q.recentProgress if p.numInputRows]
        began = [datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).timestamp() for p in (first, last)]
        # triggers lie on whole multiples of the interval
        assert began[1] > began[0] and abs(began[1] % 12) < 1.5
    finally:
        q.stop()


def test_comma_list_of_topics(spark):
    topics = ["iotData_meteo_a", " iotData_suolo_1", "", "x"]
    assert kind_topics([t.strip() for t in topics if t.strip()], "suolo") == ["iotData_suolo_1"]
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_channel(spark, "localhost:9092", ["a", "b"])


def test_a_repeated_run_writes_only_what_it_had_not(spark):
    src, out = stored_weather(spark, SF_SMALL), fresh_path(spark, "t-once")

    def stop(name):
        if name == "top10_humid_days":
            raise RuntimeError("stopped")
    with pytest.raises(RuntimeError, match="stopped"):
        run_suite_once(src, out, "run-1", after_result=stop)
    assert log.latest_version(spark, f"{out}/top10_hot_days") == -1
    paths = run_suite_once(src, out, "run-1")
    run_suite_once(src, out, "run-1")
    d, want = batch_results(src)
    for name, _, mode in SUITE:
        got = log.read_table(spark, paths[name])
        assert rows(got.select(want[name].columns)) == rows(want[name])
        assert log.latest_version(spark, paths[name]) == 0
    run_suite_once(src, out, "run-2")
    assert log.read_table(spark, paths["last_3_days_trend"]).count() == 2
    assert rows(log.read_table(spark, paths["top10_hot_days"])) == rows(want["top10_hot_days"])
    d.unpersist()
    # the reference's doubling stays available
    plain = fresh_path(spark, "t-double")
    for _ in range(2):
        paths = run_batch_suite(src, plain)
    assert spark.read.parquet(paths["last_3_days_trend"]).count() == 2


def test_interleaved_runs_end_readable(spark):
    """A run that began earlier and publishes later finds its base gone; readers see the other's."""
    src, out = stored_weather(spark, SF_SMALL), fresh_path(spark, "t-interleaved")
    run_suite_once(src, out, "run-0")

    def other_run(name):
        if name == "days_to_water" and not done:
            done.append(1)
            run_suite_once(src, out, "run-2")
    done = []
    with pytest.raises(log.Conflict):
        run_suite_once(src, out, "run-1", after_result=other_run)
    for name, _, mode in SUITE:
        if mode == "replace":
            assert log.read_table(spark, f"{out}/{name}").count() == 10
            log.vacuum(spark, f"{out}/{name}", -1)
            assert log.read_table(spark, f"{out}/{name}").count() == 10
