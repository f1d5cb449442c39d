"""Streaming: stream = batch for closed hours, restart from a checkpoint, per-batch mode."""

from dataclasses import replace

from conftest import SF_SMALL, WEATHER_TOPIC, channel, weather_line

from agrosense.operators.aggregates import hourly_soil, hourly_weather
from agrosense.params import StreamSettings
from agrosense.plans import hourly
from agrosense.session import fresh_path
from agrosense.sinks.results import read_batches
from agrosense.sources.files import channel_files
from agrosense.sources.tables import events_channel, table
from agrosense.sources.events_adapter import channel_records
from agrosense.streaming.jobs import readings_stream, start_all, start_hourly
from pyspark.sql import functions as F

SETTINGS = StreamSettings(available_now=True, max_files_per_trigger=1)


def write_channel_parts(spark, path, n_parts, parts=None):
    """events -> channel records, written as ``n_parts`` files in event-time order."""
    ev = table(spark, SF_SMALL, "events")
    bounds = ev.selectExpr("percentile_approx(ts, array(0.25, 0.5, 0.75)) AS q").first().q
    edges = [None, *bounds[: n_parts - 1], None]
    for i in parts if parts is not None else range(n_parts):
        part = ev
        if edges[i] is not None:
            part = part.where(F.col("ts") >= F.lit(edges[i]))
        if edges[i + 1] is not None:
            part = part.where(F.col("ts") < F.lit(edges[i + 1]))
        channel_records(part).coalesce(1).write.mode("append").parquet(path)


def batch_closed(spark, kind, fn, delay_minutes):
    """Batch result restricted to hours closed by the final watermark."""
    readings = readings_stream(events_channel(spark, SF_SMALL), kind)
    hours = hourly_weather(readings) if kind == "meteo" else hourly_soil(readings)
    max_t = readings.agg(F.max("event_time")).first()[0]
    limit = F.lit(max_t) - F.expr(f"INTERVAL {delay_minutes} MINUTES")
    closed = hours.where(F.to_timestamp("hour", "yyyy-MM-dd HH") + F.expr("INTERVAL 1 HOUR") <= limit)
    return fn(closed)


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_stream_equals_batch_for_closed_hours(spark):
    src = fresh_path(spark, "t-stream-src")
    write_channel_parts(spark, src, 4)
    out, ckpt = fresh_path(spark, "t-out"), fresh_path(spark, "t-ckpt")
    ch = channel_files(spark, src, streaming=True, max_files_per_trigger=1)
    for q in start_all(ch, out, ckpt, SETTINGS):
        q.awaitTermination(600)
        assert q.exception() is None
    got = as_set(read_batches(spark, out, "temperature_alert"))
    want = as_set(batch_closed(spark, "meteo", hourly.temperature_alert, 10))
    assert got == want and len(got) > 100
    got = as_set(read_batches(spark, out, "combined_sickness_alert"))
    want = as_set(batch_closed(spark, "suolo", hourly.combined_sickness_alert, 60))
    assert got == want and len(got) > 100
    raw = read_batches(spark, f"{out}/raw", "meteo")
    assert raw.count() == 398
    assert read_batches(spark, f"{out}/raw", "suolo").count() == 602
    assert read_batches(spark, f"{out}/raw", "rejected").count() == 0


def test_restart_from_checkpoint_loses_and_doubles_nothing(spark):
    src = fresh_path(spark, "t-restart-src")
    out, ckpt = fresh_path(spark, "t-restart-out"), fresh_path(spark, "t-restart-ckpt")

    def run():
        ch = channel_files(spark, src, streaming=True, max_files_per_trigger=1)
        q = start_hourly(ch, "meteo", out, ckpt, SETTINGS)
        q.awaitTermination(600)
        assert q.exception() is None

    for half in ([0, 1], [2, 3]):
        write_channel_parts(spark, src, 4, half)
        run()
    got = read_batches(spark, out, "temperature_alert")
    assert got.count() == got.distinct().count()

    out2, ckpt2 = fresh_path(spark, "t-once-out"), fresh_path(spark, "t-once-ckpt")
    ch = channel_files(spark, src, streaming=True, max_files_per_trigger=1)
    q = start_hourly(ch, "meteo", out2, ckpt2, SETTINGS)
    q.awaitTermination(600)
    assert as_set(got) == as_set(read_batches(spark, out2, "temperature_alert"))


def test_hour_split_over_two_files(spark):
    first = [(WEATHER_TOPIC, weather_line(1, "2020-01-02 03:10:00", 1.0)),
             (WEATHER_TOPIC, weather_line(2, "2020-01-02 03:20:00", 3.0))]
    second = [(WEATHER_TOPIC, weather_line(3, "2020-01-02 03:40:00", 5.0)),
              (WEATHER_TOPIC, weather_line(4, "2020-01-02 05:00:00", 7.0))]
    results = {}
    for mode in ("event_time", "per_batch"):
        src = fresh_path(spark, f"t-split-{mode}")
        for rows in (first, second):
            channel(spark, rows).coalesce(1).write.mode("append").parquet(src)
        out, ckpt = fresh_path(spark, "t-split-out"), fresh_path(spark, "t-split-ckpt")
        settings = replace(SETTINGS, mode=mode)
        ch = channel_files(spark, src, streaming=True, max_files_per_trigger=1)
        q = start_hourly(ch, "meteo", out, ckpt, settings, results=["temperature_alert"])
        q.awaitTermination(600)
        assert q.exception() is None
        df = read_batches(spark, out, "temperature_alert").where(F.col("hour") == "2020-01-02 03")
        results[mode] = sorted(r.highTemperature for r in df.collect())
    assert results["event_time"] == [3.0]
    assert results["per_batch"] == [2.0, 5.0]


def test_batch_queries_over_the_streamed_archive(spark):
    """Raw archive (stream) -> stored-table scan with topic pruning -> daily results."""
    from agrosense.operators.readings import weather_readings
    from agrosense.plans import daily
    from agrosense.plans.pipeline import stored_weather
    from agrosense.sources.tables import stored_readings
    from agrosense.streaming.replay import run_raw_archive

    out = run_raw_archive(spark, SF_SMALL)
    archive = stored_readings(spark, f"{out}/meteo", kind="meteo").drop("batch_id")
    plan = archive._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "topic" in plan
    from_archive = weather_readings(archive)
    direct = stored_weather(spark, SF_SMALL)
    for fn in (daily.top10_hot_days, daily.days_to_water, daily.last_3_days_trend):
        assert as_set(fn(from_archive)) == as_set(fn(direct))


def test_redelivered_readings_are_dropped_with_dedupe(spark):
    rows = [(WEATHER_TOPIC, weather_line(1, "2020-01-02 03:10:00", 1.0)),
            (WEATHER_TOPIC, weather_line(2, "2020-01-02 03:20:00", 3.0)),
            (WEATHER_TOPIC, weather_line(3, "2020-01-02 05:00:00", 7.0))]
    results = {}
    for dedupe in (False, True):
        src = fresh_path(spark, f"t-dedupe-{dedupe}")
        channel(spark, rows[:2]).coalesce(1).write.mode("append").parquet(src)
        channel(spark, rows[1:]).coalesce(1).write.mode("append").parquet(src)  # reading 2 again
        out, ckpt = fresh_path(spark, "t-dedupe-out"), fresh_path(spark, "t-dedupe-ckpt")
        settings = replace(SETTINGS, dedupe=dedupe)
        ch = channel_files(spark, src, streaming=True, max_files_per_trigger=1)
        q = start_hourly(ch, "meteo", out, ckpt, settings, results=["temperature_alert"])
        q.awaitTermination(600)
        assert q.exception() is None
        df = read_batches(spark, out, "temperature_alert")
        results[dedupe] = [tuple(r) for r in df.collect()]
    assert results[True] == [("2020-01-02 03", 2.0)]
    assert results[False] == [("2020-01-02 03", 2.333333333)]


def test_daily_results_from_streamed_partials(spark):
    """Daily partials written per micro-batch combine into the same daily results."""
    from agrosense.plans import daily
    from agrosense.plans.pipeline import stored_weather
    from agrosense.sources.tables import stored_daily
    from agrosense.streaming.jobs import start_raw_archive

    src = fresh_path(spark, "t-partials-src")
    write_channel_parts(spark, src, 4)
    out, ckpt = fresh_path(spark, "t-partials-out"), fresh_path(spark, "t-partials-ckpt")
    ch = channel_files(spark, src, streaming=True, max_files_per_trigger=1)
    q = start_raw_archive(ch, out, ckpt, SETTINGS)
    q.awaitTermination(600)
    assert q.exception() is None
    partials = read_batches(spark, out, "daily_partials", keep_batch_id=True)
    assert partials.select("batch_id").distinct().count() == 4
    rolled = stored_daily(spark, f"{out}/daily_partials")
    direct = stored_weather(spark, SF_SMALL)
    for fn in (daily.top10_hot_days, daily.top10_cold_days, daily.top10_humid_days,
               daily.days_to_water, daily.daily_means, daily.last_3_days_trend):
        assert as_set(fn(rolled)) == as_set(fn(direct)), fn.__name__


def test_archive_time_range_is_pushed_to_the_scan(spark):
    from agrosense.operators.readings import weather_readings
    from agrosense.plans import hourly as hourly_plans
    from agrosense.sources.tables import stored_readings
    from agrosense.streaming.replay import run_raw_archive

    out = run_raw_archive(spark, SF_SMALL)
    part = stored_readings(spark, f"{out}/meteo", "meteo", since="2024-01-05", until="2024-01-07")
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(data_ora,2024-01-05)" in plan
    got = hourly_plans.temperature_alert(hourly_weather(weather_readings(part)))
    days = {r.hour[:10] for r in got.collect()}
    assert days == {"2024-01-05", "2024-01-06"}


def test_rocksdb_state_store_gives_the_same_result(spark):
    from agrosense.streaming.replay import stream_result

    settings = StreamSettings(state_store="rocksdb", state_partitions=2)
    got = as_set(stream_result(spark, SF_SMALL, "water_content_alert", settings))
    want = as_set(stream_result(spark, SF_SMALL, "water_content_alert"))
    assert got == want and len(got) > 100
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass", "")


def test_streaming_csv_replay_feeds_the_hourly_job(spark):
    """Sensor CSV files replayed as a stream (one file per trigger) into the hourly job."""
    import os

    from agrosense.session import local_path
    from agrosense.sources.files import csv_replay

    folder = local_path(fresh_path(spark, "t-csv-stream"))
    os.makedirs(folder)
    header = ";".join(f"c{i}" for i in range(20))
    for n, rows in enumerate([[("2020-01-02 03:10:00", 1.0), ("2020-01-02 03:50:00", 3.0)],
                              [("2020-01-02 05:00:00", 9.0)]]):
        with open(os.path.join(folder, f"meteo_{n}.csv"), "w") as f:
            f.write(header + "\n")
            for i, (ts, t) in enumerate(rows):
                f.write(weather_line(f"{n}{i}", ts, t) + "\n")
    ch = csv_replay(spark, folder, "meteo_2020", streaming=True, max_files_per_trigger=1)
    out, ckpt = fresh_path(spark, "t-csv-out"), fresh_path(spark, "t-csv-ckpt")
    q = start_hourly(ch, "meteo", out, ckpt, SETTINGS, results=["temperature_alert"])
    q.awaitTermination(600)
    assert q.exception() is None
    assert as_set(read_batches(spark, out, "temperature_alert")) == {("2020-01-02 03", 2.0)}


def test_archive_routes_bad_lines_to_rejected(spark):
    from agrosense.streaming.jobs import start_raw_archive

    rows = [(WEATHER_TOPIC, weather_line(1, "2020-01-02 03:10:00", 1.0)),
            (WEATHER_TOPIC, "1;2;3"),
            ("iotData_altro", weather_line(2, "2020-01-02 03:10:00", 1.0))]
    src = fresh_path(spark, "t-rej-src")
    channel(spark, rows).coalesce(1).write.parquet(src)
    out, ckpt = fresh_path(spark, "t-rej-out"), fresh_path(spark, "t-rej-ckpt")
    q = start_raw_archive(channel_files(spark, src, streaming=True), out, ckpt, SETTINGS)
    q.awaitTermination(600)
    assert q.exception() is None
    rejected = {(r.topic, r.reason) for r in read_batches(spark, out, "rejected").collect()}
    assert rejected == {(WEATHER_TOPIC, "too_few_fields"), ("iotData_altro", "unknown_topic")}
    assert read_batches(spark, out, "meteo").count() == 1


def test_alerts_retuned_from_the_streamed_hourly_table(spark):
    """New thresholds over history from the closed-hour table equal the batch form."""
    from dataclasses import replace as dc_replace

    from agrosense.params import DEFAULT
    from agrosense.streaming.replay import run_hourly

    out = run_hourly(spark, SF_SMALL, "suolo")
    table_ = read_batches(spark, out, "hourly_suolo")
    th = dc_replace(DEFAULT, alert_water_max=0.3, combined_temp_min=0.5)
    for fn in (hourly.water_content_alert, hourly.combined_sickness_alert):
        got = as_set(fn(table_, th))
        want = as_set(batch_closed(spark, "suolo", lambda h: fn(h, th), 60))
        assert got == want and len(got) > 50


def test_reading_after_its_hour_was_emitted_is_dropped(spark):
    """Append mode emits an hour once; a reading for it arriving later is dropped, not re-emitted."""
    files = [[(WEATHER_TOPIC, weather_line(1, "2020-01-02 03:10:00", 1.0)),
              (WEATHER_TOPIC, weather_line(2, "2020-01-02 05:00:00", 7.0))],
             [(WEATHER_TOPIC, weather_line(3, "2020-01-02 06:30:00", 9.0))],   # hour 03 closes
             [(WEATHER_TOPIC, weather_line(4, "2020-01-02 03:30:00", 100.0)),  # too late
              (WEATHER_TOPIC, weather_line(5, "2020-01-02 08:00:00", 9.0))]]
    src = fresh_path(spark, "t-late")
    for rows in files:
        channel(spark, rows).coalesce(1).write.mode("append").parquet(src)
    out, ckpt = fresh_path(spark, "t-late-out"), fresh_path(spark, "t-late-ckpt")
    ch = channel_files(spark, src, streaming=True, max_files_per_trigger=1)
    q = start_hourly(ch, "meteo", out, ckpt, SETTINGS, results=["temperature_alert"])
    q.awaitTermination(600)
    assert q.exception() is None
    got = read_batches(spark, out, "temperature_alert")
    assert got.count() == got.select("hour").distinct().count()
    assert as_set(got) == {("2020-01-02 03", 1.0), ("2020-01-02 05", 7.0),
                           ("2020-01-02 06", 9.0)}


def test_soil_results_over_the_archive_with_topic_pruning(spark):
    from agrosense.operators.readings import soil_readings
    from agrosense.plans.pipeline import stored_soil
    from agrosense.sources.tables import stored_readings
    from agrosense.streaming.replay import run_raw_archive

    out = run_raw_archive(spark, SF_SMALL)
    topics = ["iotData_suolo_3_2024", "iotData_suolo_7_2024"]
    archive = stored_readings(spark, f"{out}/suolo", "suolo", topics).drop("batch_id")
    plan = archive._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "iotData_suolo_3_2024" in plan
    got = as_set(hourly.combined_sickness_alert(hourly_soil(soil_readings(archive))))
    direct = stored_soil(spark, SF_SMALL).where(F.col("topic").isin(*topics))
    want = as_set(hourly.combined_sickness_alert(hourly_soil(direct)))
    assert got == want and {t for t, _, _, _ in got} == set(topics)
