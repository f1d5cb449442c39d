"""Nothing is lost: table layouts, damaged lines, partly bad times, sinks, late readings."""

from types import SimpleNamespace

import pytest
from conftest import SF_SMALL, SOIL_TOPIC, WEATHER_TOPIC, channel, rows, soil_line, weather_channel, weather_line
from pyspark.sql import functions as F

from agrosense.operators.aggregates import (
    daily_from_partials,
    daily_partials,
    daily_weather,
    hourly_from_partials,
    hourly_partials,
    hourly_soil,
)
from agrosense.operators.parse import rejected_lines, soil_records, weather_records
from agrosense.operators.readings import soil_readings, weather_readings
from agrosense.params import StreamSettings, Thresholds
from agrosense.plans.catalog import ALL_QUERIES
from agrosense.session import fresh_path, work_dir
from agrosense.sinks.results import (
    compact_batches,
    current_version,
    drop_old_versions,
    read_batches,
    read_replaced,
    replace_results,
)
from agrosense.sources.events_adapter import (
    channel_records,
    stored_soil_records,
    stored_weather_records,
)
from agrosense.sources.files import channel_files
from agrosense.sources.tables import stored_readings, table
from agrosense.streaming.jobs import await_all, kind_topics, start_raw_archive

NOW = StreamSettings(available_now=True)


@pytest.fixture(scope="module")
def folder_of_parts(spark):
    """``events`` as a folder of four part files."""
    base = fresh_path(spark, "t-parts")
    table(spark, SF_SMALL, "events").repartition(4).write.parquet(f"{base}/events.parquet")
    return base


@pytest.mark.parametrize("name", ["raw_ingest_stream", "temperature_alert_stream", "daily_means_rollup",
                                  "water_content_alert_per_batch"])
def test_streams_read_a_table_of_many_files(spark, folder_of_parts, name):
    want = ALL_QUERIES[name](spark, SF_SMALL)
    assert rows(ALL_QUERIES[name](spark, folder_of_parts), want.columns) == rows(want, want.columns)


def test_empty_stream_results_are_empty_frames(spark):
    base = fresh_path(spark, "t-empty")
    table(spark, SF_SMALL, "events").limit(0).write.parquet(f"{base}/events.parquet")
    for name in ("temperature_alert_stream", "raw_ingest_stream"):
        assert ALL_QUERIES[name](spark, base).count() == 0


def test_every_line_is_a_record_or_a_reject(spark):
    good = weather_line(1, "2020-01-02 03:10:00", 1.0)
    lines = [good, None, '1;"2020-01-02 03:10:00;1.0;' + ";" * 17, "1;2",
             good.replace(";;", ';5"0;', 1).replace(";;", ';1"0;', 1), '"a;b";' + ";" * 19, '"";' + ";" * 18]
    ch = channel(spark, [(t, v) for v in lines for t in (WEATHER_TOPIC, SOIL_TOPIC)])
    rejects = rejected_lines(ch)
    assert weather_records(ch).count() + soil_records(ch).count() + rejects.count() == 2 * len(lines)
    assert {r.reason for r in rejects.collect()} == {"null_value", "bad_quote", "too_few_fields"}
    inches = weather_records(channel(spark, [(WEATHER_TOPIC, lines[4])])).first()
    assert '5"0' in inches.asDict().values() and '1"0' in inches.asDict().values()


def test_lines_are_split_once(spark):
    ch = channel(spark, [(WEATHER_TOPIC, "x")])
    plan = weather_records(ch)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(value") <= 1 and "from_csv" not in plan


def test_a_null_event_type_is_a_soil_reading_everywhere(spark):
    ev = table(spark, SF_SMALL, "events").limit(50).withColumn(
        "event_type", F.when(F.col("event_id") % 3 != 0, F.col("event_type")))
    ch = channel_records(ev)
    assert weather_records(ch).count() == stored_weather_records(ev).count()
    assert soil_records(ch).exceptAll(stored_soil_records(ev)).count() == 0
    assert weather_records(ch).count() + soil_records(ch).count() == 50


def test_daily_results_need_only_the_day(spark):
    ch = weather_channel(spark, [("2020-01-02 03:10:00", 1.0), ("2020-01-02 03:10", 2.0),
                                 ("2020-01-02 03:10:00.0", 6.0), ("2020-13-02 03:10:00", 50.0)])
    day = daily_weather(weather_readings(weather_records(ch))).collect()
    assert [(r.day, r.avg_temp, r.n_temp) for r in day] == [("2020-01-02", 3.0, 3)]


def archive(spark, src, out, checkpoint):
    q = start_raw_archive(channel_files(spark, src, streaming=True), out, checkpoint, NOW)
    await_all([q], 600)


def test_a_new_checkpoint_keeps_what_an_earlier_query_wrote(spark):
    out = fresh_path(spark, "t-two")
    for k, hours in enumerate((range(5), range(5, 6))):
        src = fresh_path(spark, f"t-two-src{k}")
        weather_channel(spark, [(f"2020-01-0{1 + h % 3} 0{h}:00:00", float(h)) for h in hours]).write.parquet(src)
        archive(spark, src, out, fresh_path(spark, "t-two-ckpt"))
    assert read_batches(spark, out, "meteo").count() == 6
    assert spark.read.parquet(f"{out}/meteo").select("query").distinct().count() == 2
    days = stored_readings(spark, f"{out}/meteo", "meteo", [WEATHER_TOPIC], since="2020-01-02", until="2020-01-03")
    assert days.count() == 2
    plan = days._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("PushedFilters")[0]
    assert "topic" in filters and "day" in filters
    # compaction: the same rows, pruned alike
    compact_batches(spark, out, "meteo", f"{out}/compact", ["topic", "day"])
    small = f"{out}/compact/v={current_version(spark, f'{out}/compact')}"
    a, b = (stored_readings(spark, p, "meteo", [WEATHER_TOPIC]) for p in (f"{out}/meteo", small))
    b = b.select(a.drop("batch_id").columns)
    assert rows(a.drop("batch_id"), b.columns) == rows(b, b.columns)


def test_old_versions_are_dropped(spark):
    path = fresh_path(spark, "t-versions")
    for n in range(4):
        replace_results(spark.range(n), path)
    assert drop_old_versions(spark, path, keep=2) == 2
    assert read_replaced(spark, path).count() == 3


def test_partials_of_other_thresholds_raise(spark):
    readings = weather_readings(weather_records(weather_channel(spark, [("2020-01-02 03:10:00", 23.0)])))
    mixed = daily_partials(readings).unionAll(daily_partials(readings, Thresholds(hot_reading_min=30.0)))
    with pytest.raises(Exception, match="other thresholds"):
        daily_from_partials(mixed).collect()
    assert daily_from_partials(daily_partials(readings)).first().totTempOver22 == 1


def test_hourly_partials_include_late_readings(spark):
    """A node two hours behind: its hours are complete in the partials."""
    loads = [[("2020-01-02 05:10:00", 0.1, 1.0, 0.3, 3.0)], [("2020-01-02 03:10:00", 0.5, 5.0, 0.7, 7.0),
                                                             ("2020-01-02 05:20:00", 0.2, 2.0, 0.4, 4.0)]]
    readings = [soil_readings(soil_records(channel(spark, [(SOIL_TOPIC, soil_line(i, *r)) for i, r in enumerate(x)])))
                for x in loads]
    parts = hourly_partials(readings[0], "suolo").unionAll(hourly_partials(readings[1], "suolo"))
    cols = ["topic", "hour", "avg_water", "n_water", "pair_water", "pair_temp", "n_pair"]
    got = [[round(v, 9) if isinstance(v, float) else v for v in r] for r in rows(
        hourly_from_partials(parts, "suolo").select(cols), cols)]
    want = [[round(v, 9) if isinstance(v, float) else v for v in r] for r in rows(
        hourly_soil(readings[0].unionAll(readings[1])).select(cols), cols)]
    assert got == want and len(got) == 2


def test_work_dir_needs_a_shared_folder_off_local():
    context = SimpleNamespace(master="spark://host:7077", getConf=lambda: SimpleNamespace(get=lambda *a: None),
                              getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(session)


def test_one_failed_query_ends_all(spark):
    src = fresh_path(spark, "t-fail-src")
    weather_channel(spark, [("2020-01-02 03:10:00", 1.0)]).write.parquet(src)
    good = start_raw_archive(channel_files(spark, src, streaming=True), fresh_path(spark, "t-good"),
                             fresh_path(spark, "t-good-ckpt"), StreamSettings(trigger_seconds=1))

    def broken(batch, batch_id):
        raise ValueError("broken job")

    bad = (channel_files(spark, src, streaming=True).writeStream.foreachBatch(broken)
           .option("checkpointLocation", fresh_path(spark, "t-bad-ckpt")).queryName("soil_hourly").start())
    with pytest.raises(RuntimeError, match="soil_hourly"):
        await_all([good, bad], 120)
    assert not good.isActive


def test_a_running_trigger_ends_by_time_out(spark):
    src = fresh_path(spark, "t-trigger-src")
    weather_channel(spark, [("2020-01-02 03:10:00", 1.0)]).write.parquet(src)
    q = start_raw_archive(channel_files(spark, src, streaming=True), fresh_path(spark, "t-trigger"),
                          fresh_path(spark, "t-trigger-ckpt"), StreamSettings(trigger_seconds=1))
    with pytest.raises(TimeoutError):
        await_all([q], 8)
    assert not q.isActive


def test_hourly_jobs_subscribe_to_their_own_topics():
    topics = [WEATHER_TOPIC, SOIL_TOPIC, "meteo_suolo", "other"]
    assert kind_topics(topics, "meteo") == [WEATHER_TOPIC, "meteo_suolo"]
    assert kind_topics(topics, "suolo") == [SOIL_TOPIC] and kind_topics(None, "suolo") is None
