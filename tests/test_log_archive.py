"""The archive on log tables, what is kept up from it, and hours with a watermark per topic."""

import pytest
from conftest import SF_SMALL, SOIL_TOPIC, channel, rows, soil_line, weather_channel
from pyspark.sql import functions as F

from agrosense.operators.aggregates import daily_weather, hourly_soil, hourly_weather
from agrosense.operators.parse import rejected_lines, soil_records, weather_records
from agrosense.operators.readings import soil_readings, weather_readings
from agrosense.params import StreamSettings
from agrosense.plans import daily, hourly
from agrosense.schemas import CHANNEL_SCHEMA
from agrosense.session import fresh_path
from agrosense.sinks import log
from agrosense.sources.events_adapter import channel_records
from agrosense.sources.files import channel_files
from agrosense.sources.tables import table
from agrosense.streaming.archive import (
    archive_files,
    compact_archive,
    kept_daily,
    refresh_daily,
    start_archive,
    stored_archive,
)
from agrosense.streaming.jobs import RAW_TABLES
from agrosense.streaming.per_topic import (
    closed_hours,
    late_readings,
    reading_counts,
    start_per_topic_hours,
)

NOW = StreamSettings(available_now=True)


def run(q):
    q.awaitTermination()
    assert q.exception() is None, q.exception()


class Crash:
    """Fails once, after the named table's commit of the ``n``-th batch."""

    def __init__(self, table_name, n):
        self.table, self.left, self.failed = table_name, n, False

    def __call__(self, name):
        if name == self.table and not self.failed:
            self.left -= 1
            if not self.left:
                self.failed = True
                raise RuntimeError("crash")


def load(spark, src, df):
    df.select(*CHANNEL_SCHEMA.fieldNames()).coalesce(1).write.mode("append").parquet(src)


def in_loads(spark, loads, start):
    """Each load is one micro-batch; a load whose batch fails is tried again."""
    base = fresh_path(spark, "t-loads")
    for df in loads:
        load(spark, f"{base}/in", df)
        for _ in range(2):
            q = start(channel_files(spark, f"{base}/in", streaming=True), f"{base}/out", f"{base}/checkpoint")
            try:
                q.awaitTermination()
                break
            except Exception as e:      # noqa: BLE001 - only the planted crash is expected
                assert "crash" in str(e)
    return f"{base}/out"


@pytest.fixture(scope="module")
def events(spark):
    return table(spark, SF_SMALL, "events").cache()


@pytest.fixture(scope="module")
def archive(spark, events):
    """Three loads; the second fails after two of its seven tables are committed."""
    crash = Crash("suolo", 2)
    out = in_loads(spark, [channel_records(events.where(f"event_id % 3 = {k}")) for k in range(3)],
                   lambda ch, out, ckpt: start_archive(ch, out, ckpt, NOW, after_table=crash))
    assert crash.failed
    return out


def test_a_failed_and_repeated_batch_leaves_every_row_once(spark, events, archive):
    lines = channel_records(events)
    for kind, records in (("meteo", weather_records), ("suolo", soil_records)):
        want, got = records(lines), stored_archive(spark, f"{archive}/{kind}", kind)
        assert rows(got.select(want.columns)) == rows(want)
    assert log.read_table(spark, f"{archive}/rejected").count() == rejected_lines(lines).count() == 0
    assert {n: log.latest_version(spark, f"{archive}/{n}") for n in RAW_TABLES} == dict.fromkeys(RAW_TABLES, 2)


def test_a_two_day_scan_opens_only_its_files(spark, archive):
    path = f"{archive}/meteo"
    whole = stored_archive(spark, path, "meteo").select("data_ora").orderBy("data_ora").collect()
    since = whole[len(whole) // 2].data_ora[:10]
    until = min(r.data_ora for r in whole if r.data_ora[:10] > since)[:10]
    snap, files = archive_files(spark, path, "meteo", since=since, until=until)
    assert {f.partition["day"] for f in files} == {since} and len(files) < len(snap.files) / 3
    df = stored_archive(spark, path, "meteo", since=since, until=until)
    assert len(df.inputFiles()) == len(files)
    assert df.count() == sum(since <= r.data_ora < until for r in whole) > 0
    assert stored_archive(spark, path, "meteo", topics=["nowhere"]).count() == 0


def test_compaction_keeps_the_archive(spark, archive):
    path = f"{archive}/meteo"
    want = rows(stored_archive(spark, path, "meteo"))
    n = len(log.snapshot(spark, path).files)
    done = compact_archive(spark, archive, retention_s=3600)
    assert done["meteo"]["removed"] > done["meteo"]["added"] and len(log.snapshot(spark, path).files) < n
    assert rows(stored_archive(spark, path, "meteo")) == want
    assert compact_archive(spark, archive)["meteo"]["version"] is None


def test_daily_results_are_kept_up_from_changed_days(spark):
    out, kept = None, fresh_path(spark, "t-daily")
    base = fresh_path(spark, "t-daily-in")
    days = [[(f"2020-01-{d:02d} 0{h}:00:00", 10.0 + d + h, 50.0 + d, 0.0) for d in range(a, b) for h in range(4)]
            for a, b in ((1, 20), (20, 22), (5, 6))]
    days[2] = [("2020-01-05 09:00:00", 99.0, 10.0, 1.0), ("not a time", 1.0, 1.0, 1.0)]
    seen = []
    for k, part in enumerate(days):
        load(spark, f"{base}/in", weather_channel(spark, part))
        run(start_archive(channel_files(spark, f"{base}/in", streaming=True), f"{base}/out", f"{base}/ckpt", NOW))
        seen.append(refresh_daily(spark, f"{base}/out/meteo", kept))
        out = daily_weather(weather_readings(stored_archive(spark, f"{base}/out/meteo", "meteo")))
        for fn in (daily.top10_hot_days, daily.days_to_water, daily.last_3_days_trend):
            assert rows(fn(kept_daily(spark, kept))) == rows(fn(out))
    assert [s["days"] for s in seen] == [19, 2, 1]
    assert seen[2]["files"] == 2                                   # both loads' files of that day
    assert refresh_daily(spark, f"{base}/out/meteo", kept)["days"] == 0
    compact_archive(spark, f"{base}/out")
    assert refresh_daily(spark, f"{base}/out/meteo", kept)["days"] == 0   # the same rows
    assert rows(kept_daily(spark, kept)) == rows(out.select(kept_daily(spark, kept).columns))


def soil_rows(topic, hours, v=0.2):
    return [(topic, soil_line(f"{topic}-{h}-{m}", f"2020-03-01 {h:02d}:{m:02d}:00", v, 10 + h, v, 11 + h))
            for h in hours for m in (0, 30)]


def test_a_slow_node_loses_no_hour(spark):
    """Node 2 brings its hours three hours after node 1; a common watermark would drop them."""
    slow = SOIL_TOPIC.replace("_1_", "_2_")
    loads = [channel(spark, soil_rows(SOIL_TOPIC, range(k, k + 3)) + (soil_rows(slow, range(k - 3, k)) if k else []))
             for k in (0, 3, 6, 9)]
    out = in_loads(spark, loads, lambda ch, out, ckpt: start_per_topic_hours(ch, "suolo", out, ckpt, NOW))
    got = closed_hours(spark, out, "suolo")
    whole = hourly_soil(soil_readings(soil_records(loads[0].unionAll(loads[1]).unionAll(loads[2]).unionAll(loads[3]))))
    # node 1 has come to 11:30 and node 2 to 08:30, with a delay of an hour
    want = whole.where((F.col("topic") == SOIL_TOPIC) & (F.col("hour") <= "2020-03-01 09")
                       | (F.col("topic") == slow) & (F.col("hour") <= "2020-03-01 06"))
    assert rows(got.select(want.columns)) == rows(want)
    assert late_readings(spark, out, "suolo").count() == 0
    state = log.read_table(spark, f"{out}/state_suolo")
    assert state.where("hour is not null").count() == 4 and state.where("hour is null").count() == 2
    assert hourly.water_content_alert(got).count() == 17


@pytest.mark.parametrize("crash_at", [None, "hours", "late", "used", "state"])
def test_late_readings_are_kept_counted_and_correct_their_hour(spark, crash_at):
    lines = [weather_channel(spark, [("2020-01-01 01:10:00", 1.0), ("2020-01-01 02:10:00", 2.0), ("2020-01-01 05:00:00", 5.0)]),
             weather_channel(spark, [("2020-01-01 01:50:00", 3.0), ("2020-01-01 04:59:00", 4.0), ("bad", 9.0)]),
             weather_channel(spark, [("2020-01-01 01:55:00", 8.0), ("2020-01-01 03:00:00", 7.0), ("2020-01-01 09:00:00", 1.0)])]
    crash = Crash(crash_at, 2) if crash_at else None
    out = in_loads(spark, lines, lambda ch, out, ckpt: start_per_topic_hours(ch, "meteo", out, ckpt, NOW, after_table=crash))
    readings = weather_readings(weather_records(lines[0].unionAll(lines[1]).unionAll(lines[2])))
    want = hourly_weather(readings).where("hour < '2020-01-01 09'")
    got = closed_hours(spark, out, "meteo")
    assert rows(got.select(want.columns)) == rows(want)
    assert sorted(r.data_ora[11:16] for r in late_readings(spark, out, "meteo").collect()) == ["01:50", "01:55", "03:00"]
    counts = reading_counts(spark, out, "meteo").first()
    # 04:59 came in time: its hour ends at 05:00, and the watermark stood at 04:50
    assert (counts.n_used, counts.n_late, counts.n_no_hour) == (5, 3, 1)
    versions = {r.hour[-2:]: (r.version, r.n_late) for r in log.read_table(spark, f"{out}/hours_meteo").collect()}
    assert versions == {"01": (2, 2), "02": (0, 0), "03": (2, 1), "04": (2, 0), "05": (2, 0)}
