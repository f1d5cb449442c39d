"""Registered queries: name -> ``f(spark, sf_dir) -> DataFrame`` over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrosense.operators.aggregates import (
    daily_weather,
    hourly_from_partials,
    hourly_soil,
    hourly_weather,
)
from agrosense.operators.parse import (
    kind_of,
    rejected_lines,
    route,
    soil_records,
    weather_records,
)
from agrosense.operators.readings import soil_readings, weather_readings
from agrosense.params import DEFAULT, StreamSettings
from agrosense.plans import daily, hourly
from agrosense.plans.pipeline import (
    soil_from_events,
    stored_soil,
    stored_weather,
    weather_from_events,
)
from agrosense.plans.suite import SUITE, run_batch_suite, run_suite_once
from agrosense.schemas import SEPARATOR, TIME_FORMAT
from agrosense.session import fresh_path
from agrosense.sinks.log import latest_version, read_table, snapshot
from agrosense.sinks.results import read_batches, read_replaced
from agrosense.sources.events_adapter import (
    channel_records,
    stored_soil_records,
    stored_weather_records,
)
from agrosense.sources.files import csv_import, csv_replay
from agrosense.sources.tables import (
    events_channel,
    events_channel_stream,
    stored_daily,
    stored_readings,
    table,
)
from agrosense.streaming.archive import (
    compact_archive,
    kept_daily,
    refresh_daily,
    start_archive,
    stored_archive,
)
from agrosense.streaming.jobs import await_all, start_all
from agrosense.streaming.per_topic import (
    closed_hours,
    late_readings,
    reading_counts,
    start_per_topic_hours,
)
from agrosense.streaming.replay import (
    LOADS,
    archive_in_loads,
    kind_of_result,
    per_batch_result,
    result_schema,
    run_loads,
    run_raw_archive,
    stream_raw,
    stream_result,
)

Query = Callable[[SparkSession, str], DataFrame]


def _weather_daily(fn) -> Query:
    return lambda spark, sf_dir: fn(stored_weather(spark, sf_dir), DEFAULT)


def _weather_hourly(fn, th=DEFAULT) -> Query:
    return lambda spark, sf_dir: fn(hourly_weather(stored_weather(spark, sf_dir)), th)


def _soil_hourly(fn) -> Query:
    return lambda spark, sf_dir: fn(hourly_soil(stored_soil(spark, sf_dir)), DEFAULT)


def route_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per channel after routing, with the channel's kind."""
    routed = route(events_channel(spark, sf_dir))
    return routed.groupBy("topic", "kind").agg(F.count(F.lit(1)).alias("n_records"))


def raw_ingest_meteo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored weather records: topic and the twenty fields, as text."""
    return weather_records(events_channel(spark, sf_dir))


def raw_ingest_soil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored soil records: topic and the six named fields, as text."""
    return soil_records(events_channel(spark, sf_dir))


def parse_lines_meteo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed weather readings after the line round trip."""
    return weather_from_events(spark, sf_dir).select(
        "topic", "_id", "data_ora", "temp1_media", "ur1_media", "pioggia_mm")


def parse_lines_soil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed soil readings after the line round trip."""
    return soil_from_events(spark, sf_dir).select(
        "topic", "_id", "timestamp", "water_0", "temperature_0", "water_1", "temperature_1")


def reading_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of stored weather readings."""
    return daily.reading_count(stored_weather(spark, sf_dir))


def csv_replay_meteo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored weather records written as a ``;`` sensor CSV with a header, replayed as lines
    on channel ``iotData_meteo_2024`` and parsed back into typed readings."""
    folder = fresh_path(spark, "csv-replay-meteo")
    records = stored_weather_records(table(spark, sf_dir, "events")).drop("topic")
    (records.write.option("sep", SEPARATOR).option("header", True).option("emptyValue", "")
     .csv(folder))
    channel = csv_replay(spark, folder, "meteo_2024")
    return weather_readings(weather_records(channel)).select(
        "topic", "_id", "data_ora", "temp1_media", "ur1_media", "pioggia_mm")


def csv_import_soil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored soil records as a comma CSV with a header, imported with inferred types over a
    table; reported per topic (rows, id range, first and last reading, mean water)."""
    folder = fresh_path(spark, "csv-import-soil")
    stored_soil_records(table(spark, sf_dir, "events")).write.option("header", True).csv(folder)
    imported = csv_import(spark, folder, fresh_path(spark, "csv-import-table"))
    return imported.groupBy("topic").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("_id").cast("bigint").alias("min_id"),     # the inferred type depends on the ids
        F.max("_id").cast("bigint").alias("max_id"),
        F.date_format(F.min("timestamp"), TIME_FORMAT).alias("first_reading"),
        F.date_format(F.max("timestamp"), TIME_FORMAT).alias("last_reading"),
        F.round(F.avg((F.col("water_0") + F.col("water_1")) / 2), 9).alias("avg_water"),
    )


RAIN_GT_0 = replace(DEFAULT, rain_min=0.0)
NOW = StreamSettings(available_now=True)


def _stream(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return stream_result(spark, sf_dir, name)
    run.__doc__ = f"``{name}`` computed by the event-time streaming job (closed hours only)."
    return run


def _per_batch(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return per_batch_result(spark, sf_dir, name)
    run.__doc__ = (f"``{name}`` from the streaming job in the reference's per-micro-batch mode: "
                   "three loads, each with a third of every hour, aggregated on their own.")
    return run


def raw_ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather records written by the streaming raw archive."""
    return stream_raw(spark, sf_dir, "meteo")


def archive_top10_hot_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten hottest days computed from the archive that the streaming ingest stored."""
    out = run_raw_archive(spark, sf_dir)
    stored = stored_readings(spark, f"{out}/meteo", "meteo", topics=["iotData_meteo_2024"])
    return daily.top10_hot_days(daily_weather(weather_readings(stored)), DEFAULT)


def archive_water_content_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly soil-water alert computed from the archive that the streaming ingest stored."""
    out = run_raw_archive(spark, sf_dir)
    stored = stored_readings(spark, f"{out}/suolo", "suolo")
    return hourly.water_content_alert(hourly_soil(soil_readings(stored)), DEFAULT)


def hourly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete soil hours from the hourly partials of three loads; two of them bring only
    readings that an event-time stream would have dropped as late."""
    out = archive_in_loads(spark, sf_dir)
    hours = hourly_from_partials(spark.read.parquet(f"{out}/hourly_partials_suolo"), "suolo")
    means = [F.round(c, 9).alias(c) for c in ("avg_water", "pair_water", "pair_temp")]
    return hours.select("topic", "hour", *means, "n_water", "n_pair")


SUBSCRIBED = ("iotData_meteo_2024", "iotData_suolo_3_2024")


def route_subscribed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per channel of an exact subscription to two topics."""
    routed = route(events_channel(spark, sf_dir), SUBSCRIBED)
    return routed.groupBy("topic", "kind").agg(F.count(F.lit(1)).alias("n_records"))


def suite_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch suite run twice into one folder: rows of each written result. Appended results
    hold both runs, replaced ones the last."""
    out = fresh_path(spark, "suite")
    for _ in range(2):
        paths = run_batch_suite(stored_weather(spark, sf_dir), out)
    counts = [(spark.read.parquet(paths[n]) if mode == "append" else read_replaced(spark, paths[n]))
              .agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("result"), "n_rows")
              for n, _, mode in SUITE]
    return reduce(DataFrame.unionAll, counts)


def start_all_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole streaming side started at once over ``events``: rows of each output."""
    base = fresh_path(spark, "start-all")
    channel = events_channel_stream(spark, sf_dir)
    await_all(start_all(channel, f"{base}/out", f"{base}/checkpoint", StreamSettings(available_now=True)))
    outputs = {**{n: (f"{base}/out/raw", "event_id bigint") for n in ("meteo", "suolo", "rejected")},
               **{n: (f"{base}/out", result_schema(spark, kind_of_result(n), n)) for n in HOURLY_RESULTS}}
    counts = [read_batches(spark, path, n, schema=schema).agg(F.count(F.lit(1)).alias("n_rows"))
              .select(F.lit(n).alias("output"), "n_rows") for n, (path, schema) in outputs.items()]
    return reduce(DataFrame.unionAll, counts)


def damaged_lines(events: DataFrame) -> DataFrame:
    """The channel records of ``events`` with every tenth line damaged, by event id."""
    kinds = {6: F.lit(None).cast("string"),                                  # no value
             7: F.substring_index("value", SEPARATOR, 5),                    # five fields
             8: F.concat(F.lit('1;"'), F.col("value")),                      # a quote left open
             9: F.concat(F.lit('"in ""quotes"";";'), F.col("value"))}        # one field more
    parts = [channel_records(events.where("event_id % 10 < 5")),
             channel_records(events.where("event_id % 10 = 5")).withColumn(
                 "topic", F.lit("iotData_altro"))]
    for k, value in kinds.items():
        parts.append(channel_records(events.where(f"event_id % 10 = {k}")).withColumn("value", value))
    return reduce(DataFrame.unionAll, parts)


def rejects_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged lines by what became of them: records of either kind, or rejects by reason.
    The counts add up to all lines."""
    lines = damaged_lines(table(spark, sf_dir, "events"))
    outcomes = (weather_records(lines).select(F.lit("meteo").alias("outcome"))
                .unionAll(soil_records(lines).select(F.lit("suolo")))
                .unionAll(rejected_lines(lines).select("reason")))
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_lines"))


HOURLY_RESULTS = ("temperature_alert", "dont_irrigate", "water_content_alert",
                  "water_temperature_ratio", "combined_sickness_alert")


def route_topics_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per channel, counted over what the streaming raw archive stored."""
    out = run_raw_archive(spark, sf_dir)
    stored = (read_batches(spark, out, "meteo", schema="topic string").select("topic")
              .unionByName(read_batches(spark, out, "suolo", schema="topic string").select("topic")))
    return (stored.groupBy("topic")
            .agg(F.count(F.lit(1)).alias("n_records"))
            .withColumn("kind", kind_of("topic")))


def daily_means_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``daily_means`` from the daily partials the streaming ingest writes per micro-batch."""
    out = run_raw_archive(spark, sf_dir)
    return daily.daily_means(stored_daily(spark, f"{out}/daily_partials"))


# ---- tables on a commit log ------------------------------------------------------------------

def event_loads(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The channel records of ``events`` in three loads with a third of every hour each."""
    events = table(spark, sf_dir, "events")
    return [channel_records(events.where(load)) for load in LOADS]


def fail_once(at: str, batch: int):
    """Hook that fails when table ``at`` has been committed for the ``batch``-th time."""
    left = [batch]

    def after_table(name: str) -> None:
        if name == at:
            left[0] -= 1
            if left[0] == 0:
                raise RuntimeError(f"stopped after the commit of {at}")
    return after_table


def log_archive(spark: SparkSession, sf_dir: str) -> str:
    """The archive on the log after three loads; the second batch dies between two tables and is
    repeated."""
    hook = fail_once("meteo", 2)
    return run_loads(spark, event_loads(spark, sf_dir), lambda channel, out, checkpoint: start_archive(
        channel, out, checkpoint, NOW, after_table=hook))


def archive_log_meteo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored weather records of the log archive, compacted after a failed and repeated batch."""
    out = log_archive(spark, sf_dir)
    compact_archive(spark, out)
    return stored_archive(spark, f"{out}/meteo", "meteo")


def archive_log_two_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather readings of the two days before the newest, whose files the log names."""
    path = f"{log_archive(spark, sf_dir)}/meteo"
    last = max((f.greatest["data_ora"] for f in snapshot(spark, path).files if f.greatest.get("data_ora")),
               default="1970-01-03")[:10]
    since = (date.fromisoformat(last) - timedelta(days=2)).isoformat()
    return weather_readings(stored_archive(spark, path, "meteo", since=since, until=last)).select(
        "topic", "_id", "data_ora", "temp1_media")


def daily_means_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily means from a table that is brought up to date after each of three loads of days."""
    kept, events = fresh_path(spark, "daily-kept"), table(spark, sf_dir, "events")
    loads = [channel_records(events.where(f"day(ts) % 3 = {k}")) for k in range(3)]

    def start(channel, out, checkpoint):
        if latest_version(spark, f"{out}/meteo") >= 0:
            refresh_daily(spark, f"{out}/meteo", kept)
        return start_archive(channel, out, checkpoint, NOW)
    out = run_loads(spark, loads, start)
    refresh_daily(spark, f"{out}/meteo", kept)
    return daily.daily_means(kept_daily(spark, kept))


def _rounded_hours(hours: DataFrame, means, counts) -> DataFrame:
    return hours.select("topic", "hour", *[F.round(c, 9).alias(c) for c in means], *counts)


def hourly_rollup_meteo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed weather hours of three loads with a third of every hour each: the first closes
    almost all, the readings of the others are late and correct them."""
    out = run_loads(spark, event_loads(spark, sf_dir), lambda channel, out, checkpoint: start_per_topic_hours(
        channel, "meteo", out, checkpoint, NOW))
    return _rounded_hours(closed_hours(spark, out, "meteo"), ("avg_temp", "avg_rain"), ("n_temp", "n_rain"))


SLOW_NODE, SLOW_BY_HOURS = 3, 3


def slow_node_loads(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Soil readings in four loads by arrival; those of one node arrive three hours late."""
    events = table(spark, sf_dir, "events").where(
        "event_type IS NULL OR event_type NOT IN ('view', 'click')").withColumn("arrival", F.expr(
            f"ts + make_dt_interval(0, CASE WHEN 1 + user_id % 9 = {SLOW_NODE} THEN {SLOW_BY_HOURS} ELSE 0 END)"))
    first, last = events.agg(F.min("arrival"), F.max("arrival")).first()
    if first is None:
        return [channel_records(events.drop("arrival"))]
    cuts = [first + (last - first) * k / 4 for k in range(1, 4)]
    part = sum((F.col("arrival") >= F.lit(c)).cast("int") for c in cuts)
    return [channel_records(events.where(part == k).drop("arrival")) for k in range(4)]


def per_topic_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed soil hours while one node is three hours behind the others: none is lost."""
    out = run_loads(spark, slow_node_loads(spark, sf_dir), lambda channel, out, checkpoint: start_per_topic_hours(
        channel, "suolo", out, checkpoint, NOW))
    return _rounded_hours(closed_hours(spark, out, "suolo"), ("avg_water", "pair_temp"), ("n_water", "n_pair"))


def late_reading_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Soil readings used in time and late, per topic, in three loads; they add up to all."""
    out = run_loads(spark, event_loads(spark, sf_dir), lambda channel, out, checkpoint: start_per_topic_hours(
        channel, "suolo", out, checkpoint, NOW, after_table=fail_once("hours", 2)))
    kept = late_readings(spark, out, "suolo").groupBy("topic").agg(F.count(F.lit(1)).alias("n_kept"))
    return reading_counts(spark, out, "suolo").join(kept, "topic", "left").select(
        "topic", "n_used", "n_late", F.coalesce("n_kept", F.lit(0).cast("long")).alias("n_kept"))


def suite_once_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values of the five daily results after a run that failed at the third of them and was
    repeated under the same run id, and a second run."""
    out, hook = fresh_path(spark, "suite-once"), fail_once("top10_humid_days", 1)
    for run_id in ("run-1", "run-1", "run-2"):
        try:
            paths = run_suite_once(stored_weather(spark, sf_dir), out, run_id, after_result=hook)
        except RuntimeError:
            continue
    values = {"last_3_days_trend": ("day_minus_1", "avg_temp1"), "days_to_water": ("day", "totTempOver22"),
              "top10_humid_days": ("day", "avg_humidity"), "top10_hot_days": ("day", "avg_temp"),
              "top10_cold_days": ("day", "avg_temp")}
    parts = [read_table(spark, paths[n]).select(F.lit(n).alias("result"), F.col(day).alias("day"),
                                                F.col(v).cast("double").alias("value"),
                                                (F.col("run_id") if mode == "append" else F.lit("run-2")).alias("run_id"))
             for n, _, mode in SUITE for day, v in [values[n]]]
    return reduce(DataFrame.unionAll, parts)


BATCH_QUERIES: dict[str, Query] = {
    "top10_hot_days": _weather_daily(daily.top10_hot_days),
    "top10_cold_days": _weather_daily(daily.top10_cold_days),
    "top10_humid_days": _weather_daily(daily.top10_humid_days),
    "days_to_water": _weather_daily(daily.days_to_water),
    "last_3_days_trend": _weather_daily(daily.last_3_days_trend),
    "daily_means": _weather_daily(daily.daily_means),
    "reading_count": reading_count,
    "temperature_alert": _weather_hourly(hourly.temperature_alert),
    "dont_irrigate": _weather_hourly(hourly.dont_irrigate),
    "dont_irrigate_rain_gt_0": _weather_hourly(hourly.dont_irrigate, RAIN_GT_0),
    "water_content_alert": _soil_hourly(hourly.water_content_alert),
    "water_temperature_ratio": _soil_hourly(hourly.water_temperature_ratio),
    "combined_sickness_alert": _soil_hourly(hourly.combined_sickness_alert),
    "route_topics": route_topics,
    "raw_ingest_meteo": raw_ingest_meteo,
    "raw_ingest_soil": raw_ingest_soil,
    "parse_lines_meteo": parse_lines_meteo,
    "parse_lines_soil": parse_lines_soil,
    "csv_replay": csv_replay_meteo,
    "csv_import": csv_import_soil,
    "route_subscribed": route_subscribed,
    "suite_results": suite_results,
    "rejects_by_reason": rejects_by_reason,
}

STREAM_QUERIES: dict[str, Query] = {
    **{f"{name}_stream": _stream(name) for name in HOURLY_RESULTS},
    "raw_ingest_stream": raw_ingest_stream,
    "route_topics_stream": route_topics_stream,
    "daily_means_rollup": daily_means_rollup,
    "archive_top10_hot_days": archive_top10_hot_days,
    "archive_water_content_alert": archive_water_content_alert,
    "hourly_rollup": hourly_rollup,
    "start_all_counts": start_all_counts,
    "archive_log_meteo": archive_log_meteo,
    "archive_log_two_days": archive_log_two_days,
    "daily_means_incremental": daily_means_incremental,
    "hourly_rollup_meteo": hourly_rollup_meteo,
    "per_topic_hours": per_topic_hours,
    "late_reading_counts": late_reading_counts,
    "suite_once_values": suite_once_values,
    **{f"{name}_per_batch": _per_batch(name) for name in HOURLY_RESULTS},
}

ALL_QUERIES: dict[str, Query] = {**BATCH_QUERIES, **STREAM_QUERIES}
