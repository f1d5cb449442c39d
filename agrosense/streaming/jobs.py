"""Structured Streaming jobs: raw archive and hourly analyses.

Three queries replace the reference's 39 per-topic output operations:

* raw archive — one read of the channel per micro-batch; weather records, soil records,
  rejected lines and the batch's daily partials written from the persisted batch;
* weather hourly — one stateful aggregate (per topic and event-time hour, watermarked)
  feeding ``temperature_alert``, ``dont_irrigate`` and the ``hourly_meteo`` table;
* soil hourly — one stateful aggregate feeding ``water_content_alert``,
  ``water_temperature_ratio``, ``combined_sickness_alert`` and the ``hourly_suolo`` table.

Weather and soil have separate watermarks: a topic ahead in event time would otherwise
make slower topics late. ``mode='event_time'`` (default) emits one final row per closed
hour. ``mode='per_batch'`` reproduces the reference: each micro-batch is aggregated on its
own, so an hour split over two batches yields two partial rows.

Every sink is written with ``foreachBatch`` to ``<out>/<name>/query=<id>/batch_id=<id>``
with overwrite: a batch replayed after a failure replaces its own output, and the checkpoint
(offsets + state) lets a restarted job resume where it stopped.

Rows behind the watermark cannot change an hour that was already emitted; ``supervise.Supervisor``
counts them. ``per_topic.start_per_topic_hours`` drops none: each topic has its own watermark, and
late readings are kept and correct their hour.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from agrosense.functions.columns import valid_day
from agrosense.operators.aggregates import (
    daily_partials,
    hourly_partials,
    hourly_soil,
    hourly_weather,
)
from agrosense.operators.parse import rejected_lines, soil_records, weather_records
from agrosense.operators.readings import (
    SOIL_NUMBERS,
    WEATHER_NUMBERS,
    rejected_readings,
    soil_readings,
    weather_readings,
)
from agrosense.params import DEFAULT, StreamSettings, Thresholds
from agrosense.plans import hourly
from agrosense.schemas import SOIL_MARK, WEATHER_MARK
from agrosense.sinks.results import batch_writer


def closed_hours(hours: DataFrame, th: Thresholds = DEFAULT) -> DataFrame:
    """The closed hours' aggregates themselves, every hour, whatever the thresholds: the
    ``plans.hourly`` functions run unchanged on this table, so an alert can be re-tuned over
    history from one row per topic and hour."""
    return hours.select("*")


WEATHER_RESULTS: dict[str, Callable] = {
    "temperature_alert": hourly.temperature_alert,
    "dont_irrigate": hourly.dont_irrigate,
    "hourly_meteo": closed_hours,
}
SOIL_RESULTS: dict[str, Callable] = {
    "water_content_alert": hourly.water_content_alert,
    "water_temperature_ratio": hourly.water_temperature_ratio,
    "combined_sickness_alert": hourly.combined_sickness_alert,
    "hourly_suolo": closed_hours,
}
RAW_TABLES = ("meteo", "suolo", "rejected", "rejected_readings", "daily_partials",
              "hourly_partials_meteo", "hourly_partials_suolo")


@dataclass(frozen=True)
class _Kind:
    records: Callable
    readings: Callable
    hourly: Callable
    results: dict
    delay: Callable[[StreamSettings], str]


KINDS = {
    "meteo": _Kind(weather_records, weather_readings, hourly_weather, WEATHER_RESULTS,
                   lambda s: s.weather_delay),
    "suolo": _Kind(soil_records, soil_readings, hourly_soil, SOIL_RESULTS,
                   lambda s: s.soil_delay),
}


def readings_stream(channel: DataFrame, kind: str,
                    topics: Sequence[str] | None = None) -> DataFrame:
    """Typed readings of one sensor kind from a channel stream (or batch)."""
    k = KINDS[kind]
    return k.readings(k.records(channel, topics))


def hourly_stream(channel: DataFrame, kind: str, settings: StreamSettings = StreamSettings(),
                  topics: Sequence[str] | None = None) -> DataFrame:
    """Watermarked per-topic event-time hourly aggregate of one sensor kind."""
    k = KINDS[kind]
    readings = readings_stream(channel, kind, topics).withWatermark("event_time", k.delay(settings))
    if settings.dedupe:
        # An at-least-once source may deliver a reading twice; its state lives only as long
        # as the watermark delay, so it stays bounded by rate x delay.
        readings = readings.dropDuplicatesWithinWatermark(["topic", "_id"])
    return k.hourly(readings, by="window", window=settings.window)


SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
STATE_STORES = {
    "rocksdb": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "hdfs": "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
}


def _start(writer, settings: StreamSettings, checkpoint: str, name: str,
           spark=None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint).queryName(name)
    if settings.available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{settings.trigger_seconds} seconds")
    overrides = {}
    if settings.state_partitions:
        overrides[SHUFFLE_PARTITIONS] = str(settings.state_partitions)
    if settings.state_store:
        overrides[STATE_STORE] = STATE_STORES[settings.state_store]
    if spark is None or not overrides:
        return writer.start()
    # A streaming query copies the session's settings when it starts and keeps the state
    # partition count and store in its checkpoint; the session is restored right after.
    previous = {key: spark.conf.get(key, None) for key in overrides}
    for key, value in overrides.items():
        spark.conf.set(key, value)
    try:
        return writer.start()
    finally:
        for key, value in previous.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def start_hourly(channel: DataFrame, kind: str, out_dir: str, checkpoint: str,
                 settings: StreamSettings = StreamSettings(), th: Thresholds = DEFAULT,
                 topics: Sequence[str] | None = None,
                 results: Sequence[str] | None = None) -> StreamingQuery:
    """Start the hourly analyses of one sensor kind; results land in ``<out_dir>/<name>``."""
    k = KINDS[kind]
    fns = {name: partial(fn, th=th) for name, fn in k.results.items()
           if results is None or name in results}
    if settings.mode == "event_time":
        agg = hourly_stream(channel, kind, settings, topics)
        writer = agg.writeStream.outputMode("append").foreachBatch(
            batch_writer(fns, out_dir, persist=len(fns) > 1))
    else:
        write = batch_writer(fns, out_dir, persist=len(fns) > 1)

        def per_batch(batch: DataFrame, batch_id: int) -> None:
            write(k.hourly(batch, by="text"), batch_id)

        writer = readings_stream(channel, kind, topics).writeStream.foreachBatch(per_batch)
    return _start(writer, settings, checkpoint, f"{kind}_hourly", channel.sparkSession)


def _archived(records: DataFrame, time: str) -> DataFrame:
    return records.withColumn("day", valid_day(time))


def _raw_tables(topics, th: Thresholds):
    def weather(b):
        return weather_readings(weather_records(b, topics))

    def soil(b):
        return soil_readings(soil_records(b, topics))

    def bad_readings(b):
        # the raw text of a field is in the archive; here is which reading failed, and why
        return (rejected_readings(weather(b), WEATHER_NUMBERS).select("topic", "_id", "reason")
                .unionAll(rejected_readings(soil(b), SOIL_NUMBERS).select("topic", "_id", "reason")))

    return {
        "meteo": lambda b: _archived(weather_records(b, topics), "data_ora"),
        "suolo": lambda b: _archived(soil_records(b, topics), "timestamp"),
        "rejected": lambda b: rejected_lines(b, topics),
        "rejected_readings": bad_readings,
        "daily_partials": lambda b: daily_partials(weather(b), th),
        "hourly_partials_meteo": lambda b: hourly_partials(weather(b), "meteo"),
        "hourly_partials_suolo": lambda b: hourly_partials(soil(b), "suolo"),
    }


def start_raw_archive(channel: DataFrame, out_dir: str, checkpoint: str,
                      settings: StreamSettings = StreamSettings(),
                      topics: Sequence[str] | None = None,
                      th: Thresholds = DEFAULT) -> StreamingQuery:
    """Archive every reading as text records: ``<out>/meteo``, ``<out>/suolo``, ``<out>/rejected``.

    One read of the channel per micro-batch serves all tables. Alongside, the batch's
    additive daily partials go to ``<out>/daily_partials``: the daily results can then be
    computed from a table of (topic, day) pieces instead of a scan of the whole archive
    (``sources.tables.stored_daily``).
    """
    by_topic = {"meteo": ["topic", "day"], "suolo": ["topic", "day"]}
    writer = channel.select("topic", "value").writeStream.foreachBatch(
        batch_writer(_raw_tables(topics, th), out_dir, partition_by=by_topic))
    return _start(writer, settings, checkpoint, "raw_archive")


def await_all(queries: Sequence[StreamingQuery], timeout_s: float | None = None,
              poll_s: float = 0.5, supervisor=None) -> dict | None:
    """Block until every query ended. The first failure stops the others and is raised; so is
    a time-out, if one is given. With a ``Supervisor`` returns what it counted, by query name."""
    deadline = None if timeout_s is None else time.monotonic() + timeout_s
    while True:
        failed = next((q for q in queries if q.exception() is not None), None)
        late = deadline is not None and time.monotonic() > deadline
        active = [q for q in queries if q.isActive]
        if failed is not None or (late and active):
            for q in active:
                q.stop()
            if failed is not None:
                raise RuntimeError(f"{failed.name}: {failed.exception()}")
            raise TimeoutError(f"{', '.join(q.name for q in active)} still ran after {timeout_s} s")
        if not active:
            return None if supervisor is None else {q.name: supervisor.of(q) for q in queries}
        active[0].awaitTermination(poll_s)


def kind_topics(topics: Sequence[str] | None, kind: str) -> list[str] | None:
    """Those of the subscribed topics that one kind's job needs."""
    mark = {"meteo": WEATHER_MARK, "suolo": SOIL_MARK}[kind]
    return None if topics is None else [
        t for t in topics if mark in t and (kind == "meteo" or WEATHER_MARK not in t)]


def start_all(channel, out_dir: str, checkpoint_root: str,
              settings: StreamSettings = StreamSettings(), th: Thresholds = DEFAULT,
              topics: Sequence[str] | None = None) -> list[StreamingQuery]:
    """Raw archive plus both hourly jobs (the reference's whole streaming side).

    ``channel`` is a channel stream, or a function from a list of topics (None: all) to one;
    with a function each hourly job subscribes to its own topics only."""
    of = channel if callable(channel) else lambda _: channel
    weather, soil = kind_topics(topics, "meteo"), kind_topics(topics, "suolo")
    started = [start_raw_archive(of(topics), f"{out_dir}/raw", f"{checkpoint_root}/raw", settings,
                                 topics, th)]
    for kind, own in (("meteo", weather), ("suolo", soil)):
        if own is None or own:
            started.append(start_hourly(of(own), kind, out_dir, f"{checkpoint_root}/{kind}",
                                        settings, th, own))
    return started
