"""Run a streaming job over a table to completion (``availableNow``) and read its output.

Used by the registered ``*_stream`` queries and by tests: the ``events`` table is read as
a file stream, all of it is processed, and the sink's rows are returned as a batch frame.
Output and checkpoint go to a new folder below the session's checkpoint folder.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession

from agrosense.params import DEFAULT, StreamSettings, Thresholds
from agrosense.session import fresh_path
from agrosense.schemas import CHANNEL_SCHEMA
from agrosense.sinks.results import read_batches
from agrosense.sources.events_adapter import channel_records
from agrosense.sources.tables import EVENTS_SCHEMA, events_channel_stream, table
from agrosense.streaming.jobs import KINDS, readings_stream, start_hourly, start_raw_archive


def run_hourly(spark: SparkSession, sf_dir: str, kind: str,
               settings: StreamSettings = StreamSettings(), th: Thresholds = DEFAULT,
               results=None) -> str:
    """Process the whole ``events`` table through one hourly job; returns the output folder."""
    settings = replace(settings, available_now=True)
    base = fresh_path(spark, f"stream-{kind}")
    channel = events_channel_stream(spark, sf_dir, settings.max_files_per_trigger)
    _finish(start_hourly(channel, kind, f"{base}/out", f"{base}/checkpoint", settings, th,
                         results=results))
    return f"{base}/out"


def run_raw_archive(spark: SparkSession, sf_dir: str,
                    settings: StreamSettings = StreamSettings()) -> str:
    settings = replace(settings, available_now=True)
    base = fresh_path(spark, "stream-raw")
    channel = events_channel_stream(spark, sf_dir, settings.max_files_per_trigger)
    _finish(start_raw_archive(channel, f"{base}/out", f"{base}/checkpoint", settings))
    return f"{base}/out"


# The loads of ``run_in_loads``: a third of every hour each, so each hour is split over three
# micro-batches and two of them bring only readings behind the watermark.
LOADS = tuple(f"minute(ts) div 20 = {i}" for i in range(3))


def run_in_loads(spark: SparkSession, sf_dir: str, start) -> str:
    """Bring ``events`` in three loads; each is one micro-batch of the same job, which is
    restarted from its checkpoint. ``start(channel, out, checkpoint)`` starts the job."""
    base = fresh_path(spark, "stream-loads")
    events = table(spark, sf_dir, "events")
    for load in LOADS:
        events.where(load).write.mode("append").parquet(f"{base}/in")
        channel = channel_records(spark.readStream.schema(EVENTS_SCHEMA).parquet(f"{base}/in"))
        _finish(start(channel, f"{base}/out", f"{base}/checkpoint"))
    return f"{base}/out"


def _finish(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def kind_of_result(name: str) -> str:
    for kind, k in KINDS.items():
        if name in k.results:
            return kind
    raise KeyError(name)


def result_schema(spark: SparkSession, kind: str, name: str, mode: str = "event_time"):
    """Schema of one hourly result, for a job that has written no batch."""
    k = KINDS[kind]
    readings = readings_stream(spark.createDataFrame([], CHANNEL_SCHEMA), kind)
    return k.results[name](k.hourly(readings, by="window" if mode == "event_time" else "text")).schema


def stream_result(spark: SparkSession, sf_dir: str, name: str,
                  settings: StreamSettings = StreamSettings(),
                  th: Thresholds = DEFAULT) -> DataFrame:
    """One hourly result computed by the streaming job over the whole ``events`` table."""
    kind = kind_of_result(name)
    out = run_hourly(spark, sf_dir, kind, settings, th, results=[name])
    return read_batches(spark, out, name, schema=result_schema(spark, kind, name, settings.mode))


def per_batch_result(spark: SparkSession, sf_dir: str, name: str,
                     th: Thresholds = DEFAULT) -> DataFrame:
    """One hourly result with each of three loads aggregated on its own micro-batch."""
    kind = kind_of_result(name)
    settings = StreamSettings(mode="per_batch", available_now=True)
    out = run_in_loads(spark, sf_dir, lambda channel, out, checkpoint: start_hourly(
        channel, kind, out, checkpoint, settings, th, results=[name]))
    return read_batches(spark, out, name, schema=result_schema(spark, kind, name, "per_batch"))


def archive_in_loads(spark: SparkSession, sf_dir: str) -> str:
    """The raw archive and its partials, written by three micro-batches."""
    return run_in_loads(spark, sf_dir, lambda channel, out, checkpoint: start_raw_archive(
        channel, out, checkpoint, StreamSettings(available_now=True)))


def stream_raw(spark: SparkSession, sf_dir: str, name: str,
               settings: StreamSettings = StreamSettings()) -> DataFrame:
    """One raw archive table written by the streaming ingest over the whole ``events`` table."""
    out = run_raw_archive(spark, sf_dir, settings)
    k = KINDS[name]
    schema = k.records(spark.createDataFrame([], CHANNEL_SCHEMA)).schema
    return read_batches(spark, out, name, schema=schema).drop("day")


def run_loads(spark: SparkSession, loads, start) -> str:
    """Bring frames of channel records one by one; each is one micro-batch of the same job. A
    job that fails is started again from its checkpoint, once."""
    base = fresh_path(spark, "stream-loads")
    for records in loads:
        records.select("topic", "value").write.mode("append").parquet(f"{base}/in")
        channel = spark.readStream.schema(CHANNEL_SCHEMA).parquet(f"{base}/in")
        try:
            _finish(start(channel, f"{base}/out", f"{base}/checkpoint"))
        except StreamingQueryException:
            channel = spark.readStream.schema(CHANNEL_SCHEMA).parquet(f"{base}/in")
            _finish(start(channel, f"{base}/out", f"{base}/checkpoint"))
    return f"{base}/out"
