"""Readers for the given parquet tables and for the stored (bronze) reading tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrosense.params import DEFAULT, Thresholds
from agrosense.schemas import SOIL_MARK, WEATHER_MARK
from agrosense.sinks.log import latest_version, read_table
from agrosense.sources.events_adapter import channel_records

EVENTS_SCHEMA = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
                 "value DOUBLE, props STRING")


KNOWN_SCHEMAS = {"events": EVENTS_SCHEMA}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the generated tables, e.g. ``table(spark, '/root/testdata/sf0.01', 'events')``.

    A known schema is passed to the reader, so no file footer is read to infer it.
    """
    reader = spark.read
    if name in KNOWN_SCHEMAS:
        reader = reader.schema(KNOWN_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel records ``(topic, value)`` derived from the ``events`` table."""
    return channel_records(table(spark, sf_dir, "events"))


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder, asked of the file system it belongs to."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def events_channel_stream(spark: SparkSession, sf_dir: str,
                          max_files_per_trigger: int | None = None) -> DataFrame:
    """The ``events`` table as a file stream, mapped to channel records.

    A table that is a folder of part files is streamed as that folder. A file source needs a
    folder, so a table that is one file is picked from its parent by name.
    """
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    if is_folder(spark, path):
        return channel_records(reader.parquet(path))
    return channel_records(reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir.rstrip("/")))


TIME_FIELD = {"meteo": "data_ora", "suolo": "timestamp"}


def stored_readings(spark: SparkSession, path: str, kind: str | None = None,
                    topics: list[str] | None = None, since: str | None = None,
                    until: str | None = None) -> DataFrame:
    """Scan the raw archive written by ``streaming.jobs.start_raw_archive``.

    Filters on ``topic`` prune ``topic=`` folders at planning time; ``kind`` selects weather
    or soil topics by their name mark, as the reference's per-topic collections do.
    ``since`` / ``until`` (time text, ``until`` exclusive, e.g. ``'2024-01-05'``) compare the
    reading's time text, and its ``day=`` folder, which prunes the folders outside the range. A
    reading whose date cannot be read is in no range. An archive on a commit log is scanned
    through its log (``streaming.archive.stored_archive``).
    """
    if kind is not None and latest_version(spark, path) >= 0:
        from agrosense.streaming.archive import stored_archive

        return stored_archive(spark, path, kind, topics, since, until)
    df = spark.read.parquet(path)
    if topics:
        df = df.where(F.col("topic").isin(*topics))
    if kind == "meteo":
        df = df.where(F.col("topic").contains(WEATHER_MARK))
    elif kind == "suolo":
        df = df.where(~F.col("topic").contains(WEATHER_MARK) & F.col("topic").contains(SOIL_MARK))
    if since or until:
        if kind not in TIME_FIELD:
            raise ValueError("a time range needs kind='meteo' or kind='suolo'")
        t = F.col(TIME_FIELD[kind])
        by_day = "day" in df.columns             # partition folders, written by the archive
        if since:
            df = df.where(t >= F.lit(since))
            df = df.where(F.col("day") >= F.lit(since[:10])) if by_day else df
        if until:
            df = df.where(t < F.lit(until))
            df = df.where(F.col("day") <= F.lit(until[:10])) if by_day else df
    return df.drop("day", "query")


def stored_daily(spark: SparkSession, path: str, topics: list[str] | None = None,
                 th: Thresholds = DEFAULT) -> DataFrame:
    """The daily frame combined from the archive's ``daily_partials`` table.

    Reads (topic, day) pieces — a few rows per day and micro-batch — instead of every
    stored reading; the daily queries accept it in place of ``daily_weather``.
    """
    from agrosense.operators.aggregates import daily_from_partials

    df = read_table(spark, path) if latest_version(spark, path) >= 0 else spark.read.parquet(path)
    if topics:
        df = df.where(F.col("topic").isin(*topics))
    return daily_from_partials(df, th)
