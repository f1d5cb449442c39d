"""The raw archive on commit-logged tables (``sinks.log``), and what is kept up from it.

``start_archive`` is the raw archive job on the log: every micro-batch parses each line once,
keeps the typed rows with their raw fields in memory, derives seven tables from them and commits
each with the query's id and the batch id. A batch that is repeated after a failure adds only the
tables it had not committed; files of an attempt that died are never visible.

``stored_archive`` scans it: files are chosen by topic, day and the time range in the log before
Spark opens any. ``compact_archive`` rewrites days of many small files; ``refresh_daily`` keeps one
row per day up to date from the days that changed since its last run.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from agrosense.functions.columns import valid_day
from agrosense.operators.aggregates import daily_partials, daily_weather, hourly_partials
from agrosense.operators.parse import rejected_lines, soil_records, weather_records
from agrosense.operators.readings import (
    SOIL_NUMBERS,
    WEATHER_NUMBERS,
    rejected_readings,
    soil_readings,
    weather_readings,
)
from agrosense.params import DEFAULT, StreamSettings, Thresholds
from agrosense.schemas import SOIL_MARK, WEATHER_MARK
from agrosense.sinks import log
from agrosense.sinks.log import append, changed_since, choose, compact, read_files, snapshot, upsert
from agrosense.streaming.jobs import RAW_TABLES, _start

TIME_FIELD = {"meteo": "data_ora", "suolo": "timestamp"}
PARTITION_BY = {"meteo": ("topic", "day"), "suolo": ("topic", "day"), "daily_partials": ("topic",),
                "hourly_partials_meteo": ("topic",), "hourly_partials_suolo": ("topic",)}
STATS = {"meteo": ("data_ora",), "suolo": ("timestamp",), "daily_partials": ("day",),
         "hourly_partials_meteo": ("hour",), "hourly_partials_suolo": ("hour",)}


def query_id(batch: DataFrame) -> str:
    """Id of the streaming query that runs the batch; it lives in the checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def parsed_tables(batch: DataFrame, topics: Sequence[str] | None, th: Thresholds) -> tuple[dict, list]:
    """The archive's tables of one micro-batch, and the frames to release when they are written.

    Lines are split, and their numbers and times parsed, once: the typed rows are held with the
    raw record beside them."""
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    typed = {}
    for kind, records, readings in (("meteo", weather_records, weather_readings), ("suolo", soil_records, soil_readings)):
        rows = records(batch, topics)
        rows = rows.withColumns({"raw": F.struct(*[F.col(f"`{c}`") for c in rows.columns]),
                                 "raw_day": valid_day(TIME_FIELD[kind])})
        typed[kind] = readings(rows, keep=("raw", "raw_day")).persist(StorageLevel.MEMORY_AND_DISK)
    weather, soil = typed["meteo"], typed["suolo"]
    bad = (rejected_readings(weather, WEATHER_NUMBERS).select("topic", "_id", "reason")
           .unionAll(rejected_readings(soil, SOIL_NUMBERS).select("topic", "_id", "reason")))
    stored = lambda rows: rows.select("raw.*", F.col("raw_day").alias("day"))
    return {
        "meteo": stored(weather), "suolo": stored(soil), "rejected": rejected_lines(batch, topics),
        "rejected_readings": bad, "daily_partials": daily_partials(weather, th),
        "hourly_partials_meteo": hourly_partials(weather, "meteo"),
        "hourly_partials_suolo": hourly_partials(soil, "suolo"),
    }, [batch, weather, soil]


def archive_writer(out_dir: str, topics: Sequence[str] | None = None, th: Thresholds = DEFAULT,
                   after_table: Callable[[str], None] | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function of the archive. ``after_table`` is called after each commit
    (tests let a batch fail there)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        app = query_id(batch)
        tables, held = parsed_tables(batch, topics, th)
        try:
            for name in RAW_TABLES:
                append(tables[name], f"{out_dir}/{name}", PARTITION_BY.get(name, ()), STATS.get(name, ()), app, batch_id)
                if after_table is not None:
                    after_table(name)
        finally:
            for df in held:
                df.unpersist()
    return write


def start_archive(channel: DataFrame, out_dir: str, checkpoint: str, settings: StreamSettings = StreamSettings(),
                  topics: Sequence[str] | None = None, th: Thresholds = DEFAULT,
                  after_table: Callable[[str], None] | None = None) -> StreamingQuery:
    """Archive every reading of the channel to log tables below ``out_dir``."""
    writer = channel.select("topic", "value").writeStream.foreachBatch(archive_writer(out_dir, topics, th, after_table))
    return _start(writer, settings, checkpoint, "raw_archive")


def _days(since: str | None, until: str | None):
    """Condition on a file's day: none (unreadable date) is in no range."""
    return lambda day: day is not None and (since is None or day >= since[:10]) and (until is None or day <= until[:10])


def archive_files(spark: SparkSession, path: str, kind: str, topics: Sequence[str] | None = None,
                  since: str | None = None, until: str | None = None, version: int | None = None):
    """The snapshot and those of its files that a scan needs."""
    snap = snapshot(spark, path, version)
    files = choose(snap, between={TIME_FIELD[kind]: (since, until)} if since or until else None)
    if topics:
        files = [f for f in files if f.partition.get("topic") in set(topics)]
    if since or until:
        in_range = _days(since, until)
        files = [f for f in files if "day" not in f.partition or in_range(f.partition["day"])]
    return snap, files


def stored_archive(spark: SparkSession, path: str, kind: str, topics: Sequence[str] | None = None,
                   since: str | None = None, until: str | None = None, version: int | None = None) -> DataFrame:
    """Stored records of a log archive (``<out>/meteo`` or ``<out>/suolo``) at one version.

    ``since`` / ``until`` (time text, ``until`` exclusive) choose readings by their time text. A
    reading whose date cannot be read is in no range; without a range all readings come."""
    snap, files = archive_files(spark, path, kind, topics, since, until, version)
    df, t = read_files(spark, snap, files), F.col(TIME_FIELD[kind])
    mark = F.col("topic").contains(WEATHER_MARK)
    df = df.where(mark if kind == "meteo" else ~mark & F.col("topic").contains(SOIL_MARK))
    if topics:
        df = df.where(F.col("topic").isin(*topics))
    if since:
        df = df.where((t >= F.lit(since)) & F.col("day").isNotNull())
    if until:
        df = df.where((t < F.lit(until)) & F.col("day").isNotNull())
    return df.drop("day")


def compact_archive(spark: SparkSession, out_dir: str, small_bytes: int = 64 << 20,
                    retention_s: float | None = None) -> dict:
    """Compact every table of the archive; with ``retention_s`` also delete what has been out of
    use for so long. Returns what was done per table."""
    done = {}
    for name in RAW_TABLES:
        path = f"{out_dir}/{name}"
        if log.latest_version(spark, path) < 0:
            continue
        done[name] = compact(spark, path, PARTITION_BY.get(name, ()), STATS.get(name, ()), small_bytes)
        if retention_s is not None:
            done[name]["deleted"] = log.vacuum(spark, path, retention_s)
    return done


DAILY_APP = "archive-version"


def refresh_daily(spark: SparkSession, archive: str, path: str, topics: Sequence[str] | None = None,
                  th: Thresholds = DEFAULT) -> dict:
    """Bring the table of daily measures at ``path`` up to the weather archive's newest version.

    Reads only files of days that got rows since the version the table was made from, replaces
    these days' rows, and commits with that version as its sequence number. The five daily
    results take the table (``kept_daily``) in place of the readings."""
    have = snapshot(spark, path).seen.get(DAILY_APP, -1)
    newest, days = changed_since(spark, archive, have, "day")
    if newest == have:
        return {"version": newest, "days": 0, "files": 0}
    snap = snapshot(spark, archive, newest)
    files = [f for f in snap.files if (days is None or f.partition["day"] in days) and f.partition["day"] is not None
             and (not topics or f.partition["topic"] in set(topics))]
    daily = daily_weather(weather_readings(read_files(spark, snap, files)), th).withColumn("version", F.lit(newest).cast("long"))
    upsert(daily, path, ["day"], "version", app=DAILY_APP, seq=newest)
    return {"version": newest, "days": len({f.partition["day"] for f in files}), "files": len(files)}


def kept_daily(spark: SparkSession, path: str) -> DataFrame:
    """The daily frame that ``refresh_daily`` keeps."""
    return log.read_table(spark, path).drop("version")
