"""Hourly means with a watermark of its own for every sensor, and nothing dropped.

A stream has one watermark: a node that is ahead closes the hours of all slower ones. Here each
topic has its own progress (its latest reading time), and its hours close when that, less the
delay, passes their end. State is one row per topic and one per open hour, in a log table; what a
micro-batch does to it are a few joins and partial aggregates over the batch, so a topic with most
of all readings is combined before the shuffle like any other.

* ``<out>/state_<kind>`` — progress per topic and sums per open hour.
* ``<out>/hours_<kind>`` — closed hours, one row per topic and hour: sums and counts, the batch
  that wrote it last, and how many late readings it has been corrected by. Keyed upsert.
* ``<out>/late_<kind>`` — the late readings themselves: those whose hour had closed before their
  batch began. They are added to their hour, which so appears again with a newer version.
* ``<out>/used_<kind>`` — per batch and topic the readings used in time, late, and without a time.

Every table is committed with the query and batch id, and a batch always starts from the state
that the batch before it left, so a repeated batch gives the same rows and changes nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from agrosense.functions.columns import hour_start
from agrosense.operators.aggregates import hourly_from_partials, hourly_partials
from agrosense.params import StreamSettings
from agrosense.sinks import log
from agrosense.streaming.archive import query_id
from agrosense.streaming.jobs import KINDS, _start, readings_stream

SUMS = {"meteo": ("sum_temp", "n_temp", "sum_rain", "n_rain"),
        "suolo": ("sum_water", "n_water", "sum_pair_water", "n_pair_water", "sum_pair_temp", "n_pair_temp")}


def _added(df: DataFrame, kind: str, *more) -> DataFrame:
    return df.groupBy("topic", "hour").agg(*[F.sum(c).alias(c) for c in SUMS[kind]], *more)


def _partials(readings: DataFrame, kind: str) -> DataFrame:
    sums = hourly_partials(readings, kind)
    return sums.select("topic", "hour", *SUMS[kind])


def _state(spark: SparkSession, path: str, version: int, kind: str) -> tuple[DataFrame, DataFrame]:
    """Progress per topic and sums per open hour, as one commit left them."""
    schema = "topic string, hour string, progress timestamp, " + ", ".join(
        f"{c} {'long' if c.startswith('n_') else 'double'}" for c in SUMS[kind])
    state = log.read_files(spark, log.snapshot(spark, path, version)) if version >= 0 else spark.createDataFrame([], schema)
    return (state.where("hour is null").select("topic", "progress"),
            state.where("hour is not null").select("topic", "hour", *SUMS[kind]))


def hours_writer(kind: str, out_dir: str, delay: str,
                 after_table: Callable[[str], None] | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function over typed readings of one sensor kind."""
    tables = {n: f"{out_dir}/{n}_{kind}" for n in ("state", "hours", "late", "used")}
    gap = F.expr(f"INTERVAL {delay}")
    end = lambda hour: hour_start(hour) + F.expr("INTERVAL 1 HOUR")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, app = batch.sparkSession, query_id(batch)
        before = log.version_before(spark, tables["state"], app, batch_id)
        progress, open_hours = _state(spark, tables["state"], before, kind)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # one row per topic: small, but of any number of sensors, so no broadcast is forced
            told = batch.join(progress.withColumnRenamed("progress", "before"), "topic", "left").withColumn(
                "is_late", F.coalesce(end("hour") <= F.col("before") - gap, F.lit(False)))
            late = told.where("is_late").drop("before", "is_late")
            used = told.where("not is_late").drop("before", "is_late")
            after = batch.groupBy("topic").agg(F.max("event_time").alias("progress")).unionByName(progress).groupBy(
                "topic").agg(F.max("progress").alias("progress"))
            sums = _added(open_hours.unionByName(_partials(used, kind)), kind).join(after, "topic")
            closed = F.coalesce(end("hour") <= F.col("progress") - gap, F.lit(False))
            stamp = F.lit(batch_id).cast("long").alias("version")

            nothing = F.lit(0).cast("long").alias("n_late")
            fresh = sums.where(closed).select("topic", "hour", *SUMS[kind], nothing, stamp)
            counted = late.groupBy("topic", "hour").agg(F.count(F.lit(1)).alias("n_late"))
            fixed = _partials(late, kind).join(counted, ["topic", "hour"]).select("topic", "hour", *SUMS[kind], "n_late", stamp)
            state = after.select("topic", F.lit(None).cast("string").alias("hour"), "progress",
                                 *[F.lit(None).cast(sums.schema[c].dataType).alias(c) for c in SUMS[kind]]).unionByName(
                sums.where(~closed).select("topic", "hour", F.lit(None).cast("timestamp").alias("progress"), *SUMS[kind]))
            count = told.groupBy("topic").agg(
                F.count_if(~F.col("is_late") & F.col("hour").isNotNull()).alias("n_used"), F.count_if("is_late").alias("n_late"),
                F.count_if(F.col("hour").isNull()).alias("n_no_hour")).select("topic", "n_used", "n_late", "n_no_hour", stamp)

            def combine(rows: DataFrame) -> DataFrame:
                return _added(rows, kind, F.sum("n_late").alias("n_late"), F.max("version").alias("version"))

            steps = (
                ("hours", lambda: log.upsert(fresh.unionByName(fixed), tables["hours"], ["topic", "hour"], "version", ["topic"],
                                             app, batch_id, combine)),
                ("late", lambda: log.append(late.drop("day"), tables["late"], ["topic"], ["hour"], app, batch_id)),
                ("used", lambda: log.append(count, tables["used"], app=app, seq=batch_id)),
                ("state", lambda: log.overwrite(state, tables["state"], None, app, batch_id)),
            )
            for name, step in steps:
                step()
                if after_table is not None:
                    after_table(name)
        finally:
            batch.unpersist()
    return write


def start_per_topic_hours(channel: DataFrame, kind: str, out_dir: str, checkpoint: str,
                          settings: StreamSettings = StreamSettings(), topics: Sequence[str] | None = None,
                          after_table: Callable[[str], None] | None = None) -> StreamingQuery:
    """Start the hourly means of one sensor kind with a watermark per topic."""
    readings = readings_stream(channel, kind, topics)
    writer = readings.writeStream.foreachBatch(hours_writer(kind, out_dir, KINDS[kind].delay(settings), after_table))
    return _start(writer, settings, checkpoint, f"{kind}_per_topic", channel.sparkSession)


def closed_hours(spark: SparkSession, out_dir: str, kind: str) -> DataFrame:
    """The frame of ``hourly_weather`` / ``hourly_soil`` from the closed hours: the hourly results
    (``plans.hourly``) run on it unchanged."""
    return hourly_from_partials(log.read_table(spark, f"{out_dir}/hours_{kind}"), kind)


def late_readings(spark: SparkSession, out_dir: str, kind: str) -> DataFrame:
    """The readings that came after their hour had closed."""
    return log.read_table(spark, f"{out_dir}/late_{kind}")


def reading_counts(spark: SparkSession, out_dir: str, kind: str) -> DataFrame:
    """Per topic the readings used in time, late, and without an hour; they add up to all."""
    return log.read_table(spark, f"{out_dir}/used_{kind}").groupBy("topic").agg(
        *[F.sum(c).alias(c) for c in ("n_used", "n_late", "n_no_hour")])
