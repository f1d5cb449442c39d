"""The batch suite: all five daily results from one daily aggregate.

The reference computes the same daily means once per query and reads the whole store
each time. Here the weather readings are scanned and aggregated once; the daily frame
(one row per day, so small whatever the input size) is persisted and the five results
are derived from it and written: trend and days-to-water appended, top-10 lists replaced.
If an executor holding the cached frame is lost, Spark recomputes it from its lineage.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrosense.operators.aggregates import daily_weather
from agrosense.operators.readings import WEATHER_NUMBERS, rejected_readings
from agrosense.params import DEFAULT, Thresholds
from agrosense.plans import daily
from agrosense.sinks import log
from agrosense.sinks.results import append_results, replace_results

# Reference run order: trend, days to water, humid, hot, cold.
SUITE = (
    ("last_3_days_trend", daily.last_3_days_trend, "append"),
    ("days_to_water", daily.days_to_water, "append"),
    ("top10_humid_days", daily.top10_humid_days, "replace"),
    ("top10_hot_days", daily.top10_hot_days, "replace"),
    ("top10_cold_days", daily.top10_cold_days, "replace"),
)


def batch_results(src: DataFrame, th: Thresholds = DEFAULT) -> tuple[DataFrame, dict]:
    """The persisted daily frame and the five result frames derived from it.

    ``src`` is either typed weather readings or a daily frame already combined (e.g. from
    the archive's daily partials, ``sources.tables.stored_daily``).
    """
    d = src if "n_trend" in src.columns else daily_weather(src, th)
    d = d.persist(StorageLevel.MEMORY_AND_DISK)
    return d, {name: fn(d, th) for name, fn, _ in SUITE}


def run_batch_suite(src: DataFrame, out_dir: str, th: Thresholds = DEFAULT) -> dict:
    """Compute and write all five daily results; returns ``name -> path``.

    From readings, those that some result skips are written too (``rejected_readings``: a
    version per run), with the first field that did not parse."""
    d, results = batch_results(src, th)
    paths = {}
    if "pioggia_mm" in src.columns:
        bad = rejected_readings(src, WEATHER_NUMBERS, time_col="day")
        replace_results(bad.select("topic", "_id", "reason"), f"{out_dir}/rejected_readings")
    try:
        for name, _, mode in SUITE:
            path = f"{out_dir}/{name}"
            if mode == "append":
                append_results(results[name], path)
            else:
                replace_results(results[name], path)
            paths[name] = path
    finally:
        d.unpersist()
    return paths


def run_suite_once(src: DataFrame, out_dir: str, run_id: str, th: Thresholds = DEFAULT, after_result=None) -> dict:
    """The suite on log tables, each result committed once per ``run_id``.

    A run that failed half-way and is repeated writes only what it had not committed. Replaced
    results are published against the version that was current when the run began: if another
    run has published one meanwhile, that is a ``Conflict`` and the table stays as it is.
    Returns ``name -> path``; read them with ``sinks.log.read_table``."""
    spark = src.sparkSession
    paths = {name: f"{out_dir}/{name}" for name, _, _ in SUITE}
    began = {name: log.latest_version(spark, path) for name, path in paths.items()}
    d, results = batch_results(src, th)
    try:
        for name, _, mode in SUITE:
            if mode == "append":
                rows = results[name].withColumn("run_id", F.lit(run_id))
                log.append(rows, paths[name], app=run_id)
            else:
                log.overwrite(results[name], paths[name], began[name], app=run_id)
            if after_result is not None:
                after_result(name)
    finally:
        d.unpersist()
    return paths
