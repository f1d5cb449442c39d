"""The path of a reading as one lazy plan.

Streaming analyses see lines: table -> lines -> records -> typed readings. Batch analyses
read the stored records (text fields) and type them per query. Nothing here
materialises; Catalyst sees one scan, projections and the aggregate above it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from agrosense.operators.parse import soil_records, weather_records
from agrosense.operators.readings import soil_readings, weather_readings
from agrosense.sources.events_adapter import stored_soil_records, stored_weather_records
from agrosense.sources.tables import events_channel, table


def weather_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed weather readings parsed from the lines derived from ``events``."""
    return weather_readings(weather_records(events_channel(spark, sf_dir)))


def soil_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed soil readings parsed from the lines derived from ``events``."""
    return soil_readings(soil_records(events_channel(spark, sf_dir)))


def stored_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed weather readings over the stored-record view of ``events``."""
    return weather_readings(stored_weather_records(table(spark, sf_dir, "events")))


def stored_soil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed soil readings over the stored-record view of ``events``."""
    return soil_readings(stored_soil_records(table(spark, sf_dir, "events")))
