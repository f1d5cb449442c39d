"""Typed views over stored reading records.

Stored records keep every field as text. These views add typed columns; a field that is
not a number becomes null. Of the time text each result checks what it uses: ``day`` needs
a date in the first ten characters, ``hour`` a date and an hour, ``event_time`` the whole
``yyyy-MM-dd HH:mm:ss``; what does not parse is null. Each aggregate then skips only the
readings whose *own* inputs are null, so a bad rain value never hides a good temperature.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrosense.functions.columns import reading_time, to_number, valid_day, valid_hour


def _time_columns(text: str, on_error: str):
    return [
        reading_time(text, on_error).alias("event_time"),
        valid_day(text).alias("day"),
        valid_hour(text).alias("hour"),
    ]


WEATHER_NUMBERS = ("temp1_media", "ur1_media", "pioggia_mm")
SOIL_NUMBERS = ("water_0", "temperature_0", "water_1", "temperature_1")


def weather_readings(records: DataFrame, on_error: str = "quarantine", keep: Sequence[str] = ()) -> DataFrame:
    """topic, _id, data_ora, event_time, day, hour, temp1_media, ur1_media, pioggia_mm.

    ``on_error='fail'`` stops the query on the first field that does not parse (the
    reference's behaviour) instead of nulling it for a per-query reject. ``keep`` names further
    columns to pass through.
    """
    return records.select(
        "topic", "_id", "data_ora", *_time_columns("data_ora", on_error),
        to_number("temp1_media", on_error).alias("temp1_media"),
        to_number("ur1_media", on_error).alias("ur1_media"),
        to_number("pioggia_mm", on_error).alias("pioggia_mm"), *keep,
    )


def soil_readings(records: DataFrame, on_error: str = "quarantine", keep: Sequence[str] = ()) -> DataFrame:
    """topic, _id, timestamp, event_time, day, hour, the four probes, and the pair means.

    ``water`` is the mean of the two probes' water content, ``soil_temp`` the mean of their
    temperatures (null when either probe is null).
    """
    typed = records.select(
        "topic", "_id", "timestamp", *_time_columns("timestamp", on_error),
        *[to_number(c, on_error).alias(c) for c in SOIL_NUMBERS], *keep,
    )
    return typed.withColumns({
        "water": (F.col("water_0") + F.col("water_1")) / 2,
        "soil_temp": (F.col("temperature_0") + F.col("temperature_1")) / 2,
    })


def rejected_readings(readings: DataFrame, required: Sequence[str],
                      time_col: str = "event_time") -> DataFrame:
    """Readings a query must skip, with the first failing field as the reason."""
    reason = F.when(F.col(time_col).isNull(), F.lit("bad_timestamp"))
    for c in required:
        reason = reason.when(F.col(c).isNull(), F.lit(f"bad_number:{c}"))
    return readings.withColumn("reason", reason).where(F.col("reason").isNotNull())
