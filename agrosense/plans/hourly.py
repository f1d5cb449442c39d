"""Hourly results: temperature, rain, soil-water and combined alerts, water/temperature ratio.

Each function takes an hourly frame (``operators.aggregates.hourly_weather`` /
``hourly_soil``), batch or streaming alike, so one definition serves both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrosense.functions.columns import (
    hour_start,
    interval_text,
    java_gt,
    java_lt,
    round_half_up,
    safe_ratio,
)
from agrosense.params import DEFAULT, Thresholds


def temperature_alert(hourly_weather: DataFrame, th: Thresholds = DEFAULT) -> DataFrame:
    """Weather hours whose mean temperature is above ``alert_temp_min``."""
    d = th.hourly_digits
    return (hourly_weather.where((F.col("n_temp") > 0) & java_gt("avg_temp", th.alert_temp_min))
            .select("hour", round_half_up("avg_temp", d).alias("highTemperature")))


def dont_irrigate(hourly_weather: DataFrame, th: Thresholds = DEFAULT,
                  with_bounds: bool = False) -> DataFrame:
    """Weather hours whose mean rain is above ``rain_min``, as ``<hour> -> <hour + 12h>``."""
    d = th.hourly_digits
    # The hour key comes from a validated time text, so it always parses back.
    start = hour_start("hour")
    rows = hourly_weather.where((F.col("n_rain") > 0) & java_gt("avg_rain", th.rain_min))
    cols = [interval_text(start, th.interval_hours).alias("interval"),
            round_half_up("avg_rain", d).alias("rain")]
    if with_bounds:
        cols += [start.alias("interval_start"),
                 (start + F.make_dt_interval(F.lit(0), F.lit(th.interval_hours)))
                 .alias("interval_end")]
    return rows.select(*cols)


def water_content_alert(hourly_soil: DataFrame, th: Thresholds = DEFAULT) -> DataFrame:
    """Soil hours whose mean probe-pair water content is below ``alert_water_max``."""
    d = th.hourly_digits
    return (hourly_soil.where((F.col("n_water") > 0) & java_lt("avg_water", th.alert_water_max))
            .select("topic", "hour", round_half_up("avg_water", d).alias("lowWaterContent")))


def water_temperature_ratio(hourly_soil: DataFrame, th: Thresholds = DEFAULT) -> DataFrame:
    """Per soil hour: mean water / mean temperature (ratio of the means; null on 0 degC)."""
    d = th.hourly_digits
    return (hourly_soil.where(F.col("n_pair") > 0)
            .select("topic", "hour",
                    round_half_up(safe_ratio("pair_water", "pair_temp"), d)
                    .alias("waterTemperatureRatio")))


def combined_sickness_alert(hourly_soil: DataFrame, th: Thresholds = DEFAULT) -> DataFrame:
    """Soil hours both warm (mean temperature > ``combined_temp_min``) and dry (< ``combined_water_max``)."""
    d = th.hourly_digits
    cond = ((F.col("n_pair") > 0) & java_gt("pair_temp", th.combined_temp_min)
            & java_lt("pair_water", th.combined_water_max))
    return (hourly_soil.where(cond)
            .select("topic", "hour",
                    round_half_up("pair_water", d).alias("lowWaterContent"),
                    round_half_up("pair_temp", d).alias("highTemperature")))
