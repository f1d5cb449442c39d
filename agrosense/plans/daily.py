"""Daily weather results (batch): trend, days to water, top-10 hot / cold / humid days.

Each function takes the typed weather readings (``operators.readings.weather_readings``)
or a ``daily`` frame built from them, so a suite can build ``daily`` once and reuse it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrosense.operators.aggregates import daily_weather
from agrosense.operators.ranking import latest, top_k
from agrosense.operators.trend import pivot_latest
from agrosense.params import DEFAULT, Thresholds


def _daily(src: DataFrame, th: Thresholds) -> DataFrame:
    return src if "n_trend" in src.columns else daily_weather(src, th)


def reading_count(readings: DataFrame) -> DataFrame:
    """Number of stored weather readings (one row)."""
    return readings.agg(F.count(F.lit(1)).alias("n_readings"))


def daily_means(src: DataFrame, th: Thresholds = DEFAULT) -> DataFrame:
    """Per day: mean temperature and humidity over readings with both, rounded half-up."""
    d = _daily(src, th).where(F.col("n_trend") > 0)
    return d.select(
        "day",
        F.round("trend_temp", th.daily_digits).alias("avg_temp"),
        F.round("trend_humidity", th.daily_digits).alias("avg_humidity"),
        F.col("n_trend").alias("n_readings"),
    )


def _daily_mean_top(src, th, value, out, descending):
    d = _daily(src, th)
    if th.min_readings_per_day:
        count_col = "n_temp" if value == "avg_temp" else "n_humidity"
        d = d.where(F.col(count_col) >= th.min_readings_per_day)
    rounded = d.select("day", F.round(value, th.daily_digits).alias(out))
    return top_k(rounded, out, th.top_k, descending=descending)


def top10_hot_days(src: DataFrame, th: Thresholds = DEFAULT) -> DataFrame:
    """The ``top_k`` days with the highest rounded mean temperature."""
    return _daily_mean_top(src, th, "avg_temp", "avg_temp", True)


def top10_cold_days(src: DataFrame, th: Thresholds = DEFAULT) -> DataFrame:
    """The ``top_k`` days with the lowest rounded mean temperature."""
    return _daily_mean_top(src, th, "avg_temp", "avg_temp", False)


def top10_humid_days(src: DataFrame, th: Thresholds = DEFAULT) -> DataFrame:
    """The ``top_k`` days with the highest rounded mean humidity."""
    return _daily_mean_top(src, th, "avg_humidity", "avg_humidity", True)


def days_to_water(src: DataFrame, th: Thresholds = DEFAULT) -> DataFrame:
    """Days with more than ``hot_readings_over`` readings above ``hot_reading_min`` and no rain."""
    d = _daily(src, th).where(F.col("n_water") > 0)
    return (d.where((F.col("totTempOver22") > th.hot_readings_over) & ~F.col("isRained"))
            .select("day", "totTempOver22", "isRained"))


def last_3_days_trend(src: DataFrame, th: Thresholds = DEFAULT) -> DataFrame:
    """Means of the latest ``trend_days`` days in one row plus the trend flag.

    No row when fewer days exist.
    """
    d = _daily(src, th).where(F.col("n_trend") > 0)
    if th.min_readings_per_day:
        d = d.where(F.col("n_trend") >= th.min_readings_per_day)
    days = latest(d.select("day", F.col("trend_temp").alias("temp"),
                           F.col("trend_humidity").alias("hum")), "day", th.trend_days)
    return pivot_latest(days, th.trend_days, th.daily_digits, th.trend_direction)
