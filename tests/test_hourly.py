"""Hourly results on hand-worked inputs."""

from dataclasses import replace

from conftest import SOIL_TOPIC, soil_channel, weather_channel

from agrosense.operators.aggregates import hourly_soil, hourly_weather
from agrosense.operators.parse import soil_records, weather_records
from agrosense.operators.readings import soil_readings, weather_readings
from agrosense.params import DEFAULT
from agrosense.plans import hourly


def hw(spark, rows):
    return hourly_weather(weather_readings(weather_records(weather_channel(spark, rows))))


def hs(spark, rows):
    return hourly_soil(soil_readings(soil_records(soil_channel(spark, rows))))


def test_temperature_alert_mean_and_strict_threshold(spark):
    rows = [("2020-01-02 03:00:00", 1.0, 50, 0), ("2020-01-02 03:30:00", 2.0, 50, 0),
            ("2020-01-02 04:00:00", -1.0, 50, 0), ("2020-01-02 05:10:00", -0.5, 50, 0)]
    got = sorted(tuple(r) for r in hourly.temperature_alert(hw(spark, rows)).collect())
    assert got == [("2020-01-02 03", 1.5), ("2020-01-02 05", -0.5)]


def test_nan_temperature_is_not_alerted(spark):
    rows = [("2020-01-02 03:00:00", "NaN", 50, 0)]
    assert hourly.temperature_alert(hw(spark, rows)).count() == 0


def test_dont_irrigate_interval_text_and_mean_rain(spark):
    rows = [("2020-01-02 03:05:00", 1.0, 50, 0.5), ("2020-01-02 03:55:00", 1.0, 50, 1.5)]
    row = hourly.dont_irrigate(hw(spark, rows), with_bounds=True).first()
    assert row.interval == "Thu Jan 02 03:00:00 UTC 2020 -> Thu Jan 02 15:00:00 UTC 2020"
    assert row.rain == 1.0
    assert str(row.interval_start) == "2020-01-02 03:00:00"


def test_dont_irrigate_threshold_parameter(spark):
    rows = [("2020-01-02 03:05:00", 1.0, 50, 0.0), ("2020-01-02 04:05:00", 1.0, 50, 0.2)]
    assert hourly.dont_irrigate(hw(spark, rows)).count() == 2
    th = replace(DEFAULT, rain_min=0.0)
    assert [r.rain for r in hourly.dont_irrigate(hw(spark, rows), th).collect()] == [0.2]


def test_water_content_alert_per_topic(spark):
    rows = [("2020-01-02 03:00:00", 0.1, 10.0, 0.2, 12.0),
            ("2020-01-02 03:20:00", 0.3, 10.0, 0.4, 12.0),
            ("2020-01-02 04:00:00", 0.249, 10.0, 0.249, 12.0)]
    got = [tuple(r) for r in hourly.water_content_alert(hs(spark, rows)).collect()]
    # mean of (0.15, 0.35) = 0.25 -> not below 0.249; hour 04 at exactly 0.249 -> excluded
    assert got == []
    rows.append(("2020-01-02 05:00:00", 0.1, 1.0, 0.2, 1.0))
    got = [tuple(r) for r in hourly.water_content_alert(hs(spark, rows)).collect()]
    assert got == [(SOIL_TOPIC, "2020-01-02 05", 0.15)]


def test_ratio_is_of_the_means_and_null_at_zero_degrees(spark):
    rows = [("2020-01-02 03:00:00", 0.2, 10.0, 0.4, 20.0),   # w=0.3, t=15
            ("2020-01-02 03:30:00", 0.2, 0.0, 0.4, 10.0),    # w=0.3, t=5  -> 0.3/10
            ("2020-01-02 04:00:00", 0.2, -1.0, 0.4, 1.0)]    # t=0 -> null
    got = {r.hour: r.waterTemperatureRatio for r in hourly.water_temperature_ratio(hs(spark, rows)).collect()}
    assert got == {"2020-01-02 03": 0.03, "2020-01-02 04": None}


def test_combined_alert_is_strict_on_both(spark):
    rows = [("2020-01-02 03:00:00", 0.2, 0.0, 0.2, 0.0),     # t=0 > -1, w=0.2 < 0.5 -> alert
            ("2020-01-02 04:00:00", 0.5, 0.0, 0.5, 0.0),     # w = 0.5 -> no
            ("2020-01-02 05:00:00", 0.2, -1.0, 0.2, -1.0)]   # t = -1 -> no
    got = [tuple(r) for r in hourly.combined_sickness_alert(hs(spark, rows)).collect()]
    assert got == [(SOIL_TOPIC, "2020-01-02 03", 0.2, 0.0)]


def test_hourly_means_are_rounded_to_nine_digits(spark):
    rows = [("2020-01-02 03:00:00", 1.0, 50, 0), ("2020-01-02 03:01:00", 1.0, 50, 0),
            ("2020-01-02 03:02:00", 2.0, 50, 0)]
    assert hourly.temperature_alert(hw(spark, rows)).first().highTemperature == 1.333333333
    th = replace(DEFAULT, hourly_digits=None)
    assert hourly.temperature_alert(hw(spark, rows), th).first().highTemperature == 4.0 / 3
