"""Daily results on hand-worked inputs (edge cases of thresholds, ties, rounding, NaN)."""

from dataclasses import replace

import pytest
from conftest import weather_channel

from agrosense.operators.parse import weather_records
from agrosense.operators.readings import weather_readings
from agrosense.params import DEFAULT
from agrosense.plans import daily


def readings(spark, rows):
    return weather_readings(weather_records(weather_channel(spark, rows)))


def day_rows(day, temps, hum=50.0, rain=0.0):
    return [(f"{day} {i // 60:02d}:{i % 60:02d}:00", t, hum, rain) for i, t in enumerate(temps)]


def three_days(spec):
    """spec: newest first, (temp, hum) per day."""
    days = ["2024-01-03", "2024-01-02", "2024-01-01"]
    out = []
    for d, (t, h) in zip(days, spec):
        out += day_rows(d, [t, t], hum=h)
    return out


def test_trend_true_reference_direction(spark):
    r = daily.last_3_days_trend(readings(spark, three_days([(10, 60), (12, 55), (14, 50)])))
    row = r.first()
    assert row.isGettingHotter is True
    assert (row.day_minus_1, row.day_minus_2, row.day_minus_3) == (
        "2024-01-03", "2024-01-02", "2024-01-01")
    assert (row.avg_temp1, row.avg_hum1, row.avg_temp3, row.avg_hum3) == (10.0, 60.0, 14.0, 50.0)


def test_trend_chronological_direction(spark):
    th = replace(DEFAULT, trend_direction="chronological")
    src = readings(spark, three_days([(10, 60), (12, 55), (14, 50)]))
    assert daily.last_3_days_trend(src, th).first().isGettingHotter is False
    src = readings(spark, three_days([(14, 50), (12, 55), (10, 60)]))
    assert daily.last_3_days_trend(src, th).first().isGettingHotter is True


def test_trend_newest_day_at_zero_is_false(spark):
    r = daily.last_3_days_trend(readings(spark, three_days([(0, 60), (12, 55), (14, 50)])))
    assert r.first().isGettingHotter is False


def test_trend_needs_three_days(spark):
    src = readings(spark, day_rows("2024-01-01", [1.0]) + day_rows("2024-01-02", [2.0]))
    assert daily.last_3_days_trend(src).count() == 0


def test_trend_uses_latest_three_of_more(spark):
    rows = three_days([(10, 60), (12, 55), (14, 50)]) + day_rows("2023-12-31", [99.0])
    row = daily.last_3_days_trend(readings(spark, rows)).first()
    assert row.day_minus_3 == "2024-01-01"


@pytest.mark.parametrize("n_hot,expected", [(10, 0), (11, 1)])
def test_days_to_water_threshold_is_strict(spark, n_hot, expected):
    rows = day_rows("2024-01-05", [25.0] * n_hot + [10.0] * 5)
    r = daily.days_to_water(readings(spark, rows))
    assert r.count() == expected
    if expected:
        row = r.first()
        assert (row.day, row.totTempOver22, row.isRained) == ("2024-01-05", 11, False)


def test_reading_exactly_22_is_not_hot(spark):
    r = daily.days_to_water(readings(spark, day_rows("2024-01-05", [22.0] * 11)))
    assert r.count() == 0


def test_one_rainy_reading_excludes_the_day(spark):
    rows = day_rows("2024-01-05", [25.0] * 20)
    rows[3] = (rows[3][0], 25.0, 50.0, 0.1)
    assert daily.days_to_water(readings(spark, rows)).count() == 0


def test_nan_reading_is_not_hot(spark):
    rows = day_rows("2024-01-05", [25.0] * 10 + ["NaN"])
    assert daily.days_to_water(readings(spark, rows)).count() == 0


def test_bad_rain_rejects_reading_only_where_rain_is_used(spark):
    rows = day_rows("2024-01-05", [25.0] * 11)
    rows[0] = (rows[0][0], 25.0, 50.0, "x")
    src = readings(spark, rows)
    assert daily.days_to_water(src).count() == 0          # 10 usable hot readings left
    hot = daily.top10_hot_days(src).first()
    assert hot.avg_temp == 25.0                            # all 11 temperatures used


def test_rounding_is_half_up(spark):
    src = readings(spark, day_rows("2024-01-05", [1.005]))
    assert daily.top10_hot_days(src).first().avg_temp == 1.01
    src = readings(spark, day_rows("2024-01-05", [-1.005]))
    assert daily.top10_cold_days(src).first().avg_temp == -1.01


def test_top10_orders_and_breaks_ties_by_earlier_day(spark):
    rows = []
    for d in range(1, 13):
        rows += day_rows(f"2024-01-{d:02d}", [float(d)])
    rows += day_rows("2024-01-20", [3.0])   # ties with 2024-01-03 at the cut of the cold list
    src = readings(spark, rows)
    hot = [r.day for r in daily.top10_hot_days(src).collect()]
    assert hot == [f"2024-01-{d:02d}" for d in range(12, 2, -1)]
    cold = [(r.day, r.avg_temp) for r in daily.top10_cold_days(src).collect()]
    assert cold[:4] == [("2024-01-01", 1.0), ("2024-01-02", 2.0), ("2024-01-03", 3.0),
                        ("2024-01-20", 3.0)]
    assert len(cold) == 10


def test_tie_at_rank_10_keeps_earlier_day(spark):
    rows = []
    for d in range(1, 10):
        rows += day_rows(f"2024-03-{d:02d}", [10.0 + d])
    rows += day_rows("2024-03-25", [5.0]) + day_rows("2024-03-15", [5.0])
    top = [r.day for r in daily.top10_hot_days(readings(spark, rows)).collect()]
    assert len(top) == 10 and top[-1] == "2024-03-15"


def test_humid_days(spark):
    rows = day_rows("2024-01-01", [1.0], hum=70.0) + day_rows("2024-01-02", [1.0], hum=80.0)
    got = [(r.day, r.avg_humidity) for r in daily.top10_humid_days(readings(spark, rows)).collect()]
    assert got == [("2024-01-02", 80.0), ("2024-01-01", 70.0)]


def test_min_readings_per_day_filter(spark):
    rows = day_rows("2024-01-01", [1.0] * 3) + day_rows("2024-01-02", [2.0] * 2)
    th = replace(DEFAULT, min_readings_per_day=3)
    got = [r.day for r in daily.top10_hot_days(readings(spark, rows), th).collect()]
    assert got == ["2024-01-01"]


def test_reading_count_and_daily_means(spark):
    rows = day_rows("2024-01-01", [1.0, 2.0], hum=40.0) + day_rows("2024-01-02", [3.0])
    src = readings(spark, rows)
    assert daily.reading_count(src).first().n_readings == 3
    got = [tuple(r) for r in daily.daily_means(src).orderBy("day").collect()]
    assert got == [("2024-01-01", 1.5, 40.0, 2), ("2024-01-02", 3.0, 50.0, 1)]
