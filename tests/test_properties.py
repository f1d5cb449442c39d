"""Randomised inputs (fixed seeds) against a plain-Python brute force of the same rules."""

import math
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import SOIL_TOPIC, channel, soil_line, weather_line, WEATHER_TOPIC

from agrosense.operators.aggregates import hourly_soil, hourly_weather
from agrosense.operators.parse import soil_records, weather_records
from agrosense.operators.readings import soil_readings, weather_readings
from agrosense.plans import daily, hourly


def num(text):
    try:
        return float(text)
    except ValueError:
        return None


def half_up(x, digits):
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def mean(xs):
    return sum(xs) / len(xs)


def weather_rows(seed, n=600, days=14):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        d, h, m = rnd.randrange(days), rnd.randrange(24), rnd.randrange(60)
        ts = f"2024-02-{d + 1:02d} {h:02d}:{m:02d}:{rnd.randrange(60):02d}"
        temp = rnd.choice([f"{rnd.uniform(-5, 35):.3f}"] * 12 + ["x", ""])
        hum = rnd.choice([f"{rnd.uniform(20, 99):.2f}"] * 12 + ["bad"])
        rain = rnd.choice(["0.0"] * 20 + [f"{rnd.uniform(0, 3):.2f}", "NaN", "?"])
        rows.append((ts, temp, hum, rain))
    return rows


def soil_rows(seed, n=500):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        ts = f"2024-02-01 {rnd.randrange(24):02d}:{rnd.randrange(60):02d}:00"
        vals = [rnd.choice([f"{rnd.uniform(0, 0.6):.3f}"] * 15 + ["x"]),
                rnd.choice([f"{rnd.uniform(-4, 4):.2f}"] * 15 + [""]),
                f"{rnd.uniform(0, 0.6):.3f}",
                rnd.choice([f"{rnd.uniform(-4, 4):.2f}", "0"])]
        rows.append((ts, *vals))
    return rows


def spark_weather(spark, rows):
    ch = channel(spark, [(WEATHER_TOPIC, weather_line(i, *r)) for i, r in enumerate(rows)])
    return weather_readings(weather_records(ch))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_daily_results_match_brute_force(spark, seed):
    rows = weather_rows(seed)
    src = spark_weather(spark, rows)
    by_day = defaultdict(list)
    for ts, t, h, r in rows:
        by_day[ts[:10]].append((num(t), num(h), num(r)))

    # days_to_water: readings with temperature and rain; > 10 hot, none rainy (Java: NaN > 0 false)
    want = []
    for day, rs in by_day.items():
        tr = [(t, r) for t, h, r in rs if t is not None and r is not None]
        hot = sum(1 for t, _ in tr if t > 22)
        rained = any(r > 0 for _, r in tr)
        if tr and hot > 10 and not rained:
            want.append((day, hot, False))
    assert sorted(tuple(r) for r in daily.days_to_water(src).collect()) == sorted(want)

    # top-10 hot / cold: rounded mean over valid temperatures, ties to the earlier day
    means = {d: half_up(mean(ts), 2) for d, rs in by_day.items()
             if (ts := [t for t, _, _ in rs if t is not None])}
    hot = sorted(means.items(), key=lambda kv: (-kv[1], kv[0]))[:10]
    cold = sorted(means.items(), key=lambda kv: (kv[1], kv[0]))[:10]
    assert [tuple(r) for r in daily.top10_hot_days(src).collect()] == hot
    assert [tuple(r) for r in daily.top10_cold_days(src).collect()] == cold

    # trend: latest three days, means over readings with both temperature and humidity
    pairs = {d: [(t, h) for t, h, _ in rs if t is not None and h is not None]
             for d, rs in by_day.items()}
    latest = sorted((d for d in pairs if pairs[d]), reverse=True)[:3]
    t = [mean([p[0] for p in pairs[d]]) for d in latest]
    h = [mean([p[1] for p in pairs[d]]) for d in latest]
    flag = (t[0] > 4.9e-324 and t[1] > t[0] and t[2] > t[1] and h[1] < h[0] and h[2] < h[1])
    row = daily.last_3_days_trend(src).first()
    assert (row.day_minus_1, row.day_minus_2, row.day_minus_3) == tuple(latest)
    assert (row.avg_temp1, row.avg_hum3) == (half_up(t[0], 2), half_up(h[2], 2))
    assert row.isGettingHotter is flag


@pytest.mark.parametrize("seed", [4, 5])
def test_hourly_results_match_brute_force(spark, seed):
    rows = weather_rows(seed, n=500, days=2)
    src = spark_weather(spark, rows)
    temps, rains = defaultdict(list), defaultdict(list)
    for ts, t, _, r in rows:
        if num(t) is not None:
            temps[ts[:13]].append(num(t))
        if num(r) is not None:
            rains[ts[:13]].append(num(r))
    want_t = sorted((hr, half_up(mean(v), 9)) for hr, v in temps.items() if mean(v) > -1)
    got_t = sorted(tuple(r) for r in hourly.temperature_alert(hourly_weather(src)).collect())
    assert [g[0] for g in got_t] == [w[0] for w in want_t]
    assert all(abs(g[1] - w[1]) <= 1e-9 for g, w in zip(got_t, want_t))
    # rain: NaN makes the hour's mean NaN, and NaN > -1 is false in Java
    want_r = {hr for hr, v in rains.items() if not math.isnan(mean(v)) and mean(v) > -1}
    got_r = hourly.dont_irrigate(hourly_weather(src), with_bounds=True).collect()
    assert {r.interval_start.strftime("%Y-%m-%d %H") for r in got_r} == want_r

    soil = soil_rows(seed)
    ch = channel(spark, [(SOIL_TOPIC, soil_line(i, *r)) for i, r in enumerate(soil)])
    hs = hourly_soil(soil_readings(soil_records(ch)))
    water, pair = defaultdict(list), defaultdict(list)
    for ts, w0, t0, w1, t1 in soil:
        w0, t0, w1, t1 = map(num, (w0, t0, w1, t1))
        if w0 is not None and w1 is not None:
            water[ts[:13]].append((w0 + w1) / 2)
            if t0 is not None and t1 is not None:
                pair[ts[:13]].append(((w0 + w1) / 2, (t0 + t1) / 2))
    want_w = {hr for hr, v in water.items() if mean(v) < 0.249}
    got_w = {r.hour for r in hourly.water_content_alert(hs).collect()}
    assert got_w == want_w
    want_c = {hr for hr, v in pair.items()
              if mean([p[1] for p in v]) > -1 and mean([p[0] for p in v]) < 0.5}
    assert {r.hour for r in hourly.combined_sickness_alert(hs).collect()} == want_c
    ratios = {r.hour: r.waterTemperatureRatio for r in hourly.water_temperature_ratio(hs).collect()}
    assert set(ratios) == set(pair)
    for hr, v in pair.items():
        mt = mean([p[1] for p in v])
        if mt == 0:
            assert ratios[hr] is None
        else:
            assert abs(ratios[hr] - mean([p[0] for p in v]) / mt) <= 1e-8 * max(1, abs(ratios[hr]))
