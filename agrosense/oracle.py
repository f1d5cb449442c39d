"""Oracle SQL (DuckDB) for every registered query, over the same parquet tables.

The oracle computes from the typed adapter columns directly (no line round trip), so a
match also checks publishing and parsing. Rounding goes through DECIMAL(38,18) because
DuckDB's ``round(double)`` is not half-up on the decimal value (``round(1.005, 2)``).
"""

from __future__ import annotations

from agrosense.schemas import WEATHER_FIELDS


def _r(expr: str, digits: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


ADAPTER = """
ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS time_text,
         coalesce(event_type IN ('view', 'click'), false) AS is_weather
  FROM events
),
weather AS (
  SELECT 'iotData_meteo_2024' AS topic, CAST(event_id AS VARCHAR) AS _id,
         time_text AS data_ora, substr(time_text, 1, 10) AS day, substr(time_text, 1, 13) AS hour,
         ts AS event_time,
         value / 5 - 2 AS temp1_media, CAST(k AS DOUBLE) AS ur1_media,
         CASE WHEN day(ts) % 3 = 0 AND k >= 90 THEN CAST(k - 89 AS DOUBLE)
              ELSE CAST(0 AS DOUBLE) END AS pioggia_mm
  FROM ev WHERE is_weather
),
soil AS (
  SELECT concat('iotData_suolo_', CAST(1 + user_id % 9 AS VARCHAR), '_2024') AS topic,
         CAST(event_id AS VARCHAR) AS _id, time_text AS "timestamp",
         substr(time_text, 1, 13) AS hour, ts AS event_time,
         CAST(k AS DOUBLE) / 200 AS water_0, value / 10 - 3 AS temperature_0,
         CAST((k * 7) % 100 AS DOUBLE) / 200 AS water_1, value / 10 - 2 AS temperature_1,
         (CAST(k AS DOUBLE) / 200 + CAST((k * 7) % 100 AS DOUBLE) / 200) / 2 AS water,
         ((value / 10 - 3) + (value / 10 - 2)) / 2 AS soil_temp
  FROM ev WHERE NOT is_weather
)"""


def _with(body: str, *extra: str) -> str:
    ctes = ",\n".join((ADAPTER.strip(),) + extra)
    return f"WITH {ctes}\n{body.strip()}"


DATE_TEXT = "'%a %b %d %H:%M:%S UTC %Y'"


def _top(value_expr: str, out: str, desc: bool) -> str:
    order = "DESC" if desc else "ASC"
    return _with(f"""
SELECT day, {_r(value_expr, 2)} AS {out}
FROM weather GROUP BY day
ORDER BY {out} {order}, day ASC
LIMIT 10""")


def _dont_irrigate(rain_min: float) -> str:
    start = "strptime(hour, '%Y-%m-%d %H')"
    return _with(f"""
SELECT strftime({start}, {DATE_TEXT}) || ' -> ' || strftime({start} + INTERVAL 12 HOUR, {DATE_TEXT})
         AS "interval",
       {_r('avg(pioggia_mm)', 9)} AS rain
FROM weather GROUP BY topic, hour
HAVING avg(pioggia_mm) > {rain_min}""")


_EMPTY = "''"
_WEATHER_RAW = [
    "CAST(event_id AS VARCHAR)", "time_text", "CAST(value / 5 - 2 AS VARCHAR)", _EMPTY, _EMPTY,
    "CAST(CAST(k AS DOUBLE) AS VARCHAR)", _EMPTY, _EMPTY, _EMPTY,
    "CAST(CASE WHEN day(ts) % 3 = 0 AND k >= 90 THEN CAST(k - 89 AS DOUBLE) "
    "ELSE CAST(0 AS DOUBLE) END AS VARCHAR)",
] + [_EMPTY] * 10



def _raw_meteo() -> str:
    cols = ",\n       ".join(f'{e} AS "{n}"' for e, n in zip(_WEATHER_RAW, WEATHER_FIELDS))
    return _with(f"""
SELECT 'iotData_meteo_2024' AS topic,
       {cols}
FROM ev WHERE is_weather""")


ORACLE_SQL: dict[str, str] = {
    "top10_hot_days": _top("avg(temp1_media)", "avg_temp", True),
    "top10_cold_days": _top("avg(temp1_media)", "avg_temp", False),
    "top10_humid_days": _top("avg(ur1_media)", "avg_humidity", True),
    "days_to_water": _with("""
SELECT day,
       count(*) FILTER (WHERE temp1_media > 22) AS "totTempOver22",
       bool_or(pioggia_mm > 0) AS "isRained"
FROM weather GROUP BY day
HAVING count(*) FILTER (WHERE temp1_media > 22) > 10 AND NOT bool_or(pioggia_mm > 0)"""),
    "last_3_days_trend": _with(f"""
SELECT day_minus_1, {_r('t1', 2)} AS avg_temp1, {_r('h1', 2)} AS avg_hum1,
       day_minus_2, {_r('t2', 2)} AS avg_temp2, {_r('h2', 2)} AS avg_hum2,
       day_minus_3, {_r('t3', 2)} AS avg_temp3, {_r('h3', 2)} AS avg_hum3,
       (t1 > CAST('4.9e-324' AS DOUBLE) AND h1 < CAST('1.7976931348623157e308' AS DOUBLE)
        AND t2 > t1 AND h2 < h1 AND t3 > t2 AND h3 < h2) AS "isGettingHotter"
FROM pivoted WHERE n_days = 3""",
        """daily AS (SELECT day, avg(temp1_media) AS t, avg(ur1_media) AS h
                  FROM weather GROUP BY day)""",
        """latest AS (SELECT day, t, h, row_number() OVER (ORDER BY day DESC) AS rn
                   FROM daily QUALIFY rn <= 3)""",
        """pivoted AS (
  SELECT count(*) AS n_days,
         max(CASE WHEN rn = 1 THEN day END) AS day_minus_1,
         max(CASE WHEN rn = 1 THEN t END) AS t1, max(CASE WHEN rn = 1 THEN h END) AS h1,
         max(CASE WHEN rn = 2 THEN day END) AS day_minus_2,
         max(CASE WHEN rn = 2 THEN t END) AS t2, max(CASE WHEN rn = 2 THEN h END) AS h2,
         max(CASE WHEN rn = 3 THEN day END) AS day_minus_3,
         max(CASE WHEN rn = 3 THEN t END) AS t3, max(CASE WHEN rn = 3 THEN h END) AS h3
  FROM latest)"""),
    "daily_means": _with(f"""
SELECT day, {_r('avg(temp1_media)', 2)} AS avg_temp, {_r('avg(ur1_media)', 2)} AS avg_humidity,
       count(*) AS n_readings
FROM weather GROUP BY day"""),
    "reading_count": _with("SELECT count(*) AS n_readings FROM weather"),
    "temperature_alert": _with(f"""
SELECT hour, {_r('avg(temp1_media)', 9)} AS "highTemperature"
FROM weather GROUP BY topic, hour
HAVING avg(temp1_media) > -1"""),
    "dont_irrigate": _dont_irrigate(-1),
    "dont_irrigate_rain_gt_0": _dont_irrigate(0),
    "water_content_alert": _with(f"""
SELECT topic, hour, {_r('avg(water)', 9)} AS "lowWaterContent"
FROM soil GROUP BY topic, hour
HAVING avg(water) < 0.249"""),
    "water_temperature_ratio": _with(f"""
SELECT topic, hour, {_r('avg(water) / nullif(avg(soil_temp), 0)', 9)} AS "waterTemperatureRatio"
FROM soil GROUP BY topic, hour"""),
    "combined_sickness_alert": _with(f"""
SELECT topic, hour, {_r('avg(water)', 9)} AS "lowWaterContent",
       {_r('avg(soil_temp)', 9)} AS "highTemperature"
FROM soil GROUP BY topic, hour
HAVING avg(soil_temp) > -1 AND avg(water) < 0.5"""),
    "route_topics": _with("""
SELECT topic, CASE WHEN topic LIKE '%meteo%' THEN 'meteo' WHEN topic LIKE '%suolo%' THEN 'suolo'
              END AS kind, count(*) AS n_records
FROM (SELECT topic FROM weather UNION ALL SELECT topic FROM soil) GROUP BY 1, 2"""),
    "raw_ingest_meteo": _raw_meteo(),
    "raw_ingest_soil": _with("""
SELECT topic, _id, "timestamp",
       CAST(water_0 AS VARCHAR) AS water_0, CAST(temperature_0 AS VARCHAR) AS temperature_0,
       CAST(water_1 AS VARCHAR) AS water_1, CAST(temperature_1 AS VARCHAR) AS temperature_1
FROM soil"""),
    "parse_lines_meteo": _with("""
SELECT topic, _id, data_ora, temp1_media, ur1_media, pioggia_mm FROM weather"""),
    "parse_lines_soil": _with("""
SELECT topic, _id, "timestamp", water_0, temperature_0, water_1, temperature_1 FROM soil"""),
}


HOURLY = ("temperature_alert", "dont_irrigate", "water_content_alert",
          "water_temperature_ratio", "combined_sickness_alert")


# Streaming forms: append mode emits an hour once the watermark (latest event time seen,
# minus the delay) has passed the hour's end; the last, still open hours are not emitted.
def _closed(kind: str, delay: str) -> str:
    return (f"strptime(hour, '%Y-%m-%d %H') + INTERVAL 1 HOUR <= "
            f"(SELECT date_trunc('second', max(event_time)) FROM {kind}) - INTERVAL {delay}")


_CLOSED_WEATHER = _closed("weather", "10 MINUTE")
_CLOSED_SOIL = _closed("soil", "1 HOUR")


def _stream_form(sql: str, closed: str) -> str:
    if "\nHAVING " in sql:
        return sql.replace("\nHAVING ", f"\nHAVING {closed} AND ", 1)
    return sql + f"\nHAVING {closed}"


ORACLE_SQL.update({
    "temperature_alert_stream": _stream_form(ORACLE_SQL["temperature_alert"], _CLOSED_WEATHER),
    "dont_irrigate_stream": _stream_form(ORACLE_SQL["dont_irrigate"], _CLOSED_WEATHER),
    "water_content_alert_stream": _stream_form(ORACLE_SQL["water_content_alert"], _CLOSED_SOIL),
    "water_temperature_ratio_stream": _stream_form(ORACLE_SQL["water_temperature_ratio"],
                                                   _CLOSED_SOIL),
    "combined_sickness_alert_stream": _stream_form(ORACLE_SQL["combined_sickness_alert"],
                                                   _CLOSED_SOIL),
    "raw_ingest_stream": ORACLE_SQL["raw_ingest_meteo"],
})

ORACLE_SQL.update({
    "csv_replay": ORACLE_SQL["parse_lines_meteo"],
    "csv_import": _with(f"""
SELECT topic, count(*) AS n_rows, min(CAST(_id AS BIGINT)) AS min_id,
       max(CAST(_id AS BIGINT)) AS max_id,
       min("timestamp") AS first_reading, max("timestamp") AS last_reading,
       {_r('avg(water)', 9)} AS avg_water
FROM soil GROUP BY topic"""),
    "route_topics_stream": ORACLE_SQL["route_topics"],
    "daily_means_rollup": ORACLE_SQL["daily_means"],
    # Three loads with a third of each hour; a micro-batch is aggregated on its own.
    **{f"{name}_per_batch": ORACLE_SQL[name].replace(
        "GROUP BY topic, hour", "GROUP BY topic, hour, minute(event_time) // 20")
       for name in HOURLY},
    "archive_top10_hot_days": ORACLE_SQL["top10_hot_days"],
    "archive_water_content_alert": ORACLE_SQL["water_content_alert"],
    "hourly_rollup": _with(f"""
SELECT topic, hour, {_r('avg(water)', 9)} AS avg_water, {_r('avg(water)', 9)} AS pair_water,
       {_r('avg(soil_temp)', 9)} AS pair_temp, count(*) AS n_water, count(*) AS n_pair
FROM soil GROUP BY topic, hour"""),
    "route_subscribed": _with("""
SELECT topic, CASE WHEN topic LIKE '%meteo%' THEN 'meteo' ELSE 'suolo' END AS kind,
       count(*) AS n_records
FROM (SELECT topic FROM weather UNION ALL SELECT topic FROM soil)
WHERE topic IN ('iotData_meteo_2024', 'iotData_suolo_3_2024') GROUP BY 1, 2"""),
    "suite_results": _with("""
SELECT 'last_3_days_trend' AS result, CAST(CASE WHEN count(*) >= 3 THEN 2 ELSE 0 END AS BIGINT) AS n_rows
FROM days
UNION ALL SELECT 'days_to_water', 2 * count(*) FILTER (WHERE hot > 10 AND NOT rained) FROM days
UNION ALL SELECT r, least(10, (SELECT count(*) FROM days))
FROM (VALUES ('top10_humid_days'), ('top10_hot_days'), ('top10_cold_days')) v(r)""",
        """days AS (SELECT day, count(*) FILTER (WHERE temp1_media > 22) AS hot,
                 bool_or(pioggia_mm > 0) AS rained FROM weather GROUP BY day)"""),
    "rejects_by_reason": _with("""
SELECT CASE event_id % 10 WHEN 5 THEN 'unknown_topic' WHEN 6 THEN 'null_value'
            WHEN 7 THEN 'too_few_fields' WHEN 8 THEN 'bad_quote'
            ELSE CASE WHEN is_weather THEN 'meteo' ELSE 'suolo' END END AS outcome,
       count(*) AS n_lines
FROM ev GROUP BY 1"""),
})

ORACLE_SQL["start_all_counts"] = "\nUNION ALL\n".join(
    [f"SELECT '{n}' AS output, count(*) AS n_rows FROM ({ORACLE_SQL[n + '_stream']})" for n in HOURLY]
    + [f"SELECT '{n}' AS output, count(*) AS n_rows FROM ({ORACLE_SQL[key]})"
       for n, key in (("meteo", "raw_ingest_meteo"), ("suolo", "raw_ingest_soil"))]
    + ["SELECT 'rejected' AS output, CAST(0 AS BIGINT) AS n_rows"])


# Tables on the commit log. A topic's hours close by its own latest reading, less the delay.
def _closed_by_topic(kind: str, delay: str, group: str, select: str) -> str:
    return _with(f"""
SELECT topic, hour, {select} FROM {kind}
GROUP BY topic, hour
HAVING strptime(hour, '%Y-%m-%d %H') + INTERVAL 1 HOUR <=
       (SELECT date_trunc('second', max(o.event_time)) FROM {kind} o WHERE o.topic = {group}.topic) - INTERVAL {delay}""")


ORACLE_SQL.update({
    "archive_log_meteo": ORACLE_SQL["raw_ingest_meteo"],
    "archive_log_two_days": _with("""
SELECT topic, _id, data_ora, temp1_media FROM weather, (SELECT max(data_ora)[1:10] AS last FROM weather)
WHERE data_ora < last AND data_ora >= strftime(CAST(last AS DATE) - INTERVAL 2 DAY, '%Y-%m-%d')"""),
    "daily_means_incremental": ORACLE_SQL["daily_means"],
    "hourly_rollup_meteo": _closed_by_topic("weather", "10 MINUTE", "weather", f"""{_r('avg(temp1_media)', 9)} AS avg_temp,
       {_r('avg(pioggia_mm)', 9)} AS avg_rain, count(*) AS n_temp, count(*) AS n_rain"""),
    "per_topic_hours": _closed_by_topic("soil", "1 HOUR", "soil", f"""{_r('avg(water)', 9)} AS avg_water,
       {_r('avg(soil_temp)', 9)} AS pair_temp, count(*) AS n_water, count(*) AS n_pair"""),
    # a reading is late if its hour ended before the watermark that the loads before its own left
    "late_reading_counts": _with("""
SELECT topic, count(*) FILTER (WHERE NOT late) AS n_used, count(*) FILTER (WHERE late) AS n_late,
       count(*) FILTER (WHERE late) AS n_kept
FROM judged GROUP BY topic""",
        """loaded AS (SELECT topic, hour, date_trunc('second', event_time) AS t, minute(event_time) // 20 AS load FROM soil)""",
        """reached AS (SELECT a.topic, l.load, max(a.t) AS before FROM loaded a, (VALUES (0), (1), (2)) l(load)
                WHERE a.load < l.load GROUP BY a.topic, l.load)""",
        """judged AS (SELECT loaded.topic, coalesce(strptime(hour, '%Y-%m-%d %H') + INTERVAL 1 HOUR
                       <= before - INTERVAL 1 HOUR, false) AS late
                FROM loaded LEFT JOIN reached ON loaded.topic = reached.topic AND loaded.load = reached.load)"""),
    "suite_once_values": f"""
SELECT 'last_3_days_trend' AS result, day_minus_1 AS day, avg_temp1 AS value, run_id
FROM ({ORACLE_SQL['last_3_days_trend']}), (VALUES ('run-1'), ('run-2')) r(run_id)
UNION ALL SELECT 'days_to_water', day, CAST("totTempOver22" AS DOUBLE), run_id
FROM ({ORACLE_SQL['days_to_water']}), (VALUES ('run-1'), ('run-2')) r(run_id)
UNION ALL SELECT 'top10_humid_days', day, avg_humidity, 'run-2' FROM ({ORACLE_SQL['top10_humid_days']})
UNION ALL SELECT 'top10_hot_days', day, avg_temp, 'run-2' FROM ({ORACLE_SQL['top10_hot_days']})
UNION ALL SELECT 'top10_cold_days', day, avg_temp, 'run-2' FROM ({ORACLE_SQL['top10_cold_days']})""",
})
