"""Adapter: the generated ``events`` table -> sensor channel records.

The reference ships no sensor data. ``events`` is mapped to one weather station and nine
soil nodes with plain column expressions (one projection, no shuffle, no union), so every
query's work grows with ``events``. The same mapping is written in SQL for the oracle.

Mapping (fixed values of the test adapter):
  k              = first integer in ``props``
  topic          = ``iotData_meteo_2024`` for view/click events,
                   else ``iotData_suolo_<1 + user_id % 9>_2024``
  temp1_media    = value / 5 - 2
  ur1_media      = k
  pioggia_mm     = k - 89 on days divisible by 3 when k >= 90, else 0
  water_0        = k / 200
  water_1        = ((k * 7) % 100) / 200
  temperature_0  = value / 10 - 3
  temperature_1  = value / 10 - 2
  _id            = event_id
  time text      = ts as ``yyyy-MM-dd HH:mm:ss``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrosense.schemas import (
    SEPARATOR,
    SOIL_MIN_FIELDS,
    SOIL_POSITIONS,
    TIME_FORMAT,
    WEATHER_FIELDS,
)

WEATHER_EVENT_TYPES = ("view", "click")
WEATHER_TOPIC = "iotData_meteo_2024"
SOIL_NODES = 9


def sensor_events(events: DataFrame) -> DataFrame:
    """Typed sensor columns for every event (both kinds computed; ``is_weather`` picks).

    Written as SQL expressions — the same text as the oracle's adapter — so building the
    plan is two calls instead of hundreds of column-object round trips.
    """
    weather_types = ", ".join(f"'{t}'" for t in WEATHER_EVENT_TYPES)
    base = events.selectExpr(
        "CAST(event_id AS STRING) AS _id",
        f"date_format(ts, '{TIME_FORMAT}') AS time_text",
        "value",
        "ts",
        "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k",
        f"coalesce(event_type IN ({weather_types}), false) AS is_weather",
        f"CASE WHEN event_type IN ({weather_types}) THEN '{WEATHER_TOPIC}' "
        f"ELSE concat('iotData_suolo_', CAST(1 + user_id % {SOIL_NODES} AS STRING), '_2024') "
        "END AS topic",
    )
    return base.selectExpr(
        "topic", "is_weather", "_id", "time_text",
        "value / 5 - 2 AS temp1_media",
        "CAST(k AS DOUBLE) AS ur1_media",
        "CASE WHEN day(ts) % 3 = 0 AND k >= 90 THEN CAST(k - 89 AS DOUBLE) "
        "ELSE CAST(0 AS DOUBLE) END AS pioggia_mm",
        "CAST(k AS DOUBLE) / 200 AS water_0",
        "CAST((k * 7) % 100 AS DOUBLE) / 200 AS water_1",
        "value / 10 - 3 AS temperature_0",
        "value / 10 - 2 AS temperature_1",
    )


def _join(fields) -> Column:
    # The adapter's fields are numbers, ids and time text: never a separator or a quote, so
    # a plain join is the line (``operators.publish`` quotes when fields may need it).
    return F.concat_ws(SEPARATOR, *[F.coalesce(F.col(f).cast("string"), F.lit(""))
                                    if f else F.lit("") for f in fields])


def _weather_line():
    named = {"_id": "_id", "data_ora": "time_text", "temp1_media": "temp1_media",
             "ur1_media": "ur1_media", "pioggia_mm": "pioggia_mm"}
    return _join([named.get(f) for f in WEATHER_FIELDS])


def _soil_line():
    by_pos = {pos: name for name, pos in SOIL_POSITIONS.items()}
    source = {"timestamp": "time_text"}
    return _join([source.get(by_pos[i], by_pos[i]) if i in by_pos else None
                  for i in range(SOIL_MIN_FIELDS)])


def channel_records(events: DataFrame) -> DataFrame:
    """``events`` -> ``(topic, value)``: one reading line per event.

    The line comes out of a generator (``explode`` of a one-element array), as from a source:
    the optimizer pushes no filter on ``value`` below it, which would rebuild the line once
    per reference, while filters on ``topic`` go through to ``events``. One pass, no shuffle.
    """
    s = sensor_events(events)
    line = F.when(F.col("is_weather"), _weather_line()).otherwise(_soil_line())
    return s.select("topic", F.explode(F.array(line)).alias("value"))


def _text(source: str | None, name: str) -> str:
    # One SQL projection for all fields keeps plan building to a single call.
    value = f"coalesce(cast({source} AS STRING), '')" if source else "''"
    return f"{value} AS `{name}`"


def stored_weather_records(events: DataFrame) -> DataFrame:
    """The stored weather table as the raw archive would hold it (text fields, no line).

    Equal, row for row, to ``parse.weather_records(channel_records(events))``; batch
    queries read this the way the reference's batch jobs read stored documents.
    """
    s = sensor_events(events.where(F.col("event_type").isin(*WEATHER_EVENT_TYPES)))
    source = {"_id": "_id", "data_ora": "time_text", "temp1_media": "temp1_media",
              "ur1_media": "ur1_media", "pioggia_mm": "pioggia_mm"}
    return s.selectExpr("topic", *[_text(source.get(f), f) for f in WEATHER_FIELDS])


def stored_soil_records(events: DataFrame) -> DataFrame:
    """The stored soil table (topic + six named text fields)."""
    s = sensor_events(events.where(F.col("event_type").isNull()
                                   | ~F.col("event_type").isin(*WEATHER_EVENT_TYPES)))
    source = {"timestamp": "time_text"}
    return s.selectExpr("topic", *[_text(source.get(f, f), f) for f in SOIL_POSITIONS])
