"""Record layouts and result schemas.

Readings travel as one delimited text line per reading. Weather lines carry twenty
positional fields; soil lines carry at least eleven, of which six are named. The stored
(bronze) record keeps every named field as a string, exactly as received; typed views
are derived from it per query.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------
# These must equal the reference for identical results.
# Field separator of a reading line.
SEPARATOR = ";"
# Prefix joined with "_" and the source name to form a channel (topic) name.
TOPIC_PREFIX = "iotData"
# Substrings that classify a channel; weather is tested first.
WEATHER_MARK = "meteo"
SOIL_MARK = "suolo"
# Default subscription list of the streaming job (one weather station, nine soil nodes).
DEFAULT_TOPICS = (
    "iotData_meteo_2020_gennaio_marzo",
    "iotData_suolo_1_2020",
    "iotData_suolo_2_2020",
    "iotData_suolo_3_2020",
    "iotData_suolo_4_2020",
    "iotData_suolo_5_2020",
    "iotData_suolo_6_2020",
    "iotData_suolo_7_2020",
    "iotData_suolo_8_2020",
    "iotData_suolo_9_2020",
)
# Weather line: field names in position order 0..19.
WEATHER_FIELDS = (
    "_id",
    "data_ora",
    "temp1_media",
    "temp1_min",
    "temp1_max",
    "ur1_media",
    "ur1_min",
    "ur1_max",
    "temp1_ur1_n_letture",
    "pioggia_mm",
    "wind_dir",
    "wind_dir_n_letture",
    "wind_speed_media",
    "wind_speed_min",
    "wind_speed_max",
    "wind_speed_n_letture",
    "pressione_mbar",
    "pressione_standard_mbar",
    "pressione_n_letture",
    "rad_W/mq_array",
)
# Soil line: named field -> position. Positions 1, 2, 5, 7 and 9 are unnamed and not kept.
SOIL_POSITIONS = {
    "_id": 0,
    "timestamp": 3,
    "water_0": 4,
    "temperature_0": 6,
    "water_1": 8,
    "temperature_1": 10,
}
# Text layout of a reading's time field.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_FORMAT = "yyyy-MM-dd"
HOUR_FORMAT = "yyyy-MM-dd HH"
# java.util.Date#toString layout, used for the irrigation interval text.
DATE_TEXT_FORMAT = "EEE MMM dd HH:mm:ss zzz yyyy"
# ---------------------------------------------------------------------------------------

# Channel lines quote like RFC 4180: a field holding the separator or a quote is quoted and
# a quote inside it doubled (``a"b`` -> ``"a""b"``); backslashes are ordinary characters and
# spaces are kept (the CSV writer would trim them by default).
LINE_CSV_OPTIONS = {"sep": SEPARATOR, "quote": '"', "escape": '"',
                    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

WEATHER_MIN_FIELDS = len(WEATHER_FIELDS)
SOIL_MIN_FIELDS = max(SOIL_POSITIONS.values()) + 1
SOIL_FIELDS = tuple(SOIL_POSITIONS)

# Channel record: what a message bus (or a file of messages) delivers.
CHANNEL_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("value", T.StringType()),
])


# Result schemas (column names as the reference stores them).
RESULT_COLUMNS = {
    "last_3_days_trend": ("day_minus_1", "avg_temp1", "avg_hum1", "day_minus_2", "avg_temp2",
                          "avg_hum2", "day_minus_3", "avg_temp3", "avg_hum3", "isGettingHotter"),
    "days_to_water": ("day", "totTempOver22", "isRained"),
    "top10_hot_days": ("day", "avg_temp"),
    "top10_cold_days": ("day", "avg_temp"),
    "top10_humid_days": ("day", "avg_humidity"),
    "temperature_alert": ("hour", "highTemperature"),
    "water_content_alert": ("topic", "hour", "lowWaterContent"),
    "dont_irrigate": ("interval", "rain"),
    "water_temperature_ratio": ("topic", "hour", "waterTemperatureRatio"),
    "combined_sickness_alert": ("topic", "hour", "lowWaterContent", "highTemperature"),
}
