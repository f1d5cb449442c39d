import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from agrosense.schemas import CHANNEL_SCHEMA  # noqa: E402
from agrosense.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
WEATHER_TOPIC = "iotData_meteo_2020_gennaio_marzo"
SOIL_TOPIC = "iotData_suolo_1_2020"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app_name="agrosense-tests")
    yield s
    s.stop()


def weather_line(_id, data_ora, temp, hum=50.0, rain=0.0, radiation=""):
    fields = [""] * 20
    fields[0], fields[1], fields[2], fields[5], fields[9] = str(_id), data_ora, str(temp), str(hum), str(rain)
    fields[19] = radiation
    return ";".join(fields)


def soil_line(_id, ts, w0, t0, w1, t1):
    fields = [""] * 11
    fields[0], fields[3], fields[4], fields[6], fields[8], fields[10] = (
        str(_id), ts, str(w0), str(t0), str(w1), str(t1))
    return ";".join(fields)


def channel(spark, rows):
    """rows: list of (topic, line)."""
    return spark.createDataFrame(rows, CHANNEL_SCHEMA)


def weather_channel(spark, readings):
    """readings: list of (data_ora, temp, hum, rain) on the weather topic."""
    return channel(spark, [(WEATHER_TOPIC, weather_line(i, *r)) for i, r in enumerate(readings)])


def soil_channel(spark, readings, topic=SOIL_TOPIC):
    """readings: list of (ts, w0, t0, w1, t1)."""
    return channel(spark, [(topic, soil_line(i, *r)) for i, r in enumerate(readings)])


def rows(df, order=None):
    order = order or df.columns
    return [tuple(r) for r in df.orderBy(*order).collect()]
