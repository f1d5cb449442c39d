"""Line routing, splitting and the reject policy."""

from conftest import SOIL_TOPIC, WEATHER_TOPIC, channel, soil_line, weather_line

from agrosense.functions.columns import field_count
from agrosense.operators.parse import rejected_lines, route, soil_records, weather_records
from agrosense.operators.publish import publish
from agrosense.operators.readings import weather_readings
from agrosense.schemas import WEATHER_FIELDS
from pyspark.sql import functions as F


def test_route_classifies_by_mark_weather_first(spark):
    ch = channel(spark, [("iotData_meteo_x", "a"), ("iotData_suolo_3_x", "b"),
                         ("iotData_altro", "c"), ("meteo_suolo", "d")])
    got = {r.topic: r.kind for r in route(ch).collect()}
    assert got == {"iotData_meteo_x": "meteo", "iotData_suolo_3_x": "suolo",
                   "iotData_altro": None, "meteo_suolo": "meteo"}


def test_route_subscription_is_exact_match(spark):
    ch = channel(spark, [(WEATHER_TOPIC, "a"), (WEATHER_TOPIC + "_old", "b")])
    assert [r.value for r in route(ch, [WEATHER_TOPIC]).collect()] == ["a"]


def test_weather_split_keeps_empty_last_field(spark):
    line = weather_line(1, "2020-01-02 03:04:05", 10.5, 60, 0.0)
    assert line.endswith(";")
    rec = weather_records(channel(spark, [(WEATHER_TOPIC, line)])).first()
    assert rec["data_ora"] == "2020-01-02 03:04:05"
    assert rec["temp1_media"] == "10.5"
    assert rec["rad_W/mq_array"] == ""
    assert rec["temp1_min"] == ""
    assert list(rec.asDict()) == ["topic", *WEATHER_FIELDS]


def test_quoted_separator_is_one_field(spark):
    df = spark.createDataFrame([('1;"2;3"',)], "value STRING")
    assert df.select(field_count("value")).first()[0] == 2
    parts = df.select(F.from_csv("value", "a STRING, b STRING", {"sep": ";"}).alias("p")).first().p
    assert (parts.a, parts.b) == ("1", "2;3")


def test_rejects_short_lines_and_unknown_topics(spark):
    ch = channel(spark, [
        (WEATHER_TOPIC, "1;2;3;4;5"),
        (SOIL_TOPIC, "1;2;3"),
        ("iotData_altro", weather_line(1, "2020-01-02 03:04:05", 1.0)),
        (WEATHER_TOPIC, weather_line(2, "2020-01-02 03:04:05", 1.0)),
    ])
    got = sorted((r.topic, r.reason) for r in rejected_lines(ch).collect())
    assert got == [("iotData_altro", "unknown_topic"),
                   (WEATHER_TOPIC, "too_few_fields"),
                   (SOIL_TOPIC, "too_few_fields")]
    assert weather_records(ch).count() == 1
    assert soil_records(ch).count() == 0


def test_soil_keeps_named_positions_and_drops_extra_fields(spark):
    line = soil_line(7, "2020-01-02 03:04:05", 0.2, 11.0, 0.3, 12.0) + ";x;y;z"
    rec = soil_records(channel(spark, [(SOIL_TOPIC, line)])).first().asDict()
    assert rec == {"topic": SOIL_TOPIC, "_id": "7", "timestamp": "2020-01-02 03:04:05",
                   "water_0": "0.2", "temperature_0": "11.0", "water_1": "0.3",
                   "temperature_1": "12.0"}


def test_publish_then_parse_round_trip_with_separator_inside_field(spark):
    src = spark.createDataFrame(
        [("1", "2020-01-02 03:04:05", "a;b", "60")],
        "id STRING, t STRING, temp STRING, hum STRING")
    fields = ["id", "t", "temp", None, None, "hum"] + [None] * 14
    ch = publish(src, F.lit("meteo_2020"), fields)
    row = ch.first()
    assert row.topic == "iotData_meteo_2020"
    rec = weather_records(ch).first()
    assert rec["temp1_media"] == "a;b" and rec["ur1_media"] == "60"


def test_bad_numbers_and_times_become_null(spark):
    ch = channel(spark, [
        (WEATHER_TOPIC, weather_line(1, "2020-01-02 03:04:05", "x", 50, 0)),
        (WEATHER_TOPIC, weather_line(2, "2020-01-02T03:04:05", 1.0, 50, 0)),
        (WEATHER_TOPIC, weather_line(3, "2020-01-02 03:04:05", "NaN", 50, 0)),
    ])
    r = {x._id: x for x in weather_readings(weather_records(ch)).collect()}
    assert r["1"].temp1_media is None and r["1"].day == "2020-01-02"
    # the day needs the first ten characters only, the hour an hour after a space
    assert r["2"].event_time is None and r["2"].day == "2020-01-02" and r["2"].hour is None
    assert r["3"].temp1_media != r["3"].temp1_media  # NaN
    assert r["1"].hour == "2020-01-02 03"


def test_rejected_readings_name_the_failing_field(spark):
    from agrosense.operators.readings import rejected_readings

    ch = channel(spark, [
        (WEATHER_TOPIC, weather_line(1, "2020-01-02 03:04:05", "x", 50, 0)),
        (WEATHER_TOPIC, weather_line(2, "bad time", 1.0, 50, 0)),
        (WEATHER_TOPIC, weather_line(3, "2020-01-02 03:04:05", 1.0, 50, "?")),
        (WEATHER_TOPIC, weather_line(4, "2020-01-02 03:04:05", 1.0, 50, 0)),
    ])
    readings = weather_readings(weather_records(ch))
    got = {r._id: r.reason for r in
           rejected_readings(readings, ["temp1_media", "pioggia_mm"]).collect()}
    assert got == {"1": "bad_number:temp1_media", "2": "bad_timestamp",
                   "3": "bad_number:pioggia_mm"}
    assert rejected_readings(readings, ["temp1_media"]).count() == 2


def test_fail_policy_stops_on_bad_text(spark):
    import pytest

    ch = channel(spark, [(WEATHER_TOPIC, weather_line(1, "2020-01-02 03:04:05", "x", 50, 0))])
    with pytest.raises(Exception) as err:
        weather_readings(weather_records(ch), on_error="fail").collect()
    assert "not a number: x" in str(err.value)
    ok = channel(spark, [(WEATHER_TOPIC, weather_line(1, "2020-01-02 03:04:05", 1.5, 50, 0))])
    assert weather_readings(weather_records(ok), on_error="fail").first().temp1_media == 1.5


def test_publish_parse_round_trip_random_fields(spark):
    import random

    rnd = random.Random(11)
    alphabet = ["a", "1", ";", '"', " ", ".", ",", "\\\\", "x"]
    rows = []
    for i in range(300):
        fields = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(0, 6)))
                  if rnd.random() > 0.1 else None for _ in range(20)]
        fields[0] = str(i)
        rows.append(tuple(fields))
    src = spark.createDataFrame(rows, ", ".join(f"f{i} STRING" for i in range(20)))
    ch = publish(src, F.lit("meteo_x"), [f"f{i}" for i in range(20)])
    got = {r["_id"]: tuple(r[f] for f in WEATHER_FIELDS) for r in weather_records(ch).collect()}
    assert len(got) == 300
    for row in rows:
        assert got[row[0]] == tuple("" if v is None else v for v in row), row


def test_malformed_lines_never_fail_the_job(spark):
    from agrosense.operators.readings import soil_readings

    bad = ['1;"2;3', '"', '";;;;;;;;;;;;;;;;;;;;', ';' * 25, 'a"b;c"d;' * 5, '\\";\\"' * 8, '']
    ch = channel(spark, [(t, v) for v in bad for t in (WEATHER_TOPIC, SOIL_TOPIC)])
    w = weather_readings(weather_records(ch)).collect()
    s = soil_readings(soil_records(ch)).collect()
    r = rejected_lines(ch).collect()
    assert len(w) + len(s) + len(r) == 2 * len(bad)
    assert all(x.temp1_media is None for x in w)
