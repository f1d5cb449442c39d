"""Daily and hourly aggregates, shared by the batch and the streaming queries.

Every aggregate is algebraic (count, sum/avg, count_if, bool_or), so Spark combines
map-side (partial ``HashAggregate``) and shuffles one row per key per partition: a hot
sensor or a hot day costs no more than a cold one. One ``daily`` frame feeds all five
daily queries and one ``hourly`` frame per sensor kind feeds the hourly ones; columns a
query does not use are pruned from the aggregate by the optimizer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrosense.functions.columns import hour_text, java_gt
from agrosense.params import DEFAULT, Thresholds


VALID = "_valid_key"


def _valid_key(key: str) -> Column:
    # Readings whose time text does not parse have a null key. Their group is dropped after
    # the aggregate instead of filtering rows before it: a row filter on the key would be
    # pushed down to the scan and parse every time text a second time there.
    return F.bool_and(F.col(key).isNotNull()).alias(VALID)


def _keep_valid(agg: DataFrame) -> DataFrame:
    return agg.where(F.col(VALID)).drop(VALID)


def daily_weather(readings: DataFrame, th: Thresholds = DEFAULT) -> DataFrame:
    """Per day: means of temperature and humidity, plus the inputs of ``days_to_water``.

    Columns: day, avg_temp, n_temp, avg_humidity, n_humidity (each over the readings where
    that field is a number); trend_temp, trend_humidity, n_trend (readings where both are);
    totTempOver22, isRained, n_water (readings where temperature and rain both are).
    """
    t, h, r = F.col("temp1_media"), F.col("ur1_media"), F.col("pioggia_mm")
    th_ok = t.isNotNull() & h.isNotNull()
    tr_ok = t.isNotNull() & r.isNotNull()
    return _keep_valid(
        readings.groupBy("day")
        .agg(
            _valid_key("day"),
            F.avg(t).alias("avg_temp"),
            F.count(t).alias("n_temp"),
            F.avg(h).alias("avg_humidity"),
            F.count(h).alias("n_humidity"),
            F.avg(F.when(th_ok, t)).alias("trend_temp"),
            F.avg(F.when(th_ok, h)).alias("trend_humidity"),
            F.count_if(th_ok).alias("n_trend"),
            F.count_if(tr_ok & java_gt(t, th.hot_reading_min)).alias("totTempOver22"),
            F.bool_or(tr_ok & java_gt(r, th.rain_reading_min)).alias("isRained"),
            F.count_if(tr_ok).alias("n_water"),
        )
    )


def daily_partials(readings: DataFrame, th: Thresholds = DEFAULT) -> DataFrame:
    """Additive per-(topic, day) pieces of every ``daily_weather`` measure.

    Sums, counts, conditional counts and any-flags add up across pieces, so partials
    written per micro-batch (or per file, or per load) combine into the exact daily frame
    with ``daily_from_partials`` — without re-reading the readings. The hot-reading and rain
    thresholds are applied here, so partials serve those thresholds only.
    """
    t, h, r = F.col("temp1_media"), F.col("ur1_media"), F.col("pioggia_mm")
    th_ok = t.isNotNull() & h.isNotNull()
    tr_ok = t.isNotNull() & r.isNotNull()
    return _keep_valid(
        readings.groupBy("topic", "day")
        .agg(
            _valid_key("day"),
            F.sum(t).alias("sum_temp"),
            F.count(t).alias("n_temp"),
            F.sum(h).alias("sum_humidity"),
            F.count(h).alias("n_humidity"),
            F.sum(F.when(th_ok, t)).alias("sum_trend_temp"),
            F.sum(F.when(th_ok, h)).alias("sum_trend_humidity"),
            F.count_if(th_ok).alias("n_trend"),
            F.count_if(tr_ok & java_gt(t, th.hot_reading_min)).alias("totTempOver22"),
            F.bool_or(tr_ok & java_gt(r, th.rain_reading_min)).alias("isRained"),
            F.count_if(tr_ok).alias("n_water"),
        )
    ).withColumns({"hot_reading_min": F.lit(float(th.hot_reading_min)),
                   "rain_reading_min": F.lit(float(th.rain_reading_min))})


def daily_from_partials(partials: DataFrame, th: Thresholds = DEFAULT) -> DataFrame:
    """Combine ``daily_partials`` into the ``daily_weather`` frame (same columns).

    Fails on partials that were written with other thresholds than ``th``."""
    def mean(total: str, count: str):
        return F.try_divide(F.sum(total), F.sum(count))

    same = ((F.col("hot_reading_min") == float(th.hot_reading_min))
            & (F.col("rain_reading_min") == float(th.rain_reading_min)))
    partials = partials.withColumns({c: F.when(same, F.col(c)).otherwise(
        F.raise_error(F.lit("daily partials were written with other thresholds")).cast(t))
        for c, t in (("totTempOver22", "long"), ("isRained", "boolean"))})
    return partials.groupBy("day").agg(
        mean("sum_temp", "n_temp").alias("avg_temp"),
        F.sum("n_temp").alias("n_temp"),
        mean("sum_humidity", "n_humidity").alias("avg_humidity"),
        F.sum("n_humidity").alias("n_humidity"),
        mean("sum_trend_temp", "n_trend").alias("trend_temp"),
        mean("sum_trend_humidity", "n_trend").alias("trend_humidity"),
        F.sum("n_trend").alias("n_trend"),
        F.sum("totTempOver22").alias("totTempOver22"),
        F.bool_or("isRained").alias("isRained"),
        F.sum("n_water").alias("n_water"),
    )


def hourly_partials(readings: DataFrame, kind: str) -> DataFrame:
    """Additive per-(topic, hour) sums and counts of one sensor kind (``meteo`` or ``suolo``).

    Written per micro-batch they combine into complete hours with ``hourly_from_partials``,
    late readings included: nothing here waits for, or is dropped by, a watermark."""
    if kind == "meteo":
        values = {"temp": F.col("temp1_media"), "rain": F.col("pioggia_mm")}
    else:
        w, st = F.col("water"), F.col("soil_temp")
        both = w.isNotNull() & st.isNotNull()
        values = {"water": w, "pair_water": F.when(both, w), "pair_temp": F.when(both, st)}
    aggs = [a for name, v in values.items()
            for a in (F.sum(v).alias(f"sum_{name}"), F.count(v).alias(f"n_{name}"))]
    return _keep_valid(readings.groupBy("topic", "hour").agg(_valid_key("hour"), *aggs))


def hourly_from_partials(partials: DataFrame, kind: str) -> DataFrame:
    """Combine ``hourly_partials`` into the frame of ``hourly_weather`` or ``hourly_soil``."""
    def mean(name: str):
        return F.try_divide(F.sum(f"sum_{name}"), F.sum(f"n_{name}"))

    group = partials.groupBy("topic", "hour")
    if kind == "meteo":
        return group.agg(mean("temp").alias("avg_temp"), F.sum("n_temp").alias("n_temp"),
                         mean("rain").alias("avg_rain"), F.sum("n_rain").alias("n_rain"))
    return group.agg(mean("water").alias("avg_water"), F.sum("n_water").alias("n_water"),
                     mean("pair_water").alias("pair_water"), mean("pair_temp").alias("pair_temp"),
                     F.sum("n_pair_temp").alias("n_pair"))


def _hourly(readings: DataFrame, by: str, window: str, aggs: list[Column],
            measures: list[str]) -> DataFrame:
    group, out = _hour_keys(by, window)
    if by == "text":
        agg = _keep_valid(readings.groupBy(*group).agg(_valid_key("hour"), *aggs))
    else:  # event-time windows: a reading without a time belongs to no window
        agg = readings.where(F.col("event_time").isNotNull()).groupBy(*group).agg(*aggs)
    return agg.select(*out, *measures)


def _hour_keys(by: str, window: str) -> tuple[list[Column], list[Column]]:
    if by == "text":
        return [F.col("topic"), F.col("hour")], [F.col("topic"), F.col("hour")]
    if by == "window":
        w = F.window("event_time", window).alias("window")
        return [F.col("topic"), w], [F.col("topic"), hour_text(F.col("window.start")).alias("hour"),
                                     F.col("window.start").alias("window_start"),
                                     F.col("window.end").alias("window_end")]
    raise ValueError("by must be 'text' or 'window'")


def hourly_weather(readings: DataFrame, by: str = "text", window: str = "1 hour") -> DataFrame:
    """Per weather topic and hour: mean temperature and mean rain (each over its numbers).

    ``by='text'`` keys on the hour prefix of the time text (batch); ``by='window'`` keys on
    a tumbling event-time window (streaming, after ``withWatermark``). Both give the same
    rows for closed hours.
    """
    t, r = F.col("temp1_media"), F.col("pioggia_mm")
    aggs = [F.avg(t).alias("avg_temp"), F.count(t).alias("n_temp"),
            F.avg(r).alias("avg_rain"), F.count(r).alias("n_rain")]
    return _hourly(readings, by, window, aggs, ["avg_temp", "n_temp", "avg_rain", "n_rain"])


def hourly_soil(readings: DataFrame, by: str = "text", window: str = "1 hour") -> DataFrame:
    """Per soil topic and hour: mean probe-pair water, and the pair means used together.

    avg_water / n_water: over readings with both water probes; pair_water, pair_temp /
    n_pair: over readings with all four probe values (ratio and combined alert).
    """
    w, st = F.col("water"), F.col("soil_temp")
    pair_ok = w.isNotNull() & st.isNotNull()
    aggs = [F.avg(w).alias("avg_water"), F.count(w).alias("n_water"),
            F.avg(F.when(pair_ok, w)).alias("pair_water"),
            F.avg(F.when(pair_ok, st)).alias("pair_temp"),
            F.count_if(pair_ok).alias("n_pair")]
    return _hourly(readings, by, window, aggs,
                   ["avg_water", "n_water", "pair_water", "pair_temp", "n_pair"])
