"""Routing and splitting of channel records into stored reading records.

One subscription carries every sensor; the topic stays a column instead of becoming one
stream per topic (the reference filters the full stream once per topic and output). A line
is split once, on the separator; only lines with a field that begins with a quote take the
quote-aware pattern. Soil lines keep the six named positions.

Reject policy: a line is rejected when its topic is neither weather nor soil
(``unknown_topic``), its value is null (``null_value``), a quoted field is not closed
(``bad_quote``) or it has fewer fields than its layout (``too_few_fields``). Numeric and time
fields are checked later, per query, on the fields each query uses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrosense.functions.columns import bad_quote, field_count, line_fields
from agrosense.schemas import (
    SOIL_MARK,
    SOIL_MIN_FIELDS,
    SOIL_POSITIONS,
    WEATHER_FIELDS,
    WEATHER_MARK,
    WEATHER_MIN_FIELDS,
)

KIND_WEATHER = "meteo"
KIND_SOIL = "suolo"


def kind_of(topic) -> Column:
    """Channel class by name mark; weather is tested first, unknown -> null."""
    t = F.col(topic) if isinstance(topic, str) else topic
    return (F.when(t.contains(WEATHER_MARK), F.lit(KIND_WEATHER))
            .when(t.contains(SOIL_MARK), F.lit(KIND_SOIL)))


def route(channel: DataFrame, topics: Sequence[str] | None = None) -> DataFrame:
    """Keep the subscribed topics (exact match) and tag each record with its ``kind``."""
    df = channel.select("topic", "value")
    if topics:
        df = df.where(F.col("topic").isin(*topics))
    return df.withColumn("kind", kind_of("topic"))


def _split(routed: DataFrame) -> DataFrame:
    """``topic, kind, parts``: each line split once. The one-element ``explode`` keeps filters
    on the parts above the split; filters on topic and kind still go below it."""
    return routed.select("topic", "kind", F.explode(F.array(line_fields("value"))).alias("parts"))


def _field(pos: int, name: str) -> str:
    # An empty or missing field of a quoted line is the empty string, as in a plain line.
    return f"coalesce(get(parts, {pos}), '') AS `{name}`"


def weather_records(channel: DataFrame, topics: Sequence[str] | None = None) -> DataFrame:
    """Weather lines -> ``topic`` + the twenty named string fields."""
    lines = _split(route(channel, topics).where(F.col("kind") == KIND_WEATHER))
    return (lines.where(F.size("parts") >= WEATHER_MIN_FIELDS)
            .selectExpr("topic", *[_field(i, name) for i, name in enumerate(WEATHER_FIELDS)]))


def soil_records(channel: DataFrame, topics: Sequence[str] | None = None) -> DataFrame:
    """Soil lines -> ``topic`` + the six named string fields (other positions dropped)."""
    lines = _split(route(channel, topics).where(F.col("kind") == KIND_SOIL))
    return (lines.where(F.size("parts") >= SOIL_MIN_FIELDS)
            .selectExpr("topic", *[_field(pos, name) for name, pos in SOIL_POSITIONS.items()]))


def rejected_lines(channel: DataFrame, topics: Sequence[str] | None = None) -> DataFrame:
    """Lines no record is made of, with the reason. Every line of a subscribed topic is either
    here or in one of the record tables."""
    routed = route(channel, topics).withColumns(
        {"n_fields": field_count("value"), "bad": F.coalesce(bad_quote("value"), F.lit(False))})
    least = F.when(F.col("kind") == KIND_WEATHER, F.lit(WEATHER_MIN_FIELDS)).otherwise(
        F.lit(SOIL_MIN_FIELDS))
    reason = (F.when(F.col("kind").isNull(), F.lit("unknown_topic"))
              .when(F.col("value").isNull(), F.lit("null_value"))
              .when(F.col("bad"), F.lit("bad_quote"))
              .when(F.col("n_fields") < least, F.lit("too_few_fields")))
    return (routed.withColumn("reason", reason).where(F.col("reason").isNotNull())
            .select("topic", "value", "n_fields", "reason"))
