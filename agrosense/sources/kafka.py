"""Message-bus channels (Kafka) as one subscription with ``topic`` as a column.

The reference subscribes to all sensor topics at once and splits the stream per topic;
here the subscription is one source and the topic stays a column. The Kafka connector jar
is not part of a plain PySpark install; with it on the classpath these functions run as
they are (``--packages org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version>``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrosense.schemas import DEFAULT_TOPICS


MAX_OFFSETS_PER_TRIGGER = 1_000_000


def kafka_channel(spark: SparkSession, bootstrap: str, topics: Sequence[str] = DEFAULT_TOPICS,
                  streaming: bool = True, starting_offsets: str | None = None,
                  options: dict | None = None,
                  max_offsets: int | None = MAX_OFFSETS_PER_TRIGGER) -> DataFrame:
    """Subscribe to ``topics`` and return ``(topic, value)`` with string values.

    ``topics`` may also be one comma-separated string, as in the reference's settings.
    Without ``starting_offsets`` the source's own default applies (the reference sets none).
    A micro-batch takes at most ``max_offsets`` records, so the first batch over a long topic
    is no larger than the others; None lifts the bound.
    """
    subscribe = topics if isinstance(topics, str) else ",".join(topics)
    reader = spark.readStream if streaming else spark.read
    df = (reader.format("kafka")
          .option("kafka.bootstrap.servers", bootstrap)
          .option("subscribe", subscribe)
          .options(**({"startingOffsets": starting_offsets} if starting_offsets else {}))
          .options(**({"maxOffsetsPerTrigger": max_offsets} if streaming and max_offsets else {}))
          .options(**(options or {}))
          .load())
    return df.select(F.col("topic"), F.col("value").cast("string").alias("value"))


def publish_kafka(channel: DataFrame, bootstrap: str, checkpoint: str | None = None,
                  options: dict | None = None):
    """Send ``(topic, value)`` records; batch write, or a streaming query when streaming."""
    out = channel.select("topic", "value")
    if out.isStreaming:
        if not checkpoint:
            raise ValueError("a streaming publish needs a checkpoint folder")
        return (out.writeStream.format("kafka")
                .option("kafka.bootstrap.servers", bootstrap)
                .option("checkpointLocation", checkpoint)
                .options(**(options or {})).start())
    (out.write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
     .options(**(options or {})).save())
    return None
