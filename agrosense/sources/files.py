"""File sources: sensor CSV replay, comma-CSV import, channel-record files.

* ``read_sensor_csv`` — a ``;``-separated sensor file with a header line (one header per
  file is skipped), every field kept as text, columns named from the header.
* ``csv_replay`` — that file as channel records ``(topic, value)``: the fields re-joined
  into lines on channel ``iotData_<source>``. Batch or streaming (``maxFilesPerTrigger``
  paces the replay instead of a sleeping thread).
* ``csv_import`` — a comma CSV with a header and inferred types, written over a table.
  Inference reads the data an extra time; ``sampling_ratio`` bounds that pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agrosense.operators.publish import publish
from agrosense.schemas import CHANNEL_SCHEMA, SEPARATOR, TOPIC_PREFIX


def read_sensor_csv(spark: SparkSession, path: str, sep: str = SEPARATOR,
                    schema: T.StructType | None = None) -> DataFrame:
    """Sensor file(s) -> one text column per field, header skipped."""
    reader = spark.read.option("sep", sep).option("header", True).option("inferSchema", False)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def sensor_csv_schema(spark: SparkSession, path: str, sep: str = SEPARATOR) -> T.StructType:
    """All-text schema named from the header (what a streaming reader needs up front)."""
    return read_sensor_csv(spark, path, sep).schema


def csv_replay(spark: SparkSession, path: str, source: str, sep: str = SEPARATOR,
               streaming: bool = False, schema: T.StructType | None = None,
               max_files_per_trigger: int | None = None,
               prefix: str = TOPIC_PREFIX) -> DataFrame:
    """Sensor CSV -> ``(topic, value)`` lines on channel ``<prefix>_<source>``."""
    if streaming:
        schema = schema or sensor_csv_schema(spark, path, sep)
        reader = spark.readStream.option("sep", sep).option("header", True).schema(schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        df = reader.csv(path)
    else:
        df = read_sensor_csv(spark, path, sep, schema)
    return publish(df, F.lit(source), df.columns, prefix)


def csv_import(spark: SparkSession, path: str, table_path: str | None = None,
               sampling_ratio: float = 1.0) -> DataFrame:
    """Comma CSV with a header line, types inferred; replaces ``table_path`` when given."""
    df = (spark.read.option("header", True).option("inferSchema", True)
          .option("samplingRatio", sampling_ratio).csv(path))
    if table_path:
        df.write.mode("overwrite").parquet(table_path)
        return spark.read.parquet(table_path)
    return df


def channel_files(spark: SparkSession, path: str, fmt: str = "parquet",
                  streaming: bool = False, max_files_per_trigger: int | None = None,
                  options: dict | None = None) -> DataFrame:
    """Files of channel records ``(topic STRING, value STRING)``, batch or streaming."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.format(fmt).schema(CHANNEL_SCHEMA).options(**(options or {}))
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select("topic", "value")
