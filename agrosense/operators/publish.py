"""Line publishing: a table of readings -> channel records ``(topic, value)``.

The reference's replayer re-joins CSV fields with ``;`` and sends each line to the
channel ``iotData_<source>``. Here the same step is a projection: ``to_csv`` quotes a
field that contains the separator (the reference does not, which shifts columns), so the
parser gets back exactly what was sent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrosense.schemas import LINE_CSV_OPTIONS, TOPIC_PREFIX


def encode_line(fields: Sequence[Column | None]) -> Column:
    """Join positional fields into one line; ``None`` (or null) positions stay empty."""
    parts = [
        (F.lit(None).cast("string") if f is None else f.cast("string")).alias(f"p{i}")
        for i, f in enumerate(fields)
    ]
    return F.to_csv(F.struct(*parts), LINE_CSV_OPTIONS)


def channel_name(source, prefix: str = TOPIC_PREFIX) -> Column:
    """``<prefix>_<source>``, e.g. ``iotData_meteo_2020_gennaio_marzo``."""
    src = F.col(source) if isinstance(source, str) else source
    return F.concat_ws("_", F.lit(prefix), src)


def publish(df: DataFrame, source, fields: Sequence[str | None],
            prefix: str = TOPIC_PREFIX) -> DataFrame:
    """Rows of ``df`` -> ``(topic, value)``; ``fields`` lists columns by line position."""
    cols = [None if f is None else F.col(f) for f in fields]
    return df.select(channel_name(source, prefix).alias("topic"), encode_line(cols).alias("value"))
