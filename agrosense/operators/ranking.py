"""Top-k and latest-n over small per-key aggregates.

``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: every partition keeps its own
k best rows and only k x partitions rows reach the final merge; there is no global sort
and no single-partition exchange of the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, value: str, k: int, descending: bool = True,
          tie_break: str = "day") -> DataFrame:
    """The ``k`` rows with the largest (or smallest) ``value``; ties go to the earlier key.

    Rows whose value is null are skipped (a day without any valid reading has no mean).
    """
    order = F.col(value).desc() if descending else F.col(value).asc()
    return (df.where(F.col(value).isNotNull())
            .orderBy(order, F.col(tie_break).asc())
            .limit(k))


def latest(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the greatest ``key`` (newest days first)."""
    return df.orderBy(F.col(key).desc()).limit(n)
