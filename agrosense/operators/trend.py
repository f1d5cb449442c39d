"""Trend flag over the latest days, and the pivot of those days into one row.

Reference semantics, with day 1 the newest: the scan starts from the smallest positive
double for temperature and the largest double for humidity and requires each next (older)
day to be hotter and drier. So the flag is

    t1 > 4.9E-324  and h1 < 1.7976931348623157E308
    and t2 > t1 and h2 < h1 and t3 > t2 and h3 < h2

on unrounded means, Java comparisons (false on NaN). It is true when going back in time is
hotter and drier, and always false when the newest day's mean is <= 0.
``direction='chronological'`` gives the flag its name's meaning: t1 > t2 > t3 and
h1 < h2 < h3 (newest hottest and driest), without the zero guard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrosense.functions.columns import java_gt, java_lt

# The scan's starting points in the reference (Java's Double.MIN_VALUE and
# Double.MAX_VALUE).
JAVA_DOUBLE_MIN_VALUE = 4.9e-324
JAVA_DOUBLE_MAX_VALUE = 1.7976931348623157e308


def trend_flag(temps: list[Column], hums: list[Column], direction: str = "reference") -> Column:
    """Monotone-trend flag over days ordered newest first."""
    if direction == "reference":
        cond = java_gt(temps[0], JAVA_DOUBLE_MIN_VALUE) & java_lt(hums[0], JAVA_DOUBLE_MAX_VALUE)
        for i in range(1, len(temps)):
            cond = cond & java_gt(temps[i], temps[i - 1]) & java_lt(hums[i], hums[i - 1])
        return cond
    if direction == "chronological":
        cond = F.lit(True)
        for i in range(1, len(temps)):
            cond = cond & java_gt(temps[i - 1], temps[i]) & java_lt(hums[i - 1], hums[i])
        return cond
    raise ValueError(direction)


def pivot_latest(latest_days: DataFrame, n: int, digits: int, direction: str) -> DataFrame:
    """``n`` day rows (day, temp, hum) -> one wide row, or no row when fewer than ``n``.

    The input is already cut to ``n`` rows by a top-n, so gathering it is bounded by ``n``.
    """
    gathered = latest_days.agg(
        F.count(F.lit(1)).alias("n_days"),
        F.sort_array(F.collect_list(F.struct("day", "temp", "hum")), asc=False).alias("d"),
    )
    temps = [F.col("d")[i]["temp"] for i in range(n)]
    hums = [F.col("d")[i]["hum"] for i in range(n)]
    cols = []
    for i in range(n):
        cols += [
            F.col("d")[i]["day"].alias(f"day_minus_{i + 1}"),
            F.round(temps[i], digits).alias(f"avg_temp{i + 1}"),
            F.round(hums[i], digits).alias(f"avg_hum{i + 1}"),
        ]
    cols.append(trend_flag(temps, hums, direction).alias("isGettingHotter"))
    return gathered.where(F.col("n_days") == n).select(*cols)
