"""Helpers shared by the corpus operators."""

from __future__ import annotations

import sys
import threading
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agrosense.session import fresh_path

# Fixed patterns of the result contracts.
WORD = r"[^\x20\x09-\x0D]+"                       # white-space separated words
SPACE = r"[\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"

# A lookup side is broadcast only when a count showed at most this many rows; beyond it the
# same join runs as a shuffle join (AQE splits its skewed partitions).
BROADCAST_ROWS = 200_000

BATCH_BYTES = 2 << 20             # of an Arrow batch within ``arrow_bytes``


def ship(module_name: str) -> None:
    """Send the module's functions to the Python workers by value, so that executors need
    no installed copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_SCOPES = threading.local()          # of each thread, the tables of its open ``scratch`` blocks


def _scopes() -> list[list[str]]:
    if not hasattr(_SCOPES, "open"):
        _SCOPES.open = []
    return _SCOPES.open


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` below the session's shared checkpoint folder and read it back: cuts the
    lineage, and a lost executor costs no recomputation of what lies before."""
    path = fresh_path(df.sparkSession, name)
    if _scopes():
        _scopes()[-1].append(path)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession):
    """Within it, tables written by ``stored`` are scratch and deleted at its end. What must
    outlive it is written to a path of its own, inside."""
    _scopes().append([])
    try:
        yield
    finally:
        conf = spark._jsc.hadoopConfiguration()
        for name in _scopes().pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if a count shows at most ``rows`` rows, else as it is.
    Give it a stored table: the count is an action."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Within it, at most ``rows`` rows come to a Python task at a time, for rows that are long
    texts. What runs later than its end is not affected."""
    with _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows)):
        yield


@contextmanager
def arrow_bytes(spark: SparkSession, size: int = BATCH_BYTES):
    """Within it, rows come to a Python task in batches closed at about ``size`` bytes, whatever
    the length of their texts; a longer row comes alone. What runs later than its end is not
    affected."""
    with _setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(size)):
        yield


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def bit_map(hashes: DataFrame, bits: int):
    """Bit map (numpy, 2**bits bits) of the one column of 64-bit hashes: a filter of fixed size.
    A clear bit says that no hash with these low bits is there; full, it filters nothing."""
    import numpy as np

    slot = F.col("h").bitwiseAND((1 << bits) - 1)
    rows = (hashes.toDF("h").groupBy(F.shiftright(slot, 5).alias("k"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 31 as int))")).alias("bits")).toPandas())
    out = np.zeros(1 << (bits - 5), dtype=np.uint32)
    out[rows["k"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64).astype(np.uint32)
    return out


def in_bit_map(bits, hashes):
    """Whether the bit of each hash (numpy, 64 bits) is set."""
    import numpy as np

    h = hashes.view(np.uint64) & np.uint64(32 * len(bits) - 1)
    return (bits[h >> np.uint64(5)] >> (h & np.uint64(31)).astype(np.uint32)).astype(np.uint32) & np.uint32(1) == 1


def with_map_hits(df: DataFrame, key: str, hashes: DataFrame, bits: int) -> DataFrame:
    """``df`` with ``__hit``: whether the bit of its 64-bit ``key`` is set in the bit map of the one
    column of ``hashes``. The map is broadcast, of fixed size at most; no row of ``df`` is shuffled."""
    slot = lambda c: F.shiftright(F.col(c).bitwiseAND((1 << bits) - 1), 5)
    marks = stored(hashes.toDF("h").groupBy(slot("h").alias("__slot"))
                   .agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 31 as int))")).alias("__bits")), "bit-map")
    hit = F.expr(f"coalesce(shiftright(__bits, cast(`{key}` & 31 as int)) & 1L = 1L, false)")
    return (df.withColumn("__slot", slot(key)).join(F.broadcast(marks), "__slot", "left")
            .withColumn("__hit", hit).drop("__slot", "__bits"))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does the same, and faster, on pure ASCII text."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, ASCII_UPPER, ASCII_LOWER))


def row_key(*cols: Column) -> Column:
    """64-bit key of a row; null values count as values, equal rows share their key."""
    parts = []
    for c in cols:
        parts += [c.isNull(), c]
    return F.xxhash64(*parts)
