"""Result sinks.

* ``append_results``  — adds rows, stamped with the run (the reference appends and so
  doubles rows on every re-run; the stamp makes runs tell apart).
* ``replace_results`` — the result replaced on every run. The reference drops the table
  and then inserts, so readers can see no table in between. Here every run writes a new
  version folder and then renames a one-line manifest over the old one; ``read_replaced``
  follows it, ``drop_old_versions`` removes what it no longer names. An empty result is an
  empty version, not a missing table.
* ``batch_writer``    — a ``foreachBatch`` function that writes each named result of a
  micro-batch to ``<out>/<name>/query=<id>/batch_id=<id>`` with overwrite. A replayed batch
  replaces its own output; a query with a new checkpoint has a new id and never touches what
  an earlier one wrote.
* ``compact_batches`` — the batches of a result as one table of few large files.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "CURRENT"


def append_results(df: DataFrame, path: str, run_ts: bool = True,
                   partition_by: list[str] | None = None) -> None:
    """Append ``df`` to the parquet table at ``path`` (with a ``run_ts`` column)."""
    out = df.withColumn("run_ts", F.current_timestamp()) if run_ts else df
    writer = out.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def _hadoop(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    return hadoop, hadoop.Path(path), conf


def replace_results(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Write a new version of the result, then point readers at it. Returns the version.

    The manifest is written beside its place and renamed over it, so there is no moment
    without one. A run that fails before that leaves the old version current.
    """
    version = f"{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/v={version}")
    spark = df.sparkSession
    hadoop, new, conf = _hadoop(spark, f"{path}/{MANIFEST}-{version}")
    out = new.getFileSystem(conf).create(new, True)
    try:
        out.writeBytes(version + "\n")
    finally:
        out.close()
    current = hadoop.Path(f"{path}/{MANIFEST}")
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(new.getFileSystem(conf).getUri(), conf).rename(new, current, options)
    return version


def current_version(spark: SparkSession, path: str) -> str:
    """The version that readers follow."""
    return spark.read.text(f"{path}/{MANIFEST}").first()[0].strip()


def read_replaced(spark: SparkSession, path: str) -> DataFrame:
    """The current version written by ``replace_results``."""
    return spark.read.parquet(f"{path}/v={current_version(spark, path)}")


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete all but the current version and the ``keep - 1`` before it; returns how many.
    Run it when no reader still uses an older one."""
    current = current_version(spark, path)
    _, root, conf = _hadoop(spark, path)
    fs = root.getFileSystem(conf)
    old = sorted((s.getPath() for s in fs.listStatus(root)
                  if s.getPath().getName().startswith("v=") and s.getPath().getName()[2:] < current),
                 key=lambda p: p.getName())
    gone = old[:max(0, len(old) - (keep - 1))]
    for p in gone:
        fs.delete(p, True)
    return len(gone)


def compact_batches(spark: SparkSession, out_dir: str, name: str, path: str,
                    partition_by: list[str] | None = None) -> str:
    """All batches of one result as a new version of the table at ``path``.

    Rows are gathered by the partition columns, so a folder gets few files; ``path`` can be
    read with ``read_replaced`` and, for the archive, scanned like the batches themselves."""
    rows = read_batches(spark, out_dir, name)
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)      # Spark splits a large folder's rows
    return replace_results(rows, path, partition_by)


def batch_writer(results: dict[str, Callable[[DataFrame], DataFrame]], out_dir: str,
                 persist: bool = True,
                 partition_by: dict[str, list[str]] | None = None
                 ) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function writing each derived result once per query and batch id.

    The micro-batch is persisted while its results are written so the upstream work
    (for a stateful stream, the state update) runs once; it is released afterwards.
    ``partition_by`` maps a result name to partition columns (e.g. ``topic``), so readers
    filtering on them skip the other folders.
    """
    partition_by = partition_by or {}

    def write(batch: DataFrame, batch_id: int) -> None:
        # set by Spark on the thread that runs the batch; kept in the query's checkpoint
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
        if persist:
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name, fn in results.items():
                writer = fn(batch).write.mode("overwrite")
                if partition_by.get(name):
                    writer = writer.partitionBy(*partition_by[name])
                writer.parquet(f"{out_dir}/{name}/query={query}/batch_id={batch_id}")
        finally:
            if persist:
                batch.unpersist()
    return write


def read_batches(spark: SparkSession, out_dir: str, name: str,
                 keep_batch_id: bool = False, schema=None) -> DataFrame:
    """All batches written by ``batch_writer`` for one result. With a ``schema``, a result
    that has no batch yet is an empty frame; without one that is an error."""
    path = f"{out_dir}/{name}"
    if schema is not None:
        _, p, conf = _hadoop(spark, path)
        if not p.getFileSystem(conf).exists(p):
            return spark.createDataFrame([], schema)
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:      # batches without rows leave no file in partition folders
        if schema is None or e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.createDataFrame([], schema)
    return df if keep_batch_id else df.drop("query", "batch_id")
