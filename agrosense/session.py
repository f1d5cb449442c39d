"""Session helpers.

Library code never sets ``master``; a cluster submits with its own. The builder here is
for tests, the bench and local runs. ``work_dir`` resolves the shared folder the cluster
names in ``spark.checkpoint.dir`` and only falls back to a local folder when that setting
is absent (tests, local mode).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this library should carry. Timestamps are keyed as text in the
# reference, and interval text is rendered in the session zone, so the zone is pinned.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "agrosense", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "true")
    )
    for key, value in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Pin the zone and AQE on a session we did not build (e.g. the driver's)."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints, stream state and written tables.

    Reads ``spark.checkpoint.dir`` from the session; only when it is unset and the master is
    local (tests) does it create and register a local one. Elsewhere that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no SparkContext
        sc = None
    if not root and sc is not None:
        root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        master = sc.master if sc is not None else "a remote session"
        if not master.split("[")[0] == "local":
            raise ValueError(f"spark.checkpoint.dir is not set: {master} needs a folder that the "
                             "driver and all executors share")
        root = tempfile.mkdtemp(prefix="agrosense-")
        if sc is not None:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def fresh_path(spark: SparkSession, *parts: str) -> str:
    """A new, unique path below the work folder (never reused, never cleared)."""
    name = "-".join(p for p in parts if p) or "run"
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python file APIs can use a local path (tests only)."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


__all__ = ["SESSION_DEFAULTS", "apply_defaults", "fresh_path", "local_path", "local_session",
           "work_dir"]
