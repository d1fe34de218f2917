"""Session settings the operators rely on, and the shared scratch area.

Operators keep timestamps as ``TIMESTAMP_NTZ`` holding UTC wall-clock time and
compute time-zone bounds in Python, so results do not depend on the session
zone; the session is still pinned to UTC so that any ``TIMESTAMP`` value is
rendered the same way on every executor.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package expects. AQE re-plans joins and
# coalesces partitions at runtime from real shuffle sizes; skew-join splits a
# hot key's partition instead of leaving it to one task.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def configure_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to an existing session."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    master: str = "local[*]",
    app_name: str = "tidewater",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for local runs and tests. On a cluster, use the cluster's
    session and call :func:`configure_session` instead."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tidewater-warehouse-"))
    )
    for key, value in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (distributed) folder there. Only when it is
    unset, as in local tests, do we create a fresh local one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder.

    Used for landing zones and snapshot writes; every call gets its own
    folder so no earlier run's files are ever reused or deleted.
    """
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "scratch", f"{name}-{uuid.uuid4().hex[:12]}")

