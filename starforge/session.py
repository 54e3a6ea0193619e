"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library assumes. AQE re-plans joins and coalesces shuffle
# partitions from runtime sizes; skew-join splits a hot key's partition.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, app: str = "starforge",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    On a cluster it comes from ``spark.checkpoint.dir``; we read it from the
    session and never replace it. Only when nothing is configured (unit tests
    on a laptop) do we fall back to a fresh local folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no SparkContext
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    else:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="starforge-ckpt-")
    if configured.startswith("/"):
        os.makedirs(configured, exist_ok=True)
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def materialize(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Cut lineage by writing ``df`` as Parquet under the shared checkpoint
    folder and reading it back. One computation, columnar write; a lost
    executor afterwards re-reads files instead of recomputing the plan.
    ``options`` go to the Parquet writer."""
    spark = df.sparkSession
    path = scratch_path(spark, f"materialized/{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").option("compression", "zstd").options(**(options or {})).parquet(path)
    return spark.read.parquet(path)
