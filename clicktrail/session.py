"""Spark session and checkpoint folder for the jobs and the tests."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Zone-less timestamps are read as UTC. Runtime re-planning merges small
# shuffle partitions and splits oversized ones in joins. Checkpoints of hot
# keys are deleted once nothing refers to them.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_spark(app_name: str = "clicktrail", **conf: str) -> SparkSession:
    """The running session, or a new one; `conf` names use `__` for dots."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in SESSION_CONF.items():
        builder = builder.config(name, value)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder reliable checkpoints go to.

    A cluster names a shared folder in `spark.checkpoint.dir`. Only a local
    session, whose executors share the machine, may fall back to a new
    temporary folder.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="clicktrail-checkpoint-")
    context.setCheckpointDir(folder)
    return folder
