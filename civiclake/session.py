"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A partitioned overwrite replaces only the partitions it writes.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Keep `month=01` a string instead of the integer 1.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings every function of this package relies on to a running session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def get_session(app_name: str = "civiclake", master: str | None = None, **settings: str) -> SparkSession:
    """Build (or reuse) a configured session; ``master`` is for tests and local runs."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def _shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder; a local temporary one only for local masters."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="civiclake-")
    context.setCheckpointDir(root)
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, empty folder name under the shared folder."""
    return f"{_shared_root(spark).rstrip('/')}/civiclake/{name}-{uuid.uuid4().hex}"


def materialize(df):
    """Reliable checkpoint: fixes row placement and survives the loss of executors."""
    _shared_root(df.sparkSession)
    return df.checkpoint()
