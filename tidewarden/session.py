"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the plans rely on. All can be set on a live session.
SQL_SETTINGS = {
    # Every time in the data model is zoned; one zone makes casts from naive
    # Parquet timestamps exact and keeps them pushable to the scan.
    "spark.sql.session.timeZone": "UTC",
    # Runtime join choice, partition coalescing and skewed-partition splitting.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Table writes replace only the partitions present in the frame.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SQL_SETTINGS` to a running session."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "tidewarden", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session; ``conf`` entries win over the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the checkpoint directory that all executors can reach.

    The directory comes from ``spark.checkpoint.dir``. Only a local-mode session
    without that setting gets a temporary one: on a cluster a machine-local
    folder would be invisible to the executors, so that case is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by driver and executors")
        base = tempfile.mkdtemp(prefix="tidewarden-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
