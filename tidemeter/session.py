"""Session settings and the folder shared by driver and executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on; all can be changed on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

# Bytes of stored messages and layers that one task reads: unpacked they are many times as large.
READ_BYTES = 16 * 1024 * 1024
READ_SETTING = "spark.sql.files.maxPartitionBytes"


def read_in_small_tasks(spark: SparkSession) -> None:
    """Bound what one task reads, so that larger inputs make more tasks, not larger ones; a smaller bound is kept."""
    set_bytes = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    if set_bytes > READ_BYTES:
        spark.conf.set(READ_SETTING, str(READ_BYTES))


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session that somebody else built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder; on a cluster that folder would
    exist on one machine and its contents would be lost with it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="tidemeter-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def run_dir(spark: SparkSession, label: str) -> str:
    """A folder of its own for one run, so that nothing has to be cleared first."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
