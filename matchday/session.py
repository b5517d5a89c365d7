"""Spark session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on. ANSI stays at Spark's default (on): the column helpers use
# try_* functions, so bad text gives null and a real overflow still fails.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # season=0809 must be read back as text, not as the number 809
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    # checkpoints go when nothing refers to them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # the Python state API talks to the JVM over a socket file, not a TCP port
    "spark.python.unix.domain.socket.enabled": "true",
}


def build_session(app_name: str = "matchday", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the library's settings; pass others as ``**{"spark.x.y": "value"}``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """Shared folder for checkpoints: the cluster's own setting wins.

    Only a local session without the setting (tests) gets a temporary folder; a cluster session
    without it is an error, since a folder on one machine is lost with that machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="matchday-checkpoint-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share, for files that one run writes and reads again."""
    return f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
