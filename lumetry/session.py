"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SETTINGS = {
    # Window edges and text times mean the same on every machine.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # State of many devices lives on local disk, and a checkpoint uploads only what changed.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# For batches of tens of terabytes: fewer, larger splits, and many shuffle partitions that AQE merges as needed.
VOLUME = {
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "10000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on to a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """A new, unused folder under `spark.checkpoint.dir`, which all executors can reach.

    A temporary folder is used only where that is unset and the session runs on this machine alone.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="lumetry-")
        context.setCheckpointDir(root)
    return f"{root.rstrip('/')}/lumetry-{uuid.uuid4().hex}"
