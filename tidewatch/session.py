"""Session settings the engine relies on, and its shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Needed for right results, whatever session the caller brings.
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

# Cluster defaults; a deployment may override any of them.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str = "tidewatch", master: str | None = None, **conf) -> SparkSession:
    """A session with the engine's settings; `conf` adds to them or replaces them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SCALE_CONF, **RESULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings that results depend on; safe to call repeatedly."""
    for key, value in RESULT_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def working_folder(spark: SparkSession, name: str) -> str:
    """A new folder for checkpoints and tables under the shared `spark.checkpoint.dir`.

    Only a local session may run without that setting: its single machine is
    the whole cluster, so a temporary folder is shared by definition.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="tidewatch-")
        spark.sparkContext.setCheckpointDir(shared)
        shared = spark.sparkContext.getCheckpointDir()
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
