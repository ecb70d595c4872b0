"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# UTC is part of the data contract. Adaptive execution also splits skewed join partitions and may
# turn a shuffled join into a broadcast one, but only after it has measured the size of that side.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Recording the Python line behind every column expression takes longer than planning the features.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "market_engine", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder of the cluster; fall back to a private one only where none is named."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        spark.sparkContext.setCheckpointDir(shared)
    elif spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A path of its own, not written yet, below the folder that all executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.getCheckpointDir() is None:
            ensure_checkpoint_dir(spark)
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
