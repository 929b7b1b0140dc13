"""Session settings and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tidemark", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs assume.

    Shuffle partitions are left to the caller (``spark.sql.shuffle.partitions``): adaptive
    execution coalesces small ones, so on a cluster start high.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # Streaming state larger than memory.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    settings.update({k: str(v) for k, v in conf.items()})
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings results depend on in a session made by someone else."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared checkpoint location.

    ``spark.checkpoint.dir`` names storage every executor can reach.  Only a local session
    may fall back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")


def materialised(df: DataFrame) -> DataFrame:
    """``df`` checkpointed in the shared folder: its partitions and their order stay as they are from then on."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint()
