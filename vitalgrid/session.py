"""Session settings the operators rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_session(app: str = "vitalgrid", master: str | None = None, **conf) -> SparkSession:
    """A session with UTC time and adaptive execution (skewed joins split, small sides broadcast).

    Partition counts are left to the cluster unless given in ``conf``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints: the one the cluster names, else a local one in local mode."""
    sc = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if folder is None:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="vitalgrid-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex}")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends here, and a lost
    executor costs a re-read rather than a recomputation."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """The same without a label. (A checkpoint of the session would compute the table twice.)"""
    return stored(df, "checkpoint")
