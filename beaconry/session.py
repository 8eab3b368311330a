"""Session set-up and the one shared folder that jobs may write scratch data to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here expects; `conf` wins."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: `spark.checkpoint.dir`.

    Only a local session may do without the setting; it then gets a temporary folder.
    """
    context = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None)
    active = context.getCheckpointDir()
    if known:
        if active is None:
            context.setCheckpointDir(known)
        return known
    if active:
        return active
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="beaconry-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def pin(df: DataFrame) -> DataFrame:
    """Fix the rows of `df` in shared storage, so that later readers of values that depend
    on the task layout (row positions) all see the same ones, even after executor loss."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")
