"""Session building and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app_name: str = "stayspark", master: str | None = None, shuffle_partitions: int | None = None
) -> SparkSession:
    """A session with the settings every job of this package relies on.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the submit configuration
    decides, and adaptive execution coalesces or splits shuffle partitions at run time.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master is not None:
        builder = builder.master(master).config("spark.ui.enabled", "false")
        builder = builder.config("spark.ui.showConsoleProgress", "false")
        # One JVM is driver and executors; takes effect only when this call starts it.
        builder = builder.config("spark.driver.memory", os.environ.get("STAYSPARK_LOCAL_MEMORY", "12g"))
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """All instants in this package are UTC; pin the session so casts agree with that."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by ``spark.checkpoint.dir``; invent one only for local masters."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="stayspark-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: iterative jobs restart from files, not from a lost executor's blocks."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint folder all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def session_folder(spark: SparkSession, name: str) -> str:
    """A folder under the checkpoint folder that keeps its name for as long as the session lives."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: evaluated once, and of known size to the optimizer."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
