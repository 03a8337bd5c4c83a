"""Versioned snapshots: a full rebuild writes a new folder, readers follow a small pointer table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_POINTER = "version bigint, folder string, signature string"
#: Versions that stay readable after a swap, so that running readers finish.
RETAINED = 2


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def signature(spark: SparkSession, *tables: str) -> str:
    """A digest of name, length and time of every file of the tables: another one means other content."""
    seen = []
    for name in tables:
        path, fs = _path(spark, name)
        files = fs.listFiles(path, True)
        while files.hasNext():
            f = files.next()
            seen.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()


def versions(spark: SparkSession, root: str) -> DataFrame | None:
    """(version, folder, signature) of what was published, None before the first publish."""
    path, fs = _path(spark, f"{root}/_pointer")
    return spark.read.schema(_POINTER).parquet(f"{root}/_pointer") if fs.exists(path) else None


def _current(spark: SparkSession, root: str):
    known = versions(spark, root)
    if known is None:
        return None
    return known.orderBy(F.desc("version")).first()


def current_folder(spark: SparkSession, root: str) -> str | None:
    """Folder of the newest complete version, or None before the first publish."""
    row = _current(spark, root)
    return None if row is None else row["folder"]


def publish_folder(
    spark: SparkSession, root: str, write: Callable[[str], None], signed: str = "", retained: int = RETAINED
) -> str:
    """Let ``write`` fill a new version's folder, then append its pointer and drop versions nobody should read.

    A reader sees the old or the new version, never a half-written one; a failed write leaves no pointer.
    """
    row = _current(spark, root)
    version = 1 if row is None else row["version"] + 1
    folder = f"{root}/v{version}"
    path, fs = _path(spark, folder)
    fs.delete(path, True)  # what a failed attempt left
    write(folder)
    spark.createDataFrame([(version, folder, signed)], _POINTER).coalesce(1).write.mode("append").parquet(f"{root}/_pointer")
    if version > retained:
        old, fs = _path(spark, f"{root}/v{version - retained}")
        fs.delete(old, True)
    return folder


def publish(df: DataFrame, root: str, retained: int = RETAINED) -> str:
    """Publish one table as the newest version."""
    return publish_folder(df.sparkSession, root, lambda folder: df.write.parquet(folder), retained=retained)


def current_or_rebuilt(spark: SparkSession, root: str, signed: str, write: Callable[[str], None]) -> str:
    """The newest version if it was made from the same input, else a fresh one."""
    row = _current(spark, root)
    return row["folder"] if row is not None and row["signature"] == signed else publish_folder(spark, root, write, signed)


def read_current(spark: SparkSession, root: str, schema) -> DataFrame:
    folder = current_folder(spark, root)
    if folder is None:
        raise FileNotFoundError(f"nothing published under {root}")
    return spark.read.schema(schema).parquet(folder)
