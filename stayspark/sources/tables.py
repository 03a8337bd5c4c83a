"""Relational table scans with declared schemas."""

from __future__ import annotations

import os
from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayspark.schemas import LODGING_TABLES, STAR_TABLES

#: Characters of text that one task analyses; words and postings of that many fit a task's memory.
TASK_CHARS = 8 * 1024 * 1024


def star_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One star-schema Parquet table; projections and filters reach this scan."""
    return spark.read.schema(STAR_TABLES[name]).parquet(os.path.join(folder, f"{name}.parquet"))


def spread(scan: DataFrame) -> DataFrame:
    """Deal out the rows of a plain scan that arrives in fewer splits than there are cores.

    Meant for wide per-row work on small files (text analysis, JSON). A large table has more splits
    than cores and is returned as it is, without a shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def dealt_by_text(df: DataFrame, key: str, texts: Sequence[str], chars: int = TASK_CHARS) -> DataFrame:
    """Rows dealt out by ``key`` in as many parts as their texts need: about ``chars`` characters each, at least one per core.

    Words of a text take many times its room, so parts are sized by characters. Adaptive execution goes by shuffled
    (compressed) bytes, which say little about them; it leaves a given number of parts alone.
    """
    size = reduce(add, [F.coalesce(F.length(c), F.lit(0)).cast("long") for c in texts])
    total = df.agg(F.sum(size).alias("chars")).first()["chars"] or 0
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-total // chars)), key)


def lodging_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(LODGING_TABLES[name]).parquet(os.path.join(folder, name))


def jdbc_table(
    spark: SparkSession,
    url: str,
    name: str,
    key: str = "id",
    lower: int = 0,
    upper: int = 1,
    partitions: int = 32,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """The same table from a relational server, read in key ranges (needs a driver jar)."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=name,
            partitionColumn=key,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
            fetchsize="10000",
            **(properties or {}),
        )
        .load()
    )


def write_clustered(df: DataFrame, path: str, by: list[str], partitions: int | None = None) -> None:
    """Parquet laid out by range of ``by`` so min/max statistics let later scans skip row groups."""
    ranged = (
        df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    )
    ranged.sortWithinPartitions(*by).write.mode("overwrite").parquet(path)
