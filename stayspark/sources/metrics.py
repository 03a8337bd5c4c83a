"""Metric samples: (job, metric, labels, ts, value) from Parquet, batch or stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayspark.schemas import LODGING_TABLES


def samples(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(LODGING_TABLES["metric_samples"]).parquet(folder)


def sample_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    return (
        spark.readStream.schema(LODGING_TABLES["metric_samples"])
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder)
    )


def select_series(df: DataFrame, job: str, metric: str, **labels: str) -> DataFrame:
    """Samples of one metric with the given labels; the first two predicates are pushed down."""
    picked = df.filter((F.col("job") == job) & (F.col("metric") == metric))
    for name, value in labels.items():
        picked = picked.filter(F.try_element_at("labels", F.lit(name)) == value)
    return picked


def as_samples(
    df: DataFrame, job: Column, metric: Column, labels: dict[str, Column], ts: Column, value: Column
) -> DataFrame:
    pairs = [x for name, c in labels.items() for x in (F.lit(name), c.cast("string"))]
    return df.select(
        job.alias("job"),
        metric.alias("metric"),
        F.create_map(*pairs).alias("labels"),
        ts.alias("ts"),
        value.cast("double").alias("value"),
    )
