"""Quarter-partitioned booking table: pruned window counts and rows per partition."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def quarter_of(d: Column) -> Column:
    return F.concat(F.year(d), F.lit("q"), F.quarter(d))


def quarters_between(first: date, last: date) -> list[str]:
    """Quarter labels that a half-open window [first, last) can touch."""
    labels = []
    year, quarter = first.year, (first.month - 1) // 3 + 1
    while date(year, 3 * quarter - 2, 1) < last:
        labels.append(f"{year}q{quarter}")
        year, quarter = (year + 1, 1) if quarter == 4 else (year, quarter + 1)
    return labels


def write_by_quarter(bookings: DataFrame, path: str, date_col: str = "check_in") -> None:
    """Shuffle on (quarter, date) so no quarter is written by a single task."""
    labelled = bookings.withColumn("quarter", quarter_of(F.col(date_col)))
    (
        labelled.repartitionByRange("quarter", date_col)
        .sortWithinPartitions("quarter", date_col)
        .write.mode("overwrite")
        .partitionBy("quarter")
        .parquet(path)
    )


def read_by_quarter(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, quarter string").parquet(path)


def read_window(
    spark: SparkSession, path: str, schema: str, first: date, last: date, date_col: str = "check_in"
) -> DataFrame:
    """Rows with ``first <= date < last``; the derived quarter list prunes partitions."""
    table = read_by_quarter(spark, path, schema)
    c = F.col(date_col)
    return table.filter(
        F.col("quarter").isin(quarters_between(first, last)) & (c >= F.lit(first)) & (c < F.lit(last))
    )


def rows_per_partition(table: DataFrame, partition_col: str = "quarter") -> DataFrame:
    """Rows of each partition of a written table: no column is read, the counts come from the files' footers."""
    return table.groupBy(partition_col).agg(F.count(F.lit(1)).alias("n"))


def rows_per_file(table: DataFrame) -> DataFrame:
    """The same by data file: (file, n)."""
    return table.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
