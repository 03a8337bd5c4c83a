"""Small helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayspark.session import shared_folder

WORD_GAP = "[\\x20\\x09-\\x0D]+"
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared checkpoint folder: cuts the lineage, survives a lost
    executor, and gives the optimizer the true size of what follows."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made and nothing will read again."""
    for table_ in tables:
        files = table_.inputFiles()
        if files:
            context = table_.sparkSession.sparkContext
            folder = context._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def whole(text: str | Column = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text that is not null."""
    return F.array_remove(F.split(text, WORD_GAP), "")
