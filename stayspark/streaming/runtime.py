"""Running streams to the end of the available input, and where their files go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def drain(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process everything there is, then stop; a restart goes on from the checkpoint."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state and timers live in RocksDB on the executors, checkpointed to the shared folder."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def first_arrivals(rows: DataFrame, key: str, order: list[Column], extra: dict[str, Column] | None = None) -> DataFrame:
    """A stream with the first delivery of every key, for ever: (key, row, fresh, extra columns), in update mode.

    Of one micro-batch the delivery with the least ``order`` is the first. ``fresh`` marks keys that came for the
    first time in this micro-batch; a key that comes again is reported with its old row and not fresh. The
    state is one row per key in RocksDB, so a micro-batch costs its own size, however long the history is, and nothing is
    dropped for its age.
    """
    use_rocksdb(rows.sparkSession)
    # One instant per micro-batch, kept in the offset log, so a repeated micro-batch sees it again.
    stamped = rows.withColumn("_arrived", F.current_timestamp())
    values = F.struct(*[F.col(c) for c in rows.columns if c != key])
    return stamped.groupBy(key).agg(
        F.min_by(values, F.struct("_arrived", *order)).alias("row"),
        (F.min("_arrived") == F.max("_arrived")).alias("fresh"),
        *[c.alias(name) for name, c in (extra or {}).items()],
    )


def write_batch(df: DataFrame, folder: str, batch_id: int) -> None:
    """One folder per micro-batch, overwritten on replay, so a repeated batch leaves no duplicates."""
    df.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")


def read_batches(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All micro-batches of a folder; empty before the first one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    full = f"{schema}, batch_id bigint"
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", folder).parquet(folder)


CLOCK = "clock timestamp"


def clock_before(spark: SparkSession, folder: str, batch_id: int):
    """The stream's clock before a micro-batch. Each one leaves its own, so only the newest earlier one is read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    numbers = [int(f.getPath().getName().split("=")[1]) for f in fs.listStatus(path)] if fs.exists(path) else []
    earlier = [n for n in numbers if n < batch_id]
    return spark.read.schema(CLOCK).parquet(f"{folder}/batch_id={max(earlier)}").first()["clock"] if earlier else None
