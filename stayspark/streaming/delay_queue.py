"""Delay queue as a stream: every job is released once, when the stream's clock reaches its due time."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from stayspark.operators.jobs import schedule
from stayspark.streaming.runtime import CLOCK, clock_before, drain, first_arrivals, read_batches, use_rocksdb, write_batch

RELEASED = T.StructType(
    [
        T.StructField("job_id", T.StringType()),
        T.StructField("routing_key", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("execute_ms", T.LongType()),
    ]
)
_JOB = T.StructType(
    [
        T.StructField("routing_key", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("execute_ms", T.LongType()),
        T.StructField("released", T.BooleanType()),
    ]
)


class _Release(StatefulProcessor):
    """Keeps a job until the watermark reaches its due time; a second delivery changes nothing.

    A job that arrives when its due time has passed already is released at once.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.job = handle.getValueState("job", _JOB)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self.job.exists()
        for pdf in rows:
            if known or not len(pdf):
                continue
            row = pdf.iloc[0]
            due = int(row["execute_ms"])
            overdue = due <= timerValues.getCurrentWatermarkInMs()
            self.job.update((row["routing_key"], row["payload"], due, overdue))
            known = True
            if overdue:
                yield self._row(key, row["routing_key"], row["payload"], due)
            else:
                self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        routing_key, payload, due, released = self.job.get()
        if not released:
            self.job.update((routing_key, payload, due, True))
            yield self._row(key, routing_key, payload, due)

    @staticmethod
    def _row(key, routing_key, payload, due) -> pd.DataFrame:
        row = (key[0], routing_key, payload, due)
        return pd.DataFrame([row], columns=[f.name for f in RELEASED.fields], dtype=object)

    def close(self) -> None:
        pass


def release_stream(jobs: DataFrame, watermark: str = "0 seconds") -> DataFrame:
    """jobs: job_id, routing_key, payload, created_at, delay_s -> released jobs (append).

    The watermark only moves the clock. The creation time doesn't reach the stateful step, so a job
    older than the watermark isn't taken for late data and dropped.
    """
    use_rocksdb(jobs.sparkSession)
    due = schedule(jobs.withWatermark("created_at", watermark)).select(
        "job_id", "routing_key", "payload", F.unix_millis("execute_at").alias("execute_ms")
    )
    return due.groupBy("job_id").transformWithStateInPandas(
        statefulProcessor=_Release(),
        outputStructType=RELEASED,
        outputMode="append",
        timeMode="eventTime",
    )


# ---- the same queue as set operations per micro-batch ------------------------------------------
SCHEDULED = (
    "job_id string, routing_key string, payload string, created_at timestamp, execute_at timestamp,"
    " due_day timestamp"
)
RELEASES = "job_id string, routing_key string, payload string, execute_at timestamp"


def run_release(jobs: DataFrame, root: str, checkpoint: str) -> None:
    """Drain a job stream: ``pending`` keeps every job once, ``released`` those due by the clock.

    The clock is the newest creation time seen. A job is released by the first micro-batch whose
    clock reaches its due time: it became due since the previous clock, or it arrived just now and
    was due already. Pending jobs lie in one partition per due day, so a release reads the days
    the clock passed and nothing else. Ids are remembered in keyed state, see ``first_arrivals``. No per-job Python
    runs; use it for bulk queues, and the timers of ``release_stream`` for low latency.
    """
    spark = jobs.sparkSession
    first = first_arrivals(
        schedule(jobs), "job_id", [F.col("created_at"), F.col("execute_at")], {"newest": F.max("created_at")}
    )

    def release(batch: DataFrame, batch_id: int) -> None:
        batch = batch.filter("newest is not null").select("job_id", "fresh", "newest", "row.*").persist()
        try:
            before = clock_before(spark, f"{root}/clock", batch_id)
            newest = batch.agg(F.max("newest").alias("c")).first()["c"]
            now = max(c for c in (before, newest) if c is not None) if before or newest else None
            if now is None:
                return
            fresh = batch.filter("fresh").select(
                "job_id", "routing_key", "payload", "created_at", "execute_at",
                F.date_trunc("day", "execute_at").alias("due_day"),
            )
            fresh.repartitionByRange("execute_at").write.mode("overwrite").partitionBy("due_day").parquet(
                f"{root}/pending/batch_id={batch_id}"
            )
            pending = read_batches(spark, f"{root}/pending", SCHEDULED)
            due = pending.filter(
                (F.col("batch_id") <= batch_id)
                & (F.col("due_day") <= F.lit(now))
                & (F.col("execute_at") <= F.lit(now))
            )
            if before is not None:
                passed = F.date_trunc("day", F.lit(before).cast("timestamp"))
                just_now = F.col("batch_id") == batch_id
                due = due.filter(just_now | ((F.col("due_day") >= passed) & (F.col("execute_at") > F.lit(before))))
            write_batch(
                due.select("job_id", "routing_key", "payload", "execute_at"), f"{root}/released", batch_id
            )
            write_batch(spark.createDataFrame([(now,)], CLOCK), f"{root}/clock", batch_id)
        finally:
            batch.unpersist()

    drain(first.writeStream.outputMode("update").foreachBatch(release), checkpoint)


def released(spark: SparkSession, root: str) -> DataFrame:
    return read_batches(spark, f"{root}/released", RELEASES).drop("batch_id")
