"""SLIs and alerts as streams; their batch twins are in ``operators.sli``."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from stayspark.operators.sli import FAST_MS, SECOND, SERVICE_ALERTS, ratio, rule_columns
from stayspark.streaming.runtime import CLOCK, clock_before, drain, read_batches, use_rocksdb, write_batch


def windowed_slis(
    requests: DataFrame, keys: list[str], window: str = "5 minutes", slide: str = "15 seconds",
    watermark: str = "1 minute", fast_ms: float = FAST_MS,
) -> DataFrame:
    """Latency and availability shares per sliding window and key.

    Partial counts are combined before the shuffle; state is one row per key and open window.
    """
    return (
        requests.withWatermark("ts", watermark)
        .groupBy(F.window("ts", window, slide).alias("w"), *keys)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("latency_ms") < fast_ms).alias("fast"),
            F.count_if(F.col("status") >= 500).alias("failed"),
        )
        .select(
            *keys, F.col("w.end").alias("window_end"), "n",
            ratio(F.col("fast"), F.col("n")).alias("latency_sli"),
            ratio(F.col("n") - F.col("failed"), F.col("n")).alias("availability_sli"),
        )
    )


_COUNTS = "window_end timestamp, n bigint, fast bigint, failed bigint, late bigint"


def run_window_counts(
    requests: DataFrame, keys: list[str], folder: str, checkpoint: str, window: str = "5 minutes", slide: str = "15 seconds",
    delay: str = "1 minute", fast_ms: float = FAST_MS,
) -> None:
    """Drain requests into counts per key and sliding window, one addition per micro-batch.

    Counts add up, so a sample that comes behind the clock (the newest instant seen, less ``delay``) corrects its
    windows like any other, whenever it comes; it is only counted as ``late``. No state is kept and a micro-batch reads
    nothing but the clock.
    """
    spark = requests.sparkSession

    def add(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            before = clock_before(spark, f"{folder}/clock", batch_id)
            newest = batch.agg(F.max("ts").alias("c")).first()["c"]
            now = max((c for c in (before, newest) if c is not None), default=None)
            limit = F.lit(before).cast("timestamp") - F.expr(f"interval {delay}")
            counts = batch.withColumn("_late", F.coalesce(F.col("ts") < limit, F.lit(False))).groupBy(
                F.window("ts", window, slide).alias("w"), *keys
            ).agg(
                F.count(F.lit(1)).alias("n"), F.count_if(F.col("latency_ms") < fast_ms).alias("fast"),
                F.count_if(F.col("status") >= 500).alias("failed"), F.count_if("_late").alias("late"),
            )
            write_batch(counts.select(*keys, F.col("w.end").alias("window_end"), "n", "fast", "failed", "late"), f"{folder}/counts", batch_id)
            if now is not None:
                write_batch(spark.createDataFrame([(now,)], CLOCK), f"{folder}/clock", batch_id)
        finally:
            batch.unpersist()

    drain(requests.writeStream.foreachBatch(add), checkpoint)


def counted_slis(spark: SparkSession, folder: str, keys: dict[str, str]) -> DataFrame:
    """(keys, window_end, n, late, latency_sli, availability_sli) of everything counted so far; ``keys``: name -> type."""
    schema = ", ".join([*[f"{k} {t}" for k, t in keys.items()], _COUNTS])
    rows = read_batches(spark, f"{folder}/counts", schema)
    summed = rows.groupBy(*keys, "window_end").agg(*[F.sum(c).alias(c) for c in ("n", "fast", "failed", "late")])
    return summed.select(
        *keys, "window_end", "n", "late", ratio(F.col("fast"), F.col("n")).alias("latency_sli"),
        ratio(F.col("n") - F.col("failed"), F.col("n")).alias("availability_sli"),
    )


def run_slis(slis: DataFrame, folder: str, checkpoint: str) -> None:
    """Update mode: each micro-batch writes the windows it changed."""
    writer = slis.writeStream.outputMode("update").foreachBatch(
        lambda df, batch_id: write_batch(df, folder, batch_id)
    )
    drain(writer, checkpoint)


def latest_slis(spark: SparkSession, folder: str, keys: list[str], schema: str) -> DataFrame:
    """Newest version of every (key, window)."""
    rows = read_batches(spark, folder, schema)
    values = [c for c in rows.columns if c not in (*keys, "window_end", "batch_id")]
    newest = rows.groupBy(*keys, "window_end").agg(
        F.max_by(F.struct(*values), "batch_id").alias("v")
    )
    return newest.select(*keys, "window_end", *[F.col(f"v.{c}").alias(c) for c in values])


_EPISODE = T.StructType([T.StructField("since", T.LongType()), T.StructField("last", T.LongType())])


class _Episodes(StatefulProcessor):
    """Per series: when the running episode began and its last step. A missing step ends it, also between micro-batches."""

    def __init__(self, columns: list[str], step_us: int):
        self.columns, self.step_us = columns, step_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.episode = handle.getValueState("episode", _EPISODE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # One row per evaluation step, so a micro-batch holds few rows of a series.
        steps = pd.concat(list(rows)).sort_values("step")
        since, last = self.episode.get() if self.episode.exists() else (None, None)
        out = []
        for step, on, hold in zip(steps["step"], steps["bad"], steps["hold_us"]):
            step = int(step)
            if not on:
                since = None
            elif since is None or step - last > self.step_us:
                since = step
            last = step
            if on:
                state = "firing" if step - since >= hold else "pending"
                out.append((*key, step, since, state))
        if since is None:
            self.episode.clear()
        else:
            self.episode.update((since, last))
        if out:
            yield pd.DataFrame(out, columns=self.columns, dtype=object)

    def close(self) -> None:
        pass


def _episodes(steps: DataFrame, keys: list[str], step_s: int) -> DataFrame:
    """(keys, step, since, state) from (keys, step, bad, hold_us), in step order per series across micro-batches."""
    use_rocksdb(steps.sparkSession)
    out = T.StructType([steps.schema[k] for k in keys])
    for name, kind in (("step", T.LongType()), ("since", T.LongType()), ("state", T.StringType())):
        out = out.add(name, kind)
    return steps.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=_Episodes(out.fieldNames(), step_s * SECOND),
        outputStructType=out,
        outputMode="append",
        timeMode="none",
    )


def alert_stream(steps: DataFrame, hold_s: int, step_s: int = 15) -> DataFrame:
    """One rule. steps: series, step (epoch micros), bad -> series, step, since, state."""
    held = steps.select("series", "step", "bad", F.lit(hold_s * SECOND).cast("long").alias("hold_us"))
    return _episodes(held, ["series"], step_s)


def service_alert_stream(
    indicators: DataFrame, keys: list[str], step_s: int = 15, rules: dict[str, tuple] = SERVICE_ALERTS
) -> DataFrame:
    """(keys, sli, step, since, state, severity) of every rule from a stream of (keys, sli, step, value); the batch twin is
    ``operators.sli.service_alerts``. One kind of state serves all rules, each with its own bound, side, hold and severity.
    """
    bad, hold, severity = rule_columns(rules)
    judged = indicators.select(
        *keys, "sli", "step", F.coalesce(bad, F.lit(False)).alias("bad"),
        F.coalesce(hold * SECOND, F.lit(0)).cast("long").alias("hold_us"),
    )
    return _episodes(judged, [*keys, "sli"], step_s).withColumn("severity", severity)
