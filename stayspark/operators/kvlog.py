"""Compaction of a keyed change log into the current value of every key.

A write replaces the whole value of its key. Values with several elements arrive as one row per
element, (key, write_id, pos, ...), and stay rows: lists and sets are never gathered into one cell,
and ordered answers are range-sorted on (key, order), so one large key spreads over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayspark.functions.skew import latest_per_key

NO_EXPIRY, NO_KEY = -1, -2


def current_strings(log: DataFrame) -> DataFrame:
    """Latest (key, value, expires_at) per key; log: k, seq, value, written_at, ttl_s (nullable)."""
    newest = latest_per_key(log, ["k"], [F.col("seq")], ["value", "written_at", "ttl_s"])
    expires = F.col("written_at") + F.make_dt_interval(secs=F.col("ttl_s").cast("decimal(18,6)"))
    return newest.select("k", "value", F.when(F.col("ttl_s").isNotNull(), expires).alias("expires_at"))


def live(values: DataFrame, as_of: str) -> DataFrame:
    at = F.lit(as_of).cast("timestamp")
    return values.filter(F.col("expires_at").isNull() | (F.col("expires_at") > at))


def ttl_seconds(expires_at: Column, present: Column, as_of: str) -> Column:
    """Remaining seconds, rounded; -1 without expiry, -2 for a key that is not there."""
    left = F.unix_millis(expires_at) - F.unix_millis(F.lit(as_of).cast("timestamp"))
    rounded = F.floor((left + 500) / F.lit(1000)).cast("long")
    return F.when(~present, F.lit(NO_KEY)).when(expires_at.isNull(), F.lit(NO_EXPIRY)).otherwise(rounded)


def lookup(keys: DataFrame, log: DataFrame, as_of: str) -> DataFrame:
    """Value and time-to-live of a batch of keys."""
    found = live(current_strings(log), as_of).withColumn("_found", F.lit(True))
    joined = keys.join(found, "k", "left")
    return joined.select(
        "k", "value", ttl_seconds(F.col("expires_at"), F.col("_found").isNotNull(), as_of).alias("ttl")
    )


def current_hashes(log: DataFrame) -> DataFrame:
    """Field map of the latest write per key; one write is one row with a map."""
    return log.groupBy("k").agg(F.max_by("fields", "seq").alias("fields"))


def latest_write(log: DataFrame) -> DataFrame:
    """All element rows of the newest write of every key."""
    newest = log.groupBy("k").agg(F.max("write_id").alias("write_id"))
    return log.join(newest, ["k", "write_id"])


def current_lists(log: DataFrame) -> DataFrame:
    """(k, pos, value), duplicates kept, in list order."""
    return latest_write(log).select("k", "pos", "value").orderBy("k", "pos")


def current_sets(log: DataFrame) -> DataFrame:
    """(k, member), unique, sorted."""
    return latest_write(log).select("k", F.col("value").alias("member")).distinct().orderBy("k", "member")


def current_sorted_sets(log: DataFrame) -> DataFrame:
    """(k, member, score): the last score given to a member in the write wins; by score, then member."""
    return (
        latest_write(log)
        .groupBy("k", F.col("value").alias("member"))
        .agg(F.max_by("score", "pos").alias("score"))
        .orderBy("k", "score", "member")
    )
