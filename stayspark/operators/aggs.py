"""Aggregations. Every grouped result is rows, never one list per group, so no group has to fit
in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayspark.functions.columns import csv_items, nights
from stayspark.functions.skew import segmented_running_sum
from stayspark.operators.joins import explode_nights
from stayspark.schemas import saas_plan_frame


def counts(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def conditional_sum_mean(df: DataFrame, condition: Column, value: Column, *keys: str) -> DataFrame:
    """Sum and mean over the rows that satisfy the condition; the mean of nothing is null."""
    kept = F.when(condition, value)
    return df.groupBy(*keys).agg(
        F.coalesce(F.sum(kept), F.lit(0)).alias("total"), F.avg(kept).alias("mean")
    )


def ordered_members(
    df: DataFrame, key: str, order: str, member: str, segment_width: int = 100_000
) -> DataFrame:
    """(key, position, member): the ordered list of every group, as rows.

    ``order`` is a numeric column; ranges of it are the segments of the running count.
    """
    seg = F.floor(F.col(order) / F.lit(segment_width)).cast("long")
    ranked = segmented_running_sum(
        df.select(key, order, member), [key], [F.col(order)], seg,
        {"position": F.lit(1).cast("long")},
    )
    return ranked.select(key, "position", member)


def stay_availability(requests: DataFrame, inventory: DataFrame) -> DataFrame:
    """Is every night of the stay covered? requests: request_id, hotel_id, room_type (null = any),
    check_in, check_out.

    Requests repeat: availability is worked out once per distinct (hotel, type, dates) and joined
    back. An omitted type matches the per-day best over all types, prepared as type ``*``.
    """
    shape = ["hotel_id", "_type", "check_in", "check_out"]
    typed = requests.withColumn("_type", F.coalesce("room_type", F.lit("*")))
    shapes = typed.select(*shape).distinct().filter("check_out > check_in")
    stock = inventory.select(
        "hotel_id", F.col("room_type").alias("_type"), F.col("inventory_date").alias("night"),
        (F.col("available_rooms") > 0).alias("_open"),
    )
    any_type = stock.groupBy("hotel_id", "night").agg(F.max("_open").alias("_open"))
    stock = stock.unionByName(any_type.withColumn("_type", F.lit("*")))
    covered = (
        explode_nights(shapes)
        .join(stock.filter("_open"), ["hotel_id", "_type", "night"])
        .groupBy(*shape)
        .agg(F.countDistinct("night").alias("nights_covered"))
    )
    wanted = nights(F.col("check_in"), F.col("check_out"))
    return typed.join(covered, shape, "left").select(
        "request_id", "hotel_id", "room_type", "check_in", "check_out",
        F.greatest(wanted, F.lit(0)).alias("nights_requested"),
        F.coalesce("nights_covered", F.lit(0)).alias("nights_covered"),
        ((wanted > 0) & (F.coalesce("nights_covered", F.lit(0)) == wanted)).alias("available"),
    )


def nightly_availability(requests: DataFrame, inventory: DataFrame) -> DataFrame:
    """The night-by-night list behind the answer: one row per request, night and matching type."""
    stock = inventory.select(
        "hotel_id", F.col("room_type").alias("stock_type"),
        F.col("inventory_date").alias("night"), "available_rooms",
    )
    typed = explode_nights(requests.filter("room_type is not null")).join(
        stock.withColumnRenamed("stock_type", "room_type"), ["hotel_id", "room_type", "night"]
    )
    untyped = (
        explode_nights(requests.filter("room_type is null"))
        .drop("room_type")
        .join(stock.withColumnRenamed("stock_type", "room_type"), ["hotel_id", "night"])
    )
    columns = ["request_id", "hotel_id", "room_type", "night", "available_rooms"]
    return typed.select(*columns).unionByName(untyped.select(*columns))


def distinct_items(df: DataFrame, csv_column: str, *keys: str) -> DataFrame:
    """Distinct members of comma lists, as rows."""
    return df.select(*keys, F.explode(csv_items(F.col(csv_column))).alias("item")).distinct()


def effective_plans(managers: DataFrame, hotels: DataFrame) -> DataFrame:
    """Best plan among a manager's hotels by rank, FREE when the manager has none."""
    spark = hotels.sparkSession
    owned = (
        hotels.filter("manager_id is not null")
        .groupBy("manager_id", "saas_plan")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(F.broadcast(saas_plan_frame(spark)), "saas_plan")
        .groupBy("manager_id")
        .agg(F.max_by("saas_plan", "plan_rank").alias("plan"), F.sum("n").alias("owned"))
    )
    return managers.select(F.col("id").alias("manager_id")).join(owned, "manager_id", "left").select(
        "manager_id",
        F.coalesce("plan", F.lit("FREE")).alias("effective_plan"),
        F.coalesce("owned", F.lit(0)).alias("owned"),
    )


def summary_row(spark, **frames: DataFrame) -> DataFrame:
    """One row with the row count of every frame, each a scalar sub-query of one plan."""
    columns = [
        frame.agg(F.count(F.lit(1)).alias("n")).scalar().alias(name)
        for name, frame in frames.items()
    ]
    return spark.range(1).select(*columns)


def index_drift(table: DataFrame, index: DataFrame, key: str = "id") -> DataFrame:
    """Keys present on one side only."""
    t = table.select(F.col(key)).distinct().withColumn("_t", F.lit(True))
    i = index.select(F.col(key)).distinct().withColumn("_i", F.lit(True))
    joined = t.join(i, key, "full").filter("_t is null or _i is null")
    return joined.select(
        key, F.when(F.col("_i").isNull(), "missing in index").otherwise("missing in table").alias("drift")
    )


def queue_depth(published: DataFrame, consumed: DataFrame, key: str = "routing_key") -> DataFrame:
    """Published minus consumed per key, never below zero."""
    p = counts(published, key, name="published")
    c = counts(consumed, key, name="consumed")
    return p.join(c, key, "left").select(
        key,
        "published",
        F.coalesce("consumed", F.lit(0)).alias("consumed"),
        F.greatest(F.col("published") - F.coalesce("consumed", F.lit(0)), F.lit(0)).alias("depth"),
    )
