"""Generated and derived inputs: series loads, calendars, rotating assignment, idempotent seeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayspark.functions.skew import segmented_running_sum
from stayspark.schemas import OPENING_ROOMS


def series(spark: SparkSession, n: int | Column, columns: dict[str, Column]) -> DataFrame:
    """Rows g = 1..n with one expression per column over ``g``."""
    return spark.range(1, n + 1).withColumnRenamed("id", "g").select(
        "g", *[c.alias(name) for name, c in columns.items()]
    )


def lab_bookings(numbered: DataFrame, hotel_count: Column) -> DataFrame:
    """Series-style booking rows from a frame with ``g``: every attribute is a modulus of g.

    Fixed values: status cycle CONFIRMED, PENDING, CANCELLED; room cycle SINGLE, DOUBLE, SUITE.
    """
    g = F.col("g")
    status = F.array(*[F.lit(s) for s in ("CONFIRMED", "PENDING", "CANCELLED")])
    room = F.array(*[F.lit(s) for s in ("SINGLE", "DOUBLE", "SUITE")])
    start = F.date_add(F.lit("2026-01-01").cast("date"), (g % 365).cast("int"))
    return numbered.select(
        "g",
        (g % hotel_count).alias("hotel_rank"),
        F.element_at(room, (1 + g % 3).cast("int")).alias("room_type"),
        start.alias("check_in"),
        F.date_add(start, (1 + g % 5).cast("int")).alias("check_out"),
        F.element_at(status, (1 + g % 3).cast("int")).alias("status"),
        (F.lit(50) + g % 400).cast("decimal(12,2)").alias("total_price"),
    )


def opening_inventory(
    hotels: DataFrame, first: str, last: str, hotel_id: str = "id"
) -> DataFrame:
    """One row per hotel, room type and date in [first, last], built without any join."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    rooms = F.array(
        *[
            F.struct(F.lit(t).alias("room_type"), F.lit(n).alias("available_rooms"))
            for t, n in OPENING_ROOMS
        ]
    )
    return (
        hotels.select(F.col(hotel_id).alias("hotel_id"), F.explode(days).alias("inventory_date"))
        .withColumn("_room", F.explode(rooms))
        .select("hotel_id", "_room.room_type", "inventory_date", "_room.available_rooms")
    )


def zero_based_rank(df: DataFrame, id_col: str, rank_col: str, segment_width: int = 1_000_000):
    """Position of every row in id order, from 0, scanned per id range instead of in one task."""
    seg = F.floor(F.col(id_col) / F.lit(segment_width)).cast("long")
    keyed = df.withColumn("_all", F.lit(0))
    ranked = segmented_running_sum(
        keyed, ["_all"], [F.col(id_col)], seg, {rank_col: F.lit(1).cast("long")}
    )
    return ranked.drop("_all").withColumn(rank_col, F.col(rank_col) - 1)


def assign_rotating(rows: DataFrame, pool: DataFrame, pool_id: str, rank_col: str) -> DataFrame:
    """Give row ``g`` the pool member at position ``g mod pool size`` (rank join, no offset scan).

    ``rows`` carries ``g``; the result adds the pool columns.
    """
    size = pool.agg(F.count(F.lit(1)).alias("n")).scalar()
    ranked = zero_based_rank(pool, pool_id, rank_col)
    return rows.withColumn(rank_col, F.col("g") % size).join(ranked, rank_col, "inner")


def only_new(
    candidates: DataFrame, existing: DataFrame, key: str, ignore_case: bool = False
) -> DataFrame:
    """Candidates whose natural key is not present yet; of equal candidates the lowest id stays."""
    def norm(c):
        return F.lower(F.col(c)) if ignore_case else F.col(c)

    others = [c for c in candidates.columns if c != "_key"]
    unique = (
        candidates.withColumn("_key", norm(key))
        .groupBy("_key")
        .agg(F.min_by(F.struct(*others), F.col("id")).alias("_row"))
        .select("_key", "_row.*")
    )
    seen = existing.select(norm(key).alias("_key"))
    return unique.join(seen, "_key", "left_anti").drop("_key")
