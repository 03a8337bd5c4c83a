"""Joins of the lodging tables.

Dimension sides (users, hotels) carry no broadcast hint: adaptive execution broadcasts them when
their measured size allows and otherwise splits a skewed key of the shuffled join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayspark.functions.columns import csv_items, stay_nights


def _hotel(hotels: DataFrame, *extra: str) -> DataFrame:
    return hotels.select(
        F.col("id").alias("hotel_id"),
        F.col("name").alias("hotel_name"),
        F.col("city"),
        *extra,
    )


def _user(users: DataFrame) -> DataFrame:
    return users.select(F.col("id").alias("user_id"), "username")


def bookings_of_username(bookings: DataFrame, users: DataFrame, username: str | None = None):
    """Bookings with their owner's name; optionally one owner, ordered by check-in."""
    owners = _user(users)
    if username is not None:
        owners = owners.filter(F.col("username") == username)
        return bookings.join(owners, "user_id").orderBy("check_in", "id")
    return bookings.join(owners, "user_id")


def booking_graph(bookings: DataFrame, hotels: DataFrame, users: DataFrame) -> DataFrame:
    """Booking with hotel and user in one plan (no lookups per row)."""
    return bookings.join(_hotel(hotels), "hotel_id").join(_user(users), "user_id")


def booking_rows(graph: DataFrame) -> DataFrame:
    """The columns a booking answer shows."""
    wanted = [
        "id", "user_id", "username", "hotel_id", "hotel_name", "room_type", "check_in",
        "check_out", "status", "rate_plan", "total_price",
    ]
    return graph.select(*[c for c in wanted if c in graph.columns])


def payment_rows(payments: DataFrame, bookings: DataFrame, hotels: DataFrame) -> DataFrame:
    b = bookings.select(
        F.col("id").alias("booking_id"), "user_id", "hotel_id", F.col("status").alias("booking_status")
    )
    return (
        payments.join(b, "booking_id")
        .join(_hotel(hotels).drop("city"), "hotel_id")
        .select(
            "id", "booking_id", "user_id", "hotel_id", "hotel_name", "amount", "status",
            "booking_status", "transaction_reference",
        )
    )


def notification_rows(notes: DataFrame) -> DataFrame:
    """The columns a notification answer shows."""
    return notes.select("id", "booking_id", "type", "message", F.col("is_read").alias("read"), "created_at")


def event_rows(processed: DataFrame) -> DataFrame:
    """The columns the dashboard shows of processed events; an event without an own time was processed when it occurred."""
    at = F.col("processed_at") if "processed_at" in processed.columns else F.col("occurred_at")
    return processed.select(
        "event_id", "schema_version", "event_type", "hotel_id", "hotel_name", "city", "price_per_night", "topic_name",
        "message_key", "partition_id", "kafka_offset", "consumer_group_id", "occurred_at", at.alias("processed_at"),
    )


def letter_rows(letters: DataFrame) -> DataFrame:
    """The columns the dashboard shows of dead letters."""
    return letters.select(
        F.col("letter_id").alias("id"), "original_topic", "dead_letter_topic", "message_key", "partition_id", "kafka_offset",
        "payload", "original_event_id", "original_event_type", "original_hotel_id", "error_class_name", "error_message",
        "retry_status", "retry_count", "last_retried_at", "resolved_at", "dead_lettered_at",
    )


def inventory_rows(inventory: DataFrame, hotels: DataFrame) -> DataFrame:
    return inventory.join(_hotel(hotels).drop("city"), "hotel_id").select(
        "hotel_id", "hotel_name", "room_type", "inventory_date", "available_rooms"
    )


def hotels_with_manager(hotels: DataFrame, users: DataFrame) -> DataFrame:
    managers = users.select(F.col("id").alias("manager_id"), F.col("username").alias("manager_name"))
    return hotels.join(managers, "manager_id", "left").select(
        "id", "name", "city", "manager_id", "manager_name"
    )


def overlap_counts(windows: DataFrame, bookings: DataFrame) -> DataFrame:
    """For every (hotel_id, first, last) window, how many stays meet it; zero when none.

    A stay misses [first, last) exactly when it starts at or after ``last`` or ends at or before
    ``first``, and no stay does both. So the count is (stays starting before last) minus (stays
    ending by first): two running totals over days. Bookings collapse to one row per hotel and day
    before the shuffle and no booking-window pair is ever formed, however many bookings one hotel
    has.
    """
    starts = bookings.groupBy("hotel_id", F.col("check_in").alias("day")).agg(
        F.count(F.lit(1)).alias("n_start"), F.lit(0).cast("long").alias("n_end")
    )
    ends = bookings.groupBy("hotel_id", F.col("check_out").alias("day")).agg(
        F.lit(0).cast("long").alias("n_start"), F.count(F.lit(1)).alias("n_end")
    )
    # Window bounds ride along as probe days: a start counts strictly before its day's probe, an
    # end counts up to and including it.
    probes = windows.select("hotel_id", F.explode(F.array("first", "last")).alias("day")).distinct()
    days = (
        starts.unionByName(ends)
        .unionByName(
            probes.select(
                "hotel_id", "day",
                F.lit(0).cast("long").alias("n_start"), F.lit(0).cast("long").alias("n_end"),
            )
        )
        .groupBy("hotel_id", "day")
        .agg(F.sum("n_start").alias("n_start"), F.sum("n_end").alias("n_end"))
    )
    w = Window.partitionBy("hotel_id").orderBy("day")
    totals = days.select(
        "hotel_id",
        "day",
        F.coalesce(
            F.sum("n_start").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("started_before"),
        F.sum("n_end").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("ended_by"),
    )
    by_last = totals.select("hotel_id", F.col("day").alias("last"), "started_before")
    by_first = totals.select("hotel_id", F.col("day").alias("first"), "ended_by")
    return (
        windows.join(by_last, ["hotel_id", "last"])
        .join(by_first, ["hotel_id", "first"])
        .select(*windows.columns, (F.col("started_before") - F.col("ended_by")).alias("n_stays"))
    )


def explode_nights(bookings: DataFrame, night: str = "night") -> DataFrame:
    """One row per booked night; stays that are empty or inverted yield none."""
    return bookings.withColumn(night, F.explode(stay_nights(F.col("check_in"), F.col("check_out"))))


def nights_with_inventory(bookings: DataFrame, inventory: DataFrame, how: str = "inner"):
    stock = inventory.withColumnRenamed("inventory_date", "night")
    return explode_nights(bookings).join(stock, ["hotel_id", "room_type", "night"], how)


def hit_details(hits: DataFrame, hotels: DataFrame) -> DataFrame:
    """Hits re-read from the table of record, with the comma list split."""
    facts = hotels.select(
        F.col("id"), "name", "city", "price_per_night",
        csv_items(F.col("amenities")).alias("amenity_list"),
    )
    return hits.join(facts, "id")


def letters_with_processed(letters: DataFrame, processed: DataFrame) -> DataFrame:
    done = processed.select(
        F.col("event_id").alias("original_event_id"), F.col("occurred_at").alias("processed_occurred_at")
    )
    return letters.filter("original_event_id is not null").join(done, "original_event_id")


def bookings_of_looked_up_user(bookings: DataFrame, users: DataFrame, pick: Column) -> DataFrame:
    """Bookings of the user a scalar sub-query finds (the lowest id satisfying ``pick``)."""
    user_id = users.filter(pick).agg(F.min("id").alias("id")).scalar()
    return bookings.filter(F.col("user_id") == user_id)
