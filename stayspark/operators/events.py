"""Hotel-change events: parse, keep first deliveries, dead-letter, replay, capture and apply changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayspark.functions.columns import blank_to_null, once
from stayspark.functions.payloads import is_valid_event, missing_fields, parse_error, parse_hotel_event
from stayspark.functions.skew import first_per_key, latest_per_key

# Fixed values of the model.
ATTEMPTS = 3
DEAD_LETTER_TOPIC = "hotel-events-dlt"
CONSUMER_GROUP = "hotel-status"


def parse_log(log: DataFrame) -> DataFrame:
    """Topic rows plus the parsed ``event`` struct and ``error`` (null when valid).

    ``log``: topic, message_key, partition_id, kafka_offset, payload, occurred_at.
    """
    parsed = log.withColumn("event", once(parse_hotel_event(F.col("payload"))))
    error = F.when(~F.coalesce(is_valid_event(F.col("event")), F.lit(False)), parse_error(F.col("event")))
    return parsed.withColumn("error", error)


def parsed_fields(log: DataFrame) -> DataFrame:
    """Flat view of the parse: event fields, the error branch, and fields a valid record lacks."""
    e = F.col("event")
    return parse_log(log).select(
        "partition_id", "kafka_offset",
        e["eventId"].alias("event_id"), e["schemaVersion"].alias("schema_version"),
        e["eventType"].alias("event_type"), e["hotelId"].alias("hotel_id"),
        e["hotelName"].alias("hotel_name"), e["city"].alias("city"),
        e["pricePerNight"].alias("price_per_night"),
        F.when(F.col("error").isNull(), missing_fields(e)).alias("missing_fields"),
        "error",
    )


def to_processed(valid: DataFrame) -> DataFrame:
    e = F.col("event")
    return valid.select(
        e["eventId"].alias("event_id"), e["schemaVersion"].alias("schema_version"),
        e["eventType"].alias("event_type"), e["hotelId"].alias("hotel_id"),
        e["hotelName"].alias("hotel_name"), e["city"].alias("city"),
        e["pricePerNight"].alias("price_per_night"), F.col("topic").alias("topic_name"),
        "message_key", "partition_id", "kafka_offset",
        F.lit(CONSUMER_GROUP).alias("consumer_group_id"), "occurred_at",
    )


def unseen(candidates: DataFrame, history: DataFrame, key: str = "event_id") -> DataFrame:
    """Candidates whose key the history does not hold, for all of history.

    History is first cut to keys that are asked for. Adaptive execution ships the keys to the history scan
    where they are few, which then shuffles nothing, and sorts both sides otherwise.
    """
    seen = history.select(key).join(candidates.select(key).distinct(), key, "left_semi").distinct()
    return candidates.join(seen, key, "left_anti")


def consume(log: DataFrame, processed: DataFrame | None = None) -> DataFrame:
    """First delivery of every valid event id, minus ids processed before."""
    valid = parse_log(log).filter("error is null")
    first = first_per_key(
        to_processed(valid), ["event_id"], [F.col("partition_id"), F.col("kafka_offset")]
    )
    return first if processed is None else unseen(first, processed)


def dead_letters(log: DataFrame, as_of: str | None = None) -> DataFrame:
    """One PENDING letter per record that could not be read, in the same partition.

    The parse gives the same answer on every attempt, so the attempts are recorded, not repeated.
    """
    return to_letters(parse_log(log).filter("error is not null"), as_of)


def to_letters(bad: DataFrame, as_of: str | None = None) -> DataFrame:
    e = F.col("event")
    at = F.lit(as_of).cast("timestamp") if as_of is not None else F.col("occurred_at")
    return bad.select(
        F.concat_ws("-", F.coalesce("topic", F.lit("unknown")), "partition_id", "kafka_offset").alias("letter_id"),
        F.coalesce("topic", F.lit("unknown")).alias("original_topic"),
        F.lit(DEAD_LETTER_TOPIC).alias("dead_letter_topic"),
        "message_key", "partition_id", "kafka_offset", "payload",
        F.when(e["_corrupt"].isNull(), e["eventId"]).alias("original_event_id"),
        F.when(e["_corrupt"].isNull(), e["eventType"]).alias("original_event_type"),
        F.when(e["_corrupt"].isNull(), e["hotelId"]).alias("original_hotel_id"),
        F.lit("PayloadError").alias("error_class_name"),
        F.col("error").alias("error_message"),
        F.lit(ATTEMPTS).alias("attempts"),
        F.lit("PENDING").alias("retry_status"),
        F.lit(0).alias("retry_count"),
        F.lit(None).cast("timestamp").alias("last_retried_at"),
        F.lit(None).cast("timestamp").alias("resolved_at"),
        at.alias("dead_lettered_at"),
    )


def retry(letters: DataFrame, requests: DataFrame, as_of: str) -> DataFrame:
    """Letters after a batch of replay requests (letter_id, payload_override[, seq]); ``replayed`` marks them.

    Every request of a letter counts; the last override that is not blank stays, by ``seq``, or the
    greatest text where requests carry no order.
    """
    now = F.lit(as_of).cast("timestamp")
    text = blank_to_null(F.col("payload_override"))
    order = F.struct(F.col("seq"), text) if "seq" in requests.columns else text
    overrides = requests.filter("letter_id is not null").groupBy("letter_id").agg(
        F.max_by(text, F.when(text.isNotNull(), order)).alias("_override"), F.count(F.lit(1)).cast("int").alias("_asked")
    )
    joined = letters.join(overrides, "letter_id", "left").withColumn(
        "payload", F.coalesce("_override", "payload")
    )
    parsed = joined.withColumn("_e", once(parse_hotel_event(F.col("payload"))))
    asked = F.col("_asked").isNotNull()
    ok = F.coalesce(is_valid_event(F.col("_e")), F.lit(False))

    def derived(field: str, column: str):
        return F.when(asked, F.when(ok, F.col("_e")[field])).otherwise(F.col(column)).alias(column)

    changed = {
        "original_event_id": derived("eventId", "original_event_id"),
        "original_event_type": derived("eventType", "original_event_type"),
        "original_hotel_id": derived("hotelId", "original_hotel_id"),
        "retry_status": F.when(asked, "RETRIED").otherwise(F.col("retry_status")),
        "retry_count": F.col("retry_count") + F.coalesce("_asked", F.lit(0)),
        "last_retried_at": F.when(asked, now).otherwise(F.col("last_retried_at")),
        "resolved_at": F.when(~asked, F.col("resolved_at")),
    }
    return parsed.select(
        *[changed[c].alias(c) if c in changed else F.col(c) for c in letters.columns],
        asked.alias("replayed"),
    )


def replayed_log(retried: DataFrame, as_of: str) -> DataFrame:
    """What the replay sends back to the original topic."""
    return retried.filter("replayed").select(
        F.col("original_topic").alias("topic"), "message_key", "partition_id", "kafka_offset",
        "payload", F.lit(as_of).cast("timestamp").alias("occurred_at"),
    )


def resolve(letters: DataFrame, newly_processed: DataFrame, as_of: str) -> DataFrame:
    """Letters of an event id processed just now become RESOLVED.

    An id that was processed earlier is skipped by the consumer, so its letter stays RETRIED.
    """
    done = newly_processed.select(F.col("event_id").alias("original_event_id")).distinct()
    joined = letters.join(done.withColumn("_done", F.lit(True)), "original_event_id", "left")
    hit = F.col("_done").isNotNull()
    return joined.select(
        *[c for c in letters.columns if c not in ("retry_status", "resolved_at")],
        F.when(hit, "RESOLVED").otherwise(F.col("retry_status")).alias("retry_status"),
        F.when(hit, F.lit(as_of).cast("timestamp")).otherwise(F.col("resolved_at")).alias("resolved_at"),
    )


def replay(letters: DataFrame, requests: DataFrame, processed: DataFrame, as_of: str):
    """(letters after the replay, newly processed events)."""
    retried = retry(letters, requests, as_of)
    fresh = consume(replayed_log(retried, as_of), processed)
    return resolve(retried, fresh, as_of), fresh


def capture_changes(before: DataFrame, after: DataFrame, compare: list[str], key: str = "id") -> DataFrame:
    """CREATED / UPDATED / DELETED rows between two snapshots, with the values after (before, if deleted)."""
    b = before.select(key, F.struct(*compare).alias("_before"))
    a = after.select(key, F.struct(*compare).alias("_after"))
    kind = (
        F.when(F.col("_before").isNull(), "CREATED")
        .when(F.col("_after").isNull(), "DELETED")
        .when(~F.col("_before").eqNullSafe(F.col("_after")), "UPDATED")
    )
    changed = b.join(a, key, "full").withColumn("event_type", kind).filter("event_type is not null")
    row = F.coalesce("_after", "_before")
    return changed.select(key, "event_type", *[row[c].alias(c) for c in compare])


def apply_changes(
    snapshot: DataFrame | None, changes: DataFrame, key: str, order: list, columns: list[str]
) -> DataFrame:
    """Projection after a change log: the newest change per key decides; DELETED removes the row.

    Keys the log does not touch keep their snapshot row, which is not shuffled into the ranking.
    """
    newest = latest_per_key(changes, [key], order, ["event_type", *columns])
    upserts = newest.filter("event_type <> 'DELETED'").select(key, *columns)
    if snapshot is None:
        return upserts
    untouched = snapshot.select(key, *columns).join(newest.select(key), key, "left_anti")
    return untouched.unionByName(upserts)


def consumer_lag(end_offsets: DataFrame, committed: DataFrame) -> DataFrame:
    """(topic, consumer_group_id, lag): newest offset minus committed offset, summed over partitions."""
    ends = end_offsets.groupBy("topic", "partition_id").agg(F.max("kafka_offset").alias("_end"))
    done = committed.groupBy(
        F.col("topic_name").alias("topic"), "consumer_group_id", "partition_id"
    ).agg(F.max("kafka_offset").alias("_done"))
    rows = ends.join(done, ["topic", "partition_id"], "left")
    # A group owes the whole of a partition it never committed: everything minus what it reached.
    one_per_partition = Window.partitionBy("topic", "partition_id").orderBy("consumer_group_id")
    size = F.when(F.row_number().over(one_per_partition) == 1, F.col("_end") + 1)
    sized = rows.withColumn("_size", size)
    total = F.sum("_size").over(Window.partitionBy("topic"))
    behind = F.greatest(F.col("_end") - F.col("_done"), F.lit(0))
    return (
        sized.withColumn("_total", total)
        .filter("consumer_group_id is not null")
        .groupBy("topic", "consumer_group_id")
        .agg((F.sum(behind) + F.max("_total") - F.sum(F.col("_end") + 1)).alias("lag"))
    )
