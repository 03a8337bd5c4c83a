"""The hotel-event consumer: idempotent consume, dead letters, replay.

Tables under one root: ``processed`` and ``letters``, written per micro-batch, and ``retries``, written by replay
requests. A micro-batch reads none of them; whether a letter is resolved is worked out when letters are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayspark.operators import events
from stayspark.sources.topics import append_to_folder
from stayspark.streaming.runtime import drain, first_arrivals, read_batches, write_batch

PROCESSED = (
    "event_id string, schema_version int, event_type string, hotel_id bigint, hotel_name string,"
    " city string, price_per_night double, topic_name string, message_key string,"
    " partition_id int, kafka_offset bigint, consumer_group_id string, occurred_at timestamp"
)
LETTERS = (
    "letter_id string, original_topic string, dead_letter_topic string, message_key string,"
    " partition_id int, kafka_offset bigint, payload string, original_event_id string,"
    " original_event_type string, original_hotel_id bigint, error_class_name string,"
    " error_message string, attempts int, retry_status string, retry_count int,"
    " last_retried_at timestamp, resolved_at timestamp, dead_lettered_at timestamp"
)
RETRIES = (
    "letter_id string, payload string, original_event_id string, original_event_type string,"
    " original_hotel_id bigint, retried_at timestamp, retry_count int"
)


def as_log(messages: DataFrame) -> DataFrame:
    """Topic row names -> the names the batch operators use."""
    return messages.select(
        F.col("topic"), F.col("key").alias("message_key"), F.col("partition").alias("partition_id"),
        F.col("offset").alias("kafka_offset"), F.col("value").alias("payload"),
        F.col("timestamp").alias("occurred_at"),
    )


def consume_stream(messages: DataFrame, root: str, checkpoint: str) -> None:
    """Drain a topic stream into the tables.

    An event id is processed once, however late a delivery comes: first deliveries are kept in keyed state, see
    ``first_arrivals``. A broken record becomes a letter; topic, partition and offset name it.
    """
    place = F.concat_ws("-", F.lit("place"), "topic", F.col("partition_id").cast("string"), F.col("kafka_offset").cast("string"))
    parsed = events.parse_log(as_log(messages))
    valid = F.col("error").isNull()
    keyed = parsed.withColumn("_key", F.when(valid, F.concat(F.lit("event-"), F.col("event.eventId"))).otherwise(place))
    first = first_arrivals(keyed, "_key", [F.col("partition_id"), F.col("kafka_offset")])

    def settle_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.filter("fresh").select("row.*").persist()
        try:
            write_batch(events.to_processed(batch.filter("error is null")), f"{root}/processed", batch_id)
            write_batch(events.to_letters(batch.filter("error is not null")), f"{root}/letters", batch_id)
        finally:
            batch.unpersist()

    drain(first.writeStream.outputMode("update").foreachBatch(settle_batch), checkpoint)


def request_replay(
    spark: SparkSession, root: str, requests: DataFrame, topic_folder: str, as_of: str, run: int
) -> None:
    """Record replay requests (letter_id, payload_override) and send the payloads back to the topic."""
    letters = current_letters(spark, root)
    retried = events.retry(letters, requests, as_of).filter("replayed").persist()
    try:
        rows = retried.select(
            "letter_id", "payload", "original_event_id", "original_event_type", "original_hotel_id",
            F.col("last_retried_at").alias("retried_at"), "retry_count",
        )
        write_batch(rows, f"{root}/retries", run)
        # Offsets of replayed messages are new; they follow the letter's, run by run.
        messages = events.replayed_log(retried, as_of).select(
            F.col("message_key").alias("key"), F.col("payload").alias("value"), "topic",
            F.col("partition_id").alias("partition"),
            (F.col("kafka_offset") + F.lit(run) * F.lit(1 << 40)).alias("offset"),
            F.col("occurred_at").alias("timestamp"),
        )
        append_to_folder(messages, topic_folder)
    finally:
        retried.unpersist()


def current_letters(spark: SparkSession, root: str) -> DataFrame:
    """Letters with the effect of replays and of later successes."""
    letters = read_batches(spark, f"{root}/letters", LETTERS).withColumnRenamed("batch_id", "_batch")
    retries = read_batches(spark, f"{root}/retries", RETRIES)
    last = retries.groupBy("letter_id").agg(
        F.max_by(
            F.struct("payload", "original_event_id", "original_event_type", "original_hotel_id", "retried_at", "retry_count"),
            "batch_id",
        ).alias("r"),
    )
    joined = letters.join(last, "letter_id", "left")
    asked = F.col("r").isNotNull()
    effective = joined.select(
        *[
            F.when(asked, F.col(f"r.{c}")).otherwise(F.col(c)).alias(c)
            if c in ("payload", "original_event_id", "original_event_type", "original_hotel_id")
            else F.when(asked, "RETRIED").otherwise(F.col(c)).alias(c) if c == "retry_status"
            else F.coalesce("r.retry_count", c).alias(c) if c == "retry_count"
            else F.when(asked, F.col("r.retried_at")).otherwise(F.col(c)).alias(c) if c == "last_retried_at"
            else F.col(c)
            for c in letters.columns
        ]
    )
    # A success closes a letter that was there by then, unless it was asked for again after that.
    done = read_batches(spark, f"{root}/processed", PROCESSED).select(
        F.col("event_id").alias("original_event_id"), F.col("occurred_at").alias("_at"), F.col("batch_id").alias("_done")
    )
    named = effective.filter("original_event_id is not null")
    joined = named.join(done, "original_event_id", "left")
    answers = F.when(F.col("last_retried_at").isNull(), F.col("_done") >= F.col("_batch")).otherwise(F.col("_at") >= F.col("last_retried_at"))
    nameless = effective.filter("original_event_id is null").withColumn("_at", F.lit(None).cast("timestamp"))
    final = joined.withColumn("_at", F.when(answers, F.col("_at"))).select(*effective.columns, "_at").unionByName(nameless)
    return final.select(
        *[
            F.when(F.col("_at").isNotNull(), "RESOLVED").otherwise(F.col(c)).alias(c) if c == "retry_status"
            else F.coalesce("_at", c).alias(c) if c == "resolved_at"
            else F.col(c)
            for c in letters.columns
            if c != "_batch"
        ]
    )


def processed(spark: SparkSession, root: str) -> DataFrame:
    return read_batches(spark, f"{root}/processed", PROCESSED).drop("batch_id")
