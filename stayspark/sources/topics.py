"""Event-topic source and sink. A topic row is (key, value, topic, partition, offset, timestamp)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOPIC_ROW = (
    "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"
)


def kafka_stream(spark: SparkSession, servers: str, topic: str, max_offsets: int = 5_000_000):
    """Topic stream from the earliest offset (needs the Kafka connector on the class path)."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", str(max_offsets))
        .load()
    )
    return raw.select(
        F.col("key").cast("string"),
        F.col("value").cast("string"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


def file_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """The same columns from a folder of Parquet files."""
    return (
        spark.readStream.schema(TOPIC_ROW)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder)
    )


def event_messages(changes: DataFrame, event_id: Column, occurred_at: Column) -> DataFrame:
    """Hotel changes -> topic messages: key is the hotel id, so one hotel stays in order.

    ``changes`` carries event_type, hotel_id, hotel_name, city, price_per_night.
    """
    body = F.struct(
        event_id.alias("eventId"),
        F.lit(1).alias("schemaVersion"),
        F.col("event_type").alias("eventType"),
        F.col("hotel_id").alias("hotelId"),
        F.col("hotel_name").alias("hotelName"),
        F.col("city"),
        F.col("price_per_night").alias("pricePerNight"),
        F.date_format(occurred_at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("occurredAt"),
    )
    return changes.select(
        F.col("hotel_id").cast("string").alias("key"), F.to_json(body).alias("value")
    )


def raw_messages(payloads: DataFrame, key: str, value: str) -> DataFrame:
    """Ready-made payloads under the caller's key."""
    return payloads.select(F.col(key).cast("string").alias("key"), F.col(value).alias("value"))


def append_to_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def append_to_folder(messages: DataFrame, folder: str) -> None:
    messages.write.mode("append").parquet(folder)
