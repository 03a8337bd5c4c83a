"""Streams drained over the given tables; their files go to the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayspark.plans.messaging import REG as MESSAGING
from stayspark.plans.registry import Registry, sql_ts
from stayspark.schemas import STAR_TABLES
from stayspark.sources.topics import append_to_folder, file_stream
from stayspark.sources.views import Views
from stayspark.streaming import hotel_events
from stayspark.streaming.delay_queue import released, run_release
from stayspark.plans.sli_queries import REG as SLI
from stayspark.plans.sli_queries import SERVICE_ALERTS_SQL, STEP, indicators
from stayspark.session import shared_folder, stored
from stayspark.streaming.runtime import drain, read_batches, write_batch
from stayspark.streaming.sli_stream import counted_slis, run_window_counts, service_alert_stream

REG = Registry({**SLI.views, **{k: MESSAGING.views[k] for k in ("parsed_log", "first_deliveries")}})
query = REG.query


class StreamingViews(Views):
    """The same views with the event table read as a stream."""

    def table(self, name):
        if name != "events":
            return super().table(name)
        return self.spark.readStream.schema(STAR_TABLES[name]).parquet(f"{self.folder}/{name}.parquet*")


def consumed(v: Views) -> str:
    """Publish the change log to a topic folder, drain the consumer, return the tables' root."""
    base = shared_folder(v.spark, "topic")
    log = v.hotel_event_log().select(
        F.col("message_key").alias("key"), F.col("payload").alias("value"), "topic",
        F.col("partition_id").alias("partition"), F.col("kafka_offset").alias("offset"),
        F.col("occurred_at").alias("timestamp"),
    )
    append_to_folder(log, f"{base}/messages")
    hotel_events.consume_stream(
        file_stream(v.spark, f"{base}/messages"), f"{base}/tables", f"{base}/ckpt"
    )
    return f"{base}/tables"


@query("src7_stream_consume", "select event_id, event_type, hotel_id, hotel_name, city from first_deliveries")
def _(v: Views):
    """Topic source, idempotent consume: one row per valid event id."""
    return hotel_events.processed(v.spark, consumed(v)).select(
        "event_id", "event_type", "hotel_id", "hotel_name", "city"
    )


@query("evt3_stream_dead_letters", """
    select 'hotel-events-' || partition_id || '-' || kafka_offset letter_id, payload, 3 attempts,
           'PENDING' retry_status from hotel_event_log where not json_valid(payload)""")
def _(v: Views):
    """The error branch of the same stream."""
    return hotel_events.current_letters(v.spark, consumed(v)).select(
        "letter_id", "payload", "attempts", "retry_status"
    )


@query("job3_stream_release", f"""
    select job_id, routing_key, {sql_ts("created_at + to_seconds(delay_s)")} execute_at from jobs
    where created_at + to_seconds(delay_s) <= (select max(created_at) from jobs)""")
def _(v: Views):
    """Jobs that were due when the stream's clock stopped."""
    base = shared_folder(v.spark, "delays")
    run_release(StreamingViews(v.spark, v.folder).jobs(), base, f"{base}/ckpt")
    return released(v.spark, base).select("job_id", "routing_key", "execute_at")


@query("sli9_stream_slis", f"""
    select uri, {sql_ts("window_end")} window_end, count(*) n,
           round(count(*) filter (where latency_ms < 20) / cast(count(*) as double), 6) latency_sli,
           round(count(*) filter (where status < 500) / cast(count(*) as double), 6) availability_sli
    from (select *, date_trunc('hour', ts) + to_hours(cast(k as int)) window_end
          from requests, (select unnest(range(1, 7)) k) g) x
    group by uri, window_end""")
def _(v: Views):
    """Six-hour windows sliding by the hour, counted per micro-batch and added up."""
    base = shared_folder(v.spark, "slis")
    run_window_counts(
        StreamingViews(v.spark, v.folder).requests(), ["uri"], f"{base}/out", f"{base}/ckpt", "6 hours", "1 hour", fast_ms=20,
    )
    return counted_slis(v.spark, f"{base}/out", {"uri": "string"}).drop("late")


@query("evt5_stream_replays", """
    select 'hotel-events-' || partition_id || '-' || kafka_offset letter_id, 2 retry_count,
           case when e % 2 = 0 then 'RESOLVED' else 'RETRIED' end retry_status,
           case when e % 2 = 0 then 'r' || e else 'e' || (e - 1) end original_event_id
    from (select *, kafka_offset // 2 e from hotel_event_log where not json_valid(payload)) r""")
def _(v: Views):
    """Every dead letter is asked for twice, the later override counts. Half of them name an event nobody has seen and
    are resolved by it, the others one that was processed long ago and stay retried."""
    base = consumed(v)
    letters = hotel_events.current_letters(v.spark, base).select("letter_id", F.expr("kafka_offset div 2").alias("e"))
    name = F.when(F.col("e") % 2 == 0, F.concat(F.lit("r"), "e")).otherwise(F.concat(F.lit("e"), F.col("e") - 1))
    body = F.format_string(
        '{"eventId":"%s","schemaVersion":1,"eventType":"CREATED","hotelId":1,"hotelName":"H","city":"C","pricePerNight":9}', name
    )
    asked = letters.select("letter_id", body.alias("body"), F.explode(F.array(F.lit(1), F.lit(2))).alias("seq"))
    requests = asked.select(
        "letter_id", "seq", F.when(F.col("seq") == 2, F.col("body")).otherwise(F.lit("zzz")).alias("payload_override")
    )
    topic, checkpoint = (base.replace("/tables", f"/{name}") for name in ("messages", "ckpt"))
    hotel_events.request_replay(v.spark, base, requests, topic, "2030-01-01 00:00:00", run=1)
    hotel_events.consume_stream(file_stream(v.spark, topic), base, checkpoint)
    return hotel_events.current_letters(v.spark, base).select("letter_id", "retry_count", "retry_status", "original_event_id")


@query("sli6_stream_alerts", SERVICE_ALERTS_SQL)
def _(v: Views):
    """The six service alerts from indicators that arrive in four portions; episodes go on from one to the next."""
    base = shared_folder(v.spark, "alerts")
    found = stored(indicators(v), "indicators")
    ends = found.agg(F.min("step").alias("a"), F.max("step").alias("b")).first()
    schema, portions = "uri string, sli string, step bigint, value double", 4
    for n in range(portions):
        share = F.least(F.floor((F.col("step") - ends["a"]) * portions / F.lit(max(1, ends["b"] - ends["a"]))), F.lit(portions - 1))
        found.filter(share == n).select("uri", "sli", "step", F.col("value").cast("double").alias("value")).write.mode("append").parquet(f"{base}/steps")
        arrived = v.spark.readStream.schema(schema).parquet(f"{base}/steps")
        alerts = service_alert_stream(arrived, ["uri"], STEP).writeStream.outputMode("append").foreachBatch(
            lambda df, batch_id: write_batch(df, f"{base}/out", batch_id)
        )
        drain(alerts, f"{base}/ckpt")
    return read_batches(
        v.spark, f"{base}/out", "uri string, sli string, step bigint, since bigint, state string, severity string"
    ).drop("batch_id")
