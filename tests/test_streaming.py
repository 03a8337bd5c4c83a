"""Streams are drained over files and compared with their batch twins or with the expected rows."""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import functions as F

from stayspark.operators import sli
from stayspark.sources.topics import TOPIC_ROW, append_to_folder, file_stream
from stayspark.streaming import hotel_events
from stayspark.streaming.delay_queue import release_stream, released, run_release
from stayspark.streaming.runtime import drain, read_batches, write_batch
from stayspark.streaming.sli_stream import alert_stream, counted_slis, latest_slis, run_slis, run_window_counts, service_alert_stream, windowed_slis

T0 = datetime(2026, 1, 1)


def message(key, value, offset, partition=0, ts=T0):
    return (key, value, "hotel-events", partition, offset, ts)


def event(i, hotel, kind="CREATED", city="Berlin"):
    return (
        f'{{"eventId":"e{i}","schemaVersion":1,"eventType":"{kind}","hotelId":{hotel},'
        f'"hotelName":"H","city":"{city}","pricePerNight":199.0,"occurredAt":"2026-01-01T00:00:00Z"}}'
    )


def send(spark, folder, *rows):
    append_to_folder(spark.createDataFrame(list(rows), TOPIC_ROW).coalesce(1), folder)


def test_consume_dead_letter_replay(spark, tmp_path):
    topic, root, ckpt = (str(tmp_path / n) for n in ("topic", "tables", "ckpt"))

    def drain_topic():
        hotel_events.consume_stream(file_stream(spark, topic), root, ckpt)

    send(
        spark, topic,
        message("5", event(1, 5), 0),
        message("5", event(1, 5), 1),
        message("broken-key", "{not-json}", 2),
        message("5", event(9, 5), 3),
    )
    drain_topic()
    done = {r.event_id: r for r in hotel_events.processed(spark, root).collect()}
    assert set(done) == {"e1", "e9"}
    assert done["e1"].message_key == "5" and done["e1"].partition_id == 0 and done["e1"].kafka_offset == 0
    letters = hotel_events.current_letters(spark, root).collect()
    assert len(letters) == 1
    assert letters[0].original_topic == "hotel-events"
    assert letters[0].dead_letter_topic == "hotel-events-dlt"
    assert letters[0].payload == "{not-json}" and letters[0].retry_status == "PENDING"

    # The same event again, in a later run: still one row.
    send(spark, topic, message("5", event(1, 5), 4))
    drain_topic()
    assert hotel_events.processed(spark, root).count() == 2

    requests = spark.createDataFrame(
        [(letters[0].letter_id, event(777, 777, city="Lisbon"))], "letter_id string, payload_override string"
    )
    hotel_events.request_replay(spark, root, requests, topic, "2026-01-01 01:00:00", run=1)
    retried = hotel_events.current_letters(spark, root).first()
    assert (retried.retry_status, retried.retry_count, retried.resolved_at) == ("RETRIED", 1, None)
    assert retried.original_hotel_id == 777
    drain_topic()
    resolved = hotel_events.current_letters(spark, root).first()
    assert resolved.retry_status == "RESOLVED" and resolved.resolved_at is not None
    assert hotel_events.processed(spark, root).filter("event_id = 'e777'").count() == 1


def test_replay_of_known_event_stays_retried(spark, tmp_path):
    topic, root, ckpt = (str(tmp_path / n) for n in ("topic", "tables", "ckpt"))
    send(spark, topic, message("1", event(1, 1), 0), message("1", "{not-json}", 1))
    hotel_events.consume_stream(file_stream(spark, topic), root, ckpt)
    letter = hotel_events.current_letters(spark, root).first()
    requests = spark.createDataFrame(
        [(letter.letter_id, event(1, 1))], "letter_id string, payload_override string"
    )
    hotel_events.request_replay(spark, root, requests, topic, "2026-01-01 01:00:00", run=1)
    hotel_events.consume_stream(file_stream(spark, topic), root, ckpt)
    assert hotel_events.current_letters(spark, root).first().retry_status == "RETRIED"
    assert hotel_events.processed(spark, root).count() == 1


def test_delay_queue_releases_due_jobs_once(spark, tmp_path):
    schema = "job_id string, routing_key string, payload string, created_at timestamp, delay_s int"
    source, out, ckpt = (str(tmp_path / n) for n in ("jobs", "out", "ckpt"))

    def add(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        drain(
            release_stream(stream).writeStream.outputMode("append").foreachBatch(
                lambda df, b: write_batch(df, out, b)
            ),
            ckpt,
        )
        rows = read_batches(spark, out, "job_id string, routing_key string, payload string, execute_ms bigint")
        return sorted(r.job_id for r in rows.collect())

    add(("now", "email.send", "a", T0, 0), ("later", "email.send", "b", T0, 300))
    add(("tick", "email.send", "t", datetime(2026, 1, 1, 0, 1), 3600))
    assert run() == ["now"]
    add(("now", "email.send", "a", datetime(2026, 1, 1, 0, 5), 0))
    add(("tick2", "email.send", "t", datetime(2026, 1, 1, 0, 6), 3600))
    assert run() == ["later", "now"]
    # Older than all before: one was due already, the other becomes due between the clock's stops.
    add(("old", "email.send", "o", datetime(2025, 12, 31), 60), ("between", "email.send", "o", T0, 480))
    assert run() == ["later", "now", "old"]
    add(("old", "email.send", "o", datetime(2025, 12, 31), 60), ("tick3", "email.send", "t", datetime(2026, 1, 1, 0, 9), 3600))
    assert run() == ["between", "later", "now", "old"]


def test_bulk_release_agrees(spark, tmp_path):
    schema = "job_id string, routing_key string, payload string, created_at timestamp, delay_s int"
    source, root, ckpt = (str(tmp_path / n) for n in ("jobs", "queue", "ckpt"))

    def add(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        run_release(stream, root, ckpt)
        return sorted(r.job_id for r in released(spark, root).collect())

    add(("now", "email.send", "a", T0, 0), ("later", "email.send", "b", T0, 300), ("x", " ", "b", T0, 0))
    assert run() == ["now"]
    add(("now", "email.send", "a", datetime(2026, 1, 1, 0, 4, 59), 0))
    assert run() == ["now"]
    add(("tick", "email.send", "t", datetime(2026, 1, 1, 0, 5), 3600))
    assert run() == ["later", "now"]
    add(("late", "email.send", "t", T0, 10), ("tock", "email.send", "t", datetime(2026, 1, 1, 2), 1))
    assert run() == ["late", "later", "now", "tick"]


def sample_requests(spark):
    i = F.col("id")
    return spark.range(600).select(
        (F.lit(T0).cast("timestamp") + F.make_dt_interval(secs=(i * 7).cast("decimal(18,6)"))).alias("ts"),
        F.when(i % 3 == 0, "a").otherwise("b").alias("uri"),
        (i * 37 % 1000).cast("double").alias("latency_ms"),
        F.when(i % 11 == 0, 500).otherwise(200).alias("status"),
    )


def test_many_batches_out_of_time_order(spark, tmp_path, monkeypatch):
    """Events, broken records, repeats and replays, each older than all before it: none is lost, and no micro-batch reads
    what earlier ones wrote."""
    topic, root, ckpt = (str(tmp_path / n) for n in ("topic", "tables", "ckpt"))
    for i in range(12):
        at = datetime(2026, 1, 20 - i)
        send(
            spark, topic, message("1", event(i, 1), 10 * i, ts=at), message("1", event(i // 2, 1), 10 * i + 1, ts=at),
            *([message("1", "{not-json}", 10 * i + 2, ts=at)] if i % 3 == 0 else []),
        )
    reads = []
    monkeypatch.setattr(hotel_events, "read_batches", lambda *a: reads.append(a) or read_batches(*a))
    one_by_one = file_stream(spark, topic, 1)
    hotel_events.consume_stream(one_by_one, root, ckpt)
    assert reads == [] and len(os.listdir(f"{root}/processed")) >= 12
    done = {r.event_id: r.kafka_offset for r in hotel_events.processed(spark, root).collect()}
    assert done == {f"e{i}": min(10 * i, 20 * i + 1) for i in range(12)}
    letters = hotel_events.current_letters(spark, root).collect()
    assert {r.kafka_offset for r in letters} == {2, 32, 62, 92} and {r.retry_status for r in letters} == {"PENDING"}
    # A replay into the past of an event nobody has seen, asked for three times: the last override counts.
    name = letters[0].letter_id
    asked = spark.createDataFrame(
        [(name, "zzz", 1), (name, event(500, 7), 3), (name, event(501, 8), 2)], "letter_id string, payload_override string, seq int"
    )
    hotel_events.request_replay(spark, root, asked, topic, "2026-02-01 01:00:00", run=1)
    hotel_events.consume_stream(file_stream(spark, topic, 1), root, ckpt)
    letter = {r.letter_id: r for r in hotel_events.current_letters(spark, root).collect()}[name]
    assert (letter.retry_status, letter.retry_count, letter.original_event_id) == ("RESOLVED", 3, "e500")
    assert "e501" not in {r.event_id for r in hotel_events.processed(spark, root).collect()}


def test_late_samples_correct_their_windows(spark, tmp_path):
    """Samples come newest first, days behind the clock; windows equal the batch twin and late rows are counted."""
    source, out, ckpt = (str(tmp_path / n) for n in ("requests", "out", "ckpt"))
    batch = sample_requests(spark)
    rows = batch.orderBy(F.desc("ts")).collect()
    for at in range(0, 600, 150):
        spark.createDataFrame(rows[at : at + 150], batch.schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(batch.schema).parquet(source)
        run_window_counts(stream, ["uri"], out, ckpt, "5 minutes", "1 minute")
    got = counted_slis(spark, out, {"uri": "string"}).collect()
    twin = windowed_slis(batch, ["uri"], "5 minutes", "1 minute").collect()
    key = lambda rows: {(r.uri, r.window_end): (r.n, r.latency_sli, r.availability_sli) for r in rows}
    assert key(got) == key(twin) and len(twin) > 100
    assert sum(r.late for r in got) == 5 * sum(1 for r in rows if (rows[0].ts - r.ts).total_seconds() > 60 and r.ts < rows[149].ts)


def test_sli_stream_equals_batch(spark, tmp_path):
    source, out, ckpt = (str(tmp_path / n) for n in ("requests", "out", "ckpt"))
    batch = sample_requests(spark)
    batch.repartitionByRange(4, "ts").write.parquet(source)
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(source)
    slis = windowed_slis(stream, ["uri"], "5 minutes", "1 minute", watermark="2 hours")
    run_slis(slis, out, ckpt)
    schema = "uri string, window_end timestamp, n bigint, latency_sli double, availability_sli double"
    streamed = {
        (r.uri, r.window_end): (r.n, r.latency_sli, r.availability_sli)
        for r in latest_slis(spark, out, ["uri"], schema).collect()
    }
    twin = {
        (r.uri, r.window_end): (r.n, r.latency_sli, r.availability_sli)
        for r in windowed_slis(batch, ["uri"], "5 minutes", "1 minute").collect()
    }
    assert streamed == twin and len(twin) > 100


def test_alert_stream_equals_batch(spark, tmp_path):
    source, out, ckpt = (str(tmp_path / n) for n in ("steps", "out", "ckpt"))
    i = F.col("id")
    steps = spark.range(200).filter("id % 17 <> 5").select(
        F.when(i % 2 == 0, "x").otherwise("y").alias("series"),
        (F.floor(i / 2) * 15 * sli.SECOND).cast("long").alias("step"),
        (F.floor(i / 10) % 3 != 0).alias("bad"),
    )
    steps.repartitionByRange(5, "step").write.parquet(source)
    files = sorted(p for p in (tmp_path / "steps").glob("part-*"))
    schema = "series string, step bigint, bad boolean"
    ordered = str(tmp_path / "ordered")
    for f in files:
        spark.read.schema(schema).parquet(str(f)).coalesce(1).write.mode("append").parquet(ordered)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(ordered)
    drain(
        alert_stream(stream, 30).writeStream.outputMode("append").foreachBatch(
            lambda df, b: write_batch(df, out, b)
        ),
        ckpt,
    )
    streamed = {
        tuple(r)[:4] for r in read_batches(spark, out, "series string, step bigint, since bigint, state string").collect()
    }
    twin = {
        tuple(r) for r in sli.alerts(steps, ["series"], F.col("bad"), 30, 15).collect()
    }
    assert streamed == twin
    assert {s[3] for s in twin} == {"pending", "firing"}


def test_service_alerts_as_a_stream_equal_the_batch(spark, tmp_path):
    """Rules with own bound, side and hold; values missing, steps missing, an indicator without a rule."""
    source, out, ckpt = (str(tmp_path / n) for n in ("steps", "out", "ckpt"))
    rules = {"latency": ("below", 0.9, 30, "warning"), "deadlock": ("above", 0.0, 45, "info")}
    rows = [
        (f"/u{u}", name, step * 15 * sli.SECOND, None if step % 23 == 7 else float((step * (u + 2) // 6) % 2))
        for u in range(3) for name in ("latency", "deadlock", "other") for step in range(60) if (step + u) % 19
    ]
    schema = "uri string, sli string, step bigint, value double"
    for at in range(0, 60, 13):
        part = [r for r in rows if at <= r[2] // (15 * sli.SECOND) < at + 13]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        stream = service_alert_stream(spark.readStream.schema(schema).parquet(source), ["uri"], 15, rules)
        drain(stream.writeStream.outputMode("append").foreachBatch(lambda df, b: write_batch(df, out, b)), ckpt)
    kinds = "uri string, sli string, step bigint, since bigint, state string, severity string"
    streamed = sorted(tuple(r)[:6] for r in read_batches(spark, out, kinds).collect())
    twin = sli.service_alerts(spark.createDataFrame(rows, schema), ["uri"], 15, rules).select(*[k.split()[0] for k in kinds.split(", ")])
    assert streamed == sorted(tuple(r) for r in twin.collect())
    assert {(r[1], r[4]) for r in streamed} >= {("latency", "firing"), ("latency", "pending"), ("deadlock", "pending")}
