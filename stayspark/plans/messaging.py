"""Event, job-queue and keyed-log queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayspark.operators import events, jobs, joins, kvlog
from stayspark.plans.registry import Registry, sql_ts
from stayspark.sources.views import Views

AS_OF = "2024-01-20 00:00:00"


def _j(field: str) -> str:
    return f"json_extract_string(payload, '$.{field}')"


REG = Registry(
    {
        "parsed_log": f"""
            select *, {_j('eventId')} event_id, {_j('eventType')} event_type,
                   cast({_j('hotelId')} as bigint) hotel_id, {_j('hotelName')} hotel_name,
                   {_j('city')} city, cast({_j('pricePerNight')} as double) price_per_night
            from (select * from hotel_event_log where json_valid(payload)) g""",
        "first_deliveries": """
            select * from (select *, row_number() over (partition by event_id
                             order by partition_id, kafka_offset) rn from parsed_log) x where rn = 1""",
        "early_log": "select * from hotel_event_log where occurred_at < timestamp '2024-01-16 00:00:00'",
        "classified": """
            select j.*, case when payload like '{%"source":"BOOKING"}' then 'BOOKING' else 'IMMEDIATE' end source,
                   case when payload like '{"kind"%' then
                     case when payload like '{"kind":"BAD_KIND"%' then 'unknown kind: BAD_KIND'
                          when payload like '%"roomType":"PENTHOUSE"%' then 'unknown room type: PENTHOUSE'
                          when regexp_extract(payload, '"userId":(\\d+)', 1) not in (select cast(id as varchar) from users)
                            then 'user not found: ' || regexp_extract(payload, '"userId":(\\d+)', 1) end end error
            from jobs j""",
        "last_writes": """
            select * from (select *, max(write_id) over (partition by k) newest
                           from (select *, cast(ts as date) write_id from kv_log) w) x
            where write_id = newest""",
    }
)
query = REG.query


def early(log):
    return log.filter(F.col("occurred_at") < F.lit("2024-01-16").cast("timestamp"))


# ---- events ----------------------------------------------------------------------------------
@query("evt1_parse_events", """
    select l.partition_id, l.kafka_offset, p.event_id, p.event_type, p.hotel_id, p.hotel_name, p.city,
           p.price_per_night, case when p.event_id is not null then 1 end schema_version,
           case when p.event_id is not null then 'occurredAt' end missing_fields,
           case when p.event_id is null then 'payload is not valid JSON' end error
    from hotel_event_log l left join parsed_log p on p.kafka_offset = l.kafka_offset""")
def _(v: Views):
    return events.parsed_fields(v.hotel_event_log())


@query("evt2_first_deliveries", f"""
    select event_id, event_type, hotel_id, partition_id, kafka_offset, {sql_ts("occurred_at")} occurred_at
    from first_deliveries""")
def _(v: Views):
    return events.consume(v.hotel_event_log()).select(
        "event_id", "event_type", "hotel_id", "partition_id", "kafka_offset", "occurred_at"
    )


@query("evt2_against_history", """
    select event_id, event_type, hotel_id, kafka_offset from first_deliveries
    where event_id not in (select event_id from parsed_log where occurred_at < timestamp '2024-01-16 00:00:00')""")
def _(v: Views):
    """The whole log delivered again after its first half had been processed."""
    log = v.hotel_event_log()
    return events.consume(log, events.consume(early(log))).select(
        "event_id", "event_type", "hotel_id", "kafka_offset"
    )


@query("evt3_split_and_record_attempts", """
    select case when json_valid(payload) then 'processed' else 'dead letter' end branch, partition_id,
           count(*) n, sum(case when json_valid(payload) then 1 else 3 end) attempts
    from hotel_event_log group by 1, 2""")
def _(v: Views):
    parsed = events.parse_log(v.hotel_event_log())
    bad = F.col("error").isNotNull()
    return parsed.groupBy(
        F.when(bad, "dead letter").otherwise("processed").alias("branch"), "partition_id"
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(bad, events.ATTEMPTS).otherwise(1)).alias("attempts"),
    )


@query("evt4_dead_letters", f"""
    select 'hotel-events-' || partition_id || '-' || kafka_offset letter_id, topic original_topic,
           'hotel-events-dlt' dead_letter_topic, message_key, partition_id, kafka_offset, payload,
           null original_event_id, null original_event_type, null original_hotel_id,
           'PENDING' retry_status, 0 retry_count, {sql_ts("occurred_at")} dead_lettered_at
    from hotel_event_log where not json_valid(payload)""")
def _(v: Views):
    return events.dead_letters(v.hotel_event_log()).select(
        "letter_id", "original_topic", "dead_letter_topic", "message_key", "partition_id",
        "kafka_offset", "payload", "original_event_id", "original_event_type", "original_hotel_id",
        "retry_status", "retry_count", "dead_lettered_at",
    )


@query("fil10_event_rows", f"""
    select event_id, schema_version, event_type, hotel_id, hotel_name, city, price_per_night, topic_name, message_key,
           partition_id, kafka_offset, 'hotel-status' consumer_group_id, {sql_ts("occurred_at")} occurred_at, {sql_ts("occurred_at")} processed_at
    from (select d.*, cast({_j('schemaVersion')} as int) schema_version, topic topic_name from first_deliveries d) x""")
def _(v: Views):
    return joins.event_rows(events.consume(v.hotel_event_log()))


@query("fil10_letter_rows", f"""
    select 'hotel-events-' || partition_id || '-' || kafka_offset id, topic original_topic, 'hotel-events-dlt' dead_letter_topic,
           message_key, partition_id, kafka_offset, payload, null original_event_id, null original_event_type,
           null original_hotel_id, 'PayloadError' error_class_name, 'payload is not valid JSON' error_message, 'PENDING' retry_status,
           0 retry_count, null last_retried_at, null resolved_at, {sql_ts("occurred_at")} dead_lettered_at
    from hotel_event_log where not json_valid(payload)""")
def _(v: Views):
    return joins.letter_rows(events.dead_letters(v.hotel_event_log()))


@query("evt5_replay", f"""
    select kafka_offset, coalesce('e' || eid, null) original_event_id, st retry_status, rc retry_count
    from (select kafka_offset, case when partition_id < 2 then kafka_offset // 20 end eid,
                 case when partition_id >= 2 then 'PENDING'
                      when 'e' || (kafka_offset // 20) in (select event_id from parsed_log) then 'RETRIED'
                      else 'RESOLVED' end st,
                 case when partition_id < 2 then 1 else 0 end rc
          from hotel_event_log where not json_valid(payload)) x""")
def _(v: Views):
    """Letters of two partitions are replayed with repaired payloads; some carry an id seen before."""
    log = v.hotel_event_log()
    letters = events.dead_letters(log)
    fixed = F.format_string(
        '{"eventId":"e%d","schemaVersion":1,"eventType":"UPDATED","hotelId":777,"hotelName":"Lisbon"}',
        F.expr("kafka_offset div 20"),
    )
    asked = letters.filter("partition_id < 2").select("letter_id", fixed.alias("payload_override"))
    after, _ = events.replay(letters, asked, events.consume(log), AS_OF)
    return after.select("kafka_offset", "original_event_id", "retry_status", "retry_count")


@query("evt6_change_capture", """
    select coalesce(a.id, b.id) id, case when b.id is null then 'CREATED' when a.id is null then 'DELETED'
           else 'UPDATED' end event_type, coalesce(a.price_per_night, b.price_per_night) price_per_night
    from (select id, price_per_night from hotels where saas_plan <> 'FREE') b
    full join (select id, case when saas_plan = 'PRO' then price_per_night + 10 else price_per_night end price_per_night
               from hotels where amenities is not null) a on a.id = b.id
    where a.id is null or b.id is null or a.price_per_night <> b.price_per_night""")
def _(v: Views):
    """Paying hotels became those that list amenities, and the PRO plan raised its prices."""
    hotels = v.hotels().select("id", "price_per_night", "saas_plan", "amenities")
    before = hotels.filter("saas_plan <> 'FREE'")
    raised = F.when(F.col("saas_plan") == "PRO", F.col("price_per_night") + 10)
    after = hotels.filter("amenities is not null").withColumn(
        "price_per_night", F.coalesce(raised, "price_per_night")
    )
    return events.capture_changes(before, after, ["price_per_night"])


@query("evt7_apply_changes", """
    select coalesce(n.hotel_id, h.id) id, coalesce(n.hotel_name, h."name") "name"
    from hotels h full join (
      select * from (select *, row_number() over (partition by hotel_id order by occurred_at desc, kafka_offset desc) r
                     from parsed_log) x where r = 1) n on n.hotel_id = h.id
    where coalesce(n.event_type, '') <> 'DELETED'""")
def _(v: Views):
    """The change topic applied to the hotel projection."""
    e = F.col("event")
    changes = events.parse_log(v.hotel_event_log()).filter("error is null").select(
        e["hotelId"].alias("id"), e["eventType"].alias("event_type"), e["hotelName"].alias("name"),
        "occurred_at", "kafka_offset",
    )
    snapshot = v.hotels().select("id", "name")
    return events.apply_changes(
        snapshot, changes, "id", [F.col("occurred_at"), F.col("kafka_offset")], ["name"]
    )


@query("evt9_consumer_lag", """
    select 'hotel-events' topic, 'hotel-status' consumer_group_id, sum(e - coalesce(d, -1)) lag from
      (select partition_id, max(kafka_offset) e from hotel_event_log group by 1) a
      left join (select partition_id, max(kafka_offset) d from first_deliveries
                 where occurred_at < timestamp '2024-01-16 00:00:00' group by 1) b using (partition_id)""")
def _(v: Views):
    log = v.hotel_event_log()
    return events.consumer_lag(log, events.consume(early(log)))


@query("join9_letters_with_processed", f"""
    select l.kafka_offset, 'e' || (l.kafka_offset // 20) original_event_id, {sql_ts("f.occurred_at")} processed_occurred_at
    from hotel_event_log l join first_deliveries f on f.event_id = 'e' || (l.kafka_offset // 20)
    where not json_valid(l.payload)""")
def _(v: Views):
    log = v.hotel_event_log()
    guess = F.concat(F.lit("e"), F.expr("kafka_offset div 20"))
    letters = events.dead_letters(log).withColumn("original_event_id", guess)
    return joins.letters_with_processed(letters, events.consume(log)).select(
        "kafka_offset", "original_event_id", "processed_occurred_at"
    )


# ---- jobs ------------------------------------------------------------------------------------
@query("job2_enrich_and_route", """
    select job_id, routing_key, case routing_key when 'booking.confirm' then 'booking-confirm'
             when 'email.send' then 'email-send' end queue,
           routing_key not in ('booking.confirm', 'email.send') dropped,
           case when trim(payload) like '{%' then trim(payload)
                else '{"source":"IMMEDIATE","text":"' || case when trim(payload) = '' then 'lab-job'
                     else trim(payload) end || '"}' end payload
    from jobs""")
def _(v: Views):
    return jobs.enrich_and_route(v.jobs()).select("job_id", "routing_key", "queue", "dropped", "payload")


@query("job3_claim_due", f"""
    select job_id, {sql_ts("created_at + to_seconds(delay_s)")} execute_at from jobs
    where created_at + to_seconds(delay_s) <= timestamp '{AS_OF}'
      and not created_at + to_seconds(delay_s) <= timestamp '2024-01-10 00:00:00'""")
def _(v: Views):
    """Claim of the second run: what the first run released does not come again."""
    waiting = jobs.schedule(v.jobs())
    before = jobs.claim_due(waiting, "2024-01-10")
    return jobs.claim_due(waiting, AS_OF, before).select("job_id", "execute_at")


@query("job3_pending", f"""
    select job_id, {sql_ts("created_at + to_seconds(delay_s)")} execute_at from jobs
    where created_at + to_seconds(delay_s) > timestamp '{AS_OF}'""")
def _(v: Views):
    return jobs.pending(jobs.schedule(v.jobs()), AS_OF).select("job_id", "execute_at")


@query("job4_run_history", f"""
    select job_id, routing_key "type", source, case when error is null then 'SUCCESS' else 'FAILED' end status,
           substr(payload, 1, 500) payload_snippet, error, {sql_ts("created_at")} created_at from classified""")
def _(v: Views):
    return jobs.run_history(jobs.execute(v.jobs(), v.users()))


@query("job4_notifications", """
    select cast(json_extract_string(payload, '$.userId') as bigint) user_id,
           cast(json_extract_string(payload, '$.bookingId') as bigint) booking_id,
           json_extract_string(payload, '$.kind') "type",
           'Booking ' || json_extract_string(payload, '$.bookingId')
             || case json_extract_string(payload, '$.kind') when 'BOOKING_CONFIRMED' then ' confirmed' else ' cancelled' end
             || ' for ' || json_extract_string(payload, '$.hotelName') || ' from 2026-01-01 to 2026-01-03' message
    from (select * from classified where payload like '{"kind"%' and error is null) c""")
def _(v: Views):
    return jobs.job_notifications(jobs.execute(v.jobs(), v.users()))


@query("job6_retention", f"""
    select count(*) filter (where created_at >= timestamp '{AS_OF}' - interval 1 hour) kept,
           count(*) filter (where created_at < timestamp '{AS_OF}' - interval 1 hour) deleted from jobs""")
def _(v: Views):
    kept, deleted = jobs.retain(v.jobs(), AS_OF)
    total = kept.agg(F.count(F.lit(1)).alias("n")).scalar()
    return deleted.select(total.alias("kept"), "deleted")


# ---- keyed log -------------------------------------------------------------------------------
def string_log(v: Views):
    return v.kv_log().select(
        "k", "seq", F.col("member").alias("value"), F.col("ts").alias("written_at"),
        F.when(F.col("seq") % 3 != 0, F.col("seq") % 5 * 86_400).alias("ttl_s"),
    )


def element_log(v: Views):
    """One day's records of a key are one write of its elements."""
    return v.kv_log().select(
        "k", F.col("ts").cast("date").alias("write_id"), F.col("seq").alias("pos"),
        F.col("member").alias("value"), "score",
    )


@query("kv1_strings_with_ttl", """
    select a.k, case when alive then member end "value",
      case when not coalesce(alive, false) then -2 when expires_at is null then -1
           else (date_diff('millisecond', timestamp '2024-01-30 12:00:00', expires_at) + 500) // 1000 end ttl
    from (select distinct k from kv_log union all select distinct 'x' || k from kv_log) a
    left join (select *, expires_at is null or expires_at > timestamp '2024-01-30 12:00:00' alive from (
      select k, member, case when seq % 3 <> 0 then ts + to_days(cast(seq % 5 as int)) end expires_at,
             row_number() over (partition by k order by seq desc) rn from kv_log) where rn = 1) s on s.k = a.k""")
def _(v: Views):
    """All keys of the log are asked for, and as many that were never written."""
    written = v.kv_log().select("k").distinct()
    keys = written.unionByName(written.select(F.concat(F.lit("x"), "k").alias("k")))
    return kvlog.lookup(keys, string_log(v), "2024-01-30 12:00:00")


@query("kv2_hashes", """
    select k, 'score=' || cast(seq as varchar) || ',member=' || member fields from (
      select *, row_number() over (partition by k order by seq desc) rn from kv_log) where rn = 1""")
def _(v: Views):
    log = v.kv_log().select(
        "k", "seq",
        F.create_map(F.lit("member"), F.col("member"), F.lit("score"), F.col("seq").cast("string")).alias("fields"),
    )
    f = F.col("fields")
    return kvlog.current_hashes(log).select(
        "k", F.concat(F.lit("score="), f["score"], F.lit(",member="), f["member"]).alias("fields")
    )


@query("kv3_lists", "select k, seq pos, member \"value\" from last_writes")
def _(v: Views):
    return kvlog.current_lists(element_log(v))


@query("kv4_sets", "select distinct k, member from last_writes")
def _(v: Views):
    return kvlog.current_sets(element_log(v))


@query("kv5_sorted_sets", "select k, member, arg_max(score, seq) score from last_writes group by k, member")
def _(v: Views):
    return kvlog.current_sorted_sets(element_log(v))
