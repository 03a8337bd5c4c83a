"""Sources, filters, joins, aggregations, ranking and paging over the lodging views."""

from __future__ import annotations

import hashlib
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayspark.functions.columns import csv_items, once
from stayspark.operators import aggs, filters, joins, ranking, settlement
from stayspark.plans.registry import ROUNDED, Registry, sql_date, sql_ts
from stayspark.session import session_folder
from stayspark.sources import generate, metrics, partitioned, snapshots, topics
from stayspark.sources.views import Views

REG = Registry(
    {
        "hotel_weeks": """
            select id hotel_id, date '2026-01-01' + cast(7 * k as int) "first", date '2026-01-01' + cast(7 * (k + 1) as int) "last"
            from hotels, (select unnest(range(27)) k) g""",
        "stay_requests": """
            select id request_id, hotel_id, case when rate_plan = 'NON_REFUNDABLE' then null
                   else room_type end room_type, check_in, check_out from bookings""",
        "stock": """
            select i.hotel_id, i.room_type, i.inventory_date,
                   greatest(i.available_rooms - coalesce(u.n, 0), 0) available_rooms
            from room_inventory i left join (
              select hotel_id, room_type, check_in + cast(k as int) night, count(*) n
              from bookings, (select unnest(range(3)) k) g
              where status = 'CONFIRMED' and check_in + cast(k as int) < check_out
              group by all) u
            on u.hotel_id = i.hotel_id and u.room_type = i.room_type and u.night = i.inventory_date""",
    }
)
query = REG.query


def hotel_weeks(v: Views):
    start = F.lit("2026-01-01").cast("date")
    weeks = F.sequence(start, F.date_add(start, 26 * 7), F.expr("interval 7 days"))
    return v.table("supplier").select(
        F.col("s_suppkey").alias("hotel_id"), F.explode(weeks).alias("first")
    ).withColumn("last", F.date_add("first", 7))


def stay_requests(v: Views):
    any_type = F.col("rate_plan") == "NON_REFUNDABLE"
    return v.bookings().select(
        F.col("id").alias("request_id"),
        "hotel_id",
        F.when(~any_type, F.col("room_type")).alias("room_type"),
        "check_in",
        "check_out",
    )


def stock(v: Views, hotels: DataFrame | None = None):
    """Opening rooms minus the nights of confirmed stays; as long as the inventory, so no side to broadcast either.

    ``hotels`` (hotel_id): only of these, which are looked up before anything is shuffled where they are few.
    """
    opened, confirmed = v.room_inventory(), v.bookings().filter("status = 'CONFIRMED'")
    if hotels is not None:
        opened, confirmed = (filters.by_ids(x, hotels, "hotel_id") for x in (opened, confirmed))
    used = (
        joins.explode_nights(confirmed)
        .groupBy("hotel_id", "room_type", F.col("night").alias("inventory_date"))
        .agg(F.count(F.lit(1)).alias("used"))
    )
    left = F.greatest(F.col("available_rooms") - F.coalesce("used", F.lit(0)), F.lit(0))
    return (
        opened
        .join(used, ["hotel_id", "room_type", "inventory_date"], "left")
        .select("hotel_id", "room_type", "inventory_date", left.alias("available_rooms"))
        .hint("merge")
    )


# ---- sources -------------------------------------------------------------------------------
@query("src1_table_scan", f"""
    select id, username, "role" from users""")
def _(v: Views):
    return v.users()


@query("src2_series_load", f"""
    select g, hotel_id % (select count(*) from supplier) hotel_rank,
           case g % 3 when 0 then 'SINGLE' when 1 then 'DOUBLE' else 'SUITE' end room_type,
           {sql_date("date '2026-01-01' + cast(g % 365 as int)")} check_in,
           {sql_date("date '2026-01-01' + cast(g % 365 + 1 + g % 5 as int)")} check_out,
           case g % 3 when 0 then 'CONFIRMED' when 1 then 'PENDING' else 'CANCELLED' end status,
           cast(50 + g % 400 as double) total_price
    from (select o_orderkey g, o_orderkey hotel_id from orders)""")
def _(v: Views):
    """Series of one row per order key, every attribute a modulus of the position."""
    return generate.lab_bookings(
        v.table("orders").select(F.col("o_orderkey").alias("g")), v.hotel_count()
    )


@query("src4_opening_inventory", f"""
    select hotel_id, room_type, {sql_date("inventory_date")} inventory_date, available_rooms
    from room_inventory""")
def _(v: Views):
    return v.room_inventory()


@query("src5_rotating_assignment", """
    select o_orderkey g, r.id hotel_id, r."name" hotel_name
    from orders join (select *, row_number() over (order by id) - 1 rn from hotels) r
      on o_orderkey % (select count(*) from hotels) = r.rn""")
def _(v: Views):
    pool = v.table("supplier").select(
        F.col("s_suppkey").alias("hotel_id"), F.col("s_name").alias("hotel_name")
    )
    rows = v.table("orders").select(F.col("o_orderkey").alias("g"))
    return generate.assign_rotating(rows, pool, "hotel_id", "hotel_rank").drop("hotel_rank")


@query("src6_insert_only_new", """
    with labels as (select p_partkey id, p_size, lower(p_name) || ' ' || (p_partkey % 97) "name" from part)
    select min(id) id, "name" from labels
    where "name" not in (select "name" from labels where p_size <= 10) group by "name\"""")
def _(v: Views):
    """Labels (name and series) not present, ignoring case, among those of the small parts."""
    label = F.concat_ws(" ", "p_name", F.col("p_partkey") % 97)
    parts = v.table("part").select(F.col("p_partkey").alias("id"), F.upper(label).alias("name"))
    existing = v.table("part").filter("p_size <= 10").select(label.alias("name"))
    fresh = generate.only_new(parts, existing, "name", ignore_case=True)
    return fresh.select("id", F.lower("name").alias("name"))


@query("src8_event_messages", f"""
    select cast(h.id as varchar) "key", 'u' || h.id event_id, 'UPDATED' event_type, h.id hotel_id,
           h."name" hotel_name, h.city city, h.price_per_night price_per_night,
           '2026-01-01T00:00:00Z' occurred_at
    from hotels h""")
def _(v: Views):
    """Messages are built, then read back with the event schema."""
    changes = v.hotels().select(
        F.lit("UPDATED").alias("event_type"), F.col("id").alias("hotel_id"),
        F.col("name").alias("hotel_name"), "city", "price_per_night",
    )
    at = F.lit("2026-01-01").cast("timestamp")
    out = topics.event_messages(changes, F.concat(F.lit("u"), F.col("hotel_id")), at)
    from stayspark.functions.payloads import parse_hotel_event

    e = parse_hotel_event(F.col("value"))
    return out.withColumn("e", e).select(
        "key", F.col("e.eventId").alias("event_id"), F.col("e.eventType").alias("event_type"),
        F.col("e.hotelId").alias("hotel_id"), F.col("e.hotelName").alias("hotel_name"),
        F.col("e.city").alias("city"), F.col("e.pricePerNight").alias("price_per_night"),
        F.col("e.occurredAt").alias("occurred_at"),
    )


QUARTER_SCHEMA = "id long, user_id long, hotel_id long, room_type string, check_in date, check_out date, status string"


def bookings_by_quarter(v: Views) -> str:
    """Folder of the stays written by quarter of check-in; written again only when the source files change."""
    root = session_folder(v.spark, f"bookings-by-quarter/{hashlib.sha256(v.folder.encode()).hexdigest()[:16]}")
    signed = snapshots.signature(v.spark, *[f"{v.folder}/{t}.parquet" for t in ("orders", "supplier")])
    stays = v.bookings().select(*[c.split()[0] for c in QUARTER_SCHEMA.split(", ")])
    return snapshots.current_or_rebuilt(v.spark, root, signed, lambda to: partitioned.write_by_quarter(stays, to))


@query("src10_quarter_window", """
    select year(check_in) || 'q' || quarter(check_in) "quarter", count(*) n, count(distinct hotel_id) n_hotels
    from bookings where check_in >= date '2026-02-15' and check_in < date '2026-05-15'
    group by 1""")
def _(v: Views):
    """Stays and hotels of a window, read from the quarters that it touches."""
    window = partitioned.read_window(
        v.spark, bookings_by_quarter(v), QUARTER_SCHEMA, date(2026, 2, 15), date(2026, 5, 15)
    )
    return window.groupBy("quarter").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("hotel_id").alias("n_hotels")
    )


@query("src11_rows_per_partition", """
    select year(check_in) || 'q' || quarter(check_in) "quarter", count(*) n from bookings group by 1""")
def _(v: Views):
    return partitioned.rows_per_partition(
        partitioned.read_by_quarter(v.spark, bookings_by_quarter(v), QUARTER_SCHEMA)
    )


@query("src12_metric_samples", f"""
    select 'web' job, case when status >= 500 then 'failures' else 'successes' end metric,
           uri, {sql_ts("ts")} ts, latency_ms "value" from requests""")
def _(v: Views):
    made = metrics.as_samples(
        v.requests(), F.lit("web"),
        F.when(F.col("status") >= 500, "failures").otherwise("successes"),
        {"uri": F.col("uri")}, F.col("ts"), F.col("latency_ms"),
    )
    return made.select("job", "metric", F.try_element_at("labels", F.lit("uri")).alias("uri"), "ts", "value")


# ---- filters -------------------------------------------------------------------------------
@query("fil1_hotel_filter", """
    select id, "name", city, price_per_night from hotels
    where lower(city) = 'nation_13' and price_per_night >= 100 and price_per_night <= 400""")
def _(v: Views):
    return filters.hotels_matching(v.hotels(), " Nation_13 ", 100, 400).select(
        "id", "name", "city", "price_per_night"
    )


@query("fil1_hotel_filter_batch", """
    select c_custkey request_id, h.id hotel_id, h.price_per_night from customer
    join nation on n_nationkey = c_nationkey
    join hotels h on case when c_mktsegment = 'BUILDING' then true else lower(n_name) = lower(city) end
     and price_per_night >= 100 and price_per_night <= 200 + c_nationkey * 5""")
def _(v: Views):
    """One search per customer: own nation as the city (building segment: any), own budget."""
    asked = v.table("customer").join(
        v.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select(
        F.col("c_custkey").alias("request_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", "  ").otherwise(F.lower("n_name")).alias("city"),
        F.lit(100.0).alias("min_price"),
        (F.lit(200.0) + F.col("c_nationkey") * 5).alias("max_price"),
    )
    # Rounded once per hotel, not once per pair.
    shown = F.round("price_per_night", 6).alias("shown")
    hotels = v.hotels().select(F.col("id").alias("hotel_id"), "city", "price_per_night", shown)
    return filters.hotels_matching_batch(hotels, asked).select(
        "request_id", "hotel_id", F.col("shown").alias("price_per_night", metadata=ROUNDED)
    )


@query("fil2_exact_lookups", """
    select id, "name", city, manager_id from hotels
    where manager_id in (select id from users where "role" = 'HOTEL_MANAGER')
    union all
    select id, "name", city, manager_id from hotels where city = 'NATION_13'""")
def _(v: Views):
    hotels = v.hotels().select("id", "name", "city", "manager_id")
    managers = v.users().filter("role = 'HOTEL_MANAGER'").select("id")
    return filters.by_ids(hotels, managers, "manager_id").select(*hotels.columns).unionByName(
        filters.by_exact(hotels, "city", "NATION_13")
    )


@query("fil3_booking_filter", f"""
    select id, user_id, hotel_id, status, {sql_date("check_in")} check_in from bookings
    where status = 'CONFIRMED' and check_in >= date '2026-03-01' and check_in <= date '2026-04-15'
      and hotel_id in (select id from hotels where manager_id is not null)""")
def _(v: Views):
    managed = v.hotels().filter("manager_id is not null").select("id")
    return filters.bookings_matching(
        v.bookings(), status="CONFIRMED", hotel_ids=managed,
        check_in_from="2026-03-01", check_in_to="2026-04-15",
    ).select("id", "user_id", "hotel_id", "status", "check_in")


@query("fil4_stay_overlap", f"""
    select id, hotel_id, {sql_date("check_in")} check_in, {sql_date("check_out")} check_out
    from bookings where check_in < date '2026-03-08' and check_out > date '2026-03-01'""")
def _(v: Views):
    return filters.stays_overlapping(v.bookings(), "2026-03-01", "2026-03-08").select(
        "id", "hotel_id", "check_in", "check_out"
    )


@query("fil5_inventory_window", f"""
    select hotel_id, room_type, {sql_date("inventory_date")} inventory_date, available_rooms
    from room_inventory where inventory_date between date '2026-02-01' and date '2026-02-28'
      and room_type = 'DOUBLE'""")
def _(v: Views):
    return filters.inventory_window(
        v.room_inventory(), "2026-02-01", "2026-02-28", room_type="DOUBLE"
    ).orderBy("inventory_date", "hotel_id")


@query("fil6_text_predicates", """
    select id, username from users where username like 'Customer#0000000%' and trim(username) <> ''""")
def _(v: Views):
    return filters.with_text(
        filters.with_prefix(v.users(), "username", "Customer#0000000"), "username"
    ).select("id", "username")


@query("fil8_uniqueness_conflicts", """
    select p.id, p.username, exists (select 1 from users u where u.username = p.username
                                      and u.id <> p.id) username_taken
    from (select id, case when "role" = 'CUSTOMER' then username else
            'Customer#' || lpad(cast(id + 1 as varchar), 9, '0') end username from users) p""")
def _(v: Views):
    """Staff ask for the name of the next account; customers keep their own."""
    users = v.users()
    next_name = F.concat(F.lit("Customer#"), F.lpad((F.col("id") + 1).cast("string"), 9, "0"))
    asked = users.select(
        "id", F.when(F.col("role") == "CUSTOMER", F.col("username")).otherwise(next_name).alias("username")
    )
    return filters.uniqueness_conflicts(users, asked)


@query("fil9_metadata_filter", """
    select id, city, price_per_night from vectors
    where price_per_night < 100 and city in ('1', '2', '3') and not (price_per_night >= 20 and price_per_night < 40)""")
def _(v: Views):
    condition = (
        "and",
        ("pricePerNight", "<", 100.0),
        ("city", "in", ["1", "2", "3"]),
        ("not", ("and", ("pricePerNight", ">=", 20.0), ("pricePerNight", "<", 40.0))),
    )
    kept = v.vectors().filter(filters.metadata_condition(condition))
    return kept.select(
        "id", "metadata.city", F.col("metadata.pricePerNight").alias("price_per_night")
    )


@query("fil10_booking_rows", f"""
    select b.id, user_id, username, hotel_id, h."name" hotel_name, room_type,
           {sql_date("check_in")} check_in, {sql_date("check_out")} check_out, status, rate_plan,
           cast(total_price as double) total_price
    from priced_bookings b join hotels h on b.hotel_id = h.id join users u on b.user_id = u.id""")
def _(v: Views):
    return joins.booking_rows(joins.booking_graph(v.priced_bookings(), v.hotels(), v.users()))


@query("fil11_split_lists", """
    select id, array_to_string(list_filter(list_transform(string_split(coalesce(amenities, ''), ','),
             lambda x: trim(x)), lambda x: x <> ''), '|') amenity_list from hotels""")
def _(v: Views):
    return v.hotels().select("id", csv_items(F.col("amenities")).alias("amenity_list"))


# ---- joins ---------------------------------------------------------------------------------
@query("join1_bookings_of_user", f"""
    select b.id, username, hotel_id, {sql_date("check_in")} check_in, status
    from bookings b join users u on u.id = b.user_id""")
def _(v: Views):
    return joins.bookings_of_username(v.bookings(), v.users()).select(
        "id", "username", "hotel_id", "check_in", "status"
    )


@query("join2_booking_graph", f"""
    select b.id, username, h."name" hotel_name, h.city, room_type, {sql_date("check_in")} check_in
    from bookings b join hotels h on h.id = b.hotel_id join users u on u.id = b.user_id
    where status = 'CONFIRMED'""")
def _(v: Views):
    confirmed = v.bookings().filter("status = 'CONFIRMED'")
    return joins.booking_graph(confirmed, v.hotels(), v.users()).select(
        "id", "username", "hotel_name", "city", "room_type", "check_in"
    )


@query("join3_payment_rows", """
    select p.id, p.booking_id, b.user_id, b.hotel_id, h."name" hotel_name,
           cast(p.amount as double) amount, p.status, b.status booking_status, p.transaction_reference
    from payments p join bookings b on b.id = p.booking_id join hotels h on h.id = b.hotel_id""")
def _(v: Views):
    return joins.payment_rows(v.payments(), v.bookings(), v.hotels())


@query("join4_inventory_rows", f"""
    select hotel_id, h."name" hotel_name, room_type, {sql_date("inventory_date")} inventory_date,
           available_rooms from room_inventory join hotels h on h.id = hotel_id""")
def _(v: Views):
    return joins.inventory_rows(v.room_inventory(), v.hotels())


@query("join5_hotels_with_manager", """
    select h.id, h."name", city, manager_id, username manager_name
    from hotels h left join users u on u.id = manager_id""")
def _(v: Views):
    return joins.hotels_with_manager(v.hotels(), v.users())


@query("join6_overlap_counts", f"""
    select w.hotel_id, {sql_date('w."first"')} "first", {sql_date('w."last"')} "last", count(b.id) n_stays
    from hotel_weeks w left join bookings b
      on b.hotel_id = w.hotel_id and b.check_in < w."last" and b.check_out > w."first"
    group by w.hotel_id, w."first", w."last" """)
def _(v: Views):
    return joins.overlap_counts(hotel_weeks(v), v.bookings())


@query("join7_nights_with_inventory", f"""
    select b.id, b.hotel_id, b.room_type, {sql_date("inventory_date")} night, available_rooms
    from bookings b join room_inventory i on i.hotel_id = b.hotel_id and i.room_type = b.room_type
     and inventory_date >= check_in and inventory_date < check_out""")
def _(v: Views):
    return joins.nights_with_inventory(v.bookings(), v.room_inventory()).select(
        "id", "hotel_id", "room_type", "night", "available_rooms"
    )


@query("join10_scalar_lookup", """
    select id, user_id, hotel_id, status from bookings
    where user_id = (select min(id) from users where "role" = 'ADMIN')""")
def _(v: Views):
    return joins.bookings_of_looked_up_user(
        v.bookings(), v.users(), F.col("role") == "ADMIN"
    ).select("id", "user_id", "hotel_id", "status")


# ---- aggregations ---------------------------------------------------------------------------
@query("agg1_counts", """
    select hotel_id, event_type, count(*) n from (
      select json_extract_string(payload, '$.eventType') event_type,
             cast(json_extract_string(payload, '$.hotelId') as bigint) hotel_id
      from hotel_event_log where payload like '{"%') group by 1, 2
    union all select manager_id, 'MANAGED', count(*) from hotels where manager_id is not null group by 1
    union all select null, 'JOBS', count(*) from jobs""")
def _(v: Views):
    from stayspark.functions.payloads import is_valid_event, parse_hotel_event

    e = v.hotel_event_log().select(once(parse_hotel_event(F.col("payload"))).alias("e")).filter(
        is_valid_event(F.col("e"))
    )
    events = aggs.counts(
        e.select(F.col("e.hotelId").alias("hotel_id"), F.col("e.eventType").alias("event_type")),
        "hotel_id", "event_type",
    )
    managed = aggs.counts(
        v.hotels().filter("manager_id is not null").select(
            F.col("manager_id").alias("hotel_id"), F.lit("MANAGED").alias("event_type")
        ),
        "hotel_id", "event_type",
    )
    jobs = v.jobs().agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(None).cast("bigint").alias("hotel_id"), F.lit("JOBS").alias("event_type"), "n"
    )
    return events.unionByName(managed).unionByName(jobs)


@query("agg2_conditional_sum_mean", """
    select city, coalesce(sum(case when status = 'CONFIRMED' then cast(total_price as double) end), 0) total,
           round(avg(cast(case when status = 'CONFIRMED' then total_price end as double)), 6) mean
    from priced_bookings b join hotels h on h.id = b.hotel_id group by city""")
def _(v: Views):
    graph = v.priced_bookings().join(
        v.hotels().select(F.col("id").alias("hotel_id"), "city"), "hotel_id"
    )
    return aggs.conditional_sum_mean(
        graph, F.col("status") == "CONFIRMED", F.col("total_price").cast("double"), "city"
    )


@query("agg3_ordered_members", """
    select city, row_number() over (partition by city order by id) "position", "name" from hotels""")
def _(v: Views):
    return aggs.ordered_members(v.hotels(), "city", "id", "name")


@query("agg4_stay_availability", f"""
    select r.request_id, r.hotel_id, r.room_type, {sql_date("r.check_in")} check_in,
           {sql_date("r.check_out")} check_out,
           date_diff('day', r.check_in, r.check_out) nights_requested,
           count(distinct s.inventory_date) nights_covered,
           count(distinct s.inventory_date) = date_diff('day', r.check_in, r.check_out) available
    from stay_requests r left join stock s on s.hotel_id = r.hotel_id and s.available_rooms > 0
      and (r.room_type is null or s.room_type = r.room_type)
      and s.inventory_date >= r.check_in and s.inventory_date < r.check_out
    group by r.request_id, r.hotel_id, r.room_type, r.check_in, r.check_out""")
def _(v: Views):
    return aggs.stay_availability(stay_requests(v), stock(v))


@query("agg4_nightly_list", f"""
    select r.request_id, r.hotel_id, s.room_type, {sql_date("s.inventory_date")} night, s.available_rooms
    from stay_requests r join stock s on s.hotel_id = r.hotel_id
      and (r.room_type is null or s.room_type = r.room_type)
      and s.inventory_date >= r.check_in and s.inventory_date < r.check_out""")
def _(v: Views):
    return aggs.nightly_availability(stay_requests(v), stock(v))


@query("agg5_distinct_items", """
    select distinct city, trim(i) item from (
      select city, unnest(string_split(amenities, ',')) i from hotels) where trim(i) <> ''""")
def _(v: Views):
    return aggs.distinct_items(v.hotels(), "amenities", "city")


@query("agg6_effective_plans", """
    select u.id manager_id,
           case max(case saas_plan when 'ENTERPRISE' then 2 when 'PRO' then 1 when 'FREE' then 0 end)
             when 2 then 'ENTERPRISE' when 1 then 'PRO' else 'FREE' end effective_plan,
           count(h.id) owned
    from users u left join hotels h on h.manager_id = u.id where u."role" = 'HOTEL_MANAGER' group by u.id""")
def _(v: Views):
    return aggs.effective_plans(v.users().filter("role = 'HOTEL_MANAGER'"), v.hotels())


@query("agg7_summary_row", """
    select (select count(*) from users) users, (select count(*) from hotels) hotels,
           (select count(*) from bookings) bookings, (select count(*) from payments) payments,
           (select count(*) from described_hotels where description is not null) described""")
def _(v: Views):
    return aggs.summary_row(
        v.spark, users=v.users(), hotels=v.hotels(), bookings=v.bookings(), payments=v.payments(),
        described=v.described_hotels().filter("description is not null"),
    )


@query("agg8_queue_depth", """
    select routing_key, count(*) published,
           count(*) filter (where created_at < timestamp '2024-01-20 00:00:00') consumed,
           count(*) filter (where created_at >= timestamp '2024-01-20 00:00:00') depth
    from jobs group by 1""")
def _(v: Views):
    done = v.jobs().filter(F.col("created_at") < F.lit("2024-01-20").cast("timestamp"))
    return aggs.queue_depth(v.jobs(), done)


# ---- windows, top-k, pages -------------------------------------------------------------------
@query("win1_latest_event", f"""
    select hotel_id, event_type, kafka_offset, {sql_ts("occurred_at")} occurred_at from (
      select *, row_number() over (partition by hotel_id, event_type order by occurred_at desc, kafka_offset desc) rn
      from (select json_extract_string(payload, '$.eventType') event_type,
                   json_extract_string(payload, '$.hotelId') hotel_id, kafka_offset, occurred_at
            from hotel_event_log where payload like '{{"%')) where rn = 1""")
def _(v: Views):
    from stayspark.functions.payloads import is_valid_event, parse_hotel_event
    from stayspark.functions.skew import latest_per_key

    log = v.hotel_event_log().withColumn("e", once(parse_hotel_event(F.col("payload")))).filter(
        is_valid_event(F.col("e"))
    ).select(
        F.col("e.hotelId").cast("string").alias("hotel_id"),
        F.col("e.eventType").alias("event_type"), "kafka_offset", "occurred_at",
    )
    return latest_per_key(
        log, ["hotel_id", "event_type"], [F.col("occurred_at"), F.col("kafka_offset")]
    )


@query("win2_recent_turns", """
    select conv_id, turn, role, recency from (
      select *, row_number() over (partition by conv_id order by turn desc) recency from conversations)
    where recency <= 4""")
def _(v: Views):
    """A window of four so that the bound is met by the given conversations."""
    return ranking.recent_per_key(
        v.table("conversations").select("conv_id", "turn", "role"), ["conv_id"], [F.desc("turn")], 4
    )


@query("win3_ring_buffers", """
    select routing_key, job_id, recency from (
      select *, row_number() over (partition by routing_key order by created_at desc, job_id) recency from jobs)
    where recency <= 50""")
def _(v: Views):
    return ranking.recent_per_key(
        v.jobs().select("routing_key", "job_id", "created_at"), ["routing_key"],
        [F.desc("created_at"), F.col("job_id")], ranking.RECENT_DELIVERIES, salt_by="job_id",
    ).drop("created_at")


@query("win4_first_open_night", f"""
    select h.id hotel_id, {sql_date('''coalesce(min(d) filter (where s.hotel_id is null),
           date '2026-02-10' + 90)''')} open_night
    from hotels h, (select date '2026-02-10' + cast(k as int) d from (select unnest(range(60)) k)) g
    left join stock s on s.hotel_id = h.id and s.inventory_date = d and s.room_type = 'SUITE'
      and s.available_rooms <= 0
    group by h.id""")
def _(v: Views):
    return ranking.first_open_night(v.hotels(), stock(v), "2026-02-10", "SUITE")


@query("top1_newest_events", f"""
    select event_id, event_type, {sql_ts("ts")} ts from events order by ts desc, event_id desc limit 20""")
def _(v: Views):
    return ranking.top_n(
        v.table("events").select("event_id", "event_type", "ts"), 20, F.desc("ts"), F.desc("event_id")
    )


@query("top2_cheapest_hotels", """
    select id, "name", price_per_night from hotels order by price_per_night, id limit 10""")
def _(v: Views):
    return ranking.top_n(
        v.hotels().select("id", "name", "price_per_night"), ranking.CHEAPEST,
        F.asc("price_per_night"), F.asc("id"),
    )


@query("top3_cheapest_per_city", """
    select city, "rank", id, price_per_night from (
      select *, row_number() over (partition by city order by price_per_night, id) "rank" from hotels)
    where "rank" <= 3""")
def _(v: Views):
    from stayspark.functions.skew import top_n_per_key

    return top_n_per_key(
        v.hotels().select("city", "id", "price_per_night"), ["city"],
        [F.asc("price_per_night"), F.asc("id")], 3,
    )


@query("sort1_full_history", f"""
    select message_key, partition_id, kafka_offset, {sql_ts("occurred_at")} occurred_at
    from hotel_event_log""")
def _(v: Views):
    return ranking.newest_first(
        v.hotel_event_log().select("message_key", "partition_id", "kafka_offset", "occurred_at"),
        "occurred_at", "kafka_offset",
    )


@query("page1_booking_page", f"""
    select b.id, username, h."name" hotel_name, room_type, {sql_date("check_in")} check_in,
           {sql_date("check_out")} check_out, cast(total_price as double) total_price,
           (select count(*) from priced_bookings where status = 'CONFIRMED') total_elements,
           0 page, 20 page_size,
           cast(ceil((select count(*) from priced_bookings where status = 'CONFIRMED') / 20.0) as bigint) total_pages,
           (select count(*) from priced_bookings where status = 'CONFIRMED') <= 20 "last"
    from priced_bookings b join hotels h on h.id = b.hotel_id join users u on u.id = b.user_id
    where status = 'CONFIRMED' order by b.check_in, b.id limit 20""")
def _(v: Views):
    """Confirmed stays with hotel, guest and price: first page by check-in.

    The page and its totals come from the stays alone; hotel, guest and price are looked up for its rows.
    """
    stays = filters.bookings_matching(v.bookings(), status="CONFIRMED")
    first = ranking.page(stays, 0, 20, F.asc("check_in"), F.asc("id"))
    hotels = v.hotels()
    graph = joins.booking_graph(settlement.priced(first, hotels), hotels, v.users())
    return graph.select(
        "id", "username", "hotel_name", "room_type", "check_in", "check_out", "total_price", "total_elements", "page",
        "page_size", "total_pages", "last",
    ).orderBy("check_in", "id")


@query("page1_users_by_role", """
    select id, username, "role", (select count(*) from users where "role" = 'ADMIN') total_elements,
           1 page, 12 page_size,
           cast(ceil((select count(*) from users where "role" = 'ADMIN') / 12.0) as bigint) total_pages,
           24 >= (select count(*) from users where "role" = 'ADMIN') "last"
    from users where "role" = 'ADMIN' order by id desc limit 12 offset 12""")
def _(v: Views):
    return ranking.page(v.users().filter("role = 'ADMIN'"), 1, 12, F.desc("id"))


@query("page1_keyset", f"""
    select id, hotel_id, {sql_date("check_in")} check_in from bookings
    where check_in > date '2026-04-01' or (check_in = date '2026-04-01' and id > 7000)
    order by bookings.check_in, id limit 50""")
def _(v: Views):
    """Fifty stays after a remembered position; nothing before it is sorted or counted."""
    from datetime import date

    return ranking.page_after(
        v.bookings().select("id", "hotel_id", "check_in"), 50,
        [("check_in", date(2026, 4, 1)), ("id", 7000)],
    )


@query("set1_distinct_union", f"""
    select hotel_id, {sql_date("inventory_date")} night from stock where available_rooms > 0
    union select hotel_id, {sql_date("check_in")} from bookings""")
def _(v: Views):
    opened = stock(v).filter("available_rooms > 0").select(
        "hotel_id", F.col("inventory_date").alias("night")
    )
    arrivals = v.bookings().select("hotel_id", F.col("check_in").alias("night"))
    return opened.unionByName(arrivals).distinct()
