"""Settlement and access queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayspark.operators import access, joins, settlement
from stayspark.plans.registry import Registry, sql_date, sql_ts
from stayspark.sources.views import Views

# How many rounds the SQL of the create-only log unrolls; enough for the checked scale.
ROUNDS = 6


def _unrolled_settlement() -> dict[str, str]:
    """The fix-point rounds as chained CTEs: a(i) and r(i) hold accepted and rejected ids so far."""
    views = {
        "payable_nights": """
            select b.id, created_at, hotel_id, room_type, d night from bookings b,
              lateral (select check_in + cast(k as int) d from (select unnest(range(3)) k)) n
            where d < check_out and payment_token <> 'decline'""",
        "asked_nights": """
            select n.*, coalesce(available_rooms, 0) cap from payable_nights n
            left join room_inventory i on i.hotel_id = n.hotel_id and i.room_type = n.room_type
              and i.inventory_date = n.night""",
        "hopeless_ids": "select distinct id from asked_nights where cap <= 0",
        "settle_0": """
            select a.*, 'U' st from asked_nights a where id not in (select id from hopeless_ids)""",
    }
    for i in range(ROUNDS):
        views[f"settle_{i + 1}"] = f"""
            select id, created_at, hotel_id, room_type, night, cap,
                   case when st <> 'U' then st when max(rej) over (partition by id) then 'R'
                        when min(acc) over (partition by id) then 'A' else 'U' end st
            from (select *, coalesce(sum(case when st = 'A' then 1 else 0 end) over w, 0) >= cap rej,
                         coalesce(sum(case when st <> 'R' then 1 else 0 end) over w, 0) < cap acc
                  from settle_{i}
                  window w as (partition by hotel_id, room_type, night order by created_at, id
                               rows between unbounded preceding and 1 preceding)) t"""
    views["won_stays"] = f"select distinct id from settle_{ROUNDS} where st = 'A'"
    views["settled"] = """
        select b.*, case
          when payment_token <> 'decline' then
            case when id in (select id from won_stays) then 'CONFIRMED' else 'NOT_AVAILABLE' end
          when id in (select q.id from bookings q,
                 lateral (select q.check_in + cast(k as int) d from (select unnest(range(3)) k)) n
                 left join room_inventory i on i.hotel_id = q.hotel_id and i.room_type = q.room_type
                   and i.inventory_date = d
                 where q.payment_token = 'decline' and d < q.check_out
                   and coalesce(i.available_rooms, 0) <= (
                     select count(*) from won_nights g where g.hotel_id = q.hotel_id
                       and g.room_type = q.room_type and g.night = d
                       and (g.created_at, g.id) < (q.created_at, q.id)))
          then 'NOT_AVAILABLE' else 'PAYMENT_DECLINED' end outcome
        from bookings b"""
    views["won_nights"] = """
        select n.* from payable_nights n where id in (select id from won_stays)"""
    return views


#: One turn of every hotel and room type at a time: guests inside are a list, a cancel takes its guest out.
_SEQUENTIAL = {
    "cancel_log": """
        select id, created_at + to_days(cast(1 + id % 10 as int)) ended from bookings
        where status = 'CANCELLED'""",
    "checked_log": """
        select b.id, hotel_id, room_type, check_in, check_out, payment_token, created_at, ended,
               case when check_out <= check_in then 'INVALID_DATES'
                    when user_id not in (select id from open_users) then 'UNKNOWN_USER'
                    when hotel_id not in (select id from open_hotels) then 'UNKNOWN_HOTEL' end reason
        from log_bookings b left join cancel_log c on c.id = b.id""",
    "log_bookings": """
        select b.* replace (case when status = 'CANCELLED' and id % 29 = 0 then check_in else check_out end as check_out)
        from bookings b""",
    "open_users": "select c_custkey id from customer where c_acctbal >= -900",
    "open_hotels": "select s_suppkey id from supplier where s_acctbal >= -500",
    "log_rooms": """
        select l.id, list(cast(night as date) order by night) nights, list(coalesce(available_rooms, 0) order by night) rooms
        from (select id, hotel_id, room_type, unnest(generate_series(check_in, check_out - interval 1 day, interval 1 day)) night
              from checked_log where reason is null) l
        left join room_inventory i on i.hotel_id = l.hotel_id and i.room_type = l.room_type and i.inventory_date = cast(l.night as date)
        group by l.id""",
    "log_turns": """
        select *, row_number() over (partition by hotel_id, room_type order by at_, seq) turn from (
          select id, hotel_id, room_type, created_at at_, 2 * id seq, nights, rooms,
                 lower(payment_token) = 'decline' declined, check_in, check_out, true opening
          from checked_log join log_rooms using (id) where reason is null
          union all
          select id, hotel_id, room_type, ended, 2 * id + 1, null, null, false, check_in, check_out, false
          from checked_log where reason is null and ended >= created_at) t""",
    "log_runs": """
        select hotel_id, room_type, 0 turn, cast([] as struct(id bigint, a date, b date)[]) guests,
               cast(null as bigint) id, cast(null as varchar) verdict
        from (select distinct hotel_id, room_type from log_turns) g
        union all
        select hotel_id, room_type, turn,
               case when not opening then list_filter(guests, lambda g: g.id <> id)
                    when verdict = 'CONFIRMED' then list_append(guests, {'id': id, 'a': check_in, 'b': check_out})
                    else guests end, id, verdict
        from (select t.*, r.guests, case when not opening then null
                when len(list_filter(range(1, len(nights) + 1), lambda i: rooms[i] <=
                       len(list_filter(r.guests, lambda g: g.a <= nights[i] and g.b > nights[i])))) > 0 then 'NOT_AVAILABLE'
                when declined then 'PAYMENT_DECLINED' else 'CONFIRMED' end verdict
              from log_runs r join log_turns t on t.hotel_id = r.hotel_id and t.room_type = r.room_type and t.turn = r.turn + 1) s""",
}


REG = Registry({**_unrolled_settlement(), **_SEQUENTIAL})
query = REG.query


def settled(v: Views):
    return settlement.settle(
        v.bookings(), v.room_inventory(),
        v.users(), v.table("supplier").select(F.col("s_suppkey").alias("id")),
    )


def active(v: Views):
    return v.bookings().filter("status <> 'CANCELLED'")


@query("bkg1_stay_price", """
    select id, hotel_id, rate_plan, cast(total_price as double) total_price from priced_bookings""")
def _(v: Views):
    hotels = v.hotels().select("id", "price_per_night")
    return settlement.priced(v.bookings(), hotels).select("id", "hotel_id", "rate_plan", "total_price")


@query("bkg2_validate_requests", """
    select o_orderkey id, case
        when o_orderstatus = 'P' and o_orderpriority = '5-LOW' then 'INVALID_DATES'
        when o_custkey not in (select c_custkey from customer where c_acctbal >= 0) then 'UNKNOWN_USER'
        when (o_orderkey * 31 + o_custkey) % (select count(*) from supplier)
             not in (select s_suppkey from supplier where s_acctbal >= 0) then 'UNKNOWN_HOTEL'
      end reject_reason from orders""")
def _(v: Views):
    """Accounts and hotels with a negative balance are closed; some requests end before they start."""
    orders = v.table("orders").select(F.col("o_orderkey").alias("id"), "o_orderpriority")
    asked = v.bookings().join(orders, "id")
    broken = (F.col("status") == "CANCELLED") & (F.col("o_orderpriority") == "5-LOW")
    asked = asked.withColumn("check_out", F.when(broken, F.col("check_in")).otherwise(F.col("check_out")))
    users = v.table("customer").filter("c_acctbal >= 0").select(F.col("c_custkey").alias("id"))
    hotels = v.table("supplier").filter("s_acctbal >= 0").select(F.col("s_suppkey").alias("id"))
    return settlement.validate(asked, users, hotels).select("id", "reject_reason")


@query("bkg3_settle_requests", "select id, hotel_id, room_type, outcome from settled")
def _(v: Views):
    return settled(v).select("id", "hotel_id", "room_type", "outcome")


@query("bkg3_settle_with_cancels", """
    select c.id, case when reason is not null then reason
        when verdict = 'CONFIRMED' and ended >= created_at then 'CANCELLED' else verdict end outcome
    from checked_log c left join (select id, verdict from log_runs where verdict is not null) v on v.id = c.id""")
def _(v: Views):
    """Cancelled stays withdraw one to ten days after the request and free their nights; accounts and hotels deep
    in debt are closed, and some withdrawn requests end before they start."""
    asked, key = v.bookings(), F.col("id")
    cancels = asked.filter("status = 'CANCELLED'").select(
        key.alias("booking_id"),
        (F.col("created_at") + F.make_dt_interval((1 + key % 10).cast("int"))).alias("requested_at"),
    )
    broken = (F.col("status") == "CANCELLED") & (key % 29 == 0)
    asked = asked.withColumn("check_out", F.when(broken, F.col("check_in")).otherwise(F.col("check_out")))
    users = v.table("customer").filter("c_acctbal >= -900").select(F.col("c_custkey").alias("id"))
    hotels = v.table("supplier").filter("s_acctbal >= -500").select(F.col("s_suppkey").alias("id"))
    return settlement.settle_with_cancels(asked, cancels, v.room_inventory(), users, hotels).select("id", "outcome")


@query("bkg4_inventory_ledger", f"""
    select i.hotel_id, i.room_type, {sql_date("i.inventory_date")} inventory_date,
           greatest(i.available_rooms - count(b.id), 0) available_rooms
    from room_inventory i left join bookings b on b.hotel_id = i.hotel_id and b.room_type = i.room_type
      and b.status <> 'CANCELLED' and b.check_in <= i.inventory_date and b.check_out > i.inventory_date
    group by i.hotel_id, i.room_type, i.inventory_date, i.available_rooms""")
def _(v: Views):
    return settlement.ledger(v.room_inventory(), active(v))


@query("bkg5_cancel_batch", """
    select id, case when payment_token = 'decline' then 'CANCELLED' else status end status,
           payment_token = 'decline' and status <> 'CANCELLED' released from bookings""")
def _(v: Views):
    """Stays with a declined card are cancelled; some of them already were."""
    bookings = v.bookings()
    asked = bookings.filter("payment_token = 'decline'").select("id")
    return settlement.cancel(bookings, asked).select("id", "status", "released")


@query("bkg5_released_ledger", f"""
    select i.hotel_id, i.room_type, {sql_date("i.inventory_date")} inventory_date,
           greatest(i.available_rooms - count(b.id) filter (where b.payment_token <> 'decline'), 0) available_rooms
    from room_inventory i left join bookings b on b.hotel_id = i.hotel_id and b.room_type = i.room_type
      and b.status <> 'CANCELLED' and b.check_in <= i.inventory_date and b.check_out > i.inventory_date
    group by i.hotel_id, i.room_type, i.inventory_date, i.available_rooms""")
def _(v: Views):
    """Ledger after the cancels of the previous query gave their nights back."""
    bookings = active(v)
    after = settlement.cancel(bookings, bookings.filter("payment_token = 'decline'").select("id"))
    return settlement.ledger(v.room_inventory(), bookings, after.filter("released"))


@query("bkg6_charge_confirmed", """
    select p.id booking_id, cast(total_price as double) amount, 'SUCCEEDED' status, 'MOCK' provider,
           'pay_' || md5(cast(p.id as varchar)) transaction_reference
    from priced_bookings p where status = 'CONFIRMED'""")
def _(v: Views):
    return settlement.charge(v.priced_bookings().filter("status = 'CONFIRMED'"))


@query("bkg7_refund_batch", """
    select p.id, p.booking_id, cast(p.amount as double) amount,
           case when b.rate_plan = 'FLEXIBLE' then 'REFUNDED' else p.status end status,
           p.transaction_reference || case when b.rate_plan = 'FLEXIBLE' and p.status = 'SUCCEEDED'
             then '_refund' else '' end transaction_reference,
           case when b.rate_plan <> 'FLEXIBLE' then 'UNTOUCHED'
                when p.status = 'SUCCEEDED' then 'REFUNDED' else 'ALREADY_REFUNDED' end refund_result
    from payments p join bookings b on b.id = p.booking_id""")
def _(v: Views):
    """Every stay with the flexible plan is cancelled; payments refunded before stay as they are."""
    flexible = v.bookings().filter("rate_plan = 'FLEXIBLE'").select("id")
    return settlement.refund(v.payments(), flexible)


@query("bkg8_notifications", f"""
    select user_id, b.id booking_id, 'BOOKING_' || status "type",
           'Booking ' || b.id || ' ' || lower(status) || ' for ' || h."name" || ' from '
             || {sql_date("check_in")} || ' to ' || {sql_date("check_out")} message, false is_read
    from bookings b join hotels h on h.id = b.hotel_id where status <> 'PENDING'""")
def _(v: Views):
    changes = v.bookings().withColumnRenamed("id", "booking_id").withColumnRenamed(
        "status", "to_status"
    )
    return settlement.notifications(changes, v.hotels())


@query("fil10_notification_rows", f"""
    select b.id, b.id booking_id, 'BOOKING_' || status "type",
           'Booking ' || b.id || ' ' || lower(status) || ' for ' || h."name" || ' from '
             || {sql_date("check_in")} || ' to ' || {sql_date("check_out")} message,
           user_id % 2 = 0 "read", {sql_ts("created_at")} created_at
    from bookings b join hotels h on h.id = b.hotel_id where status <> 'PENDING'""")
def _(v: Views):
    """Notifications as an answer shows them; accounts of even number have read theirs."""
    stays = v.bookings()
    changes = stays.withColumnRenamed("id", "booking_id").withColumnRenamed("status", "to_status")
    made = settlement.notifications(changes, v.hotels()).withColumn("id", F.col("booking_id"))
    receipts = stays.filter("user_id % 2 = 0").select(F.col("id").alias("notification_id"), F.col("user_id").alias("reader_id"))
    read = settlement.mark_read(made, receipts).select("id", "is_read")
    times = stays.select("id", "created_at")
    return joins.notification_rows(made.drop("is_read").join(read, "id").join(times, "id"))


@query("bkg9_mark_read", """
    select id, user_id, user_id % 2 = 0 is_read from bookings where status = 'CONFIRMED'""")
def _(v: Views):
    """Everybody signs receipts, but those signed in the name of the next account do not count."""
    stays = v.bookings().filter("status = 'CONFIRMED'")
    notes = stays.select("id", "user_id", F.lit(False).alias("is_read"))
    signer = F.col("user_id") + F.col("user_id") % 2
    receipts = stays.select(F.col("id").alias("notification_id"), signer.alias("reader_id"))
    return settlement.mark_read(notes, receipts)


@query("bkg10_set_availability", f"""
    select i.hotel_id, i.room_type, {sql_date("i.inventory_date")} inventory_date,
           coalesce(u.rooms, i.available_rooms) available_rooms
    from room_inventory i left join (
      select hotel_id, room_type, check_in, arg_max(cast(id % 9 as int), id) rooms from bookings group by all) u
    on u.hotel_id = i.hotel_id and u.room_type = i.room_type and u.check_in = i.inventory_date""")
def _(v: Views):
    updates = v.bookings().select(
        "hotel_id", "room_type", F.col("check_in").alias("inventory_date"),
        (F.col("id") % 9).cast("int").alias("available_rooms"), F.col("id").alias("seq"),
    )
    return settlement.set_availability(v.room_inventory(), updates)


@query("bkg10_create_inventory", f"""
    select hotel_id, room_type, {sql_date("check_in")} inventory_date,
           arg_min(cast(id % 9 as int), id) available_rooms
    from bookings b where not exists (select 1 from room_inventory i where i.hotel_id = b.hotel_id
      and i.room_type = b.room_type and i.inventory_date = b.check_in)
    group by hotel_id, room_type, check_in""")
def _(v: Views):
    rows = v.bookings().select(
        "hotel_id", "room_type", F.col("check_in").alias("inventory_date"),
        (F.col("id") % 9).cast("int").alias("available_rooms"), F.col("id").alias("seq"),
    )
    return settlement.create_inventory(v.room_inventory(), rows)


# ---- access ----------------------------------------------------------------------------------
@query("acc1_visible_bookings", """
    select id actor_id, 'ALL' scope, null booking_id from users where "role" = 'ADMIN'
    union all
    select user_id, 'OWN', b.id from bookings b join users u on u.id = user_id where "role" <> 'ADMIN'
    union all
    select manager_id, 'MANAGED', b.id from bookings b join hotels h on h.id = b.hotel_id
      join users u on u.id = manager_id where "role" = 'HOTEL_MANAGER' and b.user_id <> manager_id""")
def _(v: Views):
    return access.visible_bookings(v.users(), v.bookings(), v.hotels())


@query("acc1_view_checks", """
    select a.actor_id, a.booking_id, u."role" = 'ADMIN' or b.user_id = a.actor_id
           or (u."role" = 'HOTEL_MANAGER' and coalesce(h.manager_id = a.actor_id, false)) allowed
    from (select id booking_id, unnest([user_id, id % 50]) actor_id from bookings) a
    join bookings b on b.id = a.booking_id join hotels h on h.id = b.hotel_id
    join users u on u.id = a.actor_id""")
def _(v: Views):
    """Each stay is asked for by its guest and by one of the first accounts."""
    asked = v.bookings().select(
        F.explode(F.array(F.col("user_id"), F.col("id") % 50)).alias("actor_id"),
        F.col("id").alias("booking_id"),
    )
    return access.view_checks(asked, v.users(), v.bookings(), v.hotels())


@query("acc1_listing_criteria", """
    select r.id request_id, r.user_id % 50 actor_id,
      case when u."role" = 'ADMIN' then 'ALL'
           when u."role" = 'CUSTOMER' then 'OWN'
           when not exists (select 1 from hotels h where h.manager_id = u.id) then 'NONE'
           when r.hotel is null then 'MANAGED'
           when exists (select 1 from hotels h where h.manager_id = u.id and h.id = r.hotel) then 'MANAGED'
           else 'DENIED' end scope,
      case when u."role" = 'ADMIN' then r.user_id when u."role" = 'CUSTOMER' then u.id end user_id,
      case when u."role" = 'HOTEL_MANAGER' and not exists (select 1 from hotels h where h.manager_id = u.id)
           then -1 else r.hotel end hotel_id
    from (select id, user_id, case when status <> 'PENDING' then hotel_id end hotel from bookings) r
    join users u on u.id = r.user_id % 50""")
def _(v: Views):
    asked = v.bookings().select(
        F.col("id").alias("request_id"), (F.col("user_id") % 50).alias("actor_id"), "user_id",
        F.when(F.col("status") != "PENDING", F.col("hotel_id")).alias("hotel_id"),
    )
    return access.listing_criteria(asked, v.users(), v.hotels())


@query("acc2_manageable_hotels", """
    select id actor_id, 'ALL' scope, null hotel_id from users where "role" = 'ADMIN'
    union all select u.id, 'MANAGED', h.id from users u join hotels h on h.manager_id = u.id
    where "role" = 'HOTEL_MANAGER'""")
def _(v: Views):
    return access.manageable_hotels(v.users(), v.hotels())


@query("acc3_inventory_write_checks", """
    select a.actor_id, a.hotel_id, case when "role" = 'ADMIN' then 'ALLOWED'
        when "role" <> 'HOTEL_MANAGER' or coalesce(manager_id, -1) <> a.actor_id then 'NOT_MANAGER'
        when saas_plan = 'FREE' then 'PLAN' else 'ALLOWED' end verdict
    from (select distinct user_id actor_id, hotel_id from bookings
          union select manager_id, id from hotels where manager_id is not null) a
    join users u on u.id = a.actor_id join hotels h on h.id = a.hotel_id""")
def _(v: Views):
    guests = v.bookings().select(F.col("user_id").alias("actor_id"), "hotel_id")
    managers = v.hotels().filter("manager_id is not null").select(
        F.col("manager_id").alias("actor_id"), F.col("id").alias("hotel_id")
    )
    asked = guests.unionByName(managers).distinct()
    return access.inventory_write_checks(asked, v.users(), v.hotels())


@query("acc4_refund_checks", """
    select a.actor_id, a.payment_id, case when "role" = 'ADMIN' then true
        when "role" = 'CUSTOMER' and b.user_id = a.actor_id then rate_plan = 'FLEXIBLE'
        when "role" = 'HOTEL_MANAGER' and coalesce(manager_id, -1) = a.actor_id then saas_plan = 'ENTERPRISE'
        else false end allowed
    from (select p.id payment_id, unnest([b.user_id, b.user_id % 50, coalesce(h.manager_id, 1)]) actor_id
          from payments p join bookings b on b.id = p.booking_id join hotels h on h.id = b.hotel_id) a
    join payments p on p.id = a.payment_id join bookings b on b.id = p.booking_id
    join hotels h on h.id = b.hotel_id join users u on u.id = a.actor_id""")
def _(v: Views):
    """Each payment is asked for by its guest, one of the first accounts and the hotel's manager."""
    hotels = v.hotels().select("id", "manager_id", "saas_plan")
    bookings = v.bookings()
    asked = bookings.filter("status <> 'PENDING'").join(
        hotels.select(F.col("id").alias("hotel_id"), "manager_id"), "hotel_id"
    ).select(
        F.explode(
            F.array(F.col("user_id"), F.col("user_id") % 50, F.coalesce("manager_id", F.lit(1)))
        ).alias("actor_id"),
        F.col("id").alias("payment_id"),
    )
    return access.refund_checks(asked, v.users(), v.payments(), bookings, hotels)


@query("acc5_creation_checks", """
    select r.id request_id, r.user_id actor_id, case when "role" = 'ADMIN' then 'ALLOWED'
        when "role" <> 'HOTEL_MANAGER' then 'ROLE'
        when owned + nth <= case coalesce(best, 0) when 2 then 2147483647 when 1 then 5 else 1 end
        then 'ALLOWED' else 'LIMIT' end verdict
    from (select *, row_number() over (partition by user_id order by created_at, id) nth from bookings) r
    join users u on u.id = r.user_id
    left join (select u.id, count(h.id) owned,
        max(case saas_plan when 'ENTERPRISE' then 2 when 'PRO' then 1 when 'FREE' then 0 end) best
        from users u left join hotels h on h.manager_id = u.id group by u.id) m on m.id = r.user_id""")
def _(v: Views):
    """Every stay request read as an attempt to open a hotel."""
    asked = v.bookings().select(
        F.col("id").alias("request_id"), F.col("user_id").alias("actor_id"), "created_at"
    )
    month = F.date_trunc("month", F.col("created_at"))
    return access.creation_checks(asked, v.users(), v.hotels(), month)


@query("acc6_valid_sessions", f"""
    select user_id, id, 't' || id token, {sql_ts("expiry_date")} expiry_date from (
      select *, row_number() over (partition by user_id order by expiry_date desc, id desc) rn
      from (select event_id id, user_id, ts + interval 7 days expiry_date, event_type = 'error' revoked from events)
      where not revoked and expiry_date > timestamp '2024-01-25 00:00:00') where rn = 1""")
def _(v: Views):
    tokens = v.table("events").select(
        F.col("event_id").alias("id"), F.concat(F.lit("t"), F.col("event_id")).alias("token"),
        "user_id", (F.col("ts") + F.expr("interval 7 days")).alias("expiry_date"),
        (F.col("event_type") == "error").alias("revoked"),
    )
    return access.valid_sessions(tokens, "2024-01-25")
