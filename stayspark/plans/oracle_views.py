"""DuckDB text of the lodging views, used only by the SQL checks beside the registered queries."""

from __future__ import annotations

import re

_D = "date '2026-01-01' + cast({} as int)"
_OFF = "date_diff('day', date '1995-01-01', cast(o_orderdate as date))"

VIEWS: dict[str, str] = {
    "users": """
        select c_custkey id, c_name username,
               case when c_custkey <= 18 and c_custkey % 3 = 0 then 'HOTEL_MANAGER'
                    when c_custkey % 50 = 1 then 'ADMIN' else 'CUSTOMER' end "role"
        from customer""",
    "hotels": """
        select s_suppkey id, s_name "name", n_name city, 80.0e0 + (s_suppkey % 40) * 10 price_per_night,
               case when s_suppkey % 3 = 0 then 3 * (s_suppkey % 7) end manager_id,
               case (s_suppkey // 3) % 3 when 0 then 'FREE' when 1 then 'PRO' else 'ENTERPRISE' end saas_plan,
               case s_suppkey % 4 when 1 then 'free wifi, pool' when 2 then 'spa, pools, bar'
                                  when 3 then 'gym , ,laundry' end amenities
        from supplier join nation on s_nationkey = n_nationkey""",
    "described_hotels": """
        select h.*, doc_id, text description
        from documents join hotels h on h.id = doc_id % (select count(*) from supplier)""",
    "bookings": f"""
        select o_orderkey id, o_custkey user_id,
               (o_orderkey * 31 + o_custkey) % (select count(*) from supplier) hotel_id,
               case cast(substr(o_orderpriority, 1, 1) as int) % 3 when 0 then 'SINGLE'
                    when 1 then 'DOUBLE' else 'SUITE' end room_type,
               {_D.format(_OFF + ' % 180')} check_in,
               {_D.format(_OFF + ' % 180 + 1 + o_orderkey % 3')} check_out,
               case o_orderstatus when 'O' then 'PENDING' when 'F' then 'CONFIRMED'
                    else 'CANCELLED' end status,
               case when o_orderkey % 4 = 0 then 'NON_REFUNDABLE' else 'FLEXIBLE' end rate_plan,
               case when o_orderkey % 17 = 0 then 'decline' else 'approve' end payment_token,
               o_orderdate created_at
        from orders""",
    "priced_bookings": """
        select b.*, cast(round(cast(price_per_night as decimal(12,4))
                 * date_diff('day', check_in, check_out)
                 * case rate_plan when 'NON_REFUNDABLE' then 0.85 else 1.00 end, 2)
               as decimal(12,2)) total_price
        from bookings b join hotels h on b.hotel_id = h.id""",
    "room_inventory": f"""
        select hotel_id, room_type, inventory_date, available_rooms from (
          select s_suppkey hotel_id, s_acctbal, room_type, {_D.format('k')} inventory_date, available_rooms
          from supplier, (select unnest(range(183)) k) g,
               (values ('SINGLE', 4), ('DOUBLE', 6), ('SUITE', 2)) r(room_type, available_rooms)) t
        where not (s_acctbal < 0 and isodow(inventory_date) = 1)""",
    "payments": """
        select id, id booking_id, total_price amount,
               case when status = 'CANCELLED' and rate_plan = 'FLEXIBLE' then 'REFUNDED'
                    else 'SUCCEEDED' end status,
               'pay_' || id transaction_reference
        from priced_bookings where status <> 'PENDING'""",
    "hotel_event_log": """
        select 'hotel-events' topic, cast(hotel_id as varchar) message_key, hotel_id % 4 partition_id,
               event_id * 2 + c kafka_offset,
               case when event_id % 13 = 0 then '{not-json}' else
                 '{"eventId":"e' || event_id || '","schemaVersion":1,"eventType":"' || event_type
                 || '","hotelId":' || hotel_id || ',"hotelName":"H' || hotel_id || '","city":"C'
                 || (hotel_id % 5) || '","pricePerNight":' || (80 + hotel_id % 40 * 10) || '}' end payload,
               ts occurred_at
        from (select event_id, ts, user_id % (select count(*) from supplier) hotel_id,
                case event_type when 'signup' then 'CREATED' when 'error' then 'DELETED'
                     else 'UPDATED' end event_type from events) e,
             (values (0), (1)) copies(c)
        where c = 0 or event_type = 'DELETED'""",
    "jobs": """
        select 'j' || event_id job_id,
          case event_type when 'purchase' then 'booking.confirm' when 'signup' then 'email.send'
               else 'unknown.job' end routing_key,
          case event_id % 4 when 0 then '  ' when 1 then 'lab text' when 2 then props else
            '{"kind":"' || case when event_id % 8 = 3 then 'BOOKING_CONFIRMED'
                                when event_id % 16 = 7 then 'BAD_KIND' else 'BOOKING_CANCELLED' end
            || '","bookingId":' || event_id || ',"userId":' || user_id || ',"username":"u' || user_id
            || '","hotelId":' || (user_id % 7) || ',"hotelName":"H' || (user_id % 7) || '","roomType":"'
            || case when event_id % 16 = 11 then 'PENTHOUSE' else 'DOUBLE' end
            || '","checkIn":"2026-01-01","checkOut":"2026-01-03","source":"BOOKING"}' end payload,
          ts created_at, cast(event_id % 600 as int) delay_s
        from events""",
    "kv_log": """
        select 'k' || (user_id % 50) k, event_id seq, event_type member, value score, ts from events""",
    "search_docs": """
        select doc_id id, p_name "name", n_name city,
               case when lang = 'en' then text end description, p_type amenities,
               case when lang <> 'en' then p_brand end name_alt,
               case when lang <> 'en' then source end city_alt,
               case when lang <> 'en' then text end description_alt,
               p_retailprice price_per_night
        from documents join part on doc_id = p_partkey join nation on doc_id % 25 = n_nationkey""",
    "search_queries": """
        select item_id query_id, text q,
               case when item_id % 2 = 0 then 'en-US' else ' TH-th' end lang from benchmark""",
    "vectors": """
        select vec_id id, embedding, cast(label as varchar) city,
               cast(vec_id % 400 as double) price_per_night from embeddings""",
    "requests": """
        select event_id, ts, event_type uri, value latency_ms,
               case when event_type = 'error' then 500 else 200 end status from events""",
}


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix the statement with the views it names, directly or through other views."""
    known = {**VIEWS, **(extra or {})}
    needed: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name in known:
            if name not in seen and re.search(rf"\b{name}\b", text):
                seen.add(name)
                visit(known[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql.strip()
    ctes = ",\n".join(f"{name} as ({known[name].strip()})" for name in needed)
    body = sql.strip()
    start = "with recursive" if any(re.search(rf"\b{n}\b", known[n]) for n in needed) else "with"
    if re.match(r"with\b", body, re.I):
        return f"{start} {ctes},\n{body[4:].strip()}"
    return f"{start} {ctes}\n{body}"
