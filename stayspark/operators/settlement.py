"""Batch booking settlement: decide every stay request of a log against the opening inventory.

Requests are served in order of (created_at, id). A stay is accepted when every night has a room
left at its turn; it then takes one room on each night. Nothing is decided per hotel in one task:

* only nights asked for more often than there are rooms (*contested*) need any ordering at all;
* contested nights are settled in rounds of set operations. A stay is rejected once some night is
  full with earlier guests, and accepted once it is among the first ``capacity`` on every night,
  counting undecided competitors as if they were accepted. Both verdicts are final, and the
  earliest undecided stay always gets one, so the rounds end with the answer of the sequential log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayspark.functions.columns import stay_total
from stayspark.functions.skew import DEFAULT_SALTS, latest_per_key, segmented_running_sum
from stayspark.operators.joins import explode_nights
from stayspark.session import cut_lineage

CELL = ["hotel_id", "room_type", "night"]
DAY_MICROS = 86_400_000_000


def validate(requests: DataFrame, users: DataFrame, hotels: DataFrame) -> DataFrame:
    """Requests plus ``reject_reason`` (null when the request may try to reserve)."""
    known_users = users.select(F.col("id").alias("user_id")).withColumn("_user", F.lit(True))
    known_hotels = hotels.select(F.col("id").alias("hotel_id")).withColumn("_hotel", F.lit(True))
    joined = requests.join(known_users, "user_id", "left").join(known_hotels, "hotel_id", "left")
    dates_ok = F.coalesce(F.col("check_out") > F.col("check_in"), F.lit(False))
    reason = (
        F.when(~dates_ok, "INVALID_DATES")
        .when(F.col("_user").isNull(), "UNKNOWN_USER")
        .when(F.col("_hotel").isNull(), "UNKNOWN_HOTEL")
    )
    return joined.select(*requests.columns, reason.alias("reject_reason"))


def declined(token: Column) -> Column:
    return F.coalesce(F.lower(token) == "decline", F.lit(False))


def _cells(nights: DataFrame, inventory: DataFrame) -> DataFrame:
    """One row per asked (hotel, type, night): demand and capacity (0 when not configured)."""
    demand = nights.groupBy(*CELL).agg(F.count(F.lit(1)).alias("demand"))
    return demand.join(_stock(inventory), CELL, "left").withColumn(
        "capacity", F.coalesce("capacity", F.lit(0))
    )


def _contested_nights(payable: DataFrame, inventory: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(night rows of contested cells for stays still possible, ids that meet a cell without rooms)."""
    nights = explode_nights(payable).select("id", "ts", *CELL, *_end_column(payable))
    tight = _cells(nights, inventory).filter("demand > capacity").drop("demand")
    in_tight = nights.join(tight, CELL)
    hopeless = in_tight.filter("capacity <= 0").select("id").distinct()
    rows = in_tight.join(hopeless, "id", "left_anti")
    per_stay = rows.groupBy("id").agg(F.count(F.lit(1)).alias("k"))
    return rows.join(per_stay, "id"), hopeless


def _end_column(df: DataFrame) -> list[str]:
    return ["end_ts"] if "end_ts" in df.columns else []


def _turn() -> list[Column]:
    return [F.asc("ts"), F.asc("id")]


def _settle_round(state: DataFrame) -> DataFrame:
    """One round over (id, ts, cell, capacity, k, accepted): drops the rejected, marks the accepted."""
    taken = state.filter("accepted")
    full = (
        taken.groupBy(*CELL)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("capacity").alias("cap"),
            F.max(F.struct("ts", "id")).alias("last_turn"),
        )
        .filter("n >= cap")
        .select(*CELL, "last_turn")
    )
    turn = F.struct("ts", "id")
    blocked = (
        state.filter(~F.col("accepted"))
        .join(full, CELL)
        .filter(turn > F.col("last_turn"))
        .select("id")
        .distinct()
    )
    alive = state.join(blocked, "id", "left_anti")
    # First `capacity` turns per cell, in two steps so that one crowded night is cut across tasks.
    salted = alive.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(DEFAULT_SALTS)))
    part = Window.partitionBy(*CELL, "_salt").orderBy(*_turn())
    whole = Window.partitionBy(*CELL).orderBy(*_turn())
    front = (
        salted.withColumn("_rn", F.row_number().over(part))
        .filter("_rn <= capacity")
        .withColumn("_rn", F.row_number().over(whole))
        .filter("_rn <= capacity and not accepted")
    )
    winners = (
        front.groupBy("id")
        .agg(F.count(F.lit(1)).alias("n"), F.max("k").alias("k"))
        .filter("n = k")
        .select("id", F.lit(True).alias("_won"))
    )
    return alive.join(winners, "id", "left").select(
        "id", "ts", *CELL, "capacity", "k",
        (F.col("accepted") | F.col("_won").isNotNull()).alias("accepted"),
    )


def settle(requests: DataFrame, inventory: DataFrame, users: DataFrame, hotels: DataFrame):
    """Outcome of every request of a create-only log: (request columns, outcome).

    Outcomes: CONFIRMED, NOT_AVAILABLE, PAYMENT_DECLINED, INVALID_DATES, UNKNOWN_USER,
    UNKNOWN_HOTEL. A declined payment never holds rooms; it reads NOT_AVAILABLE when the stay was
    sold out at its turn, since rooms are looked up before the charge.
    """
    checked = validate(requests, users, hotels)
    timed = checked.withColumn("ts", F.unix_micros("created_at"))
    valid = timed.filter("reject_reason is null")
    payable = valid.filter(~declined(F.col("payment_token")))
    contested, hopeless = _contested_nights(payable, inventory)
    state = cut_lineage(contested.withColumn("accepted", F.lit(False)))
    lost = state.select("id").distinct()
    while not state.filter(~F.col("accepted")).isEmpty():
        state = cut_lineage(_settle_round(state))
    unavailable = lost.join(state.select("id").distinct(), "id", "left_anti").unionByName(hopeless)
    accepted = payable.join(unavailable, "id", "left_anti")
    refused = valid.filter(declined(F.col("payment_token")))
    unavailable = unavailable.unionByName(
        _sold_out_at_turn(refused, accepted, inventory)
    ).withColumn("_unavailable", F.lit(True))
    outcome = (
        F.when(F.col("reject_reason").isNotNull(), F.col("reject_reason"))
        .when(F.col("_unavailable").isNotNull(), "NOT_AVAILABLE")
        .when(declined(F.col("payment_token")), "PAYMENT_DECLINED")
        .otherwise("CONFIRMED")
    )
    return checked.join(unavailable, "id", "left").select(
        *requests.columns, outcome.alias("outcome")
    )


def _stock(inventory: DataFrame) -> DataFrame:
    return inventory.select(
        "hotel_id", "room_type", F.col("inventory_date").alias("night"),
        F.col("available_rooms").alias("capacity"),
    )


def _sold_out_at_turn(refused: DataFrame, accepted: DataFrame, inventory: DataFrame) -> DataFrame:
    """Ids of declined requests with a night that was full, or not configured, at their turn.

    A night never takes more guests than rooms, so it is full for a turn exactly when it has as
    many guests as rooms and the last of them came earlier.
    """
    asked = explode_nights(refused).select("id", "ts", *CELL)
    guests = (
        explode_nights(accepted)
        .groupBy(*CELL)
        .agg(F.count(F.lit(1)).alias("guests"), F.max(F.struct("ts", "id")).alias("last_turn"))
    )
    cells = _stock(inventory).join(guests, CELL, "left")
    full = (F.col("guests") >= F.col("capacity")) & (F.struct("ts", "id") > F.col("last_turn"))
    no_room = F.col("capacity").isNull() | (F.col("capacity") <= 0) | F.coalesce(full, F.lit(False))
    return asked.join(cells, CELL, "left").filter(no_room).select("id").distinct()


# ---- logs that also cancel -------------------------------------------------------------------
def settle_with_cancels(
    requests: DataFrame, cancels: DataFrame, inventory: DataFrame, users: DataFrame, hotels: DataFrame
) -> DataFrame:
    """Settle a log of create and cancel requests: (request columns, cancelled_at, outcome).

    ``cancels`` holds (booking_id, requested_at). A cancel frees the nights of an accepted stay for
    later turns; repeated cancels, cancels before the create and cancels of stays that were never
    accepted change nothing. Outcomes are those of ``settle`` and CANCELLED.

    Starts and ends are events of a night. Every round takes two running totals along a night's
    events, cut into days so that a crowded night is scanned in parts: the guests that are certainly
    inside, and those that are possibly inside, counting the undecided as if they were accepted. A
    stay is rejected where a night is certainly full at its turn, and accepted where no night can be
    full. Both verdicts are final and leave the undecided; accepted stays become events of a ledger,
    of which only nights that somebody still waits for are kept, summed up to the first turn that
    waits. The earliest undecided turn always gets a verdict, so the rounds end with the sequential answer.
    """
    ends = (
        cancels.withColumnRenamed("booking_id", "id")
        .join(requests.select("id", "created_at"), "id")
        .filter("requested_at >= created_at")
        .groupBy("id")
        .agg(F.min("requested_at").alias("cancelled_at"))
    )
    checked = validate(requests, users, hotels).withColumn("ts", F.unix_micros("created_at"))
    timed = checked.join(ends, "id", "left").withColumn("end_ts", F.unix_micros("cancelled_at"))
    valid = timed.filter("reject_reason is null")
    payable = valid.filter(~declined(F.col("payment_token")))
    contested, hopeless = _contested_nights(payable, inventory)
    undecided, ledger = cut_lineage(contested), None
    lost = hopeless
    while not undecided.isEmpty():
        verdicts = cut_lineage(_verdicts(undecided, ledger))
        lost = lost.unionByName(verdicts.filter("lost").select("id"))
        won = undecided.join(verdicts.filter("won").select("id"), "id", "left_semi")
        undecided = cut_lineage(undecided.join(verdicts.select("id"), "id", "left_anti"))
        ledger = cut_lineage(_compacted(_events(won), ledger, undecided))
    accepted = payable.join(lost, "id", "left_anti")
    refused = valid.filter(declined(F.col("payment_token")))
    unavailable = lost.unionByName(_full_at_turn(refused, accepted, inventory)).withColumn(
        "_unavailable", F.lit(True)
    )
    outcome = (
        F.when(F.col("reject_reason").isNotNull(), F.col("reject_reason"))
        .when(F.col("_unavailable").isNotNull(), "NOT_AVAILABLE")
        .when(declined(F.col("payment_token")), "PAYMENT_DECLINED")
        .when(F.col("cancelled_at").isNotNull(), "CANCELLED")
        .otherwise("CONFIRMED")
    )
    return timed.join(unavailable, "id", "left").select(
        *requests.columns, "cancelled_at", outcome.alias("outcome")
    )


_EVENT = [*CELL, "at", "seq", "delta"]


def _events(nights: DataFrame) -> DataFrame:
    """Starts and ends of stay nights; at one instant a create (2 id) comes before its cancel (2 id + 1)."""
    starts = nights.select(*CELL, F.col("ts").alias("at"), (F.col("id") * 2).alias("seq"), F.lit(1).alias("delta"))
    stops = nights.filter("end_ts is not null").select(
        *CELL, F.col("end_ts").alias("at"), (F.col("id") * 2 + 1).alias("seq"), F.lit(-1).alias("delta")
    )
    return starts.unionByName(stops)


def _occupancy(events: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Running totals before each event of a night, cut into days."""
    day = F.floor(F.col("at") / F.lit(DAY_MICROS))
    return segmented_running_sum(events, CELL, [F.asc("at"), F.asc("seq")], day, values, include_current=False)


def _verdicts(undecided: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """(id, lost, won) of the stays that get a verdict in this round."""
    events = _events(undecided).withColumn("sure", F.lit(False))
    if ledger is not None:
        events = events.unionByName(ledger.withColumn("sure", F.lit(True)))
    certain = F.when(F.col("sure"), F.col("delta")).otherwise(F.lit(0))
    seen = _occupancy(events, {"possible": F.col("delta"), "certain": certain})
    turns = seen.filter("delta = 1 and not sure").select(
        (F.col("seq") / 2).cast("long").alias("id"), *CELL, "possible", "certain"
    )
    rooms = undecided.select("id", *CELL, "capacity")
    judged = turns.join(rooms, ["id", *CELL]).groupBy("id").agg(
        F.max(F.col("certain") >= F.col("capacity")).alias("lost"),
        F.min(F.col("possible") < F.col("capacity")).alias("won"),
    )
    return judged.filter("lost or won")


def _compacted(new: DataFrame, ledger: DataFrame | None, undecided: DataFrame) -> DataFrame:
    """Ledger events of the nights somebody waits for; those before the first waiting turn as one sum."""
    events = new if ledger is None else new.unionByName(ledger)
    waiting = undecided.groupBy(*CELL).agg(F.min("ts").alias("first"))
    kept = events.join(waiting, CELL)
    past = F.col("at") < F.col("first")
    at = F.when(past, F.col("first") - 1).otherwise(F.col("at"))
    seq = F.when(past, F.lit(-1)).otherwise(F.col("seq"))
    summed = kept.groupBy(*CELL, at.alias("at"), seq.alias("seq")).agg(F.sum("delta").cast("int").alias("delta"))
    return summed.filter("delta <> 0").select(*_EVENT)


def _full_at_turn(refused: DataFrame, accepted: DataFrame, inventory: DataFrame) -> DataFrame:
    """Ids of declined requests with a night that was full, or not configured, at their turn."""
    asked = explode_nights(refused).select("id", "ts", *CELL)
    guests = explode_nights(accepted).select("id", "ts", "end_ts", *CELL)
    guests = _events(guests.join(asked.select(*CELL).distinct(), CELL, "left_semi"))
    probes = asked.select(*CELL, F.col("ts").alias("at"), (F.col("id") * 2).alias("seq"), F.lit(0).alias("delta"))
    seen = _occupancy(guests.unionByName(probes), {"inside": F.col("delta")}).filter("delta = 0")
    no_room = F.col("capacity").isNull() | (F.col("inside") >= F.col("capacity"))
    return (
        seen.join(_stock(inventory), CELL, "left").filter(no_room)
        .select((F.col("seq") / 2).cast("long").alias("id")).distinct()
    )


# ---- what follows from a settlement ------------------------------------------------------------
def priced(requests: DataFrame, hotels: DataFrame) -> DataFrame:
    rates = hotels.select(F.col("id").alias("hotel_id"), "price_per_night")
    total = stay_total(
        F.col("price_per_night"), F.col("check_in"), F.col("check_out"), F.col("rate_plan")
    )
    return requests.join(rates, "hotel_id").withColumn("total_price", total).drop("price_per_night")


def night_use(bookings: DataFrame) -> DataFrame:
    """Rooms taken per cell, combined before the shuffle."""
    return explode_nights(bookings).groupBy(*CELL).agg(F.count(F.lit(1)).alias("used"))


def ledger(inventory: DataFrame, taken: DataFrame, released: DataFrame | None = None) -> DataFrame:
    """Opening rooms minus the nights of ``taken`` stays plus those of ``released`` ones, at least 0."""
    change = night_use(taken).withColumn("used", -F.col("used"))
    if released is not None:
        change = (
            change.unionByName(night_use(released))
            .groupBy(*CELL)
            .agg(F.sum("used").alias("used"))
        )
    change = change.withColumnRenamed("night", "inventory_date")
    left = F.greatest(F.col("available_rooms") + F.coalesce("used", F.lit(0)), F.lit(0))
    return inventory.join(change, ["hotel_id", "room_type", "inventory_date"], "left").select(
        "hotel_id", "room_type", "inventory_date", left.alias("available_rooms")
    )


def cancel(bookings: DataFrame, cancel_ids: DataFrame) -> DataFrame:
    """Status after a batch of cancels; ``released`` marks stays whose nights become free now.

    Cancelling twice, or a stay already cancelled, changes nothing.
    """
    ids = cancel_ids.select(F.col(cancel_ids.columns[0]).alias("id")).distinct()
    asked = bookings.join(ids.withColumn("_asked", F.lit(True)), "id", "left")
    hit = F.col("_asked").isNotNull() & (F.col("status") != "CANCELLED")
    return (
        asked.withColumn("released", hit)
        .withColumn("status", F.when(hit, "CANCELLED").otherwise(F.col("status")))
        .select(*bookings.columns, "released")
    )


def payment_reference(booking_id: Column) -> Column:
    """Stable across re-runs: a hash of the booking id."""
    return F.concat(F.lit("pay_"), F.md5(booking_id.cast("string")))


def charge(confirmed: DataFrame) -> DataFrame:
    """One SUCCEEDED payment per confirmed stay."""
    return confirmed.select(
        F.col("id").alias("booking_id"),
        F.col("total_price").alias("amount"),
        F.lit("SUCCEEDED").alias("status"),
        F.lit("MOCK").alias("provider"),
        payment_reference(F.col("id")).alias("transaction_reference"),
    )


def refund(payments: DataFrame, requests: DataFrame) -> DataFrame:
    """SUCCEEDED -> REFUNDED with a suffixed reference; REFUNDED stays; anything else conflicts."""
    ids = requests.select(F.col(requests.columns[0]).alias("id")).distinct()
    asked = payments.join(ids.withColumn("_asked", F.lit(True)), "id", "left")
    wanted = F.col("_asked").isNotNull()
    now = wanted & (F.col("status") == "SUCCEEDED")
    reference = F.when(now, F.concat("transaction_reference", F.lit("_refund"))).otherwise(
        F.col("transaction_reference")
    )
    result = (
        F.when(~wanted, "UNTOUCHED")
        .when(now, "REFUNDED")
        .when(F.col("status") == "REFUNDED", "ALREADY_REFUNDED")
        .otherwise("CONFLICT")
    )
    return asked.select(
        *[c for c in payments.columns if c not in ("status", "transaction_reference")],
        F.when(now, "REFUNDED").otherwise(F.col("status")).alias("status"),
        reference.alias("transaction_reference"),
        result.alias("refund_result"),
    )


def auto_refund(cancelled: DataFrame, payments: DataFrame) -> DataFrame:
    """Refund the payments of stays cancelled now whose rate plan is refundable."""
    due = cancelled.filter("released and rate_plan = 'FLEXIBLE'").select(
        F.col("id").alias("booking_id")
    )
    return refund(payments, payments.join(due, "booking_id", "left_semi").select("id"))


def notifications(transitions: DataFrame, hotels: DataFrame) -> DataFrame:
    """One message per status change to CONFIRMED or CANCELLED.

    ``transitions``: booking_id, user_id, hotel_id, check_in, check_out, to_status.
    """
    names = hotels.select(F.col("id").alias("hotel_id"), F.col("name").alias("hotel_name"))
    # Fixed value: the message pattern.
    text = F.format_string(
        "Booking %d %s for %s from %s to %s",
        F.col("booking_id"), F.lower("to_status"), F.col("hotel_name"),
        F.col("check_in").cast("string"), F.col("check_out").cast("string"),
    )
    return (
        transitions.filter(F.col("to_status").isin("CONFIRMED", "CANCELLED"))
        .join(names, "hotel_id")
        .select(
            "user_id",
            "booking_id",
            F.concat(F.lit("BOOKING_"), F.col("to_status")).alias("type"),
            text.alias("message"),
            F.lit(False).alias("is_read"),
        )
    )


def mark_read(notes: DataFrame, receipts: DataFrame) -> DataFrame:
    """Receipts (notification_id, reader_id) count only when the reader owns the notification."""
    read = receipts.select(
        F.col("notification_id").alias("id"), F.col("reader_id").alias("user_id")
    ).distinct().withColumn("_read", F.lit(True))
    return notes.join(read, ["id", "user_id"], "left").select(
        *[c for c in notes.columns if c != "is_read"],
        (F.col("is_read") | F.col("_read").isNotNull()).alias("is_read"),
    )


def set_availability(inventory: DataFrame, updates: DataFrame) -> DataFrame:
    """Apply (hotel_id, room_type, inventory_date, available_rooms, seq); the last write wins."""
    key = ["hotel_id", "room_type", "inventory_date"]
    last = latest_per_key(updates, key, [F.col("seq")], ["available_rooms"]).withColumnRenamed(
        "available_rooms", "_new"
    )
    return inventory.join(last, key, "left").select(
        *key, F.coalesce("_new", "available_rooms").alias("available_rooms")
    )


def create_inventory(inventory: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows whose (hotel, type, date) does not exist yet; of duplicates the first one counts."""
    key = ["hotel_id", "room_type", "inventory_date"]
    unique = rows.groupBy(*key).agg(F.min_by("available_rooms", "seq").alias("available_rooms"))
    return unique.join(inventory.select(*key), key, "left_anti")
