"""Skew-safe helpers and settlement against plain sequential Python, with one key far too popular."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stayspark.functions import skew
from stayspark.operators import joins, settlement, sli

SEED = 11


def hot_rows(n=3000):
    rng = random.Random(SEED)
    return [
        ("hot" if rng.random() < 0.4 else f"k{rng.randrange(20)}", i, rng.randrange(10))
        for i in range(n)
    ]


def test_running_sum_and_lag(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k string, i long, v int").repartition(7)
    seg = F.floor(F.col("i") / 100)
    got = {
        r.i: (r.total, r.before)
        for r in skew.segmented_lag(
            skew.segmented_running_sum(df, ["k"], [F.col("i")], seg, {"total": F.col("v")}),
            ["k"], [F.col("i")], seg, "v", "before",
        ).collect()
    }
    totals, last = defaultdict(int), {}
    for k, i, value in rows:
        totals[k] += value
        assert got[i] == (totals[k], last.get(k))
        last[k] = value
    exclusive = skew.segmented_running_sum(
        df, ["k"], [F.col("i")], seg, {"total": F.col("v")}, include_current=False
    )
    assert {r.i: r.total + r.v for r in exclusive.collect()} == {i: t for i, (t, _) in got.items()}


def test_latest_and_top(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k string, i long, v int").repartition(7)
    latest = {r.k: r.i for r in skew.latest_per_key(df, ["k"], [F.col("i")]).collect()}
    by_key = defaultdict(list)
    for k, i, _ in rows:
        by_key[k].append(i)
    assert latest == {k: max(v) for k, v in by_key.items()}
    for salt in (None, "i"):
        top = skew.top_n_per_key(df, ["k"], [F.desc("v"), F.col("i")], 5, salt_by=salt)
        want = defaultdict(list)
        for k, i, value in rows:
            want[k].append((-value, i))
        expected = {(k, n + 1, i) for k, v in want.items() for n, (_, i) in enumerate(sorted(v)[:5])}
        assert {(r.k, r.rank, r.i) for r in top.collect()} == expected


def test_broadcast_only_when_counted(spark):
    df = spark.range(100)
    assert "broadcast" in skew.broadcast_if_small(df, 100)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in skew.broadcast_if_small(df, 99)._jdf.queryExecution().logical().toString().lower()


def test_overlap_counts_equal_brute_force(spark):
    rng = random.Random(SEED)
    day = date(2026, 1, 1)
    stays = [
        (i, 1 if rng.random() < 0.5 else rng.randrange(6), s, s + timedelta(rng.randrange(1, 9)))
        for i in range(800) for s in [day + timedelta(rng.randrange(60))]
    ]
    windows = [
        (h, f, f + timedelta(rng.randrange(1, 15)))
        for h in range(7) for f in [day + timedelta(rng.randrange(70)) for _ in range(12)]
    ]
    got = joins.overlap_counts(
        spark.createDataFrame(sorted(set(windows)), "hotel_id long, first date, last date"),
        spark.createDataFrame(stays, "id long, hotel_id long, check_in date, check_out date"),
    ).collect()
    assert len(got) == len(set(windows))
    for r in got:
        want = sum(1 for _, h, a, b in stays if h == r.hotel_id and a < r.last and b > r.first)
        assert r.n_stays == want


def make_log(n, hotels, seed):
    """Half of all requests want the same hotel."""
    rng = random.Random(seed)
    start, day = datetime(2025, 12, 1), date(2026, 1, 1)
    rows, cancels = [], []
    for i in range(n):
        hotel = 1 if rng.random() < 0.5 else rng.randrange(hotels)
        check_in = day + timedelta(rng.randrange(25))
        at = start + timedelta(hours=rng.randrange(24 * 20))
        rows.append(
            (
                i, rng.randrange(50), hotel, rng.choice(["SINGLE", "SUITE"]), check_in,
                check_in + timedelta(rng.randrange(0, 5)), "FLEXIBLE",
                "decline" if rng.random() < 0.1 else "approve", at,
            )
        )
        if rng.random() < 0.4:
            cancels += [(i, at + timedelta(hours=rng.randrange(-20, 150))) for _ in range(rng.randrange(1, 3))]
    return rows, cancels


REQUEST = (
    "id long, user_id long, hotel_id long, room_type string, check_in date, check_out date,"
    " rate_plan string, payment_token string, created_at timestamp"
)


def make_inventory(hotels):
    day = date(2026, 1, 1)
    return [
        (h, t, day + timedelta(d), rooms)
        for h in range(hotels) for t, rooms in (("SINGLE", 3), ("SUITE", 2))
        for d in range(32) if (h * 7 + d) % 29
    ]


def sequential(rows, cancels, inventory):
    rooms = {(h, t, d): n for h, t, d, n in inventory}
    ends = {}
    made = {r[0]: r[8] for r in rows}
    for i, at in cancels:
        if at >= made[i]:
            ends[i] = min(at, ends.get(i, at))
    turns = [(r[8], 2 * r[0], r) for r in rows]
    turns += [(ends[r[0]], 2 * r[0] + 1, r) for r in rows if r[0] in ends]
    outcome, inside = {}, set()
    for _, seq, r in sorted(turns, key=lambda t: t[:2]):
        i, nights = r[0], [(r[2], r[3], r[4] + timedelta(k)) for k in range((r[5] - r[4]).days)]
        if seq % 2:
            if i in inside:
                inside.discard(i)
                outcome[i] = "CANCELLED"
                for n in nights:
                    rooms[n] += 1
            continue
        if not nights:
            outcome[i] = "INVALID_DATES"
        elif any(rooms.get(n, 0) <= 0 for n in nights):
            outcome[i] = "NOT_AVAILABLE"
        elif r[7] == "decline":
            outcome[i] = "PAYMENT_DECLINED"
        else:
            outcome[i] = "CONFIRMED"
            inside.add(i)
            for n in nights:
                rooms[n] -= 1
    return outcome


INVENTORY = "hotel_id long, room_type string, inventory_date date, available_rooms int"


def test_settlement_equals_sequential(spark):
    rows, _ = make_log(700, 5, 3)
    inventory = make_inventory(5)
    users = spark.range(50)
    got = settlement.settle(
        spark.createDataFrame(rows, REQUEST), spark.createDataFrame(inventory, INVENTORY),
        users, spark.range(5),
    )
    assert {r.id: r.outcome for r in got.collect()} == sequential(rows, [], inventory)


def settled_log(spark, rows, cancels, inventory, users, hotels):
    got = settlement.settle_with_cancels(
        spark.createDataFrame(rows, REQUEST),
        spark.createDataFrame(cancels, "booking_id long, requested_at timestamp"),
        spark.createDataFrame(inventory, INVENTORY), users, hotels,
    )
    return {r.id: r.outcome for r in got.collect()}


@pytest.mark.parametrize("seed_shift", [0, 1])
def test_settlement_with_cancels_equals_sequential(spark, seed_shift):
    """Unknown users and hotels, broken dates, declined cards on sold-out nights, repeated and early cancels."""
    rows, cancels = make_log(320 + 40 * seed_shift, 3, 5)
    inventory = make_inventory(3)
    got = settled_log(spark, rows, cancels, inventory, spark.range(45), spark.range(3).filter("id <> 2"))
    valid = [r for r in rows if r[1] < 45 and r[2] != 2]
    want = sequential(valid, [c for c in cancels if c[0] in {r[0] for r in valid}], inventory)
    for r in rows:
        if r[5] <= r[4]:
            want[r[0]] = "INVALID_DATES"
        elif r[1] >= 45:
            want[r[0]] = "UNKNOWN_USER"
        elif r[2] == 2:
            want[r[0]] = "UNKNOWN_HOTEL"
    assert got == want
    assert set(want.values()) >= {"CONFIRMED", "CANCELLED", "NOT_AVAILABLE", "PAYMENT_DECLINED", "UNKNOWN_USER", "UNKNOWN_HOTEL"}


def test_a_chain_of_cancels_and_rebookings(spark):
    """One room, every guest leaves just before the next comes: each verdict hangs on the one before."""
    at, night = datetime(2026, 1, 1), date(2026, 2, 1)
    rows, cancels = [], []
    for i in range(24):
        rows.append((i, 1, 1, "SUITE", night, night + timedelta(1 + i % 2), "FLEXIBLE", "ok", at + timedelta(hours=i)))
        cancels.append((i, at + timedelta(hours=i, minutes=90 if i % 3 == 0 else 30)))
    stock = [(1, "SUITE", night + timedelta(d), 1) for d in range(2)]
    got = settled_log(spark, rows, cancels, stock, spark.range(5), spark.range(5))
    assert got == sequential(rows, cancels, stock) and "NOT_AVAILABLE" in got.values()


def test_settlement_with_cancels_without_rows(spark):
    assert settled_log(spark, [], [], [], spark.range(1), spark.range(1)) == {}


def test_one_room_thousand_bookers(spark):
    at = datetime(2026, 1, 1)
    rows = [
        (i, i % 50, 1, "SUITE", date(2026, 2, 1), date(2026, 2, 2), "FLEXIBLE", "ok", at + timedelta(seconds=i % 7))
        for i in range(1000)
    ]
    stock = [(1, "SUITE", date(2026, 2, 1), 1)]
    got = settlement.settle(
        spark.createDataFrame(rows, REQUEST), spark.createDataFrame(stock, INVENTORY),
        spark.range(50), spark.range(2),
    )
    won = got.filter("outcome = 'CONFIRMED'").collect()
    assert [r.id for r in won] == [0]


def test_exact_quantiles(spark):
    rng = random.Random(SEED)
    values = [("hot", round(rng.random() * 50, 2)) for _ in range(999)] + [("x", 1.0), ("x", 2.0)]
    got = {
        (r.k, r.q): r.value
        for r in sli.exact_quantiles(
            spark.createDataFrame(values, "k string, v double"), ["k"], "v", [0.5, 0.95]
        ).collect()
    }
    ordered = sorted(v for k, v in values if k == "hot")
    assert got["hot", 0.5] == pytest.approx(ordered[499])
    assert got["x", 0.5] == pytest.approx(1.5)
    low = 0.95 * 998
    want = ordered[int(low)] + (ordered[int(low) + 1] - ordered[int(low)]) * (low - int(low))
    assert got["hot", 0.95] == pytest.approx(want)
