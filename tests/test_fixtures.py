"""Small worked examples of the domain with their expected numbers."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stayspark.functions.columns import enum_or_null, iso_date_or_null, name_uuid
from stayspark.functions.vector import cosine, preview
from stayspark.operators import access, aggs, events, filters, joins, jobs, ranking, search, settlement, sli, vectors
from stayspark.schemas import ROOM_TYPES

TODAY = date(2026, 1, 1)


def plus(n):
    return TODAY + timedelta(n)


@pytest.fixture(scope="module")
def world(spark):
    users = spark.createDataFrame(
        [(1, "alice", "CUSTOMER"), (2, "bob", "CUSTOMER"), (3, "mia", "HOTEL_MANAGER"), (4, "root", "ADMIN")],
        "id long, username string, role string",
    )
    hotels = spark.createDataFrame(
        [
            (1, "Tokyo Grand", "Tokyo", 220.0, 3, "ENTERPRISE", "pool, spa", "Calm rooms"),
            (2, "Paris Central", "Paris", 180.0, 3, "FREE", None, "Near the river"),
        ],
        "id long, name string, city string, price_per_night double, manager_id long, saas_plan string,"
        " amenities string, description string",
    )
    bookings = spark.createDataFrame(
        [
            (1, 1, 1, "SUITE", plus(5), plus(8), "CONFIRMED", "FLEXIBLE", Decimal("660.00")),
            (2, 1, 2, "DOUBLE", plus(10), plus(12), "CANCELLED", "NON_REFUNDABLE", Decimal("360.00")),
            (3, 2, 1, "SINGLE", plus(6), plus(7), "CONFIRMED", "FLEXIBLE", Decimal("220.00")),
        ],
        "id long, user_id long, hotel_id long, room_type string, check_in date, check_out date,"
        " status string, rate_plan string, total_price decimal(12,2)",
    )
    return users, hotels, bookings


def test_booking_search(world):
    users, hotels, bookings = world
    assert joins.bookings_of_username(bookings, users, "alice").count() == 2
    graph = joins.booking_graph(filters.bookings_matching(bookings, hotel_id=1, status="CONFIRMED"), hotels, users)
    assert graph.count() == 2
    assert filters.bookings_matching(filters.stays_overlapping(bookings, plus(5), plus(7)), hotel_id=1).count() == 2
    assert filters.bookings_matching(
        bookings, user_id=1, status="CONFIRMED", check_in_from=plus(4), check_in_to=plus(6)
    ).count() == 1
    assert filters.bookings_matching(
        bookings, hotel_ids=[2], status="CANCELLED", check_in_from=plus(9), check_in_to=plus(11)
    ).count() == 1
    assert filters.bookings_matching(bookings, hotel_ids=[]).count() == 3


def request(spark, token="approve", first=2, last=4, room="DOUBLE"):
    return spark.createDataFrame(
        [(1, 1, 1, room, plus(first), plus(last), "FLEXIBLE", token, datetime(2026, 1, 1))],
        "id long, user_id long, hotel_id long, room_type string, check_in date, check_out date,"
        " rate_plan string, payment_token string, created_at timestamp",
    )


def inventory(spark, room, *days):
    return spark.createDataFrame(
        [(1, room, plus(d), 1) for d in days],
        "hotel_id long, room_type string, inventory_date date, available_rooms int",
    )


def test_settlement_takes_and_returns_rooms(spark, world):
    users, hotels, _ = world
    stock = inventory(spark, "DOUBLE", 2, 3)
    settled = settlement.settle(request(spark), stock, users, hotels)
    assert settled.first().outcome == "CONFIRMED"
    confirmed = settlement.priced(settled, hotels)
    left = settlement.ledger(stock, confirmed)
    assert [r.available_rooms for r in left.collect()] == [0, 0]
    paid = settlement.charge(confirmed).collect()
    assert len(paid) == 1 and paid[0].amount == Decimal("440.00")
    declined = settlement.settle(request(spark, "decline"), stock, users, hotels)
    assert declined.first().outcome == "PAYMENT_DECLINED"
    assert settlement.settle(request(spark, last=5), stock, users, hotels).first().outcome == "NOT_AVAILABLE"
    assert settlement.settle(request(spark, last=2), stock, users, hotels).first().outcome == "INVALID_DATES"

    booked = settled.withColumn("status", F.lit("CONFIRMED"))
    cancelled = settlement.cancel(booked, booked.select("id"))
    assert [r.available_rooms for r in settlement.ledger(stock, booked, cancelled.filter("released")).collect()] == [1, 1]
    again = settlement.cancel(cancelled.drop("released"), booked.select("id"))
    assert not again.first().released and again.first().status == "CANCELLED"
    moves = booked.select(
        F.col("id").alias("booking_id"), "user_id", "hotel_id", "check_in", "check_out",
        F.explode(F.array(F.lit("CONFIRMED"), F.lit("CANCELLED"))).alias("to_status"),
    )
    notes = {r.type: r.message for r in settlement.notifications(moves, hotels).collect()}
    assert notes["BOOKING_CONFIRMED"] == "Booking 1 confirmed for Tokyo Grand from 2026-01-03 to 2026-01-05"
    assert set(notes) == {"BOOKING_CONFIRMED", "BOOKING_CANCELLED"}


def test_prices_and_refunds(spark, world):
    users, hotels, bookings = world
    stay = spark.createDataFrame(
        [(1, 1, plus(1), plus(2), "NON_REFUNDABLE"), (2, 1, plus(1), plus(3), "FLEXIBLE")],
        "id long, hotel_id long, check_in date, check_out date, rate_plan string",
    )
    rates = spark.createDataFrame([(1, 200.0)], "id long, price_per_night double")
    assert {r.id: r.total_price for r in settlement.priced(stay, rates).collect()} == {
        1: Decimal("170.00"), 2: Decimal("400.00"),
    }
    payments = spark.createDataFrame(
        [(1, 1, "SUCCEEDED", "pay_a"), (2, 2, "REFUNDED", "pay_b_refund"), (3, 3, "FAILED", "pay_c")],
        "id long, booking_id long, status string, transaction_reference string",
    )
    after = {r.id: r for r in settlement.refund(payments, payments.select("id")).collect()}
    assert (after[1].status, after[1].transaction_reference) == ("REFUNDED", "pay_a_refund")
    assert after[2].transaction_reference == "pay_b_refund" and after[2].refund_result == "ALREADY_REFUNDED"
    assert after[3].status == "FAILED" and after[3].refund_result == "CONFLICT"
    asked = spark.createDataFrame([(1, 2), (3, 2), (1, 1), (3, 1), (4, 2), (2, 1)], "actor_id long, payment_id long")
    verdict = {
        (r.actor_id, r.payment_id): r.allowed
        for r in access.refund_checks(asked, users, payments, bookings, hotels).collect()
    }
    # Booking 2 is not refundable and its hotel FREE; booking 1 is flexible on an ENTERPRISE hotel.
    assert verdict == {
        (1, 2): False, (3, 2): False, (1, 1): True, (3, 1): True, (4, 2): True, (2, 1): False,
    }
    flexible = bookings.filter("id = 1").withColumn("released", F.lit(True))
    assert settlement.auto_refund(flexible, payments).filter("refund_result = 'REFUNDED'").count() == 1


def test_plan_limits(spark):
    users = spark.createDataFrame([(3, "HOTEL_MANAGER"), (5, "CUSTOMER"), (4, "ADMIN")], "id long, role string")
    asked = spark.createDataFrame(
        [(1, 3, datetime(2026, 1, 1)), (2, 3, datetime(2026, 1, 2)), (3, 5, datetime(2026, 1, 1)), (4, 4, datetime(2026, 1, 1))],
        "request_id long, actor_id long, created_at timestamp",
    )
    month = F.date_trunc("month", F.col("created_at"))
    none = spark.createDataFrame([], "id long, manager_id long, saas_plan string")
    first = {r.request_id: r.verdict for r in access.creation_checks(asked, users, none, month).collect()}
    assert first == {1: "ALLOWED", 2: "LIMIT", 3: "ROLE", 4: "ALLOWED"}
    pro = spark.createDataFrame([(1, 3, "PRO")], "id long, manager_id long, saas_plan string")
    second = {r.request_id: r.verdict for r in access.creation_checks(asked, users, pro, month).collect()}
    assert second[2] == "ALLOWED"
    writes = spark.createDataFrame([(3, 1)], "actor_id long, hotel_id long")
    for plan, want in (("FREE", "PLAN"), ("PRO", "ALLOWED")):
        h = spark.createDataFrame([(1, 3, plan)], "id long, manager_id long, saas_plan string")
        assert access.inventory_write_checks(writes, users, h).first().verdict == want


def test_hotel_tools(spark):
    hotels = spark.createDataFrame(
        [(1, "Driftwood Rooms", "Lisbon", 74.0), (2, "Azure Sands Resort", "Lisbon", 320.0), (3, "Alpine Ridge Chalet", "Zermatt", 145.0)],
        "id long, name string, city string, price_per_night double",
    )
    names = lambda df: [r.name for r in df.collect()]
    assert names(filters.hotels_matching(hotels, "LISBON ", max_price=100)) == ["Driftwood Rooms"]
    assert names(filters.hotels_matching(hotels, "lisbon", min_price=100)) == ["Azure Sands Resort"]
    cheapest = ranking.top_n(filters.hotels_matching(hotels, "lisbon"), 10, F.asc("price_per_night"), F.asc("id"))
    assert [r.price_per_night for r in cheapest.collect()] == [74.0, 320.0]
    assert filters.hotels_matching(hotels, "  ").count() == 3
    batch = spark.createDataFrame(
        [(1, "  ", None, None), (2, "LISBON", None, 100.0), (3, None, 100.0, 200.0)],
        "request_id long, city string, min_price double, max_price double",
    )
    found = sorted((r.request_id, r.id) for r in filters.hotels_matching_batch(hotels, batch).collect())
    assert found == [(1, 1), (1, 2), (1, 3), (2, 1), (3, 3)]


def test_availability(spark):
    stock = spark.createDataFrame(
        [(1, "DOUBLE", plus(d), r) for d, r in ((1, 2), (2, 2), (3, 2))]
        + [(2, "DOUBLE", plus(d), r) for d, r in ((1, 2), (2, 0), (3, 2))] + [(2, "SUITE", plus(2), 1)],
        "hotel_id long, room_type string, inventory_date date, available_rooms int",
    )
    asked = spark.createDataFrame(
        [(1, 1, "DOUBLE", plus(1), plus(4)), (2, 2, "DOUBLE", plus(1), plus(4)), (3, 1, "DOUBLE", plus(1), plus(2)),
         (4, 2, None, plus(1), plus(4)), (5, 1, "DOUBLE", plus(3), plus(1)), (6, 1, "DOUBLE", plus(3), plus(5))],
        "request_id long, hotel_id long, room_type string, check_in date, check_out date",
    )
    got = {r.request_id: (r.nights_covered, r.available) for r in aggs.stay_availability(asked, stock).collect()}
    assert got == {1: (3, True), 2: (2, False), 3: (1, True), 4: (3, True), 5: (0, False), 6: (1, False)}
    assert aggs.nightly_availability(asked.filter("request_id = 1"), stock).count() == 3
    bad = spark.createDataFrame([("2026-13-01", "penthouse"), ("2026-01-02", " double ")], "d string, t string")
    rows = bad.select(iso_date_or_null(F.col("d")).alias("d"), enum_or_null(F.col("t"), ROOM_TYPES).alias("t")).collect()
    assert [(r.d, r.t) for r in rows] == [(None, None), (date(2026, 1, 2), "DOUBLE")]


@pytest.mark.parametrize(
    "a,b,want",
    [([0.2, 0.5, 0.9], [0.2, 0.5, 0.9], 1.0), ([1.0, 0.0], [0.0, 1.0], 0.0), ([1.0, 2.0], [-1.0, -2.0], -1.0),
     ([1.0, 2.0, 3.0], [10.0, 20.0, 30.0], 1.0), ([0.0, 0.0], [1.0, 2.0], 0.0), ([1.0, 2.0], [1.0, 2.0, 3.0], None)],
)
def test_cosine(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a array<double>, b array<double>")
    got = df.select(cosine(F.col("a"), F.col("b")).alias("c"), preview(F.col("a")).alias("p")).first()
    assert got.c is None if want is None else got.c == pytest.approx(want)
    assert got.p == a


def test_retrieval_documents(spark, world):
    _, hotels, _ = world
    docs = {r.metadata.hotelId: r for r in vectors.retrieval_documents(hotels).collect()}
    assert "Paris Central in Paris." in docs[2].text and "$180.0 per night" in docs[2].text
    assert docs[2].text.endswith("Amenities: not listed.")
    assert (docs[1].metadata.city, docs[1].metadata.pricePerNight) == ("Tokyo", 220.0)
    for i, d in docs.items():
        raw = __import__("hashlib").md5(f"hotel-{i}".encode()).digest()
        assert d.id == str(uuid.UUID(bytes=raw, version=3))
    names = spark.createDataFrame([("x",), ("Zürich",)], "s string").select("s", name_uuid(F.col("s")).alias("u"))
    for r in names.collect():
        assert r.u == str(uuid.UUID(bytes=__import__("hashlib").md5(r.s.encode()).digest(), version=3))


def test_vector_store(spark):
    texts = spark.createDataFrame(
        [(1, "Sand and surf at the beach", 74.0), (2, "Beach resort with sand", 320.0), (3, "Alpine ski chalet", 145.0), (4, " ", 9.0)],
        "id long, text string, price double",
    )
    store = vectors.embed_words(texts, "id", "text", 64)
    assert {r.id: sum(r.embedding) for r in store.collect()} == {1: 6.0, 2: 4.0, 3: 3.0, 4: 1.0}
    assert vectors.upsert(store, store).count() == 4
    rich = store.join(texts, "id").select("id", "embedding", F.struct(F.col("price").alias("pricePerNight")).alias("metadata"))
    asked = vectors.embed_words(
        spark.createDataFrame([(7, "sand beach")], "query_id long, text string"), "query_id", "text", 64
    )
    hits = vectors.similarity_search(rich, asked, k=2, threshold=0.3).collect()
    assert {h.id for h in hits} == {1, 2} and hits[0].score >= hits[-1].score
    cheap = vectors.similarity_search(rich, asked, threshold=0.3, condition=("pricePerNight", "<", 100.0))
    assert [h.id for h in cheap.collect()] == [1]
    exact = vectors.similarity_search(store, store.withColumnRenamed("id", "query_id"), threshold=1.0)
    assert exact.count() == 0  # strictly above
    assert vectors.similarity_search(store, asked.filter("false")).count() == 0


def vector_rows(n, width=16, seed=5):
    import random

    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 1) + (i % 6) * (d % 3) * 0.4 for d in range(width)]) for i in range(n)]


def test_search_travels_or_is_laid_out_as_a_grid(spark, monkeypatch):
    """The same answer whether the batch travels with the tasks or meets the store in tiles, of bounded size each."""
    rows = vector_rows(300) + [(300, [1.0, 2.0]), (301, None), (302, [0.0] * 16)]
    store = spark.createDataFrame(rows, "id long, embedding array<double>").repartition(5)
    asked = store.filter("id >= 240").withColumnRenamed("id", "query_id")
    key = lambda df: sorted((r.query_id, r.rank, r.id, r.score) for r in df.collect())
    whole = key(vectors.similarity_search(store, asked, k=3))
    assert (300, 1, 300, 1.0) in whole and len(whole) > 150
    for name, value in (("STRIPE_ROWS", 9), ("PART_ROWS", 17), ("TILE", 4)):
        monkeypatch.setattr(vectors, name, value)
    sizes = vectors.grid(store, asked, 63).applyInArrow(
        lambda a, b: pa.table({"asked": [a.num_rows], "stored": [b.num_rows]}), "asked long, stored long"
    ).collect()
    assert max(r.asked for r in sizes) <= 3 * 9 and max(r.stored for r in sizes) <= 3 * 17 and len(sizes) == 7 * 18
    assert sum(r.asked * r.stored for r in sizes) == 63 * 303
    assert whole == key(vectors.similarity_search(store, asked, k=3))


def test_inverted_lists(spark, monkeypatch, tmp_path):
    """Scores are exact, all lists give the exact answer, and half of them find nine in ten."""
    monkeypatch.setattr(vectors, "PART_ROWS", 40)
    monkeypatch.setattr(vectors, "STRIPE_ROWS", 11)
    store = spark.createDataFrame(vector_rows(600), "id long, embedding array<float>")
    asked = store.filter("id % 10 = 0").withColumnRenamed("id", "query_id")
    key = lambda df: {(r.query_id, r.rank, r.id, r.score) for r in df.collect()}
    exact = key(vectors.similarity_search(store, asked, k=4, threshold=0.1))
    index = vectors.build_lists(store, str(tmp_path / "lists"), lists=12, sample=200)
    assert index.rows.count() == 600 and len(index.pieces) > 6
    assert key(vectors.approximate_search(index, asked, k=4, threshold=0.1, probes=12)) == exact
    near = key(vectors.approximate_search(index, asked, k=4, threshold=0.1, probes=6))
    pairs = {(q, i, s) for q, _, i, s in exact}
    assert len({(q, i, s) for q, _, i, s in near} & pairs) >= 0.9 * len(pairs)
    plan = vectors.approximate_search(index, asked)._jdf.queryExecution().toString()
    assert "list=" not in plan.split("ReadSchema")[-1]


def test_last_questions(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", "first"), (1, 1, "assistant", "answer"), (1, 2, "user", "second"), (1, 3, "assistant", "x"),
         (2, 0, "user", "  "), (3, 0, "system", "rules"), (4, 0, "user", None)],
        "conv_id long, turn int, role string, text string",
    )
    got = {r.conv_id: r.question for r in vectors.last_questions(turns, "Beach?").collect()}
    assert got == {1: "second", 2: "Beach?", 3: "Beach?", 4: "Beach?"}


def test_memory_and_prompts(spark):
    turns = spark.createDataFrame(
        [("a", i, "user", f"t{i}") for i in range(25)] + [("b", 0, "user", "other")],
        "conv_id string, turn long, role string, text string",
    )
    memory = {r.conv_id: r.memory.split("\n") for r in vectors.memory_window(turns).collect()}
    assert len(memory["a"]) == 20 and memory["a"][0] == "user: t5" and memory["b"] == ["user: other"]
    asked = spark.createDataFrame([(1, " "), (2, "Pool?")], "query_id long, question string")
    hits = spark.createDataFrame([(2, 1, 9), (2, 2, 8)], "query_id long, rank int, id long")
    docs = spark.createDataFrame([(8, "eight"), (9, "nine")], "id long, text string")
    got = {r.query_id: r for r in vectors.rag_prompts(asked, hits, docs, "{context}|{question}", "Beach?").collect()}
    assert got[1].prompt == "|Beach?" and got[2].prompt == "nine\n\neight|Pool?" and got[2].sources == "9,8"


def test_job_handler(spark):
    users = spark.createDataFrame([(7,)], "id long")
    good = (
        '{"kind":"BOOKING_CONFIRMED","bookingId":9,"userId":7,"username":"u","hotelId":1,"hotelName":"H",'
        '"roomType":"SUITE","checkIn":"2026-01-01","checkOut":"2026-01-02","source":"BOOKING"}'
    )
    rows = [
        ("a", good), ("b", "lab-only"), ("c", '{"source":"DELAYED","text":"x"}'), ("d", '{"source":"NOPE"}'),
        ("e", "{broken"), ("f", good.replace("BOOKING_CONFIRMED", "WHAT")), ("g", good.replace('"userId":7', '"userId":8')),
        ("h", good.replace(',"source":"BOOKING"', "")), ("i", None), ("j", "z" * 900),
    ]
    df = spark.createDataFrame(
        [(i, "email.send", p, datetime(2026, 1, 1)) for i, p in rows],
        "job_id string, routing_key string, payload string, created_at timestamp",
    )
    done = jobs.execute(df, users)
    got = {r.job_id: (r.source, r.status) for r in jobs.run_history(done).collect()}
    assert got == {
        "a": ("BOOKING", "SUCCESS"), "b": ("IMMEDIATE", "SUCCESS"), "c": ("DELAYED", "SUCCESS"),
        "d": ("IMMEDIATE", "SUCCESS"), "e": ("IMMEDIATE", "SUCCESS"), "f": ("BOOKING", "FAILED"),
        "g": ("BOOKING", "FAILED"), "h": ("BOOKING", "SUCCESS"), "i": ("IMMEDIATE", "SUCCESS"), "j": ("IMMEDIATE", "SUCCESS"),
    }
    notes = jobs.job_notifications(done).collect()
    assert {n.booking_id for n in notes} == {9} and len(notes) == 2
    snippets = {r.job_id: len(r.payload_snippet) for r in jobs.run_history(done).collect()}
    assert snippets["j"] == 500 and snippets["i"] == 0
    kept, deleted = jobs.retain(df, "2026-01-01 00:00:01", "0 seconds")
    assert kept.count() == 0 and deleted.first().deleted == len(rows)


def test_highlights_without_spaces_and_at_word_borders(spark):
    thai = "โรงแรมในภูเก็ตใกล้ทะเลและชายหาด"
    long = "".join(f"word{i} " for i in range(40)) + "quiet beach " + "".join(f"tail{i} " for i in range(40))
    docs = spark.createDataFrame(
        [(1, "Inn", "Rome", long, None, thai, "ภูเก็ต", "habitación moderna de lujo", 9.0), (2, "Beach", "Oslo", None, None, "浅草の静かな宿", None, "de", 9.0)],
        "id long, name string, city string, description string, amenities string, name_alt string, city_alt string,"
        " description_alt string, price_per_night double",
    )
    asked = spark.createDataFrame([(1, "ภูเก็ต ทะเล", "th"), (2, "beach", "en"), (3, "浅草", "th"), (4, "de", "th")], "query_id long, q string, lang string")
    hits = asked.select("query_id").crossJoin(docs.select(F.col("id").alias("doc_id")))
    marks = {(r.query_id, r.doc_id, r.field): r.fragment for r in search.highlights(hits, docs, asked).collect()}
    assert marks[1, 1, "name_alt"] == "โรงแรมใน<mark>ภูเก็ต</mark>ใกล้<mark>ทะเล</mark>และชายหาด"
    assert marks[1, 1, "city_alt"] == "<mark>ภูเก็ต</mark>"
    assert marks[3, 2, "name_alt"] == "<mark>浅草</mark>の静かな宿"
    assert marks[4, 1, "description_alt"] == "habitación moderna <mark>de</mark> lujo" and marks[4, 2, "description_alt"] == "<mark>de</mark>"
    shown = marks[2, 1, "description"]
    assert "quiet <mark>beach</mark> tail0" in shown and len(shown) <= 120 + len("<mark></mark>")
    assert set(shown.replace("<mark>", "").replace("</mark>", "").split()) <= set(long.split())
    assert set(marks) == {(1, 1, "name_alt"), (1, 1, "city_alt"), (3, 2, "name_alt"), (4, 1, "description_alt"), (4, 2, "description_alt"), (2, 1, "description"), (2, 2, "name")}


def test_price_steps_end_at_stored_prices(spark):
    hotels = spark.createDataFrame([(1, "Rome", 80.0), (2, "Oslo", 470.0)], "hotel_id long, city string, price_per_night double")
    asked = spark.createDataFrame(
        [(1, None, -1e15, 1e15), (2, None, 100.0, 1e18), (3, " ", None, 90.0), (4, None, 1e9, None)],
        "request_id long, city string, min_price double, max_price double",
    )
    got = {(r.request_id, r.hotel_id) for r in filters.hotels_matching_batch(hotels, asked).collect()}
    assert got == {(1, 1), (1, 2), (2, 2), (3, 1)}


def search_world(spark, n=400):
    """Documents of common, middling and rare words; queries of many words, few words, unknown words and none."""
    import random

    rng = random.Random(3)
    common, middling = [f"common{i}" for i in range(8)], [f"mid{i}" for i in range(60)]
    rows = []
    for i in range(n):
        text = rng.choices(common, k=rng.randrange(5, 60)) + rng.choices(middling, k=6) + [f"rare{i % 150}"] * (i % 3)
        rng.shuffle(text)
        rows.append((i, "Inn " + rng.choice(["north", "south"]), f"c{i % 7}", " ".join(text), None, "x" if i % 2 else None, 50.0 + i % 90))
    docs = spark.createDataFrame(rows, "id long, name string, city string, description string, amenities string, description_alt string, price_per_night double")
    texts = [" ".join([f"rare{i * 11}", *rng.sample(middling, 5), *common[: 2 + i % 6]]) for i in range(12)]
    texts += ["common0", "mid3 mid4", "rare5", "nothing known", " ", "inn north common1 common2"]
    asked = [(i, t, "en" if i % 3 else "th") for i, t in enumerate(texts)]
    return docs, spark.createDataFrame(asked, "query_id long, q string, lang string")


@pytest.mark.parametrize("head", [0.2, 0.65, 1.0])
def test_bounded_search_equals_all_scores(spark, monkeypatch, head):
    monkeypatch.setattr(search, "HEAD", head)
    docs, asked = search_world(spark)
    index = search.build_index(docs)
    everything = search.best_fields(search.field_scores(index, asked)).collect()
    want = {}
    for r in everything:
        want.setdefault(r.query_id, []).append((-round(r.score, 6), r.doc_id))
    got = {}
    for r in search.search(index, docs, asked.filter("query_id <> 16"), k=7).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((-r.score, r.doc_id))
    assert got == {q: sorted(x)[:7] for q, x in want.items()}


def test_bounded_search_with_filters(spark):
    docs, asked = search_world(spark)
    index = search.build_index(docs)
    asked = asked.withColumn("city", F.when(F.col("query_id") % 2 == 0, F.lit("c3"))).withColumn("min_price", F.lit(60.0)).withColumn(
        "max_price", F.when(F.col("query_id") % 3 == 0, F.lit(100.0)))
    facts = {r.id: r for r in docs.collect()}
    want = {}
    scores = [(r.query_id, r.doc_id, r.score) for r in search.best_fields(search.field_scores(index, asked)).collect()]
    scores += [(16, i, 1.0) for i in facts]
    for q, d, s in scores:
        f = facts[d]
        if f.price_per_night >= 60 and (q % 3 or f.price_per_night <= 100) and (q % 2 or f.city == "c3"):
            want.setdefault(q, []).append((-round(s, 6), d))
    got = {}
    for r in search.search(index, docs, asked, k=5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((-r.score, r.doc_id))
    assert got == {q: sorted(x)[:5] for q, x in want.items()}


def test_bounded_search_scores_few_documents_in_full(spark, monkeypatch):
    """Most pairs of query and document never get past the head of the query's terms."""
    docs, asked = search_world(spark)
    index, full = search.build_index(docs), []
    plain = search._from_documents

    def counted(index, weights, rows):
        full.append(rows.count())
        return plain(index, weights, rows)

    monkeypatch.setattr(search, "_from_documents", counted)
    search.search(index, docs, asked.filter("query_id < 12"), k=5).collect()
    assert sum(full) < 12 * docs.count() / 5


def test_search_projection_and_highlights(spark):
    docs = spark.createDataFrame(
        [(1, "Palm Grove Hotel", "Phuket", "Quiet rooms. " * 20 + "Pools by the shores.", "pool", "โรงแรม", "ภูเก็ต", None, 120.0),
         (2, "City Inn", "Bangkok", "Central and busy", "gym", None, None, None, 60.0)],
        "id long, name string, city string, description string, amenities string, name_alt string,"
        " city_alt string, description_alt string, price_per_night double",
    )
    projected = search.project_documents(docs).filter("id = 1").first()
    assert projected.name_suggest == projected.name and projected.city_alt_suggest == projected.city_alt
    index = search.build_index(docs)
    asked = spark.createDataFrame(
        [(1, "shore pool", "en"), (2, "ภูเก็ต", "th-TH"), (3, " ", None)], "query_id long, q string, lang string"
    )
    hits = search.search(index, docs, asked)
    got = sorted((r.query_id, r.rank, r.doc_id) for r in hits.collect())
    assert got == [(1, 1, 1), (2, 1, 1), (3, 1, 1), (3, 2, 2)]
    marks = {(r.query_id, r.field): r.fragment for r in search.highlights(hits, docs, asked).collect()}
    assert "<mark>Pools</mark> by the <mark>shores</mark>" in marks[1, "description"]
    assert len(marks[1, "description"].replace("<mark>", "").replace("</mark>", "")) <= 120
    assert marks[2, "city_alt"] == "<mark>ภูเก็ต</mark>"
    typed = spark.createDataFrame(
        [(1, "palm gr", "en", 5), (2, "Bang", "en", 99), (3, "  ", "en", 5), (4, "palm x", "en", 5)],
        "query_id long, q string, lang string, size int",
    )
    found = search.suggest(search.build_suggest_index(docs), typed)
    assert sorted((r.query_id, r.doc_id) for r in found.collect()) == [(1, 1), (2, 2), (4, 1)]


def test_change_capture_and_apply(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, name string")
    after = spark.createDataFrame([(2, "B"), (3, None), (4, "d")], "id long, name string")
    changes = events.capture_changes(before, after, ["name"])
    assert {(r.id, r.event_type, r.name) for r in changes.collect()} == {
        (1, "DELETED", "a"), (2, "UPDATED", "B"), (4, "CREATED", "d"),
    }
    numbered = changes.withColumn("seq", F.col("id"))
    restored = events.apply_changes(before, numbered, "id", [F.col("seq")], ["name"])
    assert {tuple(r) for r in restored.collect()} == {tuple(r) for r in after.collect()}


def test_stream_style_aggregates(spark):
    rows = spark.createDataFrame(
        [("x", 220.0, True, "pool, spa"), ("x", 75.0, True, "gym"), ("y", 180.0, False, "spa"), ("y", 130.0, True, None), ("z", 95.0, True, "pool")],
        "city string, total double, confirmed boolean, amenities string",
    )
    out = aggs.conditional_sum_mean(rows, F.col("confirmed"), F.col("total")).first()
    assert out.total == 520.0
    assert rows.agg(F.avg("total")).first()[0] == 140.0
    none = aggs.conditional_sum_mean(rows, F.lit(False), F.col("total")).first()
    assert none.total == 0 and none["mean"] is None
    assert [r.item for r in aggs.distinct_items(rows, "amenities").orderBy("item").collect()] == ["gym", "pool", "spa"]


def test_pages(spark):
    df = spark.range(45)
    page = ranking.page(df, 2, 20, F.asc("id")).collect()
    assert [r.id for r in page] == list(range(40, 45)) and page[0].total_pages == 3 and page[0]["last"]
    info = ranking.page_info(df, 9, 500).first()
    assert (info.page_size, info.total_pages, info["last"]) == (50, 1, True)
    assert [r.id for r in ranking.page_after(df, 3, [("id", 10)]).collect()] == [11, 12, 13]


def test_service_alerts_by_rule(spark):
    """Each rule has its own side, bound and hold; a gap ends an episode, a null value or unknown name is quiet."""
    second = sli.SECOND
    rows = [
        *[("a", "latency", t * second, v) for t, v in ((0, 0.98), (60, 0.5), (120, 0.9), (180, 0.99), (240, 0.1))],
        *[("a", "cpu", t * second, v) for t, v in ((0, 0.96), (60, 0.94), (120, 0.0), (240, 0.0))],
        *[("a", "deadlock", t * second, v) for t, v in ((0, 0.0), (60, 0.1), (120, 2.0))],
        ("a", "heap", 0, None),
        ("a", "other", 0, 0.0),
    ]
    steps = spark.createDataFrame(rows, "uri string, sli string, step bigint, value double")
    got = {(r.sli, r.step // second, r.since // second, r.state, r.severity) for r in sli.service_alerts(steps, ["uri"], 60).collect()}
    assert got == {
        ("latency", 0, 0, "pending", "warning"),
        ("latency", 60, 0, "pending", "warning"),
        ("latency", 120, 0, "firing", "warning"),
        ("latency", 240, 240, "pending", "warning"),
        ("cpu", 60, 60, "pending", "warning"),
        ("cpu", 120, 60, "firing", "warning"),
        ("cpu", 240, 240, "pending", "warning"),
        ("deadlock", 60, 60, "pending", "info"),
        ("deadlock", 120, 60, "firing", "info"),
    }
