"""A batch of hotel searches: no key is one task's, prices are rounded once per hotel."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayspark.operators import filters
from stayspark.plans import catalog

HOTELS = "hotel_id long, city string, price_per_night double"
REQUESTS = "request_id long, city string, min_price double, max_price double"


def test_one_city_and_one_price_are_spread(spark, monkeypatch):
    """All hotels stand in one city at one price; half of the requests name it, the others take any."""
    hotels = spark.createDataFrame([(i, "Rome", 90.0) for i in range(400)], HOTELS)
    asked = spark.createDataFrame([(i, "ROME" if i % 2 else None, 80.0, None) for i in range(400)], REQUESTS).coalesce(1)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for most in (filters.MAX_HOTEL_BROADCAST, 10):
            monkeypatch.setattr(filters, "MAX_HOTEL_BROADCAST", most)
            found = filters.hotels_matching_batch(hotels, asked)
            assert ("BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()) == (most > 400)
            sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == 160_000 and max(sizes) <= 160_000 / 4
            assert found.distinct().count() == 160_000
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_many_hotels_find_the_same(spark, monkeypatch):
    hotels = spark.createDataFrame([(1, "Rome", 80.0), (1, "Rome", 80.0), (2, "oslo", 470.0), (3, None, 90.0), (4, "Rome", None), (None, "ROME", 120.5)], HOTELS)
    rows = [(1, None, -1e15, 1e15), (1, None, 85.0, None), (2, "rome", None, None), (3, " ", None, 90.0), (None, "Oslo", 470.0, 470.0), (5, "Bonn", None, None)]
    asked = spark.createDataFrame(rows, REQUESTS)

    def fits(h, r):
        city = (r[1] or "").strip().lower()
        if city and (h[1] is None or h[1].lower() != city) or not city and h[2] is None:
            return False
        return (r[2] is None or h[2] is not None and h[2] >= r[2]) and (r[3] is None or h[2] is not None and h[2] <= r[3])

    want = sorted((tuple(h) + (r[0], r[2], r[3]) for h in hotels.collect() for r in rows if fits(h, r)), key=str)
    few = filters.hotels_matching_batch(hotels, asked)
    monkeypatch.setattr(filters, "MAX_HOTEL_BROADCAST", 2)
    many = filters.hotels_matching_batch(hotels, asked)
    assert few.columns == many.columns == ["hotel_id", "city", "price_per_night", "request_id", "min_price", "max_price"]
    for found in (few, many):
        assert sorted(map(tuple, found.collect()), key=str) == want


def test_prices_are_rounded_before_the_pairs(spark):
    made = catalog.QUERIES["fil1_hotel_filter_batch"](spark, "/root/testdata/sf0.001")
    joins = made._jdf.queryExecution().optimizedPlan().toString().split("\n")
    pairs = [i for i, line in enumerate(joins) if "Join Inner" in line and ("_city#" in line or "_step#" in line)]
    rounded = [i for i, line in enumerate(joins) if "round(price_per_night" in line]
    # A line stands above what it reads; each of the two joins has the rounding below it.
    assert len(pairs) == 2 and len(rounded) == 2 and all(a < b for a, b in zip(pairs, rounded, strict=True)) and rounded[0] < pairs[1]
