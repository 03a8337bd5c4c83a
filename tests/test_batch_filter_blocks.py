"""A batch of hotel searches makes its pairs block by block, so that neighbouring rows repeat the same hotels and requests."""

from __future__ import annotations

import pandas as pd

from stayspark.operators import filters

HOTELS = "hotel_id long, city string, price_per_night double"
REQUESTS = "request_id long, city string, min_price double, max_price double"


def test_neighbouring_rows_repeat_hotels_and_requests(spark, monkeypatch):
    """128 rows in a row are of two or three pairs of blocks; they were of 128 hotels when each request went by itself."""
    monkeypatch.setattr(filters, "HOTEL_BLOCK", 16, raising=False)
    monkeypatch.setattr(filters, "REQUEST_BLOCK", 8, raising=False)
    hotels = spark.createDataFrame([(i, "Rome", 60.0 + i / 10) for i in range(320)], HOTELS).coalesce(1)
    asked = spark.createDataFrame([(i, "ROME" if i % 2 else None, 60.0, None) for i in range(4096)], REQUESTS).coalesce(1)

    def most(batches):
        for rows in batches:
            parts = [rows[at : at + 128] for at in range(0, len(rows), 128)]
            yield pd.DataFrame({"rows": [len(rows)], "hotels": [max(p["hotel_id"].nunique() for p in parts)], "requests": [max(p["request_id"].nunique() for p in parts)]})

    found = filters.hotels_matching_batch(hotels, asked).mapInPandas(most, "rows long, hotels long, requests long").collect()
    assert sum(r.rows for r in found) == 320 * 4096
    assert max(r.hotels for r in found) <= 3 * 16 and max(r.requests for r in found) <= 3 * 8


def test_parts_of_the_hotels_find_the_same(spark, monkeypatch):
    hotels = spark.createDataFrame([(i, ["Rome", "Oslo"][i % 2], 60.0 + i) for i in range(90)], HOTELS).repartition(2)
    asked = spark.createDataFrame([(i, [None, "rome", " OSLO "][i % 3], 70.0, 100.0 + i) for i in range(50)], REQUESTS)
    monkeypatch.setattr(filters, "HOTEL_BLOCK", 4, raising=False)
    rows = sorted(map(tuple, filters.hotels_matching_batch(hotels, asked).collect()))
    monkeypatch.setattr(filters, "TASK_HOTELS", 40, raising=False)
    assert rows == sorted(map(tuple, filters.hotels_matching_batch(hotels, asked).collect())) and len(rows) > 500


def test_blocks_hold_each_row_once_and_know_their_bounds(spark):
    rows = [(i, "ab"[i % 2] if i % 7 else None, None if i == 5 else float(i), float(2 * i)) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, city string, low double, high double").repartition(3)
    made = filters._blocks(df, "city", ["low", "high"], 4, ["id", "low", "high"]).collect()
    assert sorted(r.id for b in made for r in b["_rows"]) == list(range(100)) and max(len(b["_rows"]) for b in made) == 4
    for b in made:
        lows = [r.low for r in b["_rows"]]
        assert b["_low"] == (None if None in lows else min(lows)) and b["_high"] == max(r.high for r in b["_rows"])
