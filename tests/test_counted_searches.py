"""Counts of a batch of hotel searches without the pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayspark.operators import filters, vectors


def test_counted_searches_make_no_pairs(spark):
    hotels = spark.createDataFrame(
        [(1, "Rome", 100.0), (2, "rome", 100.0), (3, "Oslo", 150.0), (4, None, 150.0), (5, "Oslo", None), (6, "Rome", 300.0)],
        "hotel_id long, city string, price_per_night double",
    )
    rows = [
        (1, "ROME", None, 200.0), (2, "ROME", None, 200.0), (3, " ", 120.0, None), (4, "Oslo", None, None), (5, "Bonn", None, None),
        (None, "Rome", None, None), (1, "Oslo", None, 500.0), (7, None, None, None),
    ]
    asked = spark.createDataFrame(rows, "request_id long, city string, min_price double, max_price double")
    pairs = filters.hotels_matching_batch(hotels, asked).groupBy("request_id").count()
    counted = filters.matching_counts(hotels, asked)
    assert sorted(counted.collect(), key=str) == sorted(pairs.collect(), key=str)
    before = vectors.call_trace(asked, filters.hotels_matching_batch(hotels, asked), "t", ["city"])
    assert sorted(vectors.call_trace(asked, counted, "t", ["city"]).collect(), key=str) == sorted(before.collect(), key=str)
    # A thousand equal hotels are one row where they meet the requests.
    crowd = spark.range(1000).select(F.col("id").alias("hotel_id"), F.lit("Rome").alias("city"), F.lit(90.0).alias("price_per_night"))
    many = spark.range(1000).select(F.col("id").alias("request_id"), F.lit("rome").alias("city"), F.lit(None).cast("double").alias("min_price"), F.lit(95.0).alias("max_price"))
    assert {r.n for r in filters.matching_counts(crowd, many).collect()} == {1000}
