"""Hybrid retrieval: meaning proposes, the tables of record decide."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayspark.functions.columns import blank_to_null
from stayspark.operators.aggs import stay_availability


def hybrid_retrieval(
    hits: DataFrame, requests: DataFrame, hotels: DataFrame, inventory: DataFrame
) -> DataFrame:
    """Semantic candidates that also meet the exact city and price filter and are free for the stay.

    hits: query_id, id (hotel), score; requests: query_id, city, min_price, max_price, room_type,
    check_in, check_out. Candidates are few per query, so the exact checks run on them alone.
    """
    facts = hotels.select(
        F.col("id").alias("hotel_id"), "name", F.col("city").alias("hotel_city"), "price_per_night"
    )
    price = F.col("price_per_night")
    city = F.lower(blank_to_null(F.col("city")))
    fitting = (
        hits.select("query_id", F.col("id").alias("hotel_id"), "rank", "score")
        .join(requests, "query_id")
        .join(facts, "hotel_id")
        .filter(city.isNull() | (F.lower("hotel_city") == city))
        .filter(F.col("min_price").isNull() | (price >= F.col("min_price")))
        .filter(F.col("max_price").isNull() | (price <= F.col("max_price")))
    )
    stays = fitting.select(
        F.struct("query_id", "hotel_id").alias("request_id"), "hotel_id", "room_type", "check_in", "check_out"
    )
    free = stay_availability(stays, inventory).filter("available").select(
        F.col("request_id.query_id").alias("query_id"), "hotel_id"
    )
    return fitting.join(free, ["query_id", "hotel_id"], "left_semi")
