"""Latest, top-N, first-open-night, pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayspark.functions.columns import clamp
from stayspark.functions.skew import top_n_per_key

# Fixed values of the model.
MEMORY_WINDOW = 20
RECENT_MESSAGES = 20
RECENT_DELIVERIES = 50
RECENT_RUNS = 50
CHEAPEST = 10
HORIZON_NIGHTS = 60
FALLBACK_NIGHTS = 90
MAX_PAGE_SIZE = 50


def recent_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, salt_by: str | None = None):
    """The newest ``n`` rows per key, newest first."""
    return top_n_per_key(df, keys, order, n, rank_col="recency", salt_by=salt_by)


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """One global top-N; planned as TakeOrdered, so only N rows per task reach the driver side."""
    return df.orderBy(*order).limit(n)


def newest_first(df: DataFrame, ts: str, tie: str) -> DataFrame:
    """Whole history, newest first: a range-partitioned sort, meant to be written, not collected."""
    return df.orderBy(F.desc(ts), F.desc(tie))


def first_open_night(hotels: DataFrame, inventory: DataFrame, first, room_type: str) -> DataFrame:
    """Earliest night of the horizon that is not sold out; a night without a row counts as open.

    The calendar has a fixed number of nights per hotel; only sold-out nights are shuffled to it.
    """
    start = F.lit(first).cast("date")
    calendar = hotels.select(
        F.col("id").alias("hotel_id"),
        F.explode(F.sequence(start, F.date_add(start, HORIZON_NIGHTS - 1))).alias("night"),
    )
    sold_out = inventory.filter(
        (F.col("room_type") == room_type) & (F.col("available_rooms") <= 0)
    ).select("hotel_id", F.col("inventory_date").alias("night"))
    opened = (
        calendar.join(sold_out, ["hotel_id", "night"], "left_anti")
        .groupBy("hotel_id")
        .agg(F.min("night").alias("open_night"))
    )
    return hotels.select(F.col("id").alias("hotel_id")).join(opened, "hotel_id", "left").select(
        "hotel_id",
        F.coalesce("open_night", F.date_add(start, FALLBACK_NIGHTS)).alias("open_night"),
    )


def page(df: DataFrame, number: int, size: int, *order: Column, max_size: int = MAX_PAGE_SIZE):
    """One page with the totals of the whole result on every row."""
    size = min(max(size, 1), max_size)
    number = max(number, 0)
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    rows = df.orderBy(*order).offset(number * size).limit(size)
    pages = F.ceil(F.col("total_elements") / F.lit(size)).cast("long")
    return (
        rows.withColumn("total_elements", total)
        .withColumn("page", F.lit(number))
        .withColumn("page_size", F.lit(size))
        .withColumn("total_pages", pages)
        .withColumn("last", F.lit(number + 1) >= F.col("total_pages"))
    )


def page_info(df: DataFrame, number: int, size: int, max_size: int = MAX_PAGE_SIZE) -> DataFrame:
    """The envelope alone; also right for a page beyond the last."""
    size = min(max(size, 1), max_size)
    number = max(number, 0)
    pages = F.ceil(F.col("total_elements") / F.lit(size)).cast("long")
    return df.agg(F.count(F.lit(1)).alias("total_elements")).select(
        F.lit(number).alias("page"),
        F.lit(size).alias("page_size"),
        "total_elements",
        pages.alias("total_pages"),
        (F.lit(number + 1) >= pages).alias("last"),
    )


def page_after(df: DataFrame, size: int, key: list[tuple[str, object]]) -> DataFrame:
    """Keyset page for deep scrolling: rows after the last seen key, ascending. No offset scan."""
    after = None
    equal = None
    for name, value in key:
        step = F.col(name) > F.lit(value)
        step = step if equal is None else equal & step
        after = step if after is None else after | step
        same = F.col(name) == F.lit(value)
        equal = same if equal is None else equal & same
    return df.filter(after).orderBy(*[F.col(name) for name, _ in key]).limit(size)


def requested_size(c: Column, high: int) -> Column:
    return clamp(c, 1, high)
