"""Predicates: each optional argument that is absent leaves no trace in the plan."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayspark.functions.columns import all_of, blank_to_null, has_text
from stayspark.functions.skew import DEFAULT_SALTS, broadcast_if_small

MAX_IN_LIST = 1000
MAX_ID_BROADCAST = 1_000_000
MAX_HOTEL_BROADCAST = 500_000
TASKS_PER_CORE = 4
#: Rows of a block of hotels and of requests at most, and blocks that a task has at least.
HOTEL_BLOCK = 128
REQUEST_BLOCK = 128
BLOCKS_PER_TASK = 8
#: Hotels that one task pairs at most, where they travel: a column chunk of a file lists its distinct values once, up to some 130,000.
TASK_HOTELS = 65536
#: Beyond the partitions of any join, so that ``coalesce`` leaves them as they are.
MAX_TASKS = 1 << 20


def _apply(df: DataFrame, conditions: list[Column]) -> DataFrame:
    predicate = all_of(conditions)
    return df if predicate is None else df.filter(predicate)


def hotels_matching(
    hotels: DataFrame,
    city: str | None = None,
    min_price: float | None = None,
    max_price: float | None = None,
) -> DataFrame:
    """City equal ignoring case (blank means any), price inside the inclusive bounds."""
    conditions = []
    if city is not None and city.strip():
        conditions.append(F.lower("city") == city.strip().lower())
    if min_price is not None:
        conditions.append(F.col("price_per_night") >= float(min_price))
    if max_price is not None:
        conditions.append(F.col("price_per_night") <= float(max_price))
    return _apply(hotels, conditions)


def hotels_matching_batch(
    hotels: DataFrame, requests: DataFrame, price_step: float = 50.0
) -> DataFrame:
    """Many hotel searches at once; requests carry request_id, city, min_price, max_price.

    Requests naming a city join on it. Those for any city are range joins on the price: both sides
    are cut into price steps and joined on the step, so no unkeyed join is planned.

    Pairs are as many as requests times hotels, so both sides meet as blocks of rows with like bounds and a pair is made where it
    goes out: a block of requests after the other, each with the same hotels. Runs and repeats like these are what a columnar file
    writes down once. Blocks of hotels that are few travel to the requests, which are dealt out evenly; more hotels are dealt into
    ``DEFAULT_SALTS`` parts of every key, and requests go to all of them.
    """
    n_hotels, n_requests = hotels.limit(MAX_HOTEL_BROADCAST + 1).count(), requests.count()
    few = n_hotels <= MAX_HOTEL_BROADCAST
    tasks = TASKS_PER_CORE * requests.sparkSession.sparkContext.defaultParallelism
    salted = F.pmod(F.xxhash64("_block"), F.lit(DEFAULT_SALTS)).alias("_salt")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(DEFAULT_SALTS - 1).cast("long"))).alias("_salt")
    salts, offers = ([], F.broadcast) if few else (["_salt"], lambda df: df.select("*", salted))
    offered = HOTEL_BLOCK if few else max(1, min(HOTEL_BLOCK, n_hotels // (BLOCKS_PER_TASK * DEFAULT_SALTS)))
    parts = -(-n_hotels // TASK_HOTELS) if few else 1
    price = F.col("price_per_night")

    def step(c: Column) -> Column:
        return F.floor(c / F.lit(price_step)).cast("long")

    def offer(key: str, value: Column, part: int) -> DataFrame:
        blocks = _blocks(hotels.withColumn(key, value), key, ["price_per_night"], offered, hotels.columns)
        blocks = blocks.filter(F.pmod(F.xxhash64("_block"), F.lit(parts)) == part) if parts > 1 else blocks
        return offers(blocks.withColumnsRenamed({"_rows": "_offers", "_low": "_least", "_high": "_most"}))

    asked = [c for c in requests.columns if c != "city"]
    size = max(1, min(REQUEST_BLOCK, n_requests // (BLOCKS_PER_TASK * tasks)))
    wanted = requests.withColumn("_city", F.lower(blank_to_null(F.col("city")))).drop("city")
    named = _blocks(wanted.filter("_city is not null"), "_city", ["min_price", "max_price"], size, asked).repartition(tasks)
    # Steps without a stored price are not made, whatever a request asks for; greatest and least skip nulls.
    low = F.greatest("min_price", hotels.agg(F.min("price_per_night").alias("v")).scalar())
    high = F.least("max_price", hotels.agg(F.max("price_per_night").alias("v")).scalar())
    ranged = wanted.filter("_city is null").withColumn("_from", low).withColumn("_to", high).filter("_from <= _to")
    ranged = _blocks(ranged, "_city", ["_from", "_to"], size, asked).repartition(tasks)
    ranged = ranged.withColumn("_step", F.explode(F.sequence(step(F.col("_low")), step(F.col("_high")))))

    def met(blocks: DataFrame, key: str, value: Column, part: int) -> DataFrame:
        blocks = blocks if few else blocks.select("*", every)
        # An open bound, or a price that is missing, is decided row by row.
        near = F.coalesce(F.col("_most") >= F.col("_low"), F.lit(True)) & F.coalesce(F.col("_least") <= F.col("_high"), F.lit(True))
        # A step hands rows on when all that one of its rows gives are made; each coalesce ends a step, so no step holds more than
        # a pair of blocks or a request's rows of one block.
        pairs = blocks.join(offer(key, value, part), [key, *salts]).filter(near).select("_rows", "_offers").coalesce(MAX_TASKS)
        made = pairs.select(F.explode("_rows").alias("_asked"), "_offers").coalesce(MAX_TASKS)
        made = made.select("_asked", F.explode("_offers").alias("_offer"))
        least, most, at = F.col("_asked.min_price"), F.col("_asked.max_price"), F.col("_offer.price_per_night")
        fits = (least.isNull() | (at >= least)) & (most.isNull() | (at <= most))
        return made.filter(fits).select(*[F.col("_offer")[c].alias(c) for c in hotels.columns], *[F.col("_asked")[c].alias(c) for c in asked])

    sides = (named, "_city", F.lower("city")), (ranged, "_step", step(price))
    return reduce(DataFrame.unionByName, [met(*side, part) for part in range(max(1, parts)) for side in sides])


def _blocks(df: DataFrame, key: str, bounds: Sequence[str], size: int, columns: Sequence[str]) -> DataFrame:
    """At most ``size`` rows of one key and like bounds as one: (key, _block, _rows, _low, _high).

    ``_low`` and ``_high`` are the least of the first and the greatest of the last bound, null where a row has none.
    """
    first, last = F.col(bounds[0]), F.col(bounds[-1])
    whole = lambda c, v: F.when(F.count(c) == F.count(F.lit(1)), v(c))
    placed = df.sortWithinPartitions(key, *bounds).withColumn("_block", F.floor(F.monotonically_increasing_id() / F.lit(size)))
    return placed.groupBy(key, "_block").agg(
        F.collect_list(F.struct(*columns)).alias("_rows"), whole(first, F.min).alias("_low"), whole(last, F.max).alias("_high")
    )


def matching_counts(hotels: DataFrame, requests: DataFrame) -> DataFrame:
    """(request_id, n): how many hotels a batch of searches finds, see ``hotels_matching_batch``; requests that find none are
    left out.

    Hotels of one city and price count as one row, equal requests search once: no pair of a request and a hotel is made.
    """
    asked = ["city", "min_price", "max_price"]
    shapes = requests.select(*asked).distinct().withColumn("request_id", F.struct(*asked))
    offers = hotels.groupBy("city", "price_per_night").agg(F.count(F.lit(1)).alias("_n"))
    found = hotels_matching_batch(offers, shapes)
    found = found.groupBy(F.col("request_id").alias("_shape")).agg(F.sum("_n").alias("_n"))
    same = [requests[c].eqNullSafe(found["_shape"][c]) for c in asked]
    return requests.join(found, same).groupBy("request_id").agg(F.sum("_n").alias("n"))


def by_exact(df: DataFrame, column: str, value: Any) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def by_ids(df: DataFrame, ids: DataFrame, column: str = "id") -> DataFrame:
    """Rows whose id is in the batch; the batch is broadcast only when it is known to be small."""
    keys = broadcast_if_small(ids.select(F.col(ids.columns[0]).alias(column)).distinct(), MAX_ID_BROADCAST)
    return df.join(keys, column, "left_semi")


def bookings_matching(
    bookings: DataFrame,
    user_id: int | None = None,
    hotel_id: int | None = None,
    hotel_ids: Sequence[int] | DataFrame | None = None,
    status: str | None = None,
    check_in_from: date | str | None = None,
    check_in_to: date | str | None = None,
) -> DataFrame:
    """Optional equality on user, hotel, status; hotel list; inclusive check-in range.

    An empty list is no filter. A list beyond ``MAX_IN_LIST`` entries, or a frame, semi-joins.
    """
    conditions = []
    if user_id is not None:
        conditions.append(F.col("user_id") == user_id)
    if hotel_id is not None:
        conditions.append(F.col("hotel_id") == hotel_id)
    if status is not None:
        conditions.append(F.col("status") == status)
    if check_in_from is not None:
        conditions.append(F.col("check_in") >= F.lit(check_in_from).cast("date"))
    if check_in_to is not None:
        conditions.append(F.col("check_in") <= F.lit(check_in_to).cast("date"))
    if isinstance(hotel_ids, DataFrame):
        return by_ids(_apply(bookings, conditions), hotel_ids, "hotel_id")
    if hotel_ids:
        if len(hotel_ids) > MAX_IN_LIST:
            frame = bookings.sparkSession.createDataFrame([(i,) for i in hotel_ids], "hotel_id bigint")
            return by_ids(_apply(bookings, conditions), frame, "hotel_id")
        conditions.append(F.col("hotel_id").isin(*hotel_ids))
    return _apply(bookings, conditions)


def overlaps(check_in: Column, check_out: Column, first: Any, last: Any) -> Column:
    """Half-open stays: [check_in, check_out) meets [first, last)."""
    return (check_in < last) & (check_out > first)


def stays_overlapping(bookings: DataFrame, first: date | str, last: date | str) -> DataFrame:
    lo, hi = F.lit(first).cast("date"), F.lit(last).cast("date")
    return bookings.filter(overlaps(F.col("check_in"), F.col("check_out"), lo, hi))


def inventory_window(
    inventory: DataFrame,
    first: date | str,
    last: date | str,
    hotel_id: int | None = None,
    room_type: str | None = None,
) -> DataFrame:
    """Inclusive date window; the optional type is decided while the plan is built."""
    conditions = [F.col("inventory_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))]
    if hotel_id is not None:
        conditions.append(F.col("hotel_id") == hotel_id)
    if room_type is not None:
        conditions.append(F.col("room_type") == room_type)
    return _apply(inventory, conditions)


def with_text(df: DataFrame, column: str) -> DataFrame:
    return df.filter(has_text(F.col(column)))


def with_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Case-sensitive prefix; reaches the Parquet scan as StringStartsWith."""
    return df.filter(F.col(column).startswith(prefix))


def uniqueness_conflicts(
    users: DataFrame, proposals: DataFrame, columns: Sequence[str] = ("username",)
) -> DataFrame:
    """Flag proposals whose value already belongs to somebody else.

    ``proposals`` carries ``id`` (null for a registration) and the proposed values. Owners are
    reduced to their lowest and highest id per value, which is enough to tell "someone but me".
    """
    out = proposals
    for column in columns:
        owners = users.groupBy(column).agg(
            F.min("id").alias("_low"), F.max("id").alias("_high")
        )
        taken = F.col("_low").isNotNull() & (
            F.col("id").isNull() | (F.col("_low") != F.col("id")) | (F.col("_high") != F.col("id"))
        )
        out = (
            out.join(owners, column, "left")
            .withColumn(f"{column}_taken", F.coalesce(taken, F.lit(False)))
            .drop("_low", "_high")
        )
    return out


_COMPARE = {
    "==": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "in": lambda c, v: c.isin(*v),
    "not in": lambda c, v: ~c.isin(*v),
}


def metadata_condition(condition: tuple, metadata: str = "metadata") -> Column:
    """Nested conditions -> Column: ``("pricePerNight", "<", 100)``, ``("and", a, b)``,
    ``("or", a, b)``, ``("not", a)``. Values become literals, never SQL text."""
    head = condition[0]
    if head == "and":
        return reduce(lambda a, b: a & b, [metadata_condition(c, metadata) for c in condition[1:]])
    if head == "or":
        return reduce(lambda a, b: a | b, [metadata_condition(c, metadata) for c in condition[1:]])
    if head == "not":
        return ~metadata_condition(condition[1], metadata)
    name, operator, value = condition
    return _COMPARE[operator](F.col(metadata)[name], value)
