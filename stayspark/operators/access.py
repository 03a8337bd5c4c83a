"""Access rules as set operations over batches of actors and requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayspark.functions.skew import latest_per_key, segmented_running_sum
from stayspark.operators.aggs import effective_plans
from stayspark.schemas import saas_plan_frame


def _actors(users: DataFrame) -> DataFrame:
    return users.select(F.col("id").alias("actor_id"), F.col("role").alias("actor_role"))


def visible_bookings(users: DataFrame, bookings: DataFrame, hotels: DataFrame) -> DataFrame:
    """(actor_id, scope, booking_id): what every actor may see.

    Three equi-joins instead of one OR-join. An admin sees everything: that is one ALL row without
    a booking, not a copy of the table per admin. A manager's own stays are OWN, so the branches
    never overlap and need no distinct.
    """
    actors = _actors(users)
    b = bookings.select(F.col("id").alias("booking_id"), "user_id", "hotel_id")
    everything = actors.filter("actor_role = 'ADMIN'").select(
        "actor_id", F.lit("ALL").alias("scope"), F.lit(None).cast("long").alias("booking_id")
    )
    own = b.join(actors.filter("actor_role <> 'ADMIN'"), F.col("user_id") == F.col("actor_id")).select(
        "actor_id", F.lit("OWN").alias("scope"), "booking_id"
    )
    managed = (
        b.join(_managed(users, hotels), "hotel_id")
        .filter("user_id <> actor_id")
        .select("actor_id", F.lit("MANAGED").alias("scope"), "booking_id")
    )
    return everything.unionByName(own).unionByName(managed)


def _managed(users: DataFrame, hotels: DataFrame) -> DataFrame:
    managers = _actors(users).filter("actor_role = 'HOTEL_MANAGER'").select("actor_id")
    owned = hotels.filter("manager_id is not null").select(
        F.col("manager_id").alias("actor_id"), F.col("id").alias("hotel_id"), "saas_plan"
    )
    return owned.join(managers, "actor_id")


def view_checks(requests: DataFrame, users: DataFrame, bookings: DataFrame, hotels: DataFrame):
    """(actor_id, booking_id) requests -> allowed."""
    b = bookings.select(F.col("id").alias("booking_id"), "user_id", "hotel_id")
    h = hotels.select(F.col("id").alias("hotel_id"), "manager_id")
    joined = requests.join(b, "booking_id").join(h, "hotel_id").join(_actors(users), "actor_id")
    allowed = (
        (F.col("actor_role") == "ADMIN")
        | (F.col("user_id") == F.col("actor_id"))
        | _manages()
    )
    return joined.select(*requests.columns, F.coalesce(allowed, F.lit(False)).alias("allowed"))


def _manages() -> Column:
    return (F.col("actor_role") == "HOTEL_MANAGER") & F.coalesce(
        F.col("manager_id") == F.col("actor_id"), F.lit(False)
    )


def listing_criteria(requests: DataFrame, users: DataFrame, hotels: DataFrame) -> DataFrame:
    """What a booking listing may actually ask for: (request_id, scope, user_id, hotel_id).

    requests: request_id, actor_id, user_id, hotel_id (the last two may be null). Admins keep their
    arguments; a manager is held to managed hotels (none managed: hotel -1; foreign hotel: DENIED)
    and the user argument is dropped; a customer is held to the own id.
    """
    owned = hotels.filter("manager_id is not null").select(
        F.col("manager_id").alias("actor_id"), F.col("id").alias("hotel_id")
    )
    owners = owned.select("actor_id").distinct().withColumn("_any", F.lit(True))
    joined = (
        requests.join(_actors(users), "actor_id")
        .join(owners, "actor_id", "left")
        .join(owned.withColumn("_mine", F.lit(True)), ["actor_id", "hotel_id"], "left")
    )
    role = F.col("actor_role")
    manager = role == "HOTEL_MANAGER"
    scope = (
        F.when(role == "ADMIN", "ALL")
        .when(manager & F.col("_any").isNull(), "NONE")
        .when(manager & F.col("hotel_id").isNull(), "MANAGED")
        .when(manager & F.col("_mine").isNull(), "DENIED")
        .when(manager, "MANAGED")
        .otherwise("OWN")
    )
    user_id = F.when(role == "ADMIN", F.col("user_id")).when(~manager, F.col("actor_id"))
    hotel_id = F.when(manager & F.col("_any").isNull(), F.lit(-1)).otherwise(F.col("hotel_id"))
    return joined.select(
        "request_id", "actor_id", scope.alias("scope"),
        user_id.cast("long").alias("user_id"), hotel_id.cast("long").alias("hotel_id"),
    )


def manageable_hotels(users: DataFrame, hotels: DataFrame) -> DataFrame:
    """(actor_id, scope, hotel_id): managers' hotels; one ALL row per admin."""
    admins = _actors(users).filter("actor_role = 'ADMIN'").select(
        "actor_id", F.lit("ALL").alias("scope"), F.lit(None).cast("long").alias("hotel_id")
    )
    return admins.unionByName(
        _managed(users, hotels).select("actor_id", F.lit("MANAGED").alias("scope"), "hotel_id")
    )


def _with_plan(df: DataFrame) -> DataFrame:
    return df.join(F.broadcast(saas_plan_frame(df.sparkSession)), "saas_plan")


def inventory_write_checks(requests: DataFrame, users: DataFrame, hotels: DataFrame) -> DataFrame:
    """(actor_id, hotel_id) requests -> verdict ALLOWED, NOT_MANAGER or PLAN."""
    h = _with_plan(
        hotels.select(F.col("id").alias("hotel_id"), "manager_id", "saas_plan")
    )
    joined = requests.join(h, "hotel_id").join(_actors(users), "actor_id")
    verdict = (
        F.when(F.col("actor_role") == "ADMIN", "ALLOWED")
        .when(~_manages(), "NOT_MANAGER")
        .when(F.col("inventory_writes"), "ALLOWED")
        .otherwise("PLAN")
    )
    return joined.select(*requests.columns, verdict.alias("verdict"))


def refund_checks(
    requests: DataFrame, users: DataFrame, payments: DataFrame, bookings: DataFrame, hotels: DataFrame
) -> DataFrame:
    """(actor_id, payment_id) requests -> allowed.

    Admins always; a customer on an own booking by its rate plan; the hotel's manager by the plan
    of the hotel.
    """
    p = payments.select(F.col("id").alias("payment_id"), "booking_id")
    b = bookings.select(F.col("id").alias("booking_id"), "user_id", "hotel_id", "rate_plan")
    h = _with_plan(hotels.select(F.col("id").alias("hotel_id"), "manager_id", "saas_plan"))
    joined = (
        requests.join(p, "payment_id")
        .join(b, "booking_id")
        .join(h, "hotel_id")
        .join(_actors(users), "actor_id")
    )
    own = (F.col("actor_role") == "CUSTOMER") & (F.col("user_id") == F.col("actor_id"))
    allowed = (
        F.when(F.col("actor_role") == "ADMIN", F.lit(True))
        .when(own, F.col("rate_plan") == "FLEXIBLE")
        .when(_manages(), F.col("refunds"))
        .otherwise(F.lit(False))
    )
    return joined.select(*requests.columns, F.coalesce(allowed, F.lit(False)).alias("allowed"))


def creation_checks(
    requests: DataFrame, users: DataFrame, hotels: DataFrame, segment: Column
) -> DataFrame:
    """Which hotel creations of a batch pass: requests (request_id, actor_id, created_at).

    New hotels start FREE, so the effective plan cannot rise inside the batch: creation number i
    of a manager passes while owned + i <= plan limit. ``segment`` is a non-decreasing cut of the
    request order, so a manager with very many requests is numbered in parts.
    """
    plans = effective_plans(
        users.filter("role = 'HOTEL_MANAGER'"), hotels
    ).withColumnRenamed("effective_plan", "saas_plan")
    limits = _with_plan(plans).select(
        F.col("manager_id").alias("actor_id"), "owned", "max_hotels"
    )
    numbered = segmented_running_sum(
        requests, ["actor_id"], [F.asc("created_at"), F.asc("request_id")], segment,
        {"nth": F.lit(1).cast("long")},
    )
    joined = numbered.join(_actors(users), "actor_id").join(limits, "actor_id", "left")
    verdict = (
        F.when(F.col("actor_role") == "ADMIN", "ALLOWED")
        .when(F.col("actor_role") != "HOTEL_MANAGER", "ROLE")
        .when(F.col("owned") + F.col("nth") <= F.col("max_hotels").cast("long"), "ALLOWED")
        .otherwise("LIMIT")
    )
    return joined.select("request_id", "actor_id", verdict.alias("verdict"))


def valid_sessions(tokens: DataFrame, as_of: str) -> DataFrame:
    """Tokens neither revoked nor expired; the newest one per user survives."""
    alive = tokens.filter(
        ~F.col("revoked") & (F.col("expiry_date") > F.lit(as_of).cast("timestamp"))
    )
    return latest_per_key(
        alive, ["user_id"], [F.col("expiry_date"), F.col("id")], ["id", "token", "expiry_date"]
    )
