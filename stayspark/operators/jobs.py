"""Job queue: enrich and route, delay and release, classify and execute, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayspark.functions.columns import blank_to_null, has_text, once
from stayspark.schemas import JOB_SOURCES, NOTIFICATION_TYPES, ROOM_TYPES

# Fixed values of the model: queue bindings, default body, snippet and error lengths.
BINDINGS = (("booking.confirm", "booking-confirm"), ("email.send", "email-send"))
DEFAULT_BODY = "lab-job"
SNIPPET_CHARS = 500
ERROR_CHARS = 1000

_PAYLOAD = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("bookingId", T.LongType()),
        T.StructField("userId", T.LongType()),
        T.StructField("username", T.StringType()),
        T.StructField("hotelId", T.LongType()),
        T.StructField("hotelName", T.StringType()),
        T.StructField("roomType", T.StringType()),
        T.StructField("checkIn", T.StringType()),
        T.StructField("checkOut", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("_corrupt", T.StringType()),
    ]
)


def enriched_payload(payload: Column, source: Column) -> Column:
    """Blank -> default body; text starting like JSON passes; plain text is wrapped with its source."""
    body = F.coalesce(blank_to_null(payload), F.lit(DEFAULT_BODY))
    envelope = F.to_json(
        F.struct(F.coalesce(source, F.lit("IMMEDIATE")).alias("source"), body.alias("text"))
    )
    return F.when(body.startswith("{"), body).otherwise(envelope)


def bindings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(BINDINGS), "routing_key string, queue string")


def route(jobs: DataFrame) -> DataFrame:
    """Jobs with their queue by exact key; ``dropped`` marks keys no queue is bound to."""
    trimmed = jobs.withColumn("routing_key", F.trim("routing_key"))
    bound = F.broadcast(bindings(jobs.sparkSession))
    return trimmed.join(bound, "routing_key", "left").withColumn("dropped", F.col("queue").isNull())


def enrich_and_route(jobs: DataFrame) -> DataFrame:
    source = F.col("source") if "source" in jobs.columns else F.lit(None).cast("string")
    return route(jobs.withColumn("payload", enriched_payload(F.col("payload"), source)))


def schedule(jobs: DataFrame) -> DataFrame:
    """Delayed jobs with their due time; a negative delay or a blank key is not accepted."""
    due = F.col("created_at") + F.make_dt_interval(secs=F.col("delay_s").cast("decimal(18,6)"))
    ok = has_text(F.col("routing_key")) & (F.col("delay_s") >= 0)
    return jobs.filter(ok).withColumn("execute_at", due)


def claim_due(scheduled: DataFrame, as_of: str, released: DataFrame | None = None) -> DataFrame:
    """Jobs due at or before ``as_of`` and not released before, in due order."""
    due = scheduled.filter(F.col("execute_at") <= F.lit(as_of).cast("timestamp"))
    if released is not None:
        due = due.join(released.select("job_id"), "job_id", "left_anti")
    return due.orderBy("execute_at", "job_id")


def pending(scheduled: DataFrame, as_of: str, released: DataFrame | None = None) -> DataFrame:
    """Jobs still waiting after the claim of ``as_of``."""
    rest = scheduled.filter(F.col("execute_at") > F.lit(as_of).cast("timestamp"))
    if released is not None:
        rest = rest.join(released.select("job_id"), "job_id", "left_anti")
    return rest


def purge(scheduled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(empty queue, one-row report of how many jobs were dropped)."""
    return scheduled.filter(F.lit(False)), scheduled.agg(F.count(F.lit(1)).alias("purged"))


def classify(jobs: DataFrame) -> DataFrame:
    """Adds ``source``, the parsed ``note`` (null unless a notification) and ``error``.

    Precedence: notification (kind and bookingId), then a payload naming its source, else
    IMMEDIATE. Unreadable JSON or an unknown source also counts as IMMEDIATE.
    """
    parsed = F.from_json(
        "payload", _PAYLOAD, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    )
    looks_json = F.coalesce(F.trim("payload").startswith("{"), F.lit(False))
    with_json = jobs.withColumn("_p", once(F.when(looks_json, parsed)))
    p = F.col("_p")
    readable = p.isNotNull() & p["_corrupt"].isNull()
    is_note = readable & p["kind"].isNotNull() & p["bookingId"].isNotNull()
    known = F.coalesce(p["source"].isin(*JOB_SOURCES), F.lit(False))
    note_ok = is_note & (p["source"].isNull() | known)
    source = (
        F.when(note_ok, F.coalesce(p["source"], F.lit("BOOKING")))
        .when(readable & ~is_note & known, p["source"])
        .otherwise("IMMEDIATE")
    )
    n = F.col("note")
    error = F.when(
        n.isNotNull(),
        F.when(~n["kind"].isin(*NOTIFICATION_TYPES), F.concat(F.lit("unknown kind: "), n["kind"]))
        .when(
            ~F.coalesce(n["roomType"].isin(*ROOM_TYPES), F.lit(False)),
            F.concat(F.lit("unknown room type: "), F.coalesce(n["roomType"], F.lit("null"))),
        )
        .when(
            n["checkIn"].try_cast("date").isNull() | n["checkOut"].try_cast("date").isNull(),
            F.lit("unreadable stay dates"),
        ),
    )
    return (
        with_json.withColumn("source", source)
        .withColumn("note", F.when(note_ok, p))
        .withColumn("error", error)
        .drop("_p")
    )


def execute(jobs: DataFrame, users: DataFrame) -> DataFrame:
    """Classified jobs with status; a notification for an unknown user fails too."""
    known = users.select(F.col("id").alias("_uid")).withColumn("_known", F.lit(True))
    joined = classify(jobs).join(known, F.col("note.userId") == F.col("_uid"), "left")
    missing = F.concat(F.lit("user not found: "), F.coalesce(F.col("note.userId").cast("string"), F.lit("null")))
    error = F.coalesce(
        F.col("error"), F.when(F.col("note").isNotNull() & F.col("_known").isNull(), missing)
    )
    return (
        joined.withColumn("error", F.left(error, F.lit(ERROR_CHARS)))
        .withColumn("status", F.when(F.col("error").isNull(), "SUCCESS").otherwise("FAILED"))
        .drop("_uid", "_known")
    )


def run_history(executed: DataFrame) -> DataFrame:
    return executed.select(
        "job_id",
        F.col("routing_key").alias("type"),
        "source",
        "status",
        F.left(F.coalesce("payload", F.lit("")), F.lit(SNIPPET_CHARS)).alias("payload_snippet"),
        "error",
        "created_at",
    )


def job_notifications(executed: DataFrame) -> DataFrame:
    """Notification rows of the jobs that succeeded."""
    n = F.col("note")
    verb = F.when(n["kind"] == "BOOKING_CONFIRMED", "confirmed").otherwise("cancelled")
    text = F.format_string(
        "Booking %d %s for %s from %s to %s",
        n["bookingId"], verb, n["hotelName"], n["checkIn"], n["checkOut"],
    )
    return executed.filter("note is not null and status = 'SUCCESS'").select(
        n["userId"].alias("user_id"), n["bookingId"].alias("booking_id"),
        n["kind"].alias("type"), text.alias("message"),
    )


def retain(runs: DataFrame, as_of: str, keep: str = "1 hour") -> tuple[DataFrame, DataFrame]:
    """(runs kept, one-row count of runs strictly older than ``as_of - keep``).

    On a table partitioned by hour the predicate on ``created_hour`` drops whole partitions.
    """
    limit = F.lit(as_of).cast("timestamp") - F.expr(f"interval {keep}")
    kept = runs.filter(F.col("created_at") >= limit)
    if "created_hour" in runs.columns:
        kept = kept.filter(F.col("created_hour") >= F.date_trunc("hour", limit))
    return kept, runs.filter(F.col("created_at") < limit).agg(F.count(F.lit(1)).alias("deleted"))
