"""Explicit schemas and the small value domains of the lodging model.

Nothing is inferred at read time: every scan names its columns and types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)


# ---- the star-schema tables the package is tested on ---------------------------------------
STAR_TABLES: dict[str, str] = {
    "region": ("r_regionkey int, r_name string"),
    "nation": ("n_nationkey int, n_name string, n_regionkey int"),
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": ("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
        " p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
        " l_returnflag string, l_linestatus string, l_shipdate timestamp"
    ),
    "events": (
        "event_id bigint, ts timestamp, user_id bigint, event_type string, value double,"
        " props string"
    ),
    "documents": (
        "doc_id bigint, text string, lang string, source string, n_chars bigint"
    ),
    "embeddings": ("vec_id bigint, embedding array<float>, label int"),
    "pages": ("page_id bigint, url string, html string"),
    "benchmark": ("item_id bigint, text string"),
    "labels": ("doc_id bigint, quality int, toxic int"),
    "conversations": ("conv_id bigint, turn bigint, role string, text string"),
}

# ---- the lodging tables ---------------------------------------------------------------------
LODGING_TABLES: dict[str, str] = {
    "users": ("id bigint, username string, email string, role string"),
    "hotels": (
        "id bigint, name string, city string, price_per_night double, description string,"
        " amenities string, name_th string, city_th string, description_th string,"
        " image_url string, gallery_urls string, star_rating int, guest_rating double,"
        " review_count int, address string, address_th string, neighborhood string,"
        " neighborhood_th string, check_in_from string, check_out_until string, phone string,"
        " manager_id bigint, saas_plan string"
    ),
    "room_inventory": (
        "id bigint, hotel_id bigint, room_type string, inventory_date date, available_rooms int"
    ),
    "bookings": (
        "id bigint, user_id bigint, hotel_id bigint, room_type string, check_in_date date,"
        " check_out_date date, status string, rate_plan string, total_price decimal(12,2),"
        " created_at timestamp"
    ),
    "payments": (
        "id bigint, booking_id bigint, amount decimal(12,2), status string, provider string,"
        " transaction_reference string, processed_at timestamp"
    ),
    "notifications": (
        "id bigint, user_id bigint, booking_id bigint, type string, message string,"
        " is_read boolean, created_at timestamp"
    ),
    "refresh_tokens": (
        "id bigint, token string, user_id bigint, expiry_date timestamp, revoked boolean"
    ),
    "job_runs": (
        "id bigint, job_id string, type string, source string, status string,"
        " payload_snippet string, error string, created_at timestamp, finished_at timestamp"
    ),
    "processed_hotel_events": (
        "event_id string, schema_version int, event_type string, hotel_id bigint,"
        " hotel_name string, city string, price_per_night double, topic_name string,"
        " message_key string, partition_id int, kafka_offset bigint, consumer_group_id string,"
        " occurred_at timestamp, processed_at timestamp"
    ),
    "dead_letter_hotel_events": (
        "original_topic string, dead_letter_topic string, message_key string, partition_id int,"
        " kafka_offset bigint, payload string, original_event_id string,"
        " original_event_type string, original_hotel_id bigint, error_class_name string,"
        " error_message string, retry_status string, retry_count int, last_retried_at timestamp,"
        " resolved_at timestamp, dead_lettered_at timestamp"
    ),
    "metric_samples": (
        "job string, metric string, labels map<string,string>, ts timestamp, value double"
    ),
}

# Record carried by the hotel-event topic.
HOTEL_EVENT = T.StructType(
    [
        T.StructField("eventId", T.StringType()),
        T.StructField("schemaVersion", T.IntegerType()),
        T.StructField("eventType", T.StringType()),
        T.StructField("hotelId", T.LongType()),
        T.StructField("hotelName", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("pricePerNight", T.DoubleType()),
        T.StructField("occurredAt", T.StringType()),
    ]
)

# ---- fixed values: enum domains, in declaration order ----------------------------------------
ROOM_TYPES = ("SINGLE", "DOUBLE", "SUITE")
BOOKING_STATUSES = ("PENDING", "CONFIRMED", "CANCELLED")
ROLES = ("CUSTOMER", "HOTEL_MANAGER", "ADMIN")
EVENT_TYPES = ("CREATED", "UPDATED", "DELETED")
PAYMENT_STATUSES = ("SUCCEEDED", "FAILED", "REFUNDED")
DEAD_LETTER_STATUSES = ("PENDING", "RETRIED", "RESOLVED", "FAILED_AGAIN")
JOB_SOURCES = ("IMMEDIATE", "DELAYED", "BOOKING")
NOTIFICATION_TYPES = ("BOOKING_CONFIRMED", "BOOKING_CANCELLED")
# plan: (ordinal, most hotels a manager may own, inventory writes, refunds)
SAAS_PLANS = (
    ("FREE", 0, 1, False, False),
    ("PRO", 1, 5, True, False),
    ("ENTERPRISE", 2, 2147483647, True, True),
)
# rate plan: (price multiplier, refundable by the customer)
RATE_PLANS = (("FLEXIBLE", "1", True), ("NON_REFUNDABLE", "0.85", False))
# opening rooms per night
OPENING_ROOMS = (("SINGLE", 4), ("DOUBLE", 6), ("SUITE", 2))


def saas_plan_frame(spark: SparkSession) -> DataFrame:
    """Three rows, one per plan: small by definition, so joins against it may be hinted broadcast."""
    return spark.createDataFrame(
        list(SAAS_PLANS),
        "saas_plan string, plan_rank int, max_hotels int, inventory_writes boolean, refunds boolean",
    )
