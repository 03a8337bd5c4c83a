"""The star-schema tables seen as the lodging model.

Suppliers are hotels, customers are users, orders are stay requests; events feed the change topic,
the job queue, the keyed log and the metric series; documents and parts make the search catalogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayspark.functions.columns import stay_total
from stayspark.functions.skew import within_rows
from stayspark.sources.generate import opening_inventory
from stayspark.sources.tables import spread, star_table

FIRST_NIGHT = "2026-01-01"
LAST_NIGHT = "2026-07-02"
FEW_HOTELS = 500_000


class Views:
    """Lazily planned views over one folder; nothing is read until a query asks for it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return star_table(self.spark, self.folder, name)

    def spread_events(self) -> DataFrame:
        return spread(self.table("events").select("event_id", "ts", "user_id", "event_type"))

    def hotel_count(self) -> Column:
        return self.table("supplier").agg(F.count(F.lit(1)).alias("n")).scalar()

    def users(self) -> DataFrame:
        k = F.col("c_custkey")
        role = (
            F.when((k <= 18) & (k % 3 == 0), "HOTEL_MANAGER")
            .when(k % 50 == 1, "ADMIN")
            .otherwise("CUSTOMER")
        )
        return self.table("customer").select(
            k.alias("id"), F.col("c_name").alias("username"), role.alias("role")
        )

    def hotels(self) -> DataFrame:
        k = F.col("s_suppkey")
        plan = F.expr("s_suppkey div 3") % 3
        named = self.table("supplier").join(
            self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")
        )
        return named.select(
            k.alias("id"),
            F.col("s_name").alias("name"),
            F.col("n_name").alias("city"),
            (F.lit(80.0) + (k % 40) * 10).alias("price_per_night"),
            F.when(k % 3 == 0, 3 * (k % 7)).alias("manager_id"),
            F.when(plan == 0, "FREE").when(plan == 1, "PRO").otherwise("ENTERPRISE").alias("saas_plan"),
            F.when(k % 4 == 1, "free wifi, pool")
            .when(k % 4 == 2, "spa, pools, bar")
            .when(k % 4 == 3, "gym , ,laundry")
            .alias("amenities"),
        )

    def described_hotels(self) -> DataFrame:
        """A row per document: every text describes the hotel that its number falls to.

        Hotels, short rows, travel to the texts where they are few, so that the texts are not shuffled for them.
        """
        hotels = F.broadcast(self.hotels()) if within_rows(self.table("supplier"), FEW_HOTELS) else self.hotels()
        texts = self.table("documents").select(
            "doc_id", (F.col("doc_id") % self.hotel_count()).alias("id"), F.col("text").alias("description")
        )
        return texts.join(hotels, "id")

    def bookings(self) -> DataFrame:
        o, c = F.col("o_orderkey"), F.col("o_custkey")
        offset = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date"))
        first = F.lit(FIRST_NIGHT).cast("date")
        check_in = F.date_add(first, (offset % 180).cast("int"))
        priority = F.substring("o_orderpriority", 1, 1).cast("int") % 3
        return self.table("orders").select(
            o.alias("id"),
            c.alias("user_id"),
            ((o * 31 + c) % self.hotel_count()).alias("hotel_id"),
            F.when(priority == 0, "SINGLE").when(priority == 1, "DOUBLE").otherwise("SUITE").alias("room_type"),
            check_in.alias("check_in"),
            F.date_add(check_in, (1 + o % 3).cast("int")).alias("check_out"),
            F.when(F.col("o_orderstatus") == "O", "PENDING")
            .when(F.col("o_orderstatus") == "F", "CONFIRMED")
            .otherwise("CANCELLED")
            .alias("status"),
            F.when(o % 4 == 0, "NON_REFUNDABLE").otherwise("FLEXIBLE").alias("rate_plan"),
            F.when(o % 17 == 0, "decline").otherwise("approve").alias("payment_token"),
            F.col("o_orderdate").alias("created_at"),
        )

    def priced_bookings(self) -> DataFrame:
        hotels = self.hotels().select(F.col("id").alias("hotel_id"), "price_per_night")
        joined = self.bookings().join(hotels, "hotel_id")
        total = stay_total(
            F.col("price_per_night"), F.col("check_in"), F.col("check_out"), F.col("rate_plan")
        )
        return joined.withColumn("total_price", total).drop("price_per_night")

    def room_inventory(self) -> DataFrame:
        """Hotels with a negative balance do not open on Mondays: those nights are not configured.

        A hotel becomes 549 rows here, which the optimizer does not count: to it the inventory is as small as the table
        of hotels. The hint keeps it from being broadcast.
        """
        opened = opening_inventory(
            self.table("supplier"), FIRST_NIGHT, LAST_NIGHT, hotel_id="s_suppkey"
        )
        closed = self.table("supplier").filter("s_acctbal < 0").select(
            F.col("s_suppkey").alias("hotel_id")
        )
        monday = F.weekday("inventory_date") == 0
        return opened.filter(~monday).unionByName(
            opened.filter(monday).join(closed, "hotel_id", "left_anti")
        ).hint("merge")

    def payments(self) -> DataFrame:
        paid = self.priced_bookings().filter("status <> 'PENDING'")
        refunded = (F.col("status") == "CANCELLED") & (F.col("rate_plan") == "FLEXIBLE")
        return paid.select(
            F.col("id"),
            F.col("id").alias("booking_id"),
            F.col("total_price").alias("amount"),
            F.when(refunded, "REFUNDED").otherwise("SUCCEEDED").alias("status"),
            F.concat(F.lit("pay_"), F.col("id")).alias("transaction_reference"),
        )

    def hotel_event_log(self) -> DataFrame:
        """The change topic; records of error events were delivered twice."""
        e = F.col("event_id")
        hotel = F.col("user_id") % self.hotel_count()
        base = self.spread_events().select(
            "event_id",
            "ts",
            hotel.alias("hotel_id"),
            F.when(F.col("event_type") == "signup", "CREATED")
            .when(F.col("event_type") == "error", "DELETED")
            .otherwise("UPDATED")
            .alias("event_type"),
        )
        h = F.col("hotel_id")
        good = F.format_string(
            '{"eventId":"e%d","schemaVersion":1,"eventType":"%s","hotelId":%d,"hotelName":"H%d",'
            '"city":"C%d","pricePerNight":%d}',
            e, F.col("event_type"), h, h, h % 5, 80 + h % 40 * 10,
        )
        copies = F.when(F.col("event_type") == "DELETED", F.array(F.lit(0), F.lit(1))).otherwise(
            F.array(F.lit(0))
        )
        return base.select(
            F.lit("hotel-events").alias("topic"),
            h.cast("string").alias("message_key"),
            (h % 4).cast("int").alias("partition_id"),
            F.when(e % 13 == 0, "{not-json}").otherwise(good).alias("payload"),
            F.col("ts").alias("occurred_at"),
            e,
            F.explode(copies).alias("_copy"),
        ).select(
            "topic",
            "message_key",
            "partition_id",
            (e * 2 + F.col("_copy")).alias("kafka_offset"),
            "payload",
            "occurred_at",
        )

    def jobs(self) -> DataFrame:
        e = F.col("event_id")
        kind = (
            F.when(e % 8 == 3, "BOOKING_CONFIRMED")
            .when(e % 16 == 7, "BAD_KIND")
            .otherwise("BOOKING_CANCELLED")
        )
        room = F.when(e % 16 == 11, "PENTHOUSE").otherwise("DOUBLE")
        body = F.format_string(
            '{"kind":"%s","bookingId":%d,"userId":%d,"username":"u%d","hotelId":%d,"hotelName":"H%d",'
            '"roomType":"%s","checkIn":"2026-01-01","checkOut":"2026-01-03","source":"BOOKING"}',
            kind, e, F.col("user_id"), F.col("user_id"), F.col("user_id") % 7, F.col("user_id") % 7, room,
        )
        return self.table("events").select(
            F.concat(F.lit("j"), e).alias("job_id"),
            F.when(F.col("event_type") == "purchase", "booking.confirm")
            .when(F.col("event_type") == "signup", "email.send")
            .otherwise("unknown.job")
            .alias("routing_key"),
            F.when(e % 4 == 0, "  ")
            .when(e % 4 == 1, "lab text")
            .when(e % 4 == 2, F.col("props"))
            .otherwise(body)
            .alias("payload"),
            F.col("ts").alias("created_at"),
            (e % 600).cast("int").alias("delay_s"),
        )

    def kv_log(self) -> DataFrame:
        return self.table("events").select(
            F.concat(F.lit("k"), F.col("user_id") % 50).alias("k"),
            F.col("event_id").alias("seq"),
            F.col("event_type").alias("member"),
            F.col("value").alias("score"),
            "ts",
        )

    def search_docs(self) -> DataFrame:
        """Catalogue documents; texts that are not English fill the second-locale fields."""
        joined = (
            spread(self.table("documents"))
            .join(self.table("part"), F.col("doc_id") == F.col("p_partkey"))
            .join(self.table("nation"), F.col("doc_id") % 25 == F.col("n_nationkey"))
        )
        english = F.col("lang") == "en"
        return joined.select(
            F.col("doc_id").alias("id"),
            F.col("p_name").alias("name"),
            F.col("n_name").alias("city"),
            F.when(english, F.col("text")).alias("description"),
            F.col("p_type").alias("amenities"),
            F.when(~english, F.col("p_brand")).alias("name_alt"),
            F.when(~english, F.col("source")).alias("city_alt"),
            F.when(~english, F.col("text")).alias("description_alt"),
            F.col("p_retailprice").alias("price_per_night"),
        )

    def search_queries(self) -> DataFrame:
        """Every benchmark passage is one whole-text query; the locale alternates."""
        return self.table("benchmark").select(
            F.col("item_id").alias("query_id"),
            F.col("text").alias("q"),
            F.when(F.col("item_id") % 2 == 0, "en-US").otherwise(" TH-th").alias("lang"),
        )

    def vectors(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("vec_id").alias("id"),
            "embedding",
            F.struct(
                F.col("label").cast("string").alias("city"),
                (F.col("vec_id") % 400).cast("double").alias("pricePerNight"),
            ).alias("metadata"),
        )

    def requests(self) -> DataFrame:
        return self.table("events").select(
            "event_id",
            "ts",
            F.col("event_type").alias("uri"),
            F.col("value").alias("latency_ms"),
            F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
        )
