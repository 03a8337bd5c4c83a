"""Sources, sinks, and what the physical plans must and must not contain."""

from __future__ import annotations

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from stayspark.operators import filters, search, vectors
from stayspark.schemas import LODGING_TABLES, SAAS_PLANS
from stayspark.sources import generate, metrics, partitioned, snapshots, tables, topics

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def test_quarter_partitions_are_pruned(spark, tmp_path):
    path = str(tmp_path / "by_quarter")
    stays = generate.series(
        spark, 2000, {"check_in": F.date_add(F.lit("2026-01-01").cast("date"), (F.col("g") % 365).cast("int"))}
    )
    partitioned.write_by_quarter(stays, path)
    assert sorted(p for p in os.listdir(path) if p.startswith("quarter=")) == [
        f"quarter=2026q{q}" for q in (1, 2, 3, 4)
    ]
    first, last = date(2026, 4, 10), date(2026, 7, 1)
    window = partitioned.read_window(spark, path, "g long, check_in date", first, last)
    assert window.count() == stays.filter(F.col("check_in").between(first, date(2026, 6, 30))).count()
    assert "PartitionFilters: [isnotnull(quarter" in plan_of(window) or "quarter#" in plan_of(window).split("PartitionFilters: [")[1][:60]
    assert partitioned.quarters_between(first, last) == ["2026q2"]
    assert partitioned.quarters_between(date(2025, 12, 31), date(2026, 1, 2)) == ["2025q4", "2026q1"]
    whole = partitioned.read_by_quarter(spark, path, "g long, check_in date")
    counted = partitioned.rows_per_partition(whole)
    assert {r.quarter: r.n for r in counted.collect()} == {
        r.q: r.n for r in stays.groupBy(partitioned.quarter_of(F.col("check_in")).alias("q")).agg(F.count("*").alias("n")).collect()
    }
    assert "ReadSchema: struct<>" in plan_of(counted)
    files = partitioned.rows_per_file(whole).collect()
    assert sum(r.n for r in files) == 2000 and all("quarter=" in r.file for r in files)


def test_registered_quarter_queries_read_the_written_table(spark):
    plan = plan_of(entry.queries()["src10_quarter_window"](spark, FOLDER))
    scan = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "quarter#" in scan and "2026q1,2026q2" in scan and "quarter=" not in scan
    assert "hotel_id" in plan.split("ReadSchema")[-1] and "user_id" not in plan.split("ReadSchema")[-1]
    assert "orders.parquet" not in plan
    plan = plan_of(entry.queries()["src11_rows_per_partition"](spark, FOLDER))
    assert "ReadSchema: struct<>" in plan and "orders.parquet" not in plan


def test_snapshot_rebuild(spark, tmp_path):
    root = str(tmp_path / "index")
    assert snapshots.current_folder(spark, root) is None
    snapshots.publish(spark.range(5), root)
    snapshots.publish(spark.range(3), root)
    assert snapshots.read_current(spark, root, "id long").count() == 3


def test_snapshot_swap_retention_and_failed_writes(spark, tmp_path):
    root = str(tmp_path / "index")
    for n in (4, 5, 6):
        snapshots.publish(spark.range(n), root)
    assert sorted(p for p in os.listdir(root) if p.startswith("v")) == ["v2", "v3"]

    def breaks(folder):
        spark.range(9).write.parquet(folder)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        snapshots.publish_folder(spark, root, breaks)
    assert snapshots.read_current(spark, root, "id long").count() == 6
    snapshots.publish(spark.range(7), root)  # over what the failed attempt left
    assert snapshots.read_current(spark, root, "id long").count() == 7


def test_snapshot_is_rebuilt_only_for_other_input(spark, tmp_path):
    table, root, made = str(tmp_path / "t.parquet"), str(tmp_path / "index"), []

    def write(folder):
        made.append(folder)
        spark.read.parquet(table).write.parquet(folder)

    for n, builds in ((3, 1), (None, 1), (5, 2)):
        if n:
            spark.range(n).write.mode("overwrite").parquet(table)
        snapshots.current_or_rebuilt(spark, root, snapshots.signature(spark, table), write)
        assert len(made) == builds
    assert snapshots.read_current(spark, root, "id long").count() == 5


def test_topic_rows_round_trip(spark, tmp_path):
    changes = spark.createDataFrame(
        [("CREATED", 5, "H", "Berlin", 199.0)],
        "event_type string, hotel_id long, hotel_name string, city string, price_per_night double",
    )
    at = F.lit("2026-01-01 00:00:00").cast("timestamp")
    out = topics.event_messages(changes, F.lit("e1"), at).first()
    assert out.key == "5"
    assert out.value == (
        '{"eventId":"e1","schemaVersion":1,"eventType":"CREATED","hotelId":5,"hotelName":"H",'
        '"city":"Berlin","pricePerNight":199.0,"occurredAt":"2026-01-01T00:00:00Z"}'
    )
    raw = spark.createDataFrame([("k", "{not-json}")], "k string, v string")
    assert topics.raw_messages(raw, "k", "v").first().value == "{not-json}"


def test_generators(spark):
    hotels = spark.createDataFrame([(10, "a"), (20, "b"), (35, "c")], "id long, name string")
    stock = generate.opening_inventory(hotels, "2026-01-01", "2026-01-10")
    assert stock.count() == 3 * 10 * 3
    assert {(r.room_type, r.available_rooms) for r in stock.collect()} == {("SINGLE", 4), ("DOUBLE", 6), ("SUITE", 2)}
    rows = spark.range(1, 8).withColumnRenamed("id", "g")
    dealt = generate.assign_rotating(rows, hotels, "id", "rank").collect()
    assert {r.g: r.id for r in dealt} == {g: [10, 20, 35][g % 3] for g in range(1, 8)}
    fresh = spark.createDataFrame([(1, "A"), (2, "a"), (3, "X"), (4, "x")], "id long, name string")
    assert [(r.id, r.name) for r in generate.only_new(fresh, hotels, "name", ignore_case=True).collect()] == [(3, "X")]


def test_tables_and_metrics(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a", "a@x", "ADMIN")], LODGING_TABLES["users"])
    tables.write_clustered(df, f"{path}/users", ["id"], 1)
    assert tables.lodging_table(spark, path, "users").first().role == "ADMIN"
    made = metrics.as_samples(
        spark.range(4), F.lit("app"), F.lit("cpu"), {"host": F.col("id") % 2},
        F.lit("2026-01-01").cast("timestamp"), F.col("id"),
    )
    made.write.parquet(f"{path}/samples")
    assert metrics.select_series(metrics.samples(spark, f"{path}/samples"), "app", "cpu", host="1").count() == 2
    assert [p[0] for p in sorted(SAAS_PLANS, key=lambda p: p[1])] == ["FREE", "PRO", "ENTERPRISE"]


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")
ROUNDS = ("bkg3",)


@pytest.mark.parametrize(
    "name", sorted(n for n in entry.queries() if not n.startswith(ROUNDS) and "stream" not in n)
)
def test_no_unkeyed_joins(spark, name):
    plan = plan_of(entry.queries()[name](spark, FOLDER))
    assert not any(bad in plan for bad in FORBIDDEN)


def test_pushdown_and_pruning(spark, tmp_path):
    plan = plan_of(entry.queries()["fil6_text_predicates"](spark, FOLDER))
    assert "StringStartsWith(c_name" in plan
    stays = spark.createDataFrame([], LODGING_TABLES["bookings"]).withColumnsRenamed(
        {"check_in_date": "check_in", "check_out_date": "check_out"}
    )
    stays.write.parquet(str(tmp_path / "bookings"))
    stored = spark.read.schema(stays.schema).parquet(str(tmp_path / "bookings"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    found = filters.bookings_matching(stored, status="CONFIRMED", hotel_ids=[1, 2], check_in_from="2026-01-01")
    plan = plan_of(found.select("id"))
    assert "EqualTo(status,CONFIRMED)" in plan and "In(hotel_id, [1,2])" in plan
    assert "GreaterThanOrEqual(check_in,2026-01-01)" in plan and "total_price" not in plan.split("ReadSchema")[-1]
    assert "documents.parquet" not in plan_of(entry.queries()["bkg6_charge_confirmed"](spark, FOLDER))
    plan = plan_of(entry.queries()["join1_bookings_of_user"](spark, FOLDER))
    assert "c_acctbal" not in plan.split("== Physical Plan ==")[1]


def test_top_lists_are_limited_before_the_shuffle(spark):
    assert "TakeOrderedAndProject" in plan_of(entry.queries()["top1_newest_events"](spark, FOLDER))
    assert "WindowGroupLimit" in plan_of(entry.queries()["win2_recent_turns"](spark, FOLDER))


def test_page_is_cut_before_anything_is_joined(spark):
    df = entry.queries()["page1_booking_page"](spark, FOLDER)
    lines = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    at = next(i for i, line in enumerate(lines) if "GlobalLimit" in line)
    below = [x for x in lines[at + 1 :] if depth(x) > depth(lines[at])]
    assert any("Join" in x for x in lines[:at]) and not any("Join" in x for x in below[:12])
    assert df.orderBy("check_in", "id").collect() == df.collect()


def test_embedding_shuffles_texts_once(spark):
    texts = spark.createDataFrame([(1, "a b a"), (2, " "), (3, None)], "id long, text string")
    made = vectors.embed_words(texts, "id", "text", 8)
    assert plan_of(made).split("== Physical Plan ==")[1].count("Exchange") == 1
    assert {r.id: sum(r.embedding) for r in made.collect()} == {1: 3.0, 2: 1.0, 3: 1.0}


def test_index_deals_texts_out_once(spark):
    docs = spark.createDataFrame([(1, "inn", "free bar bars")], "id long, name string, description string")
    made = search.postings_of(docs)
    assert plan_of(made).split("== Physical Plan ==")[1].count("Exchange") == 1
    assert {(r.field, r.term, r.tf, r.len) for r in made.collect()} == {("name", "inn", 1, 1), ("description", "free", 1, 3), ("description", "bar", 2, 3)}
