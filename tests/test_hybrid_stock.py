"""The stock behind hybrid retrieval is worked out for the hotels that were hit only."""

from __future__ import annotations

from stayspark.plans import relational
from stayspark.sources.views import Views

FOLDER = "/root/testdata/sf0.001"


def test_stock_of_some_hotels_is_the_same_and_moves_no_other(spark):
    views = Views(spark, FOLDER)
    asked = spark.createDataFrame([(2,), (5,), (5,), (None,), (-1,)], "hotel_id long")
    some, every = relational.stock(views, asked), relational.stock(views)
    want = every.filter("hotel_id in (2, 5)")
    assert want.count() and sorted(map(tuple, some.collect())) == sorted(map(tuple, want.collect()))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LeftSemi") >= 2 and "BroadcastHashJoin [hotel_id" in plan


def test_texts_are_not_shuffled_for_their_hotels(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        text = Views(spark, FOLDER).described_hotels().select("doc_id", "description", "name")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning(id" not in text
