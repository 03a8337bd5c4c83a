"""The inventory is estimated as small as the table of hotels and must not be broadcast for it."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from stayspark.operators import joins, settlement
from stayspark.sources.views import Views

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

#: Queries that join the inventory, of which every hotel makes hundreds of rows.
STOCKED = (
    "bkg10_create_inventory", "join4_inventory_rows", "join7_nights_with_inventory", "vec10_availability_trace",
    "bkg10_set_availability", "bkg4_inventory_ledger", "agg4_stay_availability", "agg4_nightly_list",
)


def inventory_broadcast(df) -> bool:
    """Whether a broadcast of the plan holds rows exploded from hotels."""
    nodes = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    for at, line in enumerate(nodes):
        if "BroadcastExchange" in line:
            end = next((i for i in range(at + 1, len(nodes)) if depth(nodes[i]) <= depth(line)), len(nodes))
            if any("Generate explode" in x and "SINGLE" in x for x in nodes[at + 1 : end]):
                return True
    return False


@pytest.mark.parametrize("name", STOCKED)
def test_inventory_is_not_broadcast(spark, name):
    assert not inventory_broadcast(entry.queries()[name](spark, FOLDER))


def test_settlement_does_not_broadcast_the_inventory(spark):
    views = Views(spark, FOLDER)
    nights = joins.explode_nights(views.bookings())
    assert not inventory_broadcast(settlement._cells(nights, views.room_inventory()))
