"""A batch of vector searches beyond what travels with the tasks: exact, and without a copy of either side."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from stayspark.operators import vectors

ROWS = "id long, embedding array<double>"


def rows_of(n: int, seed: int = 3):
    rng = random.Random(seed)
    made = [(i, [float(rng.randrange(4)) for _ in range(8)]) for i in range(n)]
    copies = [(n + i, made[i % 5][1]) for i in range(60)]
    odd = [(10_001, None), (10_002, [0.0] * 8), (10_003, [1.0, 2.0]), (10_004, [float("inf")] + [1.0] * 7), (None, made[3][1]), (7, made[9][1]), (2**60 + 1, made[9][1])]
    return made + copies + odd


def nearest(rows, asked, k, threshold):
    want = []
    for query, a in asked:
        found = []
        for i, b in rows:
            if a is None or b is None or len(a) != len(b):
                continue
            with np.errstate(invalid="ignore"):
                x, y = vectors._unit(np.array([a])), vectors._unit(np.array([b]))
                score = round(float((x @ y.T)[0, 0]), 6)
            if score > threshold:
                found.append((-score, i is not None, i or 0))
        want += [(query, rank, i if known else None, -s) for rank, (s, known, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(want, key=str)


def test_blocks_find_what_brute_force_finds(spark, monkeypatch):
    for name, value in (("STRIPE_ROWS", 16), ("PART_ROWS", 23), ("TILE", 5), ("TILE_COLUMNS", 7), ("FIRST_ROWS", 9), ("EXACT_PAIRS", 11)):
        monkeypatch.setattr(vectors, name, value)
    rows = [r for r in rows_of(200) if r[0] is not None]
    asked = [(q, v) for q, v in rows_of(200)[::3] if q is not None]
    store = spark.createDataFrame(rows, ROWS).repartition(3)
    queries = spark.createDataFrame([*asked, (None, [1.0] * 8)], ROWS).withColumnRenamed("id", "query_id")
    for k, threshold in ((4, 0.5), (1, 0.97), (300, 0.9)):
        found = vectors.similarity_search(store, queries, k, threshold).collect()
        assert sorted(map(tuple, found), key=str) == nearest(rows, asked, k, threshold)
    unnamed = spark.createDataFrame(rows_of(200), ROWS)
    found = vectors.similarity_search(unnamed, queries, 300, 0.9).collect()
    assert {(r.query_id, r.id, r.score) for r in found} == {(q, i, s) for q, _, i, s in nearest(rows_of(200), asked, 300, 0.9)}


def test_neither_side_is_copied(spark, monkeypatch):
    """What is shuffled or stored holds each vector once, however many stripes and blocks meet."""
    for name, value in (("STRIPE_ROWS", 20), ("PART_ROWS", 25)):
        monkeypatch.setattr(vectors, name, value)
    rows = [(i, [1.0 + i % 7, 2.0, float(i % 3)]) for i in range(400)]
    store = spark.createDataFrame(rows, ROWS)
    asked = spark.createDataFrame(rows, ROWS).withColumnRenamed("id", "query_id")
    found = vectors.similarity_search(store, asked)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "CoGroup" not in plan and "sequence" not in plan
    packed = store.mapInArrow(vectors._packed("id", store.schema["id"].dataType, 25), "ids array<long>, width int, vectors binary")
    sizes = packed.select(F.size("ids").alias("n"), F.length("vectors").alias("bytes")).collect()
    assert sum(r.n for r in sizes) == 400 and max(r.n for r in sizes) <= 25 and all(r.bytes == 24 * r.n for r in sizes)
