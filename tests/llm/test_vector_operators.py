"""Top-k, integer centroids and hard negatives against plain loops, on rows with everything odd in them."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from stayspark.llm import centroids, negatives, top_k
from stayspark.llm.vectors import products

SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, pivot int, rank string, query string, cluster string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z", "w") for r in rows], SCHEMA)


def odd_rows(rng, n=260, width=16):
    """Few different values, so that ties are common; repeated ids and rows, lengths, nulls."""
    rows = []
    for i in range(n):
        center = (i % 4) * 0.2
        rows.append((i * 5, [center + rng.choice([-0.25, 0, 0.25, 0.3]) for _ in range(width)], rng.choice([0, 1, 2, 9])))
    rows += [rows[10], rows[10], rows[20], (rows[20][0], rows[30][1], 1), (None, rows[40][1], 2), (None, [0.0] * width, 1)]
    rows += [(50, [0.5] * 3, 0), (100, [], 1), (5000, None, 1), (5050, [0.1, None] + [0.0] * 14, 1), (5100, [float("nan")] * width, 1)]
    rows += [(5150, [float("inf")] * width, 1), (5200, [0.5] * width, None), (-100, [-0.9] * width, -3), (-350, [0.7] * width, -1)]
    return rows


def whole(vector, scale):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(scale * float(np.float32(x))) for x in vector]


def dot(a, b):
    return sum(x * y for x, y in zip(a, b, strict=False))


def by_score(entries):
    return sorted(entries, key=lambda e: (-e[1], e[0] is None, e[0] or 0))


def top_k_by_hand(rows, k=5, every=50):
    kept = [(i, v) for i, e, *_ in rows if (v := whole(e, 256)) is not None]
    out = []
    for at, (q, v) in enumerate(kept):
        if q is None or q % every:
            continue
        found = by_score([(i, dot(v, w)) for j, (i, w) in enumerate(kept) if j != at])
        out += [(q, rank + 1, i, s) for rank, (i, s) in enumerate(found[:k])]
    return out


def key(rows):
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("sizes", [(1024, 512, 16384, 2048), (64, 4, 3, 2)])
def test_top_k(spark, monkeypatch, sizes):
    for name, value in zip(("BUCKETS", "RING_ROWS", "CELL_ROWS", "STRIPE"), sizes, strict=True):
        monkeypatch.setattr(top_k, name, value)
    rows = odd_rows(random.Random(1))
    assert key(top_k.top_k(table(spark, rows)).collect()) == key(top_k_by_hand(rows))


def test_top_k_leaves_far_annuli_out(spark, monkeypatch):
    """Groups far apart: bounds rule most annuli out, and what is ruled out is never needed."""
    monkeypatch.setattr(top_k, "RING_ROWS", 16)
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(20, 24)) * 8
    rows = [(i, [float(x) for x in centers[i % 20] + rng.normal(size=24) * 0.05], 1) for i in range(1200)]
    frame = top_k.clean(table(spark, rows))
    index = top_k.build(frame)
    asked = np.array([whole(e, 256) for i, e, _ in rows if i % 50 == 0])
    every = np.array([whole(e, 256) for _, e, _ in rows])
    sixth = np.sort(asked @ every.T, axis=1)[:, -6]
    limit = top_k.bounds(index, asked)
    assert (limit >= sixth[:, None]).mean() < 0.3
    cell = {(p, b): a for p, b, a in index.places}
    for r in index.rows.collect():
        assert (asked @ np.array(r.v) <= limit[:, cell[r.pivot, r.bucket]]).all()
    assert key(top_k.top_k(table(spark, rows)).collect()) == key(top_k_by_hand(rows))


def test_top_k_few_rows(spark):
    assert top_k.top_k(table(spark, [])).collect() == []
    assert top_k.top_k(table(spark, [(1, [0.5], 1), (2, None, 1)])).collect() == []
    assert top_k.top_k(table(spark, [(50, [0.5], 1)])).collect() == []
    assert [tuple(r) for r in top_k.top_k(table(spark, [(50, [0.5, 1.0], 1), (50, [0.5, 1.0], 1), (3, [0.0, 0.0], 1)])).collect()].count((50, 1, 50, 81920)) == 2


def test_products_stay_exact():
    big = np.array([[2**40 + 1, -(2**40)], [3, 5]])
    assert products(big[1:], big).tolist() == [[3 * (2**40 + 1) - 5 * 2**40, 34]]
    assert products(np.array([[2**31 - 1, 1]]), np.array([[2**31 - 1, 1]])).tolist() == [[(2**31 - 1) ** 2 + 1]]


def cluster_by_hand(rows, k, rounds, width):
    kept = [(i, v) for i, e, *_ in rows if (v := whole(e, 64)) is not None and len(v) == width]
    name = lambda i: (i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "")
    centers = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def assign():
        out = []
        for _, v in kept:
            out.append(min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centers)))
        return out

    for _ in range(rounds):
        placed = assign()
        for n in range(len(centers)):
            own = [v for (_, v), (_, m) in zip(kept, placed, strict=True) if m == n]
            if own:
                centers[n] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    placed = assign()
    total = {n: sum(d for d, m in placed if m == n) for n in range(len(centers))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return [(i, n, d, total[n], sum(total.values()), sha[n]) for (i, _), (d, n) in zip(kept, placed, strict=True)]


@pytest.mark.parametrize("k,rounds", [(16, 3), (7, 1), (1, 2)])
def test_clusters(spark, monkeypatch, k, rounds):
    monkeypatch.setattr(centroids, "PART", 50)
    rows = odd_rows(random.Random(3))
    got = centroids.cluster(table(spark, rows), k=k, rounds=rounds, dimensions=16)
    assert key(got.collect()) == key(cluster_by_hand(rows, k, rounds, 16))


def test_walk_finds_the_nearest_with_ties_to_the_smaller_number():
    rng = np.random.default_rng(4)
    for _ in range(30):
        k, width = int(rng.integers(1, 40)), int(rng.integers(1, 9))
        centers, found = rng.integers(-4, 5, (k, width)), rng.integers(-5, 6, (50, width))
        number, distance, steps = centroids.Walker(centers).nearest(found)
        apart = ((found[:, None] - centers[None]) ** 2).sum(axis=2)
        assert (number == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all() and steps.max() <= k


def test_walk_stops_early_between_distant_centroids():
    centers = np.arange(64)[:, None] * 1000 + np.zeros((1, 8), int)
    assert centroids.Walker(centers).nearest(centers + 1)[2].max() <= 2


def test_clusters_of_few_rows(spark):
    assert centroids.cluster(table(spark, [(1, None, 1), (2, [0.1], 1)])).collect() == []
    got = centroids.cluster(table(spark, [(i, [0.5] * 64, 1) for i in range(3)])).collect()
    assert {(r.cluster, r.distance, r.inertia) for r in got} == {(0, 0, 0)} and len(got) == 3
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster(table(spark, [(1, [3e7] * 64, 1)])).collect()


def mine_by_hand(rows):
    kept = []
    for i, e, label, *_ in rows:
        v = whole(e, 256)
        if v is None or label is None:
            continue
        kept.append((i, math.fmod(label + 1, 10) if i is not None and i % 7 == 0 else label, v))
    out = []
    for at, (a, label, v) in enumerate(kept):
        if a is None or a % 100:
            continue
        scored = [(i, dot(v, w), other) for j, (i, other, w) in enumerate(kept) if j != at]
        for p, ps, _ in by_score([s for s in scored if s[2] == label])[:5]:
            inside = by_score([s for s in scored if s[2] != label and 30 * ps <= 100 * s[1] <= 90 * ps])
            out += [(a, p, n + 1, i, ps, s) for n, (i, s, _) in enumerate(inside[:10])]
    return out


@pytest.mark.parametrize("sizes", [(8192, 4096, 256), (7, 2, 1)])
def test_hard_negatives(spark, monkeypatch, sizes):
    for name, value in zip(("PART", "STRIPE", "STRIDE"), sizes, strict=True):
        monkeypatch.setattr(negatives, name, value)
    rows = odd_rows(random.Random(5))
    got = negatives.mine(table(spark, rows)).collect()
    assert key(got) == key(mine_by_hand(rows)) and len(got) > 100


def test_table_lookups_equal_products():
    rng = np.random.default_rng(6)
    for bits, width in ((1, 3), (4, 8), (9, 64), (20, 17)):
        stored = rng.integers(-(1 << bits - 1), 1 << bits - 1, (70, width))
        asked = rng.integers(-300, 300, (130, width))
        assert negatives.bits_of(int(stored.min()), int(stored.max())) <= bits
        assert (negatives.scores(asked, negatives.pack(stored, bits)) == asked @ stored.T).all()
    assert [negatives.bits_of(*x) for x in ((0, 0), (-1, 0), (-2, 1), (-3, 1), (0, 255), (-256, 255))] == [1, 1, 2, 3, 9, 9]


def test_negatives_of_few_rows(spark):
    assert negatives.mine(table(spark, [])).collect() == []
    assert negatives.mine(table(spark, [(100, [0.5], 1), (1, [0.4], 2)])).collect() == []
    assert negatives.mine(table(spark, [(100, [0.5], 1), (1, [0.5], 1), (2, [-0.4], 2)])).collect() == []
