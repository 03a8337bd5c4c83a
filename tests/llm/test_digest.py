"""Digests of neighbours against a plain loop."""

from __future__ import annotations

import hashlib
import random

import pytest

from stayspark.llm import digest

SCHEMA = "doc_id bigint, text string, part int, extra string"


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    out = []
    for i, (doc_id, text, *_) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        change = digest.edited(text, following)
        a, b, c = (digest.digest(x.encode()) for x in (text, change, following))
        out.append((doc_id, len(text), hashlib.sha256(change.encode()).hexdigest(), a.tobytes().hex(), b.tobytes().hex(), digest.likeness(a, b), digest.likeness(a, c)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("range_rows", [3, 40, 1000])
def test_neighbours(spark, monkeypatch, range_rows):
    monkeypatch.setattr(digest, "RANGE_ROWS", range_rows)
    rng = random.Random(1)
    rows = [(rng.randrange(10**9), "".join(rng.choices("aé😀b \n", k=rng.randint(0, 80))), 1, "x") for _ in range(120)]
    rows += [(5, None, 1, "x"), (6, "", 1, "x"), (7, "same id", 1, "x"), (7, "other text", 1, "x"), (7, "same id", 1, "x"), (None, "no id", 1, "x")]
    got = digest.compare_with_following(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows)


def test_one_row_and_empty_table(spark):
    rows = [(3, "alone", 1, "x")]
    assert [tuple(r) for r in digest.compare_with_following(spark.createDataFrame(rows, SCHEMA)).collect()] == expected(rows)
    assert digest.compare_with_following(spark.createDataFrame([], SCHEMA)).count() == 0


def test_likeness_falls_with_the_edit():
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(300)]
    text = " ".join(rng.choices(words, k=400))
    own = digest.digest(text.encode())
    near = [digest.likeness(own, digest.digest(digest.edited(text, "".join(rng.choices("ijklmnop ", k=5000)))[: len(text)].encode()))]
    slight = digest.likeness(own, digest.digest(text.replace("a", "b", 1).encode()))
    other = digest.likeness(own, digest.digest(("".join(rng.choices("ijklmnop ", k=3000))).encode()))
    assert 1 >= slight > 0.9 > near[0] > other >= 0 and digest.likeness(own, own) == 1
