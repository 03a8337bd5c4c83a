"""Source mixing against plain loops."""

from __future__ import annotations

import pytest

from stayspark.llm import mixing

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, mix_note string, size int"


def targets_by_hand(sizes: dict) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        if not free:
            return fixed
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > 3 * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: 3.0 * sizes[s] for s in above}


def rows_of(counts):
    rows, n = [], 0
    for source, documents in counts.items():
        for k in range(documents):
            text = None if k % 11 == 10 else " ".join(["w"] * (n * 7 % 23))
            rows.append((n if k % 13 else None, text, "en", source, None, "x", 1))
            n += 1
    return rows


@pytest.mark.parametrize("counts", [{"a": 40, "b": 3, None: 5, "c": 1, "": 9, "é": 2}, {"z": 5}, {"a": 1, "b": 1, "c": 60}])
def test_targets_and_taken(spark, counts):
    docs = spark.createDataFrame(rows_of(counts), SCHEMA)
    rows = mixing.assign(docs).collect()
    assert len(rows) == sum(counts.values())
    sizes, taken, target = {}, {}, {}
    for r in rows:
        assert r.mix_size == len((r.text or "").split()) and r.mix_taken <= 3 * r.mix_size
        sizes[r.source] = sizes.get(r.source, 0) + r.mix_size
        taken[r.source] = taken.get(r.source, 0) + r.mix_taken
        target[r.source] = r.mix_target
        assert sum(c.words for c in r.mix_copies) == r.mix_taken
    wanted = targets_by_hand(sizes)
    for source, words in sizes.items():
        assert target[source] == pytest.approx(wanted[source])
        assert abs(taken[source] - wanted[source]) <= 1
        assert all(r.mix_source_size == words for r in rows if r.source == source)


def test_mix_is_ordered_and_cut_by_words(spark):
    docs = spark.createDataFrame(rows_of({"a": 30, "b": 6, "c": 4}), SCHEMA)
    rows = mixing.mix(docs).collect()
    assert [r.mix_position for r in rows] == sorted(r.mix_position for r in rows)
    words = sum(len(r.text.split()) for r in rows)
    total = sum(len((r.text or "").split()) for r in docs.collect())
    assert abs(words - total) <= 3
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.mix(docs).collect()))


def test_positions_follow_the_schedule(spark):
    """Source c speeds up and a slows down, so a is ahead of c in the first half."""
    docs = spark.createDataFrame([(i, "w " * 10, "en", "abc"[i % 3], None, "x", 1) for i in range(300)], SCHEMA)
    rows = mixing.mix(docs).collect()
    half = max(r.mix_position for r in rows) / 2
    share = {s: sum(r.source == s and r.mix_position < half for r in rows) / sum(r.source == s for r in rows) for s in "abc"}
    assert share["a"] == pytest.approx(0.625, abs=0.03) and share["b"] == pytest.approx(0.5, abs=0.03)
    assert share["c"] == pytest.approx(0.375, abs=0.03)


def test_empty_table(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
