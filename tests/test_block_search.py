"""Batches that travel with the tasks score whole blocks of documents: same results as all pairs, few rows onwards."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from stayspark.functions import text
from stayspark.operators import search

WORDS = ["bodies", "aies", "eies", "shoes", "trees", "aes", "bus", "glass", "es", "s", "ies", "a", "é", "ปลา", "żółwies", "𝒳ys", "rooms"]


def world(spark):
    rows = [(i, f"Inn {i % 4}", f"c{i % 5}", " ".join(WORDS[j % 17] for j in range(i, i * 3 + 1)), None if i % 3 else "ห้องพัก ปลา x", 50.0 + i % 9) for i in range(40)]
    rows += [rows[7], rows[7], (8, "Inn", "c9", "bodies extra", None, 99.0), (90, None, None, None, None, None), (91, "", " ", "the of", "", 60.0)]
    docs = spark.createDataFrame(rows, "id long, name string, city string, description string, description_alt string, price_per_night double")
    asked = [(1, "bodies shoes", "en"), (2, "ปลา trees", "th"), (3, "inn 2 rooms the", "en"), (4, "unknown", "en"), (5, "glass glass bus", "th-TH"), (6, " ", None), (7, "ห้อง", "th"),
             (8, "inn aies", "en"), (8, "inn aies", "en")]
    return docs, spark.createDataFrame(asked, "query_id long, q string, lang string")


def test_words_become_the_same_terms_in_tasks(spark):
    made = spark.createDataFrame([(w,) for w in WORDS], "w string").select("w", text.stem(F.col("w")).alias("s"), text.pairs(F.col("w")).alias("p"))
    for r in made.collect():
        assert (text.stem_of(r.w), text.pairs_of(r.w)) == (r.s, r.p)


def test_forward_rows_hold_every_posting_once(spark):
    docs, _ = world(spark)
    want = Counter()
    for r in docs.collect():
        for f in ("name", "city", "description", "description_alt"):
            for w in (r[f] or "").lower().split():
                terms = text.pairs_of(w) if f.endswith("_alt") else [] if w in text.STOP_WORDS else [text.stem_of(w)]
                want.update((r.id, f, t) for t in terms)
    lengths = Counter()
    for (i, f, _), n in want.items():
        lengths[i, f] += n
    got = [((r.doc_id, r.field, r.term), r.tf, r.len) for r in search.postings_of(docs).collect()]
    assert len(got) == len(want) and all(tf == want[k] and n == lengths[k[:2]] for k, tf, n in got)
    assert search.postings_of(docs.limit(0)).count() == 0


def test_explained_search_equals_counts_over_all_scores(spark, monkeypatch):
    docs, asked = world(spark)
    index = search.build_index(docs)
    want = search.explain_fields(search.field_scores(index, asked)).collect()
    monkeypatch.setattr(search, "TILE", 3)
    monkeypatch.setattr(search, "BLOCK", 4)
    monkeypatch.setattr(search, "field_scores", lambda *_: pytest.fail("a row per query, document and field"))
    got = search.explain_search(index, asked).collect()
    assert got and {tuple(r) for r in got} == {tuple(r) for r in want} and len(got) == len(want)
    assert search.explain_search(index, asked.limit(0)).count() == 0


@pytest.mark.parametrize("filters", [(), ("city",), ("min_price", "max_price"), ("city", "min_price", "max_price")])
def test_block_search_equals_bounded_search(spark, monkeypatch, filters):
    docs, asked = world(spark)
    q = F.col("query_id")
    values = {"city": F.when(q % 3 == 0, F.lit("c1")).when(q % 3 == 1, F.lit(" ")).otherwise(F.lit("C2 c3")),
              "min_price": F.when(q % 2 == 0, F.lit(52.0)), "max_price": F.when(q != 1, F.lit(57.0))}
    asked = asked.withColumns({c: values[c] for c in filters}).filter("query_id <> 6")
    index = search.build_index(docs)
    monkeypatch.setattr(search, "TILE", 3)
    monkeypatch.setattr(search, "BLOCK", 4)
    got = [tuple(r) for r in search.search(index, docs, asked, k=4).collect()]
    monkeypatch.setattr(search, "BATCH_QUERIES", 0)
    want = [tuple(r) for r in search.search(index, docs, asked, k=4).collect()]
    assert got and sorted(got) == sorted(want)


def test_tasks_send_k_rows_a_query_onwards(spark):
    docs, asked = world(spark)
    index = search.build_index(docs)
    weights = search._weights(index, asked)
    hits = search.block_hits(index, search._travelling(weights), weights, 2)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan.replace("CartesianProduct", "Join") and hits.count() <= 2 * 8 * hits.rdd.getNumPartitions()
