"""Near copies of the pipeline's stage against the Jaccard similarity of all pairs."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stayspark.llm import near, simhash

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def kept_by_hand(texts):
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if (a == b or 5 * len(a & b) >= 4 * len(a | b)) and root[i] != root[j]:
                least, other = sorted((root[i], root[j]))
                root = [least if r == other else r for r in root]
    return set(root)


def edited(rng, words, n):
    out = list(words)
    for at in rng.sample(range(len(out)), n):
        out[at] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


def texts_of(rng):
    texts = [None, "", "a", "a b c", "A  b c", "a b c d e", "a b c d e f"]
    for n in (30, 60, 120, 400):
        for _ in range(4):
            words = [f"w{rng.randrange(4000)}" for _ in range(n)]
            texts.append(" ".join(words))
            for edits in (1, 1, 2, 3, 5, 8):
                texts.append(edited(rng, words, min(n, edits * n // 120 + 1)))
    base = [f"b{i}" for i in range(100)]
    texts += [edited(rng, base, rng.choice([1, 2, 3])) for _ in range(40)]
    # A chain of which only neighbours are alike, and many texts that share a beginning only.
    texts += [" ".join(f"c{i}" for i in range(at, at + 100)) for at in range(0, 60, 9)]
    return texts + [" ".join(base[:12] + [f"u{k}x{i}" for i in range(20)]) for k in range(30)]


def test_stage_against_all_pairs(spark):
    texts = texts_of(random.Random(8))
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    kept = kept_by_hand(texts)
    assert {r.doc_id for r in corpus_pipeline.dedup_near(spark, docs, "").collect()} == kept
    assert {r.doc_id for r in simhash.keep_one(docs).collect()} != kept


def test_any_number_of_pivots_gives_the_same(spark):
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts_of(random.Random(9))[-80:])], SCHEMA)
    rows = near.nodes(docs).cache()
    one, many = ({r.node: r.root for r in near.links(docs, rows, n).collect()} for n in (1, 1000))
    assert one == many and len(one) > 20


def test_prefixes_by_hand(spark):
    """Rare even elements first, then odd ones; a pair at similarity 0.8 shares one of its prefix."""
    texts = texts_of(random.Random(10))[-90:]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    sets = {near._node(s): [int(x) for x in s] for t in texts for s in [np.unique(simhash.shingle_hashes(t or "", 5).view(np.int64))]}
    rows, of = Counter(), {}
    for t in texts:
        s = np.unique(simhash.shingle_hashes(t or "", 5).view(np.int64))
        for x in s.tolist():
            rows[x] += 1
            of.setdefault(x, set()).add(near._node(s))
    expected = set()
    for node, found in sets.items():
        order = sorted(found, key=lambda x: (x & 1, len(of[x]) > 1 and not x & 1, 0 if x & 1 or len(of[x]) == 1 else rows[x], x))
        size = len(found) - -(-len(found) * 4 // 5) + 1 if found else 0
        expected |= {(x, node, len(found), i) for i, x in enumerate(order[:size]) if len(of[x]) > 1}
    facts = near.nodes(docs).where("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.first("even").alias("even"), F.first("bits").alias("bits"))
    assert {tuple(r)[:4] for r in near.prefixes(near.elements(docs), facts).collect()} == expected


def test_signatures_bound_what_is_common():
    rng = np.random.default_rng(3)
    for n in (5, 80, 400, 3000):
        a = np.unique(rng.integers(-(2**63), 2**63 - 1, n))
        b = np.unique(np.r_[a[: n // 2], rng.integers(-(2**63), 2**63 - 1, n // 2)])
        only = np.bitwise_count(near.signature(a).view(np.uint64) & ~near.signature(b).view(np.uint64)).sum()
        assert len(np.intersect1d(a, b)) <= len(a) - only and (n > 400 or only > 0)


def test_shared_passages_make_few_candidates(spark):
    """Texts that repeat a passage which fills under a third of them have no shared element in their prefixes."""
    passage = " ".join(f"p{i}" for i in range(100))
    texts = [" ".join(f"t{k}x{i}" for i in range(300)) + " " + passage for k in range(200)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    facts = near.nodes(docs).groupBy("node").agg(F.first("n").alias("n"), F.first("even").alias("even"), F.first("bits").alias("bits"))
    assert near.prefixes(near.elements(docs), facts).count() == 0
    assert near.keep_one(docs).count() == 200


def test_counts_and_join_share_one_shuffle(spark):
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts_of(random.Random(11)))], SCHEMA)
    facts = near.nodes(docs).groupBy("node").agg(F.first("n").alias("n"), F.first("even").alias("even"), F.first("bits").alias("bits"))
    found = near.prefixes(near.elements(docs), facts)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final


def test_clashing_names_pass_through(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 7, "x"), (2, "a b c d e f", 8, "y"), (1, None, 9, "z")], "doc_id bigint, text string, near_id int, near_key string")
    assert {tuple(r) for r in near.keep_one(docs).collect()} == {(1, None, 9, "z"), (1, "a b c d e f", 7, "x")}


def test_a_third_of_all_rows_equal(spark):
    docs = spark.createDataFrame([(i % 7 or None, "m n o p q r s", "en", "s", 1) for i in range(300)] + [(1000 + i, f"u{i} v w x y z", "en", "s", 1) for i in range(50)], SCHEMA)
    assert near.keep_one(docs).count() == 51


def test_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "x y", "en", "s", 1), (None, "x y", "en", "s", 1), (7, "X  y", "en", "s", 1), (None, "p q r s t u", "en", "s", 1)], SCHEMA)
    assert sorted(str(r.doc_id) for r in near.keep_one(docs).collect()) == ["7", "None"]
    assert near.keep_one(spark.createDataFrame([], SCHEMA)).count() == 0


def test_radius_beyond_the_cover_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.near_duplicates(spark.createDataFrame([], SCHEMA), 5)
