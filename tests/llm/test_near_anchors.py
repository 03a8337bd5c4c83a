"""The anchors of SimHash are the first step of the near-dedup stage; what they reach is linked there."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from stayspark.llm import near, simhash
from test_near import SCHEMA, edited, kept_by_hand, shingles


def sample(rng):
    """Long texts, each beside a copy with one new word and one with many; two texts without copies."""
    texts = []
    for _ in range(6):
        words = [f"w{rng.randrange(4000)}" for _ in range(600)]
        texts += [" ".join(words), edited(rng, words, 1), edited(rng, words, 12)]
    return texts + [None, "a b c", "d e f g h i"]


def test_pairs_of_the_anchors_by_hand(spark):
    texts = sample(random.Random(3))
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    rows = near.nodes(docs).where("n > 0").cache()
    node, fp = {r.doc_id: r.node for r in rows.collect()}, {r.doc_id: r.fp & (2**64 - 1) for r in rows.collect()}
    for i in node:
        assert fp[i] == simhash.majority(np.unique(simhash.shingle_hashes(texts[i], 5)))
    expected = set()
    for i in node:
        for j in (j for j in node if j < i):
            a, b = shingles(texts[i]), shingles(texts[j])
            if (fp[i] ^ fp[j]).bit_count() <= simhash.MAX_BITS and 5 * len(a & b) >= 4 * len(a | b):
                expected.add((min(node[i], node[j]), max(node[i], node[j])))
    facts = rows.groupBy("node").agg(*[F.first(c).alias(c) for c in ("n", "bits", "fp")])
    found = {(r.a, r.b) for r in near.anchored(facts).collect()}
    assert len(expected) >= 4 and expected <= found
    of = {node[i]: i for i in node}
    assert all((fp[of[a]] ^ fp[of[b]]).bit_count() <= simhash.MAX_BITS for a, b in found)


def test_stage_links_at_the_anchors_first(spark, monkeypatch):
    texts = sample(random.Random(4))
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    steps, decide = [], near._same

    def watched(pairs, sets):
        asked = {(r.a, r.b) for r in pairs.collect()}
        links = decide(pairs, sets)
        steps.append((asked, {(r.a, r.b) for r in links.collect()}))
        return links

    monkeypatch.setattr(near, "_same", watched)
    assert {r.doc_id for r in corpus_pipeline.dedup_near(spark, docs, "").collect()} == kept_by_hand(texts)
    (asked, linked), later = steps[0], steps[1:]
    assert len(linked) >= 4 and linked <= asked
    # The copies with many new words are out of reach there, and nothing is compared twice.
    assert any(links for _, links in later) and not any(asked & pairs for pairs, _ in later)


def test_many_near_copies_of_one_fingerprint(spark):
    """Nodes of one fingerprint are compared with one of them, not each with each."""
    words = [f"c{i}" for i in range(900)]
    texts = [" ".join(words + [f"tail{i}"]) for i in range(120)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    rows = near.nodes(docs)
    facts = rows.groupBy("node").agg(*[F.first(c).alias(c) for c in ("n", "bits", "fp")])
    assert near.anchored(facts).count() < 120
    assert {r.doc_id for r in near.keep_one(docs).collect()} == {0}
