"""Fingerprints and components against all pairs."""

from __future__ import annotations

import random

import numpy as np
import xxhash

from stayspark.llm import simhash

SCHEMA = "doc_id bigint, text string, fp string, key int"


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots_by_hand(fps, bits=4):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def test_pairs_within_four_bits_always_meet():
    rng = random.Random(3)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for bit in rng.sample(range(64), rng.randint(0, 4)):
            y ^= 1 << bit
        a, b = (set(simhash.anchors(np.array([v], np.uint64))[0].tolist()) for v in (x, y))
        assert a & b
        assert len(a) == len(simhash.anchors(np.array([x], np.uint64))[0])


def test_links_connect_random_clusters(spark):
    rng = random.Random(11)
    fps = [0]
    for _ in range(40):
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 3, 40])):
            centre ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5)))
            fps.append(centre)
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    frame = spark.createDataFrame([(f,) for f in set(signed)], "fp bigint")
    found = {r.node: r.root for r in simhash.components(simhash.links(frame)).collect()}
    by_hand = roots_by_hand(fps)
    got = [found.get(f, f) for f in signed]
    assert len(set(zip(by_hand, got, strict=True))) == len(set(by_hand)) == len(set(got))


def test_documents_against_all_pairs(spark):
    rng = random.Random(2)
    vocabulary = ["W%d" % i for i in range(500)] + ["é", " x"]
    texts = [None, "", " \t\n", "a", "a b c", "A  B\tc d e", "a b c d e"]
    for _ in range(25):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(5, 400))]
        texts.append(" ".join(words))
        for _ in range(rng.randint(0, 3)):
            copy = list(words)
            copy[rng.randrange(len(copy))] = "changed"
            texts.append("\n".join(copy))
    docs = spark.createDataFrame([(i * 3, t, "clash", 1) for i, t in enumerate(texts)] + [(3, "", "again", 1)], SCHEMA)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(texts) + 1
    fps = [plain_fingerprint(t) for t in texts]
    by_hand = roots_by_hand(fps)
    for r in rows:
        i = r.doc_id // 3
        assert r.fp % 2**64 == fps[i] and r.component_id == 3 * by_hand[i]
    kept = simhash.keep_one(docs).collect()
    assert sorted(r.doc_id for r in kept) == sorted({3 * x for x in by_hand})
    assert kept[0].asDict().keys() == {"doc_id", "text", "fp", "key"}


def test_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "x y", "a", 1), (None, "x y", "a", 1), (7, "x y", "a", 1), (None, "p q r s t u", "a", 1)], SCHEMA)
    rows = simhash.near_duplicates(docs).collect()
    assert sorted(str(r.component_id) for r in rows) == ["7", "7", "7", "None"]
    assert sorted(str(r.doc_id) for r in simhash.keep_one(docs).collect()) == ["7", "None"]
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0
