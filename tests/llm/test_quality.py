"""Base statistics against plain loops; robust estimates against numpy."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from stayspark.llm import quality

SCHEMA = "doc_id bigint, text string, lang string, source string, n_words string, x0 int"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def sample(rng, n):
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randint(2, 8))) for _ in range(400)]
    rows = []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(40, 300))]
        if i % 10 == 0:
            words = [w + rng.choice(["%%%", "###", "$$$"]) for w in words]
        text = "".join(w + rng.choice([" ", " ", "\n", "\t "]) for w in words)
        if i % 17 == 0:
            text += text
        rows.append((i, text, "en" if i % 3 else "fr", f"s{i % 2}", "clash", 1))
    return rows


def test_statistics_and_outliers(spark, monkeypatch):
    rng = random.Random(8)
    rows = sample(rng, 900)
    rows += [(900, None, None, None, "c", 1), (901, "", "en", None, "c", 1), (902, "a b c a b c", "en", "s0", "c", 1), (None, "x", "", "s0", "c", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    judged = quality.judge(docs).collect()
    assert len(judged) == len(rows)
    by_id = {r.doc_id: r for r in judged}
    for doc_id, text, *_ in rows:
        r = by_id[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(text)
        if r.base_failed:
            assert not r.kept
        elif doc_id % 10 == 0:
            assert not r.kept
        else:
            assert r.kept
    kept = quality.keep(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in by_id.items() if r.kept)


def test_estimates_against_numpy(spark):
    docs = spark.createDataFrame(sample(random.Random(3), 700), SCHEMA)
    stats = quality.statistics(quality._named(docs)).cache()
    pools, params = quality.estimates(stats)
    pool_of = {(r.qr_lang, r.qr_source): r.pool for r in pools.collect()}
    rows = [r for r in stats.collect() if not r.base_failed]
    for p in params.collect():
        x = np.array([[r.asDict()[c] for c in quality.X] for r in rows if pool_of[r.qr_lang, r.qr_source] == p.pool])
        assert p.n_fit == len(x)
        rounded = np.sort(np.floor(x * 200 + 0.5), axis=0)
        q = [rounded[int(np.ceil(s * len(x))) - 1] for s in (0.25, 0.5, 0.75)]
        floor = np.diag(np.square(quality.FLOOR))
        mean, cov = q[1] / 200, np.diag(((q[2] - q[0]) / 200 / 1.349) ** 2) + floor
        for _ in range(quality.STEPS):
            d2 = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
            bins = np.floor(16 * np.log(d2 + 1e-4))
            inside = x[bins <= np.sort(bins)[int(np.ceil(quality.SUBSET * len(x))) - 1]]
            mean, cov = inside.mean(axis=0), quality.CORRECTION * np.cov(inside.T, bias=True) + floor
        found = np.array([[p[f"l{i}{j}"] if j <= i else 0.0 for j in range(4)] for i in range(4)])
        assert [p[f"m{i}"] for i in range(4)] == pytest.approx(mean, abs=1e-6)
        assert found @ found.T == pytest.approx(cov, abs=1e-6)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert quality.judge(docs).count() == 0 and quality.keep(docs).count() == 0
