"""Bounded samples of the learned operators: class ratio, and ids that are null or equal."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from stayspark.llm import language, toxicity
from test_learned import SCHEMA, labelled


def mean_offset(spark, n, sample):
    """Log-odds that texts without a known word get, learned from the first ``n`` of the same labelled rows."""
    rows, labels, _ = labelled(random.Random(4), n)
    docs, known = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    return toxicity.fit(docs, known.select("doc_id", "toxic"), sample)


def test_offset_is_the_same_below_and_above_the_sample(spark):
    # 20 % are toxic. Beyond 300 rows of either class the sample alone would say 50 %.
    (_, all_rows), (_, capped) = (mean_offset(spark, 3000, s) for s in (5000, 300))
    assert abs(all_rows - capped) < 0.5
    none = np.zeros(0, np.float32)
    assert toxicity.train([""] * 4, np.array([0, 0, 1, 1], np.float32), np.array([4.0, 4.0, 1.0, 1.0]))[1] < -1.2
    assert toxicity.train([], none, none)[1] < 0


def test_documents_of_one_sampled_id_are_bounded(spark, monkeypatch):
    rows, labels, _ = labelled(random.Random(5), 100)
    docs = spark.createDataFrame(rows, SCHEMA)
    many = docs.unionByName(docs.where("doc_id = 3").crossJoin(spark.range(4000).select(F.col("id").alias("n"))).drop("n"))
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").select("doc_id", "toxic")
    # The offset tells how many rows were learned from.
    monkeypatch.setattr(toxicity, "train", lambda texts, y, w: (np.zeros(1, np.float32), float(len(texts)) + w.sum() / 1e6))
    learned = toxicity.fit(many, known, 200)[1]
    assert 300 < int(learned) < 520 and abs((learned % 1) * 1e6 - 4100) < 1


def test_language_sample_is_bounded_for_null_and_equal_ids(spark, monkeypatch):
    word = lambda i: "".join("abcdefghij"[int(c)] for c in str(i))
    rows = [(None, f"the cat {word(i)}", "en") for i in range(3000)] + [(None, "the dog", "en")] * 1500 + [(8, f"der hund {word(i)}", "de") for i in range(3000)]
    # The floor tells how many rows the centroids were fitted on.
    monkeypatch.setattr(language, "cluster", lambda x, k: (x[:1], float(len(x))))
    model = language.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), 300)
    assert model.names == ["de", "en"] and all(200 < n < 400 for n in model.floors)
