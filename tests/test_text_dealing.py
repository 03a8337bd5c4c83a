"""Tasks that analyse texts get so many characters each, whatever the table holds."""

from __future__ import annotations

from stayspark.operators import search, vectors
from stayspark.sources import tables


def test_texts_are_dealt_out_by_their_characters(spark):
    texts = spark.createDataFrame([(i, "word " * 20, None) for i in range(50)], "id long, text string, other string")
    dealt = tables.dealt_by_text(texts, "id", ["text", "other"], 250)
    assert dealt.rdd.getNumPartitions() == 20 and dealt.count() == 50
    cores = spark.sparkContext.defaultParallelism
    assert tables.dealt_by_text(texts, "id", ["text"]).rdd.getNumPartitions() == cores
    assert tables.dealt_by_text(texts.limit(0), "id", ["text"]).rdd.getNumPartitions() == cores


def test_embedding_and_index_tasks_keep_their_size(spark, monkeypatch):
    monkeypatch.setattr(tables.dealt_by_text, "__defaults__", (100,))
    texts = spark.createDataFrame([(i, "word " * 20) for i in range(50)], "id long, description string")
    assert vectors.embed_words(texts, "id", "description", 8).rdd.getNumPartitions() == 50
    assert search.postings_of(texts).rdd.getNumPartitions() == 50
