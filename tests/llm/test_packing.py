"""Packing: every id in one piece, windows gapless and within the capacity."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from stayspark.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id bigint, text string, length string"
TEXTS = ["", None, "one two", "Hello, WORLD! it's 12.5% <|endoftext|> don't", "ab\tc\xa0d\n\né İﬁ ...!! x_y", "word " * 3000, "Lorem ipsum, dolor. " * 900]


def whole_ids(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, texts):
    for (doc_id, text), n in texts:
        ids = whole_ids(text)
        own = sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.start)
        assert sum(r.length for r in own) == n * len(ids) and all(r.doc_tokens == len(ids) for r in own)
        for r in own:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
        if n == 1:
            assert [r.start for r in own] == list(np.cumsum([0] + [r.length for r in own])[:-1])
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    return len(windows)


def test_round_trip(spark):
    docs = [(i, t) for i, t in enumerate(TEXTS)]
    frame = spark.createDataFrame([(i, t, "clash") for i, t in docs] + [(None, "no id", "x"), (2, "one two", "x")], SCHEMA)
    rows = packing.pack(frame, windows=4).collect()
    check(rows, [(d, 2 if d[0] == 2 else 1) for d in docs] + [((None, "no id"), 1)])


def test_little_padding_at_every_size():
    lengths = np.sort(np.random.default_rng(5).integers(1, 513, 2000))[::-1]
    owner = packing.pack_group(lengths, 2048)
    sums = np.bincount(owner, weights=lengths)
    assert sums.max() <= 2048 and len(sums) <= -(-lengths.sum() // 2048) + 1
    assert sums.max() - sums.min() <= 40


def test_window_count_rises_when_pieces_do_not_fit():
    owner = packing.pack_group(np.array([1500, 1500, 1500]), 2048)
    assert len(set(owner.tolist())) == 3


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA)).count() == 0
