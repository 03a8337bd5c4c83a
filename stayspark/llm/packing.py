"""Packing token sequences by multiway Karmarkar-Karp differencing.

A document's tokens, ended by ``end_id``, are cut into full windows of ``capacity`` and a rest; the rest is
cut into pieces of at most ``piece`` tokens. Full windows are sequences of their own. The other pieces are
dealt by hash into groups of about ``windows`` windows. A group starts with as many windows as its tokens
need; every piece is a partial partition, and the two partial partitions with the largest imbalance are
merged, the large windows of one onto the small windows of the other, until one is left. If a window is
beyond the capacity, the window count rises and the group is packed again. No group grows with the data,
and a long document's pieces are spread over the groups.

A null text is empty and gives the one token ``end_id``. Repeated rows are packed each. An empty table
gives no rows. Only ``doc_id`` and ``text`` are read.

Words between ASCII blanks are encoded once and kept in a bounded table per task: the vocabulary file
drops white space and never joins across it.
"""

from __future__ import annotations

import heapq
import math
import sys
import types
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayspark.llm.common import whole, written

CAPACITY = 2048
PIECE = 512
WINDOWS = 256
CACHE_WORDS = 1_300_000
#: ASCII punctuation that never joins a letter run; an apostrophe may.
PUNCTUATION = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Little-endian 32-bit ids of a text, as bytes.

    Words are looked up; a new word is encoded alone, or put together from the word without its closing
    punctuation (the vocabulary's splitter always cuts there), or from its lower case if it is ASCII.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer, self.cache, self.limit = Tokenizer.from_file(path), {}, cache_words

    def word(self, word: str) -> bytes:
        ids = self.cache.get(word)
        if ids is None:
            core = word.rstrip(PUNCTUATION)
            if core != word and core.isalpha():
                ids = self.word(core) + self.word(word[len(core) :])
            elif word.isascii() and word.lower() != word:
                ids = self.word(word.lower())
            else:
                ids = np.asarray(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
            self.cache[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if len(self.cache) > self.limit:
            self.cache.clear()
        parts = text.replace("\n", " ").split(" ")
        ids = list(map(self.cache.get, parts))
        if None in ids:
            ids = [self.word(p) if i is None else i for p, i in zip(parts, ids, strict=True)]
        return b"".join(ids)


def worker_encoder(path: str) -> Encoder:
    """The encoder of this Python worker: later tasks of the same worker go on with its table of words.

    Functions are shipped by value, so the module they come from doesn't outlive a task; a name among the
    loaded modules does.
    """
    kept = sys.modules.setdefault("stayspark_worker_encoders", types.ModuleType("stayspark_worker_encoders"))
    if path not in vars(kept):
        vars(kept)[path] = Encoder(path)
    return vars(kept)[path]


def differencing(lengths: np.ndarray, k: int) -> tuple[np.ndarray, int]:
    """Window of each item when the items are differenced into k windows, and the fullest window's sum."""
    n = len(lengths)
    left, right, base = [], [], n  # a merged window is a node with two children
    # A partial partition: sums of its windows that are not empty, descending, and their nodes.
    parts: list = [(lengths[i : i + 1], np.array([i])) for i in range(n)]
    heap = [(-int(lengths[i]), i) for i in range(n)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, i = heapq.heappop(heap)
        _, j = heapq.heappop(heap)
        (s, a), (t, b) = parts[i], parts[j]
        parts[i] = parts[j] = None
        both = len(s) + len(t) - k
        if both > 0:  # largest of one onto smallest of the other
            x, y = len(s) - both, len(t) - both
            sums = np.concatenate([s[:x], s[x:] + t[y:][::-1], t[:y]])
            nodes = np.concatenate([a[:x], np.arange(base, base + both), b[:y]])
            left.append(a[x:])
            right.append(b[y:][::-1])
            base += both
        else:
            sums, nodes = np.concatenate([s, t]), np.concatenate([a, b])
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        least = int(sums[-1]) if len(sums) == k else 0
        heapq.heappush(heap, (least - int(sums[0]), len(parts)))
        parts.append((sums, nodes))
    sums, nodes = parts[-1]
    owner = np.full(base, -1)
    owner[nodes] = np.arange(len(nodes))
    if left:
        a, b = np.concatenate(left), np.concatenate(right)
        for node in range(base - n - 1, -1, -1):  # parents come after their children
            owner[a[node]] = owner[b[node]] = owner[n + node]
    return owner[:n], int(sums[0])


def pack_group(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Window of each piece, no window beyond the capacity."""
    k = max(1, math.ceil(int(lengths.sum()) / capacity))
    while True:
        owner, fullest = differencing(lengths, k)
        if fullest <= capacity:
            return owner
        k += 1


def tokenised_pieces(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY, piece: int = PIECE) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens) per piece."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    end = np.asarray([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zlib

        encoder = worker_encoder(tokenizer)
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = encoder.encode(text) + end
                n, at = len(ids) // 4, 0
                while at < n:
                    size = capacity if n - at >= capacity else min(piece, n - at)
                    for column, value in zip(rows, (doc_id, at, size, zlib.crc32(ids[4 * at : 4 * (at + size)]), n), strict=True):
                        column.append(value)
                    at += size
            names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
            out = pd.DataFrame(dict(zip(names, rows, strict=True)))
            out["doc_id"] = out["doc_id"].astype("Int64") if kind == "bigint" else out["doc_id"]
            yield out

    source = docs.select("doc_id", whole().alias("text"))
    return source.mapInPandas(cut, f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1, capacity: int = CAPACITY, piece: int = PIECE, windows: int = WINDOWS) -> DataFrame:
    """One row per piece with its sequence and the offset there."""
    pieces = written(tokenised_pieces(docs, tokenizer or default_tokenizer(), end_id, capacity, piece), "pack-pieces")
    tokens = pieces.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()["n"]
    groups = max(1, round(tokens / (windows * capacity)))
    # Ids that recur are told apart by what the pieces hold, so one id's rows are spread as well.
    pieces = pieces.withColumn("pack_group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)))

    def one(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable", ignore_index=True)
        lengths = group["length"].to_numpy()
        full = int((lengths == capacity).sum())
        owner = np.arange(len(lengths))
        if full < len(lengths):
            owner[full:] = full + pack_group(lengths[full:], capacity)
        order = np.argsort(owner, kind="stable")
        ends = np.cumsum(lengths[order])
        first = np.r_[True, owner[order][1:] != owner[order][:-1]]
        begin = (ends - lengths[order])[first][np.cumsum(first) - 1]
        offset = np.empty(len(lengths), np.int64)
        offset[order] = ends - lengths[order] - begin
        group["sequence_id"] = group["pack_group"] * (1 << 31) + owner
        group["offset"] = offset
        return group.drop(columns="pack_group")

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return pieces.groupBy("pack_group").applyInPandas(one, schema)
