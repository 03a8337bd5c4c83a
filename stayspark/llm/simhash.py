"""SimHash near-duplicates by anchor points of a covering code.

A fingerprint has 64 bits in five blocks of 13, 13, 13, 13 and 12. If two fingerprints differ in at most 4
bits, then in one of the block pairs (0,1), (2,3), (2,4), (3,4) they differ in at most one bit: whatever way
four differing bits fall on five blocks, one of these pairs gets at most one. (Three blocks always hold a
pair of the list, so the pair can avoid the blocks with two or more.)

So each block pair is searched for distance 1. Its points are covered by the code Hamming(15, 11) on 15 of
its bits and all points on the rest; every point has one nearest anchor, at distance 1 at most, which is
its home. A fingerprint is replicated to every anchor within covering radius 1 plus distance 1. Two
fingerprints that differ in one bit of the pair therefore meet at the home of either, and the whole 64 bits
are compared there. Anchors hold distinct fingerprints only: copies and equal fingerprints are one member.

At an anchor the links are not expanded: small groups give their links, larger ones a spanning forest of
them, found by comparing the unvisited members with one visited member after the other. Components come
from rounds that hook each label to its least neighbour and then follow the hooks; rounds are cut by
written tables.

Null texts are empty; a text without words has fingerprint 0 and links like any other. Repeated rows share
fingerprint and component. A null id never names a component unless all its members have null ids. Columns
other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayspark.llm.common import whole, written

SHINGLE = 4
SEED = 42
MAX_BITS = 4
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
PAIRS = ((0, 1), (2, 3), (2, 4), (3, 4))
CODE_BITS = 15
SMALL_GROUP = 6


def shingle_hashes(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of all word shingles of a text, unsigned; a shorter text is one shingle, one without words has none."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - [len(w) + 1 for w in words])[:n].tolist()
    stops = (ends - 1)[min(shingle, len(words)) - 1 :].tolist()
    return np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, n)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 of all word shingles of a text, unsigned."""
    return majority(shingle_hashes(text, shingle))


def majority(hashes: np.ndarray) -> int:
    """The bits that over half of the unsigned hashes have; of none, zero."""
    n = len(hashes)
    if not n:
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 8192):
        block = hashes[at : at + 8192].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, tie): signed 64-bit fingerprint and a hash of the text, one row per input row."""

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = np.array([fingerprint(t) for t in batch["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fp": fps, "tie": batch["tie"]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", whole().alias("text"), F.xxhash64("text").alias("tie"))
    return rows.mapInPandas(compute, f"doc_id {kind}, fp bigint, tie bigint")


def _syndromes() -> np.ndarray:
    values = np.arange(1 << CODE_BITS)
    out = np.zeros(1 << CODE_BITS, np.int64)
    for i in range(CODE_BITS):
        out ^= np.where(values >> i & 1, i + 1, 0)
    return out


def anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, fingerprint) for every anchor in reach of each fingerprint; the key names block pair and anchor."""
    syndromes = _syndromes()
    flips = [[(1 << i - 1) | (1 << (i ^ s) - 1) for i in range(1, CODE_BITS + 1) if i < i ^ s] for s in range(CODE_BITS + 1)]
    keys, members = [], []
    for number, (lo, hi) in enumerate(PAIRS):
        (a, m), (b, n) = BLOCKS[lo], BLOCKS[hi]
        value = ((fps >> np.uint64(a)) & np.uint64((1 << m) - 1)) | (((fps >> np.uint64(b)) & np.uint64((1 << n) - 1)) << np.uint64(m))
        value = value.astype(np.int64)
        free = [1 << i for i in range(CODE_BITS, m + n)]
        s = syndromes[value & ((1 << CODE_BITS) - 1)]
        for syndrome in range(CODE_BITS + 1):
            own = value[s == syndrome]
            if not len(own):
                continue
            if syndrome:  # one anchor at distance 1, seven at distance 2
                step = 1 << syndrome - 1
                # Two code bits whose positions cancel the syndrome lead to an anchor at distance 2.
                reach = [step] + [step | f for f in free] + [x for x in flips[syndrome] if x != step]
            else:
                reach = [0] + free + [f | g for i, f in enumerate(free) for g in free[:i]]
            keys.append(((own[:, None] ^ np.array(reach)[None, :]) | (number << 28)).ravel())
            members.append(np.repeat(fps[s == syndrome], len(reach)))
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(keys), np.concatenate(members)


def forest(members: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect whatever the links among the members connect, fewer than there are members."""
    left, right, rest = [], [], members
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            pivot = frontier.pop()
            near = np.bitwise_count(rest ^ pivot) <= max_bits
            if near.any():
                hit, rest = rest[near], rest[~near]
                left.append(np.full(len(hit), pivot))
                right.append(hit)
                frontier.extend(hit)
    none = np.empty(0, np.uint64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def links_of_sorted(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within each run of equal keys."""
    bounds = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
    sizes = np.diff(bounds)
    small = np.repeat(sizes <= SMALL_GROUP, sizes)
    left, right = [], []
    for d in range(1, SMALL_GROUP):
        i = np.flatnonzero((keys[d:] == keys[:-d]) & small[d:])
        if not len(i):
            break
        i = i[np.bitwise_count(fps[i] ^ fps[i + d]) <= max_bits]
        left.append(fps[i])
        right.append(fps[i + d])
    for run in np.flatnonzero(sizes > SMALL_GROUP):
        a, b = forest(fps[bounds[run] : bounds[run + 1]], max_bits)
        left.append(a)
        right.append(b)
    none = np.empty(0, np.uint64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b) with a < b: links between different fingerprints of ``distinct`` (fp), enough of them to
    connect all that links connect."""

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = batch["fp"].to_numpy().view(np.uint64)
            for at in range(0, len(fps), 4096):
                keys, members = anchors(fps[at : at + 4096])
                yield pd.DataFrame({"key": keys.astype(np.int32), "fp": members.view(np.int64)})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest_keys, rest_fps = np.empty(0, np.int32), np.empty(0, np.uint64)

        def found(keys, fps):
            a, b = links_of_sorted(keys, fps, max_bits)
            a, b = a.view(np.int64), b.view(np.int64)
            pairs = pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})
            return pairs.drop_duplicates()

        for batch in batches:
            keys = np.concatenate([rest_keys, batch["key"].to_numpy(np.int32)])
            fps = np.concatenate([rest_fps, batch["fp"].to_numpy(np.int64).view(np.uint64)])
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            if cut:
                yield found(keys[:cut], fps[:cut])
            rest_keys, rest_fps = keys[cut:], fps[cut:]
        if len(rest_keys):
            yield found(rest_keys, rest_fps)

    placed = distinct.select("fp").mapInPandas(spread, "key int, fp bigint")
    met = placed.repartition("key").sortWithinPartitions("key", "fp")
    return met.mapInPandas(compare, "a bigint, b bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node that the edges (a, b) lead to, for every node that has an edge."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(both, "links")
    labels = None
    while True:
        hooks = edges.groupBy("a").agg(F.min("b").alias("least"))
        hooks = hooks.select(F.col("a").alias("node"), F.least("a", "least").alias("parent"))
        hooks = written(hooks, "hooks")
        up = hooks.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        jump = written(hooks.join(up, "parent").select("node", F.col("grand").alias("root")), "jumps")
        if labels is None:
            labels = jump
        else:
            step = jump.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = labels.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        labels = written(labels, "labels")
        a = jump.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = jump.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        moved = edges.join(a, "a").join(b, "b").where("ra <> rb")
        edges = written(moved.select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "links")
        if edges.isEmpty():
            return labels


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, tie, component_id) per row."""
    if max_bits > MAX_BITS:
        raise ValueError(f"the code covers {MAX_BITS} bits, not {max_bits}")
    rows = written(fingerprints(docs), "fingerprints")
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(links(distinct, max_bits))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(rooted.join(ids, "root").select("fp", "component_id"), "components")
    return rows.join(named, "fp").select("doc_id", "fp", "tie", "component_id")


def hexadecimal(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` with one document left of each component: the least id, of equal ids the one
    with the least text hash, of identical rows any."""
    member = near_duplicates(docs, max_bits)
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "tie")
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("fp"), F.col("fp").cast("string")))
    chosen = member.groupBy(group.alias("g")).agg(F.min(order).alias("k"))
    chosen = chosen.select(F.coalesce("k.doc_id", F.lit(0)).alias("sim_id"), F.col("k.n").alias("sim_null"), F.col("k.tie").alias("sim_tie"))
    marked = docs.withColumns({"sim_id": F.coalesce("doc_id", F.lit(0)), "sim_null": F.col("doc_id").isNull(), "sim_tie": F.xxhash64("text")})
    keys = ["sim_id", "sim_null", "sim_tie"]
    return marked.join(chosen, keys, "left_semi").dropDuplicates(keys).drop(*keys)
