"""Near copies by exact Jaccard similarity of the sets of word shingles.

Texts of equal sets are one node. Two nodes are linked if the Jaccard similarity of their sets of ``SHINGLE``
words is ``SHARE`` at least, and groups are the components of these links.

The links come in two steps. First SimHash: sets have fingerprints (majority bits of their elements), which meet at the anchors of the
covering code in ``simhash``; pairs of nodes whose fingerprints differ in few bits are compared as whole sets, and those that are
alike enough are linked. Four bits of 64 reach a similarity of about 0.96, so the second step finds the other links by an exact prefix
filter; it compares no pair again and none that the first step has put into one component.

No link is missed by the second step: if the similarity is t at least, two sets have at least ceil(t n) elements of either in common
(n its size), so in any one order of all elements the first n - ceil(t n) + 1 of both share an element. The order taken
here puts rare elements first: even hashes before odd ones; of the even ones those of a single node first, the others by rising number
of rows that have them, then by hash; odd ones by hash. A passage that many texts repeat stands at the end of their
orders and is hardly ever reached. Only even elements are counted (odd ones serve sets that have too few even ones), which halves what is
shuffled. A pair is a candidate at an element only if the places of that element in both orders leave room for enough
common elements behind it: the first common element of a linked pair always does. Signatures of ``BITS`` bits bound from above what two
sets can have in common (a bit that only one of them has costs it an element), which rules out most pairs that are merely somewhat
alike. A pair that shares several of its first ``HEAD`` prefix elements is a candidate at the first of them only.

Pairs within an element are not all expanded. In rounds the least ``PIVOTS`` nodes of every element, four times as many each round,
are compared with its other nodes and then leave it; nodes that are in one component by then are not compared. Candidates
are decided by their whole sets, which are made again from the texts of the nodes that share an element, once.

Null texts are empty; texts without words are equal, one node. Words are as in ``simhash``. Elements and sets are known by
64-bit hashes. Null ids and ids that repeat are told apart by the text's hash; of identical rows one stays. An empty table gives no rows.
Other columns pass through, those that start with ``near_`` too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayspark.llm import simhash
from stayspark.llm.common import forget, whole, written
from stayspark.llm.simhash import SEED, components, shingle_hashes

SHINGLE = 5
#: Least similarity as a fraction of whole numbers, so that no rounding decides.
SHARE = (4, 5)
PIVOTS = 2
CHUNK = 256
#: Bits of a signature (in longs of 64), and prefix elements by which a pair is met once.
BITS = 512
HEAD = 12


def _texts(docs: DataFrame, *columns: Column) -> DataFrame:
    return docs.select(*columns, whole().alias("text"))


def _sets(batches: Iterator[pd.DataFrame], shingle: int) -> Iterator[tuple[pd.DataFrame, list[np.ndarray]]]:
    """Parts of the rows with the sorted set of each text."""
    for batch in batches:
        for at in range(0, len(batch), CHUNK):
            part = batch.iloc[at : at + CHUNK]
            yield part, [np.unique(shingle_hashes(t, shingle).view(np.int64)) for t in part["text"]]


def _node(found: np.ndarray) -> int:
    from xxhash import xxh64_intdigest

    return int(np.uint64(xxh64_intdigest(found.tobytes(), SEED)).view(np.int64))


def signature(found: np.ndarray) -> np.ndarray:
    """``BITS`` bits as longs: the bit of every element, by its upper bits."""
    bits = np.zeros(BITS, np.uint8)
    bits[(found.view(np.uint64) >> np.uint64(20)) % np.uint64(BITS)] = 1
    return np.packbits(bits).view(np.int64)


def nodes(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, tie, node, n, even, bits, fp): hash of the text, hash of its set, its size, number of even hashes, signature and
    SimHash fingerprint of the set, a row per input row."""

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, sets in _sets(batches, shingle):
            facts = {"node": [_node(s) for s in sets], "n": [len(s) for s in sets], "even": [int((s & 1 == 0).sum()) for s in sets], "bits": [signature(s) for s in sets]}
            facts["fp"] = np.array([simhash.majority(s.view(np.uint64)) for s in sets], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": part["doc_id"], "tie": part["tie"]} | {k: pd.Series(v, part.index) for k, v in facts.items()})

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = _texts(docs, F.col("doc_id"), F.xxhash64("text").alias("tie"))
    return rows.mapInPandas(compute, f"doc_id {kind}, tie bigint, node bigint, n int, even int, bits array<bigint>, fp bigint")


def prefix_size(n: Column | np.ndarray):
    """n - ceil(t n) + 1, in whole numbers."""
    top, below = SHARE
    if isinstance(n, Column):
        return n - F.expr(f"(n * {top} + {below - 1}) div {below}").cast("int") + 1
    return n - (n * top + below - 1) // below + 1


def elements(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(node, element, fill): all even hashes of each text (fill -1), and, where they are too few for the prefix, the first odd
    ones with their places among the odd ones."""

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, sets in _sets(batches, shingle):
            node, element, fill = [], [], []
            for s in sets:
                even, odd = s[s & 1 == 0], s[s & 1 == 1]
                odd = odd[: max(0, prefix_size(len(s)) - len(even))] if len(s) else odd
                node.append(np.full(len(even) + len(odd), _node(s)))
                element += [even, odd]
                fill += [np.full(len(even), -1), np.arange(len(odd))]
            yield pd.DataFrame({"node": np.concatenate(node), "element": np.concatenate(element), "fill": np.concatenate(fill).astype(np.int32)})

    return _texts(docs).mapInPandas(compute, "node bigint, element bigint, fill int")


def prefixes(found: DataFrame, facts: DataFrame) -> DataFrame:
    """(key, node, n, place, head, bits): the elements in the prefixes of their nodes that several nodes share; ``head``, the first
    few of a node's.

    ``facts``: node, n, even, bits; one row per node.
    """
    # One shuffle serves both the counts and the join with them; the filter keeps their plans equal below it.
    dealt = found.where("element is not null and node is not null").repartition("element")
    counts = dealt.groupBy("element").agg(F.count_if(F.col("fill") < 0).alias("rows"), F.min("node").alias("a"), F.max("node").alias("b"))
    shared = dealt.join(counts.where("a < b").select("element", "rows"), "element")
    # What is gathered per node is no longer than its text.
    gathered = shared.groupBy("node").agg(F.array_sort(F.collect_set(F.struct("rows", "element", "fill"))).alias("s"))
    even = F.filter("s", lambda x: x["fill"] < 0)
    alone = F.col("even") - F.size(even)  # even elements of this node only come first
    reached = F.greatest(F.lit(0), F.least(prefix_size(F.col("n")), F.col("even")) - alone)
    first = F.transform(F.slice(even, F.lit(1), reached), lambda x, i: F.struct(x["element"].alias("key"), (alone + i).alias("place")))
    odd = F.transform(F.filter("s", lambda x: x["fill"] >= 0), lambda x: F.struct(x["element"].alias("key"), (F.col("even") + x["fill"]).alias("place")))
    listed = gathered.join(facts, "node").select("node", "n", "bits", F.concat(first, odd).alias("xs"))
    head = F.transform(F.slice("xs", 1, HEAD), lambda x: x["key"])
    placed = listed.select("node", "n", "bits", head.alias("head"), F.explode("xs").alias("x"))
    return placed.select("x.key", "node", "n", F.col("x.place").alias("place"), "head", "bits")


def enough(common: Column) -> Column:
    """Whether so many common elements make a link of the nodes with n_a and n_b."""
    top, below = SHARE
    return common * (top + below) >= (F.col("n_a") + F.col("n_b")) * top


def anchored(facts: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b): pairs that SimHash proposes, not yet compared. Nodes of one fingerprint are paired with its least node,
    which also stands for it where ``simhash.links`` finds fingerprints within its radius at an anchor.

    ``facts``: node, n, bits, fp; one row per node.
    """
    least = written(facts.groupBy("fp").agg(F.min("node").alias("a")), "near-fingerprints")
    equal = facts.select("fp", F.col("node").alias("b")).join(least, "fp").where("a <> b").select("a", "b")
    first, second = (least.select(F.col("fp").alias(fp), F.col("a").alias(node)) for fp, node in (("a", "x"), ("b", "y")))
    close = simhash.links(least.select("fp")).join(first, "a").join(second, "b")
    pairs = equal.unionAll(close.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))
    for side in "ab":
        pairs = pairs.join(facts.select(*[F.col(c).alias(to) for c, to in (("node", side), ("n", f"n_{side}"), ("bits", f"bits_{side}"))]), side)
    return pairs.where(enough(F.least("n_a", "n_b")) & _room()).select("a", "b", "n_a", "n_b")


def _room() -> Column:
    """Whether the signatures leave room for enough common elements."""
    return enough(F.least(*[F.col(f"n_{x}") - _only(f"bits_{x}", f"bits_{y}") for x, y in ("ab", "ba")]))


def _same(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The links among ``pairs``, decided by whole sets, as a table. A pair without a set shares no prefix element: no link."""
    whole_a, whole_b = sets.select(F.col("node").alias("a"), F.col("hashes").alias("h_a")), sets.select(F.col("node").alias("b"), F.col("hashes").alias("h_b"))
    both = pairs.join(whole_b, "b").join(whole_a, "a").withColumn("common", F.size(F.array_intersect("h_a", "h_b")))
    return written(both.where(enough(F.col("common"))).select("a", "b"), "near-links")


def links(docs: DataFrame, rows: DataFrame, pivots: int = PIVOTS, shingle: int = SHINGLE) -> DataFrame:
    """(node, root) for every node that a link connects with another.

    ``rows``: the ``nodes`` of ``docs``.
    """
    facts = rows.where("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.first("even").alias("even"), F.first("bits").alias("bits"), F.first("fp").alias("fp"))
    facts = written(facts, "near-facts")
    keys = written(prefixes(elements(docs, shingle), facts).withColumn("root", F.col("node")), "near-keys")
    keys = _shared(keys, "node")
    sets = written(_whole_sets(docs, rows, keys, shingle), "near-sets")
    # What meets at the anchors first; the rounds below need not compare it again.
    checked = written(anchored(facts), "near-anchored")
    found = _same(checked, sets)
    checked, labels = checked.select("a", "b"), components(found)
    left = _rooted(keys, labels)
    forget(keys)
    keys = left
    while not keys.isEmpty():
        turn = F.row_number().over(Window.partitionBy("key").orderBy("node"))
        first = written(keys.withColumn("turn", turn).where(F.col("turn") <= pivots).drop("turn"), "near-pivots")
        a, b = (keys_of.withColumnsRenamed({c: f"{c}_{side}" for c in ("n", "place", "head", "bits", "root")} | {"node": side}) for side, keys_of in (("a", first), ("b", keys)))
        pairs = b.join(a, "key").where("a < b and root_a <> root_b")
        # The element itself, and what follows it in the shorter rest.
        pairs = pairs.where(enough(F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))))
        pairs = pairs.where(_room())
        met = F.array_intersect("head_a", "head_b")
        pairs = pairs.where((F.size(met) == 0) | (F.element_at(met, 1) == F.col("key"))).select("a", "b", "n_a", "n_b").distinct()
        pairs = written(pairs.join(checked, ["a", "b"], "left_anti"), "near-pairs")
        checked = checked.unionAll(pairs.select("a", "b"))
        found = found.unionAll(_same(pairs, sets))
        before, labels = labels, components(found)
        # What is left of each element: nodes behind its pivots, unless one component holds them all.
        last = first.groupBy("key").agg(F.max("node").alias("last"))
        rest = keys.join(last, "key").where("node > last").drop("last")
        left = _rooted(rest, labels)
        forget(keys, first, before)
        keys = left
        pivots *= 4
    forget(sets, facts)
    return labels


def _rooted(keys: DataFrame, labels: DataFrame) -> DataFrame:
    """The keys with the roots of ``labels``, as far as one component does not hold all nodes of a key."""
    rooted = keys.drop("root").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return _shared(written(rooted, "near-rest"), "root")


def _only(bits: str, others: str) -> Column:
    """Bits of one signature that the other lacks."""
    missing = F.zip_with(bits, others, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y))))
    return F.aggregate(missing, F.lit(0), lambda total, x: total + x)


def _shared(keys: DataFrame, by: str) -> DataFrame:
    """The rows whose key has different values of ``by``, as a table; ``keys`` is deleted."""
    several = keys.groupBy("key").agg(F.min(by).alias("a"), F.max(by).alias("b")).where("a < b").select("key")
    left = written(keys.join(several, "key"), "near-shared")
    forget(keys)
    return left


def _whole_sets(docs: DataFrame, rows: DataFrame, keys: DataFrame, shingle: int) -> DataFrame:
    """(node, hashes) of the nodes in ``keys``."""
    asked = rows.join(keys.select("node").distinct(), "node", "left_semi")
    names = asked.groupBy("node").agg(F.min(F.struct(*_name(F.col("doc_id"), F.col("tie")))).alias("k")).select("k.*").distinct()

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, sets in _sets(batches, shingle):
            yield pd.DataFrame({"node": pd.Series([_node(s) for s in sets], part.index), "hashes": pd.Series(sets, part.index)})

    texts = docs.select(*_name(F.col("doc_id"), F.xxhash64("text")), whole().alias("text")).join(names, list(NAME), "left_semi")
    return texts.select("text").mapInPandas(compute, "node bigint, hashes array<bigint>").dropDuplicates(["node"])


#: A row is known by these: whether its id is null, the id, hash of the text.
NAME = ("near_null", "near_id", "near_tie")


def _name(doc_id: Column, tie: Column) -> list[Column]:
    return [doc_id.isNull().alias("near_null"), F.coalesce(doc_id, F.lit(0)).alias("near_id"), tie.alias("near_tie")]


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one document left of each group: the least id, of equal ids the one with the
    least text hash, of identical rows any."""
    rows = written(nodes(docs), "near-rows")
    roots = links(docs, rows)
    member = rows.select("doc_id", "tie", "node").join(roots, "node", "left")
    chosen = member.groupBy(F.coalesce("root", "node").alias("g")).agg(F.min(F.struct(*_name(F.col("doc_id"), F.col("tie")))).alias("k"))
    chosen = chosen.select(F.col("k").alias("near_key"))
    # All columns in one, so that names of the input cannot clash.
    marked = docs.select(F.struct(*_name(F.col("doc_id"), F.xxhash64("text"))).alias("near_key"), F.struct("*").alias("row"))
    return marked.join(chosen, "near_key", "left_semi").dropDuplicates(["near_key"]).select("row.*")
