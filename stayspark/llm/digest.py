"""Quartile bucket digests of texts.

All byte triplets of the UTF-8 text are hashed into 256 buckets and counted. The digest is the logarithm of
the length in quarter octaves (one byte), the ratios of the first and second quartile of the bucket counts to
the third (four bits each), and for each bucket the quarter that its count falls in (two bits): 66 bytes, in
hexadecimal. The difference of two digests adds up the steps between the buckets' quarters (three steps count
6), the difference of the ratios and ``LENGTH_WEIGHT`` per quarter octave; it ends at ``LARGEST``, which texts
without relation come near. The likeness is 1 less the difference as a share of that.

Null text is empty; the digest of a text of fewer than three bytes has counts of 0. Equal texts have equal
digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayspark.llm.common import whole, written

BUCKETS = 256
LENGTH_WEIGHT = 2
LARGEST = 416
RANGE_ROWS = 2000
STEP = np.array([0, 1, 2, 6])


def digest(data: bytes) -> np.ndarray:
    """66 bytes."""
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    counts = np.zeros(BUCKETS, np.int64)
    if len(b) >= 3:
        mixed = (b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)) * np.uint32(2654435761)
        counts = np.bincount((mixed ^ mixed >> np.uint32(15)) * np.uint32(2246822519) >> np.uint32(24), minlength=BUCKETS)
    q1, q2, q3 = np.sort(counts)[[63, 127, 191]]
    quarter = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    packed = quarter.reshape(-1, 4) << np.array([6, 4, 2, 0], np.uint8)
    ratio = 15 * q1 // max(q3, 1) << 4 | 15 * q2 // max(q3, 1)
    length = min(255, int(4 * np.log2(len(data) + 1)))
    return np.concatenate([np.array([length, ratio], np.uint8), packed.sum(axis=1).astype(np.uint8)])


def difference(a: np.ndarray, b: np.ndarray) -> int:
    """Bounded difference of two digests."""
    shifts = np.array([6, 4, 2, 0], np.uint8)
    quarters = [(x[2:, None] >> shifts & 3).astype(np.int64) for x in (a, b)]
    total = int(STEP[np.abs(quarters[0] - quarters[1])].sum())
    total += LENGTH_WEIGHT * abs(int(a[0]) - int(b[0]))
    total += abs((int(a[1]) >> 4) - (int(b[1]) >> 4)) + abs((int(a[1]) & 15) - (int(b[1]) & 15))
    return min(LARGEST, total)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return 1.0 - difference(a, b) / LARGEST


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_following(docs: DataFrame) -> DataFrame:
    """(part, extra, doc_id, text): the rows cut into ranges of ids, each part ending with the row that
    follows its last one (``extra`` = 1); the first row follows the last. Null ids stand last; rows with the
    same id are in the order of their texts.

    The ranges come from approximate quantiles of the ids, whatever their error: it moves a limit only.
    """
    rows = docs.select("doc_id", whole().alias("text"))
    n = rows.count()
    cuts = max(1, n // RANGE_ROWS)
    limits = rows.select(F.percentile_approx("doc_id", [i / cuts for i in range(1, cuts)], 10_000)).first()[0] if cuts > 1 else None
    limits = sorted(set(limits or []))
    # Position among the limits; a null id is beyond all of them.
    part = F.lit(len(limits)) if not limits else F.when(F.col("doc_id").isNull(), F.lit(len(limits))).otherwise(_place("doc_id", limits))
    rows = rows.withColumn("part", part.cast("int"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text")).alias("least")
    heads = written(rows.groupBy("part").agg(first), "digest-heads")  # a row per range
    parts = sorted(r["part"] for r in heads.select("part").collect())
    before = {p: parts[i - 1] for i, p in enumerate(parts)}
    moved = heads.select(
        F.element_at(F.create_map(*[F.lit(x) for p, b in before.items() for x in (p, b)]), F.col("part")).alias("part") if before else F.col("part"),
        F.lit(1).alias("extra"),
        F.col("least.doc_id").alias("doc_id"),
        F.col("least.text").alias("text"),
    )
    return rows.select("part", F.lit(0).alias("extra"), "doc_id", "text").unionByName(moved)


def _place(column: str, limits: list) -> Column:
    """How many of the sorted limits are at most the column, by halving."""
    if not limits:
        return F.lit(0)
    at = len(limits) // 2
    low, high = _place(column, limits[:at]), _place(column, limits[at + 1 :]) + F.lit(at + 1)
    return F.when(F.col(column) < F.lit(limits[at]), low).otherwise(high)


def compare_with_following(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            rows = []
            for part, extra, doc_id, text in zip(batch["part"], batch["extra"], batch["doc_id"], batch["text"], strict=True):
                own = digest(text.encode("utf-8", "surrogatepass"))
                if held is not None and held[0] == part:
                    change = edited(held[3], text).encode("utf-8", "surrogatepass")
                    other = digest(change)
                    rows.append((held[2], len(held[3]), hashlib.sha256(change).hexdigest(), held[4].tobytes().hex(), other.tobytes().hex(), likeness(held[4], other), likeness(held[4], own)))
                held = (part, extra, doc_id, text, own)
            out = pd.DataFrame(rows, columns=list(names))
            out["doc_id"] = out["doc_id"].astype("Int64") if kind == "bigint" else out["doc_id"]
            yield out

    placed = with_following(docs).repartition("part")
    placed = placed.sortWithinPartitions("part", "extra", F.col("doc_id").asc_nulls_last(), "text")
    placed = placed.select("part", "extra", "doc_id", "text")
    types = ("bigint", "string", "string", "string", "double", "double")
    schema = f"doc_id {kind}, " + ", ".join(f"{n} {t}" for n, t in zip(names[1:], types, strict=True))
    return placed.mapInPandas(run, schema)
