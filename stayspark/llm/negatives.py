"""Hard negatives by full exact scores, looked up from tables of subset sums (the method of the Four Russians).

A stored vector is packed once: component by component in two's complement, plane by plane of equal bits, eight dimensions to
a byte. For an anchor and each group of eight dimensions a table holds the sums of all 256 subsets of its components. The score is then
built from the highest plane downwards: double it, and add the table entry that each byte names (the sign plane counts
negatively). No component is multiplied; all scores are whole numbers and exact.

Two passes: the positives of an anchor are among the rows of its label; its negatives, whose bounds depend on the positives' scores, among
all other rows. Both lay the pairs out as a grid: candidates in parts of ``PART`` rows and anchors in stripes of ``STRIPE``, each copied
along the other side, so that a task's group is bounded whatever label or vector is common. Every group returns its best
few rows per anchor, which a window joins.

Odd rows: rows with a null label or vector or a null or non-finite component take no part. A shorter vector counts as followed by
zeros. A null id is neither anchor nor relabelled; as a candidate it comes last among equal scores. Several rows with one id are rows of
their own, each an anchor where the id says so, and each other's candidates. No positive, or nothing inside the bounds: no rows for it.
Empty table: no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from stayspark.llm.common import written
from stayspark.llm.vectors import LEAST, SQL_USABLE, first_rows, matrix, sql_numbers, usable, whole_numbers

SCALE = 256
EVERY = 100
POSITIVES = 5
NEGATIVES = 10
#: Hundredths of the positive's score between which a negative lies.
BAND = (30, 90)
PART = 8192
STRIPE = 4096
TILE = (64, 2048)
#: Anchors whose scores with all rows of a part are held at once.
STRIDE = 256
FOUND_POSITIVES = pa.schema([(c, pa.int64()) for c in ("anchor", "positive_id", "other", "positive_score")])
FOUND_NEGATIVES = pa.schema(
    [("anchor", pa.int64()), ("anchor_id", pa.int64()), ("place", pa.int32())]
    + [(c, pa.int64()) for c in ("positive_id", "negative_id", "positive_score", "negative_score")]
)
OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def clean(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v) of the rows that take part, with the labels that hold."""
    kept = vectors.where(F.col("label").isNotNull() & usable("embedding"))
    vec_id, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    label = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return kept.select(vec_id.alias("vec_id"), label.alias("label"), whole_numbers("embedding", scale).alias("v"))


def pack(found: np.ndarray, bits: int) -> np.ndarray:
    """(rows, planes, groups): the bytes of each row, sign plane first."""
    n, width = found.shape
    planes = (found[:, None, :] >> np.arange(bits - 1, -1, -1)[None, :, None]) & 1
    return np.packbits(planes.astype(np.uint8), axis=2, bitorder="little").reshape(n, bits, -(-width // 8))


def subset_sums(anchors: np.ndarray, groups: int, kind: type) -> np.ndarray:
    """(group, subset, anchor): sums of the subsets of each eight components, built by adding one component at a time."""
    filled = np.zeros((len(anchors), groups * 8), kind)
    width = min(anchors.shape[1], groups * 8)
    filled[:, :width] = anchors[:, :width]
    tables = np.zeros((groups, 256, len(anchors)), kind)
    for j in range(8):
        tables[:, 1 << j : 2 << j] = tables[:, : 1 << j] + filled[:, j::8].T[:, None, :]
    return tables


def scores(anchors: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """(anchor, row) inner products by table lookups."""
    n, bits, groups = packed.shape
    groups = min(groups, -(-anchors.shape[1] // 8))
    most = max(abs(int(anchors.min(initial=0))), abs(int(anchors.max(initial=0)))) * anchors.shape[1] << bits
    if most >= 2**63:
        raise OverflowError("scores do not fit a long")
    kind = np.int32 if most < 2**31 else np.int64
    out = np.zeros((len(anchors), n), np.int64)
    for a in range(0, len(anchors), TILE[0]):
        tables = subset_sums(anchors[a : a + TILE[0]], groups, kind)
        for r in range(0, n, TILE[1]):
            rows = packed[r : r + TILE[1]]
            total = np.zeros((len(rows), tables.shape[2]), kind)
            entry = np.empty_like(total)
            for plane in range(bits):
                total <<= 1
                for group in range(groups):
                    np.take(tables[group], rows[:, plane, group], axis=0, out=entry, mode="clip")
                    if plane:
                        total += entry
                    else:
                        total -= entry
            out[a : a + TILE[0], r : r + TILE[1]] = total.T
    return out


def bits_of(least: int, most: int) -> int:
    """Bits that two's complement needs for whole numbers between the two."""
    return max((-least - 1).bit_length() if least < 0 else 0, most.bit_length() if most > 0 else 0) + 1


def packed_rows(found: DataFrame, bits: int) -> DataFrame:
    """(row, vec_id, label, v, planes), each row with a number of its own, as a table.

    The vector stays only where the row is an anchor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, TILE[1]):
                batch = whole.slice(at, TILE[1])
                planes = pack(matrix(batch.column("v")), bits)
                columns = [*[batch.column(c) for c in ("vec_id", "label", "v")], pa.array([p.tobytes() for p in planes], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "v", "planes"])

    rows = found.mapInArrow(run, "vec_id bigint, label bigint, v array<bigint>, planes binary")
    anchor = F.col("vec_id") % EVERY == 0
    return written(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", F.when(anchor, F.col("v")).alias("v"), "planes"), "negatives-rows")


def unpacked(column: pa.ChunkedArray, bits: int) -> np.ndarray:
    """(rows, planes, groups) of packed rows, filled with zeros to the longest."""
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        return np.zeros((0, bits, 0), np.uint8)
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False)
    longest = int(sizes.max(initial=0)) // bits
    if (sizes == longest * bits).all():
        flat = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
        return flat.reshape(len(sizes), bits, longest)
    out = np.zeros((len(sizes), bits, longest), np.uint8)
    for i, text in enumerate(column.to_pylist()):
        out[i, :, : len(text) // bits] = np.frombuffer(text, np.uint8).reshape(bits, -1)
    return out


def _sides(count: Column, size: int) -> Column:
    return F.ceil(count / F.lit(size)).cast("long")


def best_positives(rows: DataFrame, bits: int, k: int = POSITIVES) -> DataFrame:
    """(anchor, place, positive_id, positive_score): the k best other rows of each anchor's label."""
    anchor = F.col("v").isNotNull()
    sides = rows.groupBy("label").agg(
        _sides(F.count(F.lit(1)), PART).alias("parts"), _sides(F.count(F.when(anchor, 1)), STRIPE).alias("stripes")
    )
    sided = rows.join(sides, "label").where("stripes > 0")
    stripe, part = F.pmod(F.xxhash64("row"), F.col("stripes")), F.pmod(F.col("row"), F.col("parts"))
    asked = sided.where(anchor).select("row", "label", "v", stripe.alias("stripe"), F.explode(F.expr("sequence(0, parts - 1)")).alias("part"))
    met = sided.select(
        F.col("row").alias("other"), F.col("label").alias("kind"), "vec_id", "planes", part.alias("piece"), F.explode(F.expr("sequence(0, stripes - 1)")).alias("band")
    )
    groups = asked.groupBy("label", "stripe", "part").cogroup(met.groupBy("kind", "band", "piece"))

    def run(asked: pa.Table, stored: pa.Table) -> pa.Table:
        if not asked.num_rows or not stored.num_rows:  # one side of the grid has nothing here
            return FOUND_POSITIVES.empty_table()
        stored = stored.sort_by([("vec_id", "ascending"), ("other", "ascending")])  # null ids last
        others, planes = stored.column("other").to_numpy(), unpacked(stored.column("planes"), bits)
        parts = []
        for some, vectors in _strides(asked):
            numbers = some.column("row").to_numpy()
            got = scores(vectors, planes)
            got[numbers[:, None] == others[None, :]] = LEAST
            at, columns = first_rows(got, k)
            found = stored.select(["vec_id", "other"]).take(pa.array(columns)).rename_columns(["positive_id", "other"])
            parts.append(found.append_column("anchor", pa.array(numbers[at])).append_column("positive_score", pa.array(got[at, columns])))
        return pa.concat_tables(parts).select(["anchor", "positive_id", "other", "positive_score"])

    found = groups.applyInArrow(run, from_arrow_schema(FOUND_POSITIVES))
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), F.asc_nulls_last("positive_id"), "other")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("other")


def _strides(asked: pa.Table) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Anchors of a group a few at a time, so that their scores stay small."""
    for at in range(0, asked.num_rows, STRIDE):
        some = asked.slice(at, STRIDE)
        yield some, matrix(some.column("v"))


def mine(vectors: DataFrame, scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    found = clean(vectors, scale)
    shape = found.agg(
        F.count(F.lit(1)).alias("n"), F.min(F.array_min("v")).alias("least"), F.max(F.array_max("v")).alias("most"),
        F.count(F.when(F.col("vec_id") % EVERY == 0, 1)).alias("anchors"),
    ).first()
    if not shape["anchors"]:
        return vectors.sparkSession.createDataFrame([], OUT)
    bits = bits_of(shape["least"] or 0, shape["most"] or 0)
    rows = packed_rows(found, bits)
    chosen = best_positives(rows, bits, positives)
    # At most ``positives`` entries per anchor.
    lists = chosen.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("p"))
    lists = lists.select("anchor", F.col("p.positive_id").alias("ids"), F.col("p.positive_score").alias("marks"))
    anchors = rows.where(F.col("v").isNotNull()).select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), "label", "v").join(lists, "anchor")
    anchors = written(anchors, "negatives-anchors")
    parts, stripes = -(-shape["n"] // PART), -(-shape["anchors"] // STRIPE)
    # Keys of both sides are long: groups meet by the hash of the typed value.
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    asked = anchors.withColumn("stripe", F.pmod(F.xxhash64("anchor"), F.lit(stripes).cast("long"))).withColumn("part", numbers(parts))
    piece = F.pmod("row", F.lit(parts).cast("long"))
    met = rows.select("vec_id", F.col("label").alias("kind"), "planes", piece.alias("piece"), numbers(stripes).alias("band"))
    low, high = BAND

    def run(asked: pa.Table, stored: pa.Table) -> pa.Table:
        if not asked.num_rows or not stored.num_rows:
            return FOUND_NEGATIVES.empty_table()
        stored = stored.sort_by([("vec_id", "ascending")])  # null ids last
        kinds, planes = stored.column("kind").to_numpy(), unpacked(stored.column("planes"), bits)
        parts = []
        for some, vectors in _strides(asked):
            got = scores(vectors, planes)
            got[some.column("label").to_numpy()[:, None] == kinds[None, :]] = LEAST
            # One row per anchor and positive.
            pairs = pc.list_parent_indices(some.column("marks")).combine_chunks().to_numpy()
            marks = pc.list_flatten(some.column("marks")).to_numpy()
            pair, column = [], []
            for i, (a, mark) in enumerate(zip(pairs, marks, strict=True)):
                inside = np.flatnonzero((got[a] >= -(-low * mark // 100)) & (got[a] <= high * mark // 100) & (got[a] != LEAST))
                _, at = first_rows(got[a][None, inside], negatives)
                pair.append(np.full(len(at), i))
                column.append(inside[at])
            pair, column = np.concatenate(pair), np.concatenate(column)
            picked = some.take(pa.array(pairs[pair]))
            first = np.searchsorted(pairs, pairs)  # where the pairs of the same anchor begin
            parts.append(pa.table({
                "anchor": picked.column("anchor"), "anchor_id": picked.column("anchor_id"),
                "place": pa.array((pair - first[pair]).astype(np.int32)),
                "positive_id": pc.list_flatten(some.column("ids")).take(pa.array(pair)),
                "negative_id": stored.column("vec_id").take(pa.array(column)),
                "positive_score": pa.array(marks[pair]), "negative_score": pa.array(got[pairs[pair], column]),
            }))
        return pa.concat_tables(parts)

    groups = asked.groupBy("stripe", "part").cogroup(met.groupBy("band", "piece"))
    every = groups.applyInArrow(run, from_arrow_schema(FOUND_NEGATIVES))
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"))
    ranked = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE = f"""
    with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end label, {sql_numbers(SCALE)} v
               from embeddings where label is not null and {SQL_USABLE}),
    scored as (select a.vec_id anchor_id, c.vec_id, a.label = c.label same, cast(list_dot_product(a.v, c.v) as bigint) score
               from v a join v c on c.vec_id <> a.vec_id where a.vec_id % {EVERY} = 0),
    positives as (select anchor_id, vec_id positive_id, score positive_score from scored where same
                  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= {POSITIVES})
    select p.anchor_id, p.positive_id,
           row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.vec_id) "rank",
           n.vec_id negative_id, p.positive_score, n.score negative_score
    from positives p join scored n on n.anchor_id = p.anchor_id and not n.same
      and {BAND[0]} * p.positive_score <= 100 * n.score and 100 * n.score <= {BAND[1]} * p.positive_score
    qualify "rank" <= {NEGATIVES}"""
