"""Clustering around integer centroids; each vector finds its nearest one by the threshold algorithm.

Every dimension has its list of centroids, sorted by their value there. For a vector the lists are walked outward from its own
values, all one step at a time: the nearest centroid of each dimension, then the second nearest, and so on. A centroid seen for
the first time is measured exactly. The squares of the last gaps of all lists add up to a frontier: a centroid that no list has shown yet is
at least that far away. The walk stops when the frontier strictly exceeds the best distance, so ties still go to the smaller number.

Centroids start as the k vectors with the least SHA-256 of ``1:<id>``. Each round adds up the vectors of a centroid in
every task first; one row per task and centroid is shuffled, the driver holds k centroids. Means are exact floors of sums.

Odd rows: vectors that are null, of another length, or with a null or non-finite component are left out. A row with a null id
is clustered but starts a centroid only where there are too few others; of rows with equal ids the lesser vector comes first. Each of
several equal rows counts, also as a start, so centroids may be equal and the larger number stays empty. Fewer than k vectors: as many
centroids. No vector: no rows. Components beyond 2**27 after scaling raise an error, as distances would not fit a long. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayspark.llm.common import written
from stayspark.llm.vectors import SQL_USABLE, matrix, sql_numbers, usable, whole_numbers

K = 16
ROUNDS = 3
SCALE = 64
DIMENSIONS = 64
PART = 2048
REACH = 1 << 27


def clean(vectors: DataFrame, scale: int = SCALE, dimensions: int = DIMENSIONS) -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    kept = vectors.where((F.size("embedding") == dimensions) & usable("embedding"))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), whole_numbers("embedding", scale).alias("v"))


def starts(vectors: DataFrame, k: int = K) -> np.ndarray:
    """The k vectors with the least hash of their ids, in that order."""
    key = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(key.alias("key"), "v").orderBy(F.asc_nulls_last("key"), "v").limit(k).collect()
    found = np.array([r["v"] for r in rows], np.int64)
    _check(found)
    return found


def _check(values: np.ndarray) -> None:
    if values.size and max(int(values.max()), -int(values.min())) > REACH:
        raise OverflowError(f"components beyond {REACH} have distances that do not fit a long")


class Walker:
    """Sorted lists of the centroids per dimension, and the walk along them."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.lists = np.argsort(centroids, axis=0, kind="stable")  # (place, dimension)
        self.values = np.take_along_axis(centroids, self.lists, axis=0)

    def nearest(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number, squared distance, steps walked) for each row."""
        n, dimensions = found.shape
        k = len(self.centroids)
        number, best = np.full(n, k), np.full(n, np.iinfo(np.int64).max)
        steps = np.zeros(n, np.int64)
        seen = np.zeros((n, k), bool)
        right = np.stack([np.searchsorted(self.values[:, d], found[:, d]) for d in range(dimensions)], axis=1)
        left = right - 1
        active, across, far = np.arange(n), np.arange(dimensions), np.iinfo(np.int64).max
        for _ in range(k):
            here = found[active]
            below = np.where(left >= 0, here - self.values[np.maximum(left, 0), across], far)
            above = np.where(right < k, self.values[np.minimum(right, k - 1), across] - here, far)
            down = below <= above
            gap = np.where(down, below, above)
            shown = self.lists[np.where(down, left, right), across]
            left, right = left - down, right + ~down
            first = np.zeros((len(active), k), bool)
            first[np.arange(len(active))[:, None], shown] = True
            first &= ~seen[active]
            seen[active] |= first
            for c in np.flatnonzero(first.any(axis=0)):
                rows = active[first[:, c]]
                apart = found[rows] - self.centroids[c]
                distance = np.einsum("ij,ij->i", apart, apart)
                better = (distance < best[rows]) | ((distance == best[rows]) & (c < number[rows]))
                best[rows[better]], number[rows[better]] = distance[better], c
            steps[active] += 1
            open_ = (gap * gap).sum(axis=1) <= best[active]
            active, left, right = active[open_], left[open_], right[open_]
            if not len(active):
                break
        return number, best, steps


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, PART):
            part = batch.slice(at, PART)
            found = matrix(part.column("v"))
            _check(found)
            yield part, found


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid as the floor of the mean of the vectors nearest to it; one that has none stays."""
    walker = Walker(centroids)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
        for _, found in _parts(batches):
            number, _, _ = walker.nearest(found)
            np.add.at(sums, number, found)
            counts += np.bincount(number, minlength=len(centroids))
        held = np.flatnonzero(counts)
        columns = [pa.array(held.astype(np.int32)), pa.array(counts[held]), pa.array(list(sums[held]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "sums"])

    parts = vectors.select("v").mapInArrow(add, "cluster int, n bigint, sums array<bigint>")
    by_place = parts.select("cluster", "n", F.posexplode("sums").alias("place", "s"))
    rows = by_place.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    out = centroids.copy()
    for r in rows:  # k times the number of dimensions
        out[r["cluster"], r["place"]] = r["s"] // r["n"]
    return out


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    walker = Walker(centroids)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in _parts(batches):
            number, distance, _ = walker.nearest(found)
            columns = [part.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    return vectors.select("vec_id", "v").mapInArrow(place, "vec_id bigint, cluster int, distance bigint")


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, scale: int = SCALE, dimensions: int = DIMENSIONS) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part."""
    found = clean(vectors, scale, dimensions)
    centroids = starts(found, k)
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        none = found.sparkSession.createDataFrame([], f"vec_id long, {schema}").withColumn("distance", F.lit(0).cast("long"))
        return none.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    for _ in range(rounds):
        centroids = moved(found, centroids)
    placed = written(assign(found, centroids), "clusters")
    inertia = {r["cluster"]: r["s"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    whole = sum(inertia.values())
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    facts = found.sparkSession.createDataFrame([(c, inertia[c], whole, names[c]) for c in sorted(inertia)], schema)
    # One row per centroid.
    joined = placed.join(F.broadcast(facts), "cluster")
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(rounds: int = ROUNDS) -> str:
    apart = "list_dot_product(f.v, f.v) + list_dot_product(c.v, c.v) - 2 * list_dot_product(f.v, c.v)"
    steps = [
        f"""found as (select vec_id, {sql_numbers(SCALE)} v from embeddings where len(embedding) = {DIMENSIONS} and {SQL_USABLE})""",
        f"""c0 as (select row_number() over (order by sha256('1:' || vec_id)) - 1 number, v from found qualify number < {K})""",
    ]
    for i in range(rounds + 1):
        steps.append(f"""
            a{i} as (select f.vec_id, any_value(f.v) v, arg_min(c.number, ({apart}, c.number)) cluster, min({apart}) distance
                     from found f cross join c{i} c group by f.vec_id)""")
        if i < rounds:
            steps.append(f"""
            c{i + 1} as (select number, coalesce(m.v, c.v) v from c{i} c left join (
                select cluster, list(x order by place) v from (
                  select cluster, place, floor(sum(x) / count(*)) x
                  from (select cluster, unnest(v) x, generate_subscripts(v, 1) place from a{i}) u group by cluster, place) g
                group by cluster) m on m.cluster = c.number)""")
    return f"""
    with {", ".join(steps)}
    select a.vec_id, cast(a.cluster as int) cluster, cast(a.distance as bigint) distance,
           cast(sum(a.distance) over (partition by a.cluster) as bigint) cluster_inertia, cast(sum(a.distance) over () as bigint) inertia,
           sha256(array_to_string(list_transform(c.v, lambda x: cast(cast(x as bigint) as varchar)), ',')) centroid_sha256
    from a{rounds} a join c{rounds} c on c.number = a.cluster"""


ORACLE = _sql()
