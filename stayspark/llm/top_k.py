"""Exact top-k by inner product with a pivot-distance index.

Inner products become distances by one more component: sqrt(M - |v|^2) for a stored vector (M the greatest squared length),
0 for a query. Then |q - v|^2 = |q|^2 + M - 2 q.v, and the nearest stored vectors are those with the greatest products.

Index: every stored vector is keyed by its nearest pivot and its distance from it. Distances are cut into annuli, in which the
rows of a pivot stand in order of distance; an annulus is stored as cells of ``CELL_ROWS`` rows at most on average.
Pivots are means of a bounded sample (``SAMPLE`` different vectors, on average); every row is indexed, and the result is exact whatever
the pivots are.

Search: by the triangle inequality a vector at distance r from a pivot is at least |D - r| away from a query at distance D. Each query
sorts the annuli by that bound and expands them in rounds, eight times as many each round; it stops as soon as the next
annulus cannot hold a product as great as its k-th best. Bounds leave room for rounding, scores are exact integers.

In a round, requested cells meet the queries that ask for them: queries in stripes of ``STRIPE`` neighbours, one group per (cell,
stripe), so that neither many queries nor many equal vectors meet in one task without bound. Driver and closures hold the
pivots, at most ``PIVOTS * BUCKETS`` counts and at most ``PIVOTS * RINGS`` annuli.

Odd rows: vectors null or with a null or non-finite component take no part; a shorter vector counts as followed by zeros (an
empty one scores 0 with all). Rows with a null id are candidates, placed last among equal scores, and never queries. Each of
several rows with one id is a row of its own: it is a query by itself, and only one copy is left out as the query's own. Fewer than k
candidates: all of them. An empty table or one without queries: no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayspark.llm.common import written
from stayspark.llm.vectors import LEAST, SQL_USABLE, first_rows, matrix, products, sql_numbers, usable, whole_numbers

K = 5
SCALE = 256
EVERY = 50
PIVOTS = 32
#: Different vectors that the pivots are fitted on.
SAMPLE = 4096
#: Steps of distance that are counted per pivot, and annuli that they are merged into, at most.
BUCKETS = 1024
RINGS = 32
RING_ROWS = 512
CELL_ROWS = 16384
STRIPE = 2048
FIRST_ANNULI = 2
GROWTH = 8
TILE = 256


@dataclass
class Index:
    """Rows (pivot, bucket, radius, vec_id, v) with the pivots and what is known of the annuli.

    ``annuli``: rows of (pivot, least and greatest radius); ``cells`` their first cell and number of cells; ``places`` the
    (pivot, bucket, annulus) that occur; ``top`` is M.
    """

    rows: DataFrame
    pivots: np.ndarray
    top: int
    annuli: np.ndarray
    cells: np.ndarray
    places: list[tuple[int, int, int]]


def clean(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): whole-number components of the rows that take part."""
    kept = vectors.where(usable("embedding"))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), whole_numbers("embedding", scale).alias("v"))


def _square() -> Column:
    return F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x)


def fit_pivots(sample: np.ndarray, top: int, pivots: int = PIVOTS, turns: int = 8) -> np.ndarray:
    """Means of groups of the sample in the space with one more component; the origin if there is no sample."""
    if not len(sample):
        return np.zeros((1, sample.shape[1] + 1))
    points = np.c_[sample, np.sqrt(np.maximum(0.0, top - (sample * sample).sum(axis=1)))]
    points = points[np.lexsort(points.T)]
    centers = points[np.linspace(0, len(points) - 1, min(pivots, len(points))).astype(int)]
    for _ in range(turns):
        nearest = _distances(points, centers).argmin(axis=1)
        for c in range(len(centers)):
            if (nearest == c).any():
                centers[c] = points[nearest == c].mean(axis=0)
    return np.unique(centers, axis=0)


def _distances(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    width = min(points.shape[1], centers.shape[1])
    square = (points * points).sum(axis=1)[:, None] + (centers * centers).sum(axis=1)[None, :]
    return np.sqrt(np.maximum(0.0, square - 2 * points[:, :width] @ centers[:, :width].T))


def _placed(found: np.ndarray, pivots: np.ndarray, extra: np.ndarray) -> np.ndarray:
    """Distances of vectors, with one more component ``extra``, from the pivots."""
    width = min(found.shape[1], pivots.shape[1] - 1)
    square = (found * found).sum(axis=1) + extra * extra
    cross = found[:, :width] @ pivots[:, :width].T + extra[:, None] * pivots[None, :, -1]
    return np.sqrt(np.maximum(0.0, square[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2 * cross))


def build(vectors: DataFrame, sample: int = SAMPLE) -> Index | None:
    """The index of a table (vec_id, v); None if it has no row."""
    shape = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(_square()).alias("top")).first()
    if not shape["n"]:
        return None
    top = int(shape["top"])
    # A sample by content: copies of a vector count once, however many there are.
    share = min(1.0, sample / shape["n"])
    drawn = vectors.select("v").where(F.pmod(F.xxhash64("v"), F.lit(1 << 30)) < int(share * (1 << 30))).distinct()
    drawn = matrix(drawn.limit(4 * sample).toArrow().column("v")).astype(np.float64)
    pivots = fit_pivots(drawn, top)
    step = (2 * np.sqrt(top) + 1) / BUCKETS

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                found = matrix(batch.column("v")).astype(np.float64)
                extra = np.sqrt(np.maximum(0.0, top - (found * found).sum(axis=1)))
                far = _placed(found, pivots, extra)
                pivot = far.argmin(axis=1)
                radius = far[np.arange(len(far)), pivot]
                bucket = np.minimum(BUCKETS - 1, radius // step).astype(np.int32)
                columns = [pa.array(pivot.astype(np.int32)), pa.array(bucket), pa.array(radius), batch.column("vec_id"), batch.column("v")]
                yield pa.RecordBatch.from_arrays(columns, ["pivot", "bucket", "radius", "vec_id", "v"])

    placed = vectors.select("vec_id", "v").mapInArrow(assign, "pivot int, bucket int, radius double, vec_id bigint, v array<bigint>")
    rows = written(placed, "top-k-index")
    counted = rows.groupBy("pivot", "bucket").agg(F.count(F.lit(1)).alias("n"), F.min("radius").alias("low"), F.max("radius").alias("high"))
    # At most PIVOTS * BUCKETS rows.
    return Index(rows, pivots, top, *_annuli(sorted(map(tuple, counted.collect()))))


def _annuli(counted: list[tuple]) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """Neighbouring buckets of a pivot merged until they hold their share of its rows."""
    total: dict[int, int] = {}
    for pivot, _, n, _, _ in counted:
        total[pivot] = total.get(pivot, 0) + n
    annuli: list[list] = []
    places = []
    for pivot, bucket, n, low, high in counted:
        full = max(RING_ROWS, -(-total[pivot] // RINGS))
        if not annuli or annuli[-1][0] != pivot or annuli[-1][3] >= full:
            annuli.append([pivot, low, high, 0])
        annuli[-1][2:] = [high, annuli[-1][3] + n]
        places.append((pivot, bucket, len(annuli) - 1))
    parts = [-(-a[3] // CELL_ROWS) for a in annuli]
    cells = np.array([(first, n) for first, n in zip(np.cumsum([0, *parts[:-1]]), parts, strict=True)], np.int64)
    return np.array([a[:3] for a in annuli], np.float64), cells, places


def _stripes(counted: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(pivot, bucket, first stripe, stripes): queries of neighbouring buckets share stripes of ``STRIPE`` rows, on average at most."""
    out, stripe, held = [], 0, 0
    for pivot, bucket, n in counted:
        if held and held + n > STRIPE:
            stripe, held = stripe + 1, 0
        parts = -(-n // STRIPE)
        out.append((pivot, bucket, stripe, parts))
        stripe, held = stripe + parts - 1, held + n if parts == 1 else STRIPE
    return out


def bounds(index: Index, asked: np.ndarray) -> np.ndarray:
    """Per query and annulus a number that no product with a vector of the annulus exceeds."""
    asked = asked.astype(np.float64)
    square = (asked * asked).sum(axis=1)
    far = _placed(asked, index.pivots, np.zeros(len(asked)))[:, index.annuli[:, 0].astype(int)]
    gap = np.maximum(far - index.annuli[:, 2], index.annuli[:, 1] - far)
    # Rounding of distances: a millionth of the lengths at most.
    gap = np.maximum(0.0, gap - 1e-6 * (np.sqrt(square)[:, None] + 2 * np.sqrt(index.top) + 1))
    return (square[:, None] + index.top - gap * gap) / 2 + 1


def search(index: Index, queries: DataFrame, k: int) -> DataFrame:
    """(query, query_id, own, vec_id, score): the k best rows of the index for each row of ``queries``, itself among them.

    ``query`` numbers the rows of ``queries`` (a part of the index's rows); ``own`` is a query's product with itself.
    """
    spark, cells = queries.sparkSession, index.cells
    place = lambda table: F.broadcast(spark.createDataFrame(table, "pivot int, bucket int, first int, parts int"))
    part = F.col("first") + F.pmod(F.monotonically_increasing_id(), F.col("parts"))
    # At most PIVOTS * BUCKETS rows each.
    counted = sorted(map(tuple, queries.groupBy("pivot", "bucket").agg(F.count(F.lit(1))).collect()))
    dealt = queries.join(place(_stripes(counted)), ["pivot", "bucket"])
    numbered = dealt.select(F.monotonically_increasing_id().alias("query"), part.alias("stripe"), F.col("vec_id").alias("query_id"), "v")
    questions = written(numbered, "top-k-queries")
    kept = index.rows.join(place([(p, b, int(cells[a][0]), int(cells[a][1])) for p, b, a in index.places]), ["pivot", "bucket"])
    store = kept.select(part.cast("int").alias("cell"), "vec_id", "v")
    light = Index(None, index.pivots, index.top, index.annuli, cells, [])
    best, begin, count = None, 0, FIRST_ANNULI
    while begin < len(index.annuli):
        state = questions.withColumn("least", F.lit(LEAST)) if best is None else _with_least(questions, best, k)
        asked = written(state.mapInArrow(_expansion(light, begin, begin + count), "cell int, stripe long, query long, least long, v array<bigint>"), "top-k-asked")
        if asked.isEmpty():
            break
        wanted = asked.select(F.col("cell").alias("of"), F.col("stripe").alias("band")).distinct()
        met = store.join(wanted, F.col("cell") == F.col("of")).select("of", "band", "vec_id", "v")
        groups = asked.groupBy("cell", "stripe").cogroup(met.groupBy("of", "band"))
        found = groups.applyInArrow(_scorer(k), "query long, vec_id long, score long")
        if best is not None:
            found = found.unionByName(best)
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
        ranked = found.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= k).drop("turn")
        best = written(ranked, "top-k-best")
        begin, count = begin + count, count * GROWTH
    if best is None:
        best = spark.createDataFrame([], "query long, vec_id long, score long")
    own = questions.select("query", "query_id", _square().alias("own"))
    return best.join(own, "query").select("query", "query_id", "own", "vec_id", "score")


def _with_least(questions: DataFrame, best: DataFrame, k: int) -> DataFrame:
    """The queries with the least score that still matters: the k-th best, none before there are k."""
    least = best.groupBy("query").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
    least = least.select("query", F.when(F.col("n") >= k, F.col("least")).otherwise(F.lit(LEAST)).alias("least"))
    return questions.join(least, "query", "left").withColumn("least", F.coalesce("least", F.lit(LEAST)))


def _expansion(index: Index, begin: int, end: int):
    """For each query the cells of its annuli number ``begin`` to ``end``, as far as their bounds reach its least score."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, TILE):
                batch = whole.slice(at, TILE)
                limit = bounds(index, matrix(batch.column("v")))
                order = np.argsort(-limit, axis=1, kind="stable")[:, begin:end]
                reach = np.take_along_axis(limit, order, axis=1)
                least = batch.column("least").to_numpy(zero_copy_only=False)
                rows, places = np.nonzero(reach >= least[:, None])
                annulus = order[rows, places]
                parts = index.cells[annulus, 1]
                rows = np.repeat(rows, parts)
                within = np.arange(len(rows)) - np.repeat(np.cumsum(parts) - parts, parts)
                cell = np.repeat(index.cells[annulus, 0], parts) + within
                for part in range(0, len(rows), 8192):
                    some = pa.array(rows[part : part + 8192])
                    columns = [pa.array(cell[part : part + 8192].astype(np.int32))]
                    columns += [batch.column(c).take(some) for c in ("stripe", "query", "least", "v")]
                    yield pa.RecordBatch.from_arrays(columns, ["cell", "stripe", "query", "least", "v"])

    return expand


def _scorer(k: int):
    """The k best rows of a cell for each query of a stripe."""

    def score(asked: pa.Table, stored: pa.Table) -> pa.Table:
        stored = stored.sort_by([("vec_id", "ascending")])  # null ids last
        right = matrix(stored.column("v"))
        numbers, least = asked.column("query").to_numpy(), asked.column("least").to_numpy()
        left = matrix(asked.column("v"))
        queries, places, scores = [], [], []
        for at in range(0, len(left), TILE):
            got = products(left[at : at + TILE], right)
            got[got < least[at : at + TILE, None]] = LEAST
            rows, columns = first_rows(got, k)
            queries.append(numbers[at + rows])
            places.append(columns)
            scores.append(got[rows, columns])
        chosen = stored.column("vec_id").take(pa.array(np.concatenate(places)))
        return pa.table({"query": pa.array(np.concatenate(queries)), "vec_id": chosen, "score": pa.array(np.concatenate(scores))})

    return score


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score) of every row whose id is divisible by ``every`` against all other rows."""
    index = build(clean(vectors, scale))
    if index is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = search(index, index.rows.where(F.col("vec_id") % every == 0), k + 1)
    # One row that looks like the query's own goes; which one of equal rows does not show.
    by_query = Window.partitionBy("query")
    turn = F.row_number().over(by_query.orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    mine = (F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("own"))
    ranked = found.withColumn("turn", turn).withColumn("own_turn", F.min(F.when(mine, F.col("turn"))).over(by_query))
    others = ranked.where(F.col("own_turn").isNull() | (F.col("turn") != F.col("own_turn")))
    rank = F.col("turn") - F.when(F.col("turn") > F.col("own_turn"), 1).otherwise(0)
    return others.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = f"""
    with v as (select vec_id, {sql_numbers(SCALE)} v from embeddings where {SQL_USABLE})
    select query_id, "rank", vec_id, score from (
      select query_id, vec_id, score, row_number() over (partition by query_id order by score desc, vec_id) "rank" from (
        select q.vec_id query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) score
        from v q join v c on c.vec_id <> q.vec_id where q.vec_id % {EVERY} = 0) s) r
    where "rank" <= {K}"""
