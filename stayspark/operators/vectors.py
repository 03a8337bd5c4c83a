"""Retrieval documents, embeddings, similarity search and prompt assembly."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stayspark.functions.columns import has_text, name_uuid
from stayspark.functions.skew import top_n_per_key
from stayspark.functions.text import words
from stayspark.functions.vector import cosine, word_bucket
from stayspark.operators.filters import metadata_condition
from stayspark.operators.ranking import MEMORY_WINDOW
from stayspark.session import stored
from stayspark.sources.tables import dealt_by_text

# Fixed values of the model.
TOP_K = 4
THRESHOLD = 0.5
DIMENSIONS = 64

#: A batch of queries that may travel with the tasks: rows, and numbers in all (64 MiB of doubles).
STRIPE_ROWS = 4096
BATCH_VALUES = 8 * 1024 * 1024
PART_ROWS = 16384
#: Queries whose scores with all rows of a batch or part are held at once; with a block, with so many of its rows.
TILE = 256
TILE_COLUMNS = 4096
#: Pairs that are scored exactly at once, and rows of a block that give a query its first bound.
EXACT_PAIRS = 65536
FIRST_ROWS = 1024
TASKS_PER_CORE = 4
#: Inverted lists of the approximate search, rows they are fitted on, and lists that a query visits.
LISTS = 32
LIST_SAMPLE = 8192
PROBES = 16


def retrieval_documents(hotels: DataFrame, id_prefix: str = "hotel-", key: str = "id") -> DataFrame:
    """(id, text, metadata) for hotels with a description; the id, from ``key``, is stable over re-runs.

    Where a hotel has several descriptions, ``key`` is what tells them apart; it joins the metadata.
    """
    # Fixed value: the text pattern.
    text = F.format_string(
        "%s in %s.\nPrice: $%s per night.\n%s\nAmenities: %s.",
        F.col("name"), F.col("city"), F.col("price_per_night").cast("string"),
        F.col("description"), F.coalesce("amenities", F.lit("not listed")),
    )
    return hotels.filter(has_text(F.col("description"))).select(
        name_uuid(F.concat(F.lit(id_prefix), F.col(key).cast("string"))).alias("id"),
        F.trim(text).alias("text"),
        F.struct(
            F.col("id").alias("hotelId"), F.col("name"), F.col("city"),
            F.col("price_per_night").alias("pricePerNight"),
            *([F.col(key)] if key != "id" else []),
        ).alias("metadata"),
    )


def embed_words(df: DataFrame, key: str, text: str, dimensions: int = DIMENSIONS) -> DataFrame:
    """Hashed bag of words of the whole text: (key, embedding). No words: the first bucket is 1.

    ``key`` is unique. Texts are dealt out by it once, so many characters per task; words are counted per document, hashed and gathered in the task they came
    to. What is gathered per document is at most one entry per dimension.
    """
    word = F.explode_outer(words(F.col(text))).alias("w")
    counted = dealt_by_text(df.select(key, text), key, [text]).select(key, word).groupBy(key, "w").agg(F.count("w").alias("n"))
    hits = counted.groupBy(key, word_bucket(F.col("w"), dimensions).alias("b")).agg(F.sum("n").cast("double").alias("n"))
    entry = F.when(F.col("b").isNotNull(), F.struct("b", "n"))
    filled = hits.groupBy(key).agg(F.map_from_entries(F.collect_list(entry)).alias("m"))
    buckets = F.sequence(F.lit(0), F.lit(dimensions - 1))
    dense = F.transform(buckets, lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0)))
    empty = F.transform(buckets, lambda i: F.when(i == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return filled.select(key, F.when(F.size("m") == 0, empty).otherwise(dense).alias("embedding"))


def embed_with(
    df: DataFrame, key: str, text: str, model: Callable[[pd.Series], np.ndarray]
) -> DataFrame:
    """Plug a model in: ``model`` maps a batch of texts to a matrix; runs batch by batch in the tasks."""
    key_type = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({key: pdf[key], "embedding": list(model(pdf[text]))})

    return df.select(key, text).mapInPandas(run, f"{key} {key_type}, embedding array<double>")


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _by_length(column: pa.Array | pa.ChunkedArray, made: Callable[[np.ndarray], np.ndarray] = _unit) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """length -> (row numbers, unit vectors as a matrix) of a list column; null rows are left out."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    found = {}
    for d in np.unique(sizes[~np.isnan(sizes)] if sizes.dtype.kind == "f" else sizes):
        rows = np.flatnonzero(sizes == d)
        flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        found[int(d)] = (rows, made(flat.reshape(len(rows), int(d))))
    return found


def _best(asked: pa.Table, stored: pa.Table | pa.RecordBatch, k: int, threshold: float) -> list[pd.DataFrame]:
    """The k nearest of the stored rows for each asked row; ``TILE`` asked rows are scored at once."""
    if not asked.num_rows or not stored.num_rows:
        return []
    query_ids, names = asked.column("query_id").to_numpy(zero_copy_only=False), stored.column("id").to_pandas().to_numpy()
    left, right, parts = _by_length(asked.column("embedding")), _by_length(stored.column("embedding")), []
    for d in left.keys() & right.keys():
        (rows, matrix), (places, vectors) = left[d], right[d]
        for at in range(0, len(rows), TILE):
            scores = np.round(matrix[at : at + TILE] @ vectors.T, 6)
            keep = scores > threshold
            if len(places) > k:
                keep &= scores >= np.partition(scores, len(places) - k, axis=1)[:, len(places) - k, None]
            i, j = np.nonzero(keep)
            found = pd.DataFrame({"query_id": query_ids[rows[at + i]], "id": names[places[j]], "score": scores[i, j]})
            parts.append(_head(found, k))
    return parts


def _head(found: pd.DataFrame, k: int) -> pd.DataFrame:
    ordered = found.sort_values(["query_id", "score", "id"], ascending=[True, False, True])
    return ordered.groupby("query_id", sort=False).head(k)


def similarity_search(
    store: DataFrame,
    queries: DataFrame,
    k: int = TOP_K,
    threshold: float = THRESHOLD,
    condition: tuple | None = None,
    id_type: str = "long",
) -> DataFrame:
    """Top-k per query by cosine, strictly above the threshold: (query_id, rank, id, score).

    ``store``: id, embedding[, metadata]; ``queries``: query_id long, embedding. The metadata
    condition is an ordinary filter below the scan of vectors. Scores are compared at six decimals,
    ties go to the lower id; vectors of another length are skipped.

    A batch of at most ``STRIPE_ROWS`` queries and ``BATCH_VALUES`` numbers travels with the tasks that scan the store, which is
    not shuffled then. A larger batch meets the store block by block without a copy of either, see ``block_search``. Either way
    a task holds ``TILE`` rows of scores at a time and sends k rows per query onwards.
    """
    if condition is not None:
        store = store.filter(metadata_condition(condition))
    store, queries = store.select("id", "embedding"), queries.select("query_id", "embedding")
    schema = f"query_id long, id {id_type}, score double"
    size = queries.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("embedding")).alias("values")).first()
    if size["n"] <= STRIPE_ROWS and (size["values"] or 0) <= BATCH_VALUES:
        found = store.mapInArrow(_scan(queries.toArrow(), k, threshold), schema)
    else:
        found = block_search(store, queries, size["n"], k, threshold)
    return top_n_per_key(found, ["query_id"], [F.desc("score"), F.asc("id")], k).select(
        "query_id", "rank", "id", "score"
    )


def _scan(asked: pa.Table, k: int, threshold: float):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[pd.DataFrame] = []
        for batch in batches:
            best += _best(asked, batch, k, threshold)
            if len(best) > 16:
                best = [_head(pd.concat(best), k)]
        if best:
            yield pa.RecordBatch.from_pandas(_head(pd.concat(best), k), preserve_index=False)

    return scan


def block_search(store: DataFrame, queries: DataFrame, n_queries: int, k: int, threshold: float) -> DataFrame:
    """The k nearest rows of each part of the store per query: (query_id, id, score).

    Both sides become rows that hold many vectors each: blocks of ``PART_ROWS`` and stripes of ``STRIPE_ROWS`` at most. The
    product of blocks and stripes reads both again in each task and writes neither, so what is shuffled and stored grows with
    the store plus the queries. The store is cut into as many parts as keep the cores busy and no more, as each part sends k
    rows per query.
    """
    kinds = {f.name: f.dataType for f in store.schema.fields}
    ids = lambda kind: f"ids array<{kind}>, width int, vectors binary"
    # Parts of an eighth less, as rows are not dealt out to the last one evenly.
    asked = queries.filter("query_id is not null").repartition(max(1, -(-9 * n_queries // (8 * STRIPE_ROWS))))
    asked = asked.mapInArrow(_packed("query_id", T.LongType(), STRIPE_ROWS), ids("long"))
    asked = stored(asked.select(F.monotonically_increasing_id().alias("stripe"), *[F.col(c).alias(f"asked_{c}") for c in asked.columns]), "stripes")
    tasks = TASKS_PER_CORE * store.sparkSession.sparkContext.defaultParallelism
    parts = -(-tasks // max(1, asked.rdd.getNumPartitions()))
    blocks = store.mapInArrow(_packed("id", kinds["id"], PART_ROWS), ids(kinds["id"].simpleString()))
    blocks = blocks.withColumn("block", F.monotonically_increasing_id()).repartition(parts)
    met = blocks.crossJoin(asked.hint("shuffle_replicate_nl"))
    return met.mapInArrow(_across(k, threshold, kinds["id"]), f"query_id long, id {kinds['id'].simpleString()}, score double")


def _packed(key: str, kind: T.DataType, most: int):
    """At most so many rows of (key, embedding) as one: their keys, and their vectors of one length end to end."""
    out = to_arrow_schema(T.StructType().add("ids", T.ArrayType(kind)).add("width", T.IntegerType()).add("vectors", T.BinaryType()))

    def one(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = rows.column(key).combine_chunks()
        for d, (places, matrix) in _by_length(rows.column("embedding"), lambda m: m).items():
            columns = [[keys.take(pa.array(places)).to_pylist()], [d], [matrix.tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out, strict=True)], schema=out)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            while sum(b.num_rows for b in waiting) >= most:
                rows = pa.Table.from_batches(waiting)
                yield from one(rows.slice(0, most))
                waiting = rows.slice(most).to_batches()
        if sum(b.num_rows for b in waiting):
            yield from one(pa.Table.from_batches(waiting))

    return pack


class _Stripe:
    """The best rows that the queries of one stripe have met so far.

    Products in single precision rule pairs out, by a margin above their error; what is left is scored in double precision.
    """

    def __init__(self, ids: pa.Array, vectors: np.ndarray, k: int, threshold: float):
        self.ids, self.k, self.threshold = ids, k, threshold
        self.exact = _unit(vectors)
        self.rough = self.exact.astype(np.float32)
        # Half a unit of the sixth decimal, and the error of a product of two unit vectors.
        self.margin = 1e-6 + vectors.shape[1] * float(np.finfo(np.float32).eps)
        self.least = np.full(len(vectors), threshold)
        self.best: list[pd.DataFrame] = []
        self.fresh = 0

    def meet(self, ids: np.ndarray, exact: np.ndarray, rough: np.ndarray) -> None:
        first = not self.best and len(ids) > self.k
        for at in range(0, len(self.rough), TILE):
            rows = self.rough[at : at + TILE]
            if first:
                near = rows @ rough[: max(FIRST_ROWS, self.k + 1)].T
                near[np.isnan(near)] = -np.inf
                reached = np.partition(near, near.shape[1] - self.k, axis=1)[:, near.shape[1] - self.k]
                # Exact scores lie a margin lower at most.
                self.least[at : at + TILE] = np.maximum(self.least[at : at + TILE], reached - self.margin)
            low = (self.least[at : at + TILE, None] - self.margin).astype(np.float32)
            for column in range(0, len(rough), TILE_COLUMNS):
                i, j = np.nonzero(rows @ rough[column : column + TILE_COLUMNS].T >= low)
                for some in range(0, len(i), EXACT_PAIRS):
                    self._add(ids, exact, at + i[some : some + EXACT_PAIRS], column + j[some : some + EXACT_PAIRS])
        if self.fresh * 4 >= len(self.rough) * self.k or first:
            self.settle()

    def _add(self, ids: np.ndarray, exact: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
        scores = np.round(np.einsum("ij,ij->i", self.exact[i], exact[j]), 6)
        keep = (scores > self.threshold) & (scores >= self.least[i])
        if keep.any():
            found = _head(pd.DataFrame({"query_id": i[keep], "id": ids[j[keep]], "score": scores[keep]}), self.k)
            self.best.append(found)
            self.fresh += len(found)
            if self.fresh > EXACT_PAIRS:
                self.settle()

    def settle(self) -> None:
        """Keep k rows per query, and have queries with k rows ask for no less than the last of them."""
        if not self.fresh:
            return
        best = _head(pd.concat(self.best), self.k)
        self.best, self.fresh = [best], 0
        per_query = best.groupby("query_id", sort=False)["score"].agg(["size", "min"])
        full = per_query[per_query["size"] == self.k]
        self.least[full.index] = np.maximum(self.least[full.index], full["min"])


def _across(k: int, threshold: float, id_type: T.DataType):
    out = to_arrow_schema(T.StructType().add("query_id", T.LongType()).add("id", id_type).add("score", T.DoubleType()))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripes: dict[int, _Stripe] = {}
        for batch in batches:
            block, met = None, ()
            for at in range(batch.num_rows):
                cell = {name: batch.column(name)[at] for name in batch.schema.names}
                if cell["asked_width"] != cell["width"]:
                    continue
                width, stripe = cell["width"].as_py(), cell["stripe"].as_py()
                if stripe not in stripes:
                    asked = cell["asked_ids"].values
                    stripes[stripe] = _Stripe(asked, np.frombuffer(cell["asked_vectors"].as_py()).reshape(len(asked), width), k, threshold)
                if cell["block"] != block:
                    ids = cell["ids"].values.to_pandas(integer_object_nulls=True).to_numpy()
                    exact = _unit(np.frombuffer(cell["vectors"].as_py()).reshape(len(ids), width))
                    block, met = cell["block"], (ids, exact, exact.astype(np.float32))
                stripes[stripe].meet(*met)
        for stripe in stripes.values():
            stripe.settle()
            for best in stripe.best:
                ids = stripe.ids.take(pa.array(best["query_id"].to_numpy()))
                found = pa.Table.from_pandas(best[["id", "score"]].assign(query_id=ids.to_numpy())[out.names], out, preserve_index=False)
                yield from found.to_batches()

    return score


def grid(store: DataFrame, queries: DataFrame, n_queries: int):
    """Both sides dealt out as parts of ``PART_ROWS`` store rows and stripes of ``STRIPE_ROWS`` queries, each copied along
    the other: one group per (stripe, part), of bounded size whatever the batch or the store holds.

    Keys are long on both sides, as groups meet by the hash of the typed value.
    """
    number = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    deal = lambda n: F.pmod(F.monotonically_increasing_id(), F.lit(n).cast("long"))
    parts = max(1, -(-store.count() // PART_ROWS))
    stripes = max(1, -(-n_queries // STRIPE_ROWS))
    asked = queries.withColumn("stripe", deal(stripes)).withColumn("part", number(parts))
    stored_ = store.withColumn("piece", deal(parts)).withColumn("band", number(stripes))
    return asked.groupBy("stripe", "part").cogroup(stored_.groupBy("band", "piece"))


def _tile(k: int, threshold: float, id_type):
    out = to_arrow_schema(T.StructType().add("query_id", T.LongType()).add("id", id_type).add("score", T.DoubleType()))

    def score(asked: pa.Table, stored_: pa.Table) -> pa.Table:
        found = _best(asked, stored_, k, threshold)
        return pa.Table.from_pandas(pd.concat(found), out, preserve_index=False) if found else out.empty_table()

    return score


# ---- approximate search ------------------------------------------------------------------------------
@dataclass
class ListIndex:
    """Inverted lists: ``rows`` (list, piece, id, embedding) by nearest centroid; ``pieces`` per list."""

    rows: DataFrame
    centroids: np.ndarray
    pieces: dict[int, int]


def build_lists(store: DataFrame, folder: str, lists: int = LISTS, sample: int = LIST_SAMPLE) -> ListIndex:
    """Write the store as inverted lists, a folder each: every row goes to the list of its nearest centroid.

    Centroids are fitted on a sample of about ``sample`` rows (by hash of the id); every row with a
    vector is indexed. Vectors must have one length.
    """
    store = store.select("id", "embedding").filter("embedding is not null")
    n = max(1, store.count())
    share = min(1.0, sample / n)
    drawn = store.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))).select("embedding").limit(4 * sample)
    drawn = list(_by_length(drawn.toArrow().column("embedding")).values())
    if not drawn:
        raise ValueError("nothing to index")
    centroids = _coarse(drawn[0][1], lists)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nearest = np.zeros(batch.num_rows, np.int32)
            for d, (rows, vectors) in _by_length(batch.column("embedding")).items():
                if d != centroids.shape[1]:
                    raise ValueError(f"a vector of {d} numbers among those of {centroids.shape[1]}")
                nearest[rows] = (vectors @ centroids.T).argmax(axis=1)
            yield batch.append_column("list", pa.array(nearest))

    kinds = {f.name: f.dataType.simpleString() for f in store.schema.fields}
    schema = f"id {kinds['id']}, embedding {kinds['embedding']}, list int"
    placed = stored(store.mapInArrow(assign, schema), "lists")
    sizes = {r["list"]: r["n"] for r in placed.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
    pieces = {c: -(-n // PART_ROWS) for c, n in sizes.items()}
    # A long list is written by as many tasks as it has pieces.
    piece = F.pmod(F.xxhash64("id"), F.element_at(F.create_map(*[F.lit(x).cast("long") for c in pieces.items() for x in c]), F.col("list").cast("long")))
    placed.withColumn("piece", piece).repartition("list", "piece").write.mode("overwrite").partitionBy("list").parquet(folder)
    rows = store.sparkSession.read.schema(f"id {kinds['id']}, embedding {kinds['embedding']}, piece long, list int").parquet(folder)
    return ListIndex(rows, centroids, pieces)


def _coarse(sample: np.ndarray, lists: int, turns: int = 10) -> np.ndarray:
    """Unit centroids of the sample by spherical k-means from evenly spaced starts."""
    ordered = sample[np.lexsort(sample.T)]
    centers = ordered[np.linspace(0, len(ordered) - 1, min(lists, len(ordered))).astype(int)]
    for _ in range(turns):
        nearest = (ordered @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, ordered)
        centers = np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 0, _unit(sums), centers)
    return centers


def approximate_search(
    index: ListIndex, queries: DataFrame, k: int = TOP_K, threshold: float = THRESHOLD, probes: int = PROBES
) -> DataFrame:
    """Index-backed variant of ``similarity_search``: a query looks only into the ``probes`` lists with the nearest centroids."""
    centroids, pieces = index.centroids, index.pieces

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, (rows, vectors) in _by_length(batch.column("embedding")).items():
                if d != centroids.shape[1]:
                    continue
                near = np.argsort(-(vectors @ centroids.T), axis=1, kind="stable")[:, :probes]
                visits = [(r, c, p) for r, row in zip(rows, near, strict=True) for c in row for p in range(pieces.get(int(c), 0))]
                if not visits:
                    continue
                taken, lists, parts = (pa.array(x) for x in zip(*[(int(r), int(c), p) for r, c, p in visits], strict=True))
                picked = batch.select(["query_id", "embedding"]).take(taken)
                columns = [*picked.columns, pa.array(lists, pa.int32()), pa.array(parts, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "embedding", "list", "piece"])

    kind = queries.schema["embedding"].dataType.simpleString()
    visits = queries.select("query_id", "embedding").mapInArrow(probe, f"query_id long, embedding {kind}, list int, piece long")
    # Stripes bound what meets in a list that many queries visit.
    n = max(1, queries.count())
    stripes = -(-n // STRIPE_ROWS)
    visits = stored(visits.withColumn("stripe", F.pmod(F.xxhash64("query_id"), F.lit(stripes))), "visits")
    wanted = visits.select(F.col("list").alias("of"), F.col("piece").alias("part"), F.col("stripe").alias("band")).distinct()
    rows = index.rows
    met = rows.join(wanted, (rows["list"] == wanted["of"]) & (rows["piece"] == wanted["part"])).select("id", "embedding", "of", "part", "band")
    groups = visits.groupBy("list", "piece", "stripe").cogroup(met.groupBy("of", "part", "band"))
    id_type = rows.schema["id"].dataType
    found = groups.applyInArrow(_tile(k, threshold, id_type), f"query_id long, id {id_type.simpleString()}, score double")
    return top_n_per_key(found, ["query_id"], [F.desc("score"), F.asc("id")], k).select("query_id", "rank", "id", "score")


def pair_similarity(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Cosine of every listed pair (left_id, right_id); ``rejected`` where the lengths differ."""
    l = left.select(F.col("id").alias("left_id"), F.col("embedding").alias("_l"))
    r = right.select(F.col("id").alias("right_id"), F.col("embedding").alias("_r"))
    joined = pairs.join(l, "left_id").join(r, "right_id")
    return joined.select(
        *pairs.columns,
        F.round(cosine(F.col("_l"), F.col("_r")), 6).alias("similarity"),
        (F.size("_l") != F.size("_r")).alias("rejected"),
    )


def upsert(store: DataFrame, fresh: DataFrame, key: str = "id") -> DataFrame:
    """Delete-then-add: rows of ``fresh`` replace those with the same id. Write to a new version."""
    return store.join(fresh.select(key), key, "left_anti").select(*fresh.columns).unionByName(fresh)


# ---- prompts ---------------------------------------------------------------------------------------
def context_blocks(hits: DataFrame, documents: DataFrame) -> DataFrame:
    """(query_id, context, sources): ranked documents of a query joined by blank lines; k rows at most
    per query, as the hits are already cut."""
    joined = hits.join(documents.select("id", "text"), "id")
    ordered = joined.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "text", "id"))).alias("docs")
    )
    return ordered.select(
        "query_id",
        F.array_join(F.transform("docs", lambda d: d["text"]), "\n\n").alias("context"),
        F.array_join(F.transform("docs", lambda d: d["id"].cast("string")), ",").alias("sources"),
    )


def render(template: str, **values: Column) -> Column:
    """Replace each ``{name}`` by its column; the template's other text is literal."""
    pieces: list[Column] = []
    rest = template
    while "{" in rest:
        head, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        pieces += [F.lit(head), values[name]]
    return F.concat(*pieces, F.lit(rest))


def rag_prompts(questions: DataFrame, hits: DataFrame, documents: DataFrame, template: str, default: str):
    """(query_id, prompt, sources); a blank question falls back to the default one."""
    asked = questions.select(
        "query_id", F.when(has_text(F.col("question")), F.col("question")).otherwise(F.lit(default)).alias("question")
    )
    joined = asked.join(context_blocks(hits, documents), "query_id", "left")
    return joined.select(
        "query_id",
        render(
            template, question=F.col("question"), context=F.coalesce("context", F.lit(""))
        ).alias("prompt"),
        F.coalesce("sources", F.lit("")).alias("sources"),
    )


def suggestion_prompts(requests: DataFrame) -> DataFrame:
    """Prompt of a template with defaulted variables: request_id, city, budget, vibe.

    Fixed values: defaults Lisbon, 100.0, close to the beach.
    """
    template = (
        "City: {city}\nNightly budget: {budget} USD\nPreferred vibe: {vibe}"
    )
    return requests.select(
        "request_id",
        render(
            template,
            city=F.when(has_text(F.col("city")), F.col("city")).otherwise(F.lit("Lisbon")),
            budget=F.coalesce("budget", F.lit(100.0)).cast("string"),
            vibe=F.when(has_text(F.col("vibe")), F.col("vibe")).otherwise(F.lit("close to the beach")),
        ).alias("prompt"),
    )


def last_questions(turns: DataFrame, default: str) -> DataFrame:
    """(conv_id, question): the newest user turn of each conversation, the default where it is blank or missing."""
    is_user = F.col("role") == "user"
    last = turns.groupBy("conv_id").agg(F.max_by(F.when(is_user, F.col("text")), F.when(is_user, F.col("turn"))).alias("q"))
    return last.select("conv_id", F.when(has_text(F.col("q")), F.col("q")).otherwise(F.lit(default)).alias("question"))


def memory_window(turns: DataFrame, n: int = MEMORY_WINDOW) -> DataFrame:
    """(conv_id, memory): the newest n turns of each conversation, oldest first, as one text.

    Cut to n rows per conversation before anything is gathered.
    """
    recent = top_n_per_key(turns, ["conv_id"], [F.desc("turn")], n, rank_col="recency")
    line = F.concat(F.col("role"), F.lit(": "), F.col("text"))
    gathered = recent.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct(F.col("turn"), line.alias("line")))).alias("lines")
    )
    return gathered.select(
        "conv_id", F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("memory")
    )


def conversation_prompts(
    questions: DataFrame, turns: DataFrame, hits: DataFrame, documents: DataFrame, n: int = MEMORY_WINDOW
) -> DataFrame:
    """Memory window, retrieved context and question per conversation: (conv_id, prompt).

    ``questions``: conv_id, question; ``hits`` carry the conversation id as query_id.
    """
    context = context_blocks(hits, documents).select(F.col("query_id").alias("conv_id"), "context")
    joined = questions.join(memory_window(turns, n), "conv_id", "left").join(context, "conv_id", "left")
    body = F.concat_ws(
        "\n", F.coalesce("memory", F.lit("")), F.coalesce("context", F.lit("")), F.col("question")
    )
    return joined.select("conv_id", body.alias("prompt"))


def call_trace(requests: DataFrame, results: DataFrame, tool: str, arguments: list[str]) -> DataFrame:
    """(request_id, tool, arguments, result_count) for a request batch, zero counts included.

    ``results``: a row per result, or (request_id, n) where they were counted before.
    """
    n = results if results.columns == ["request_id", "n"] else results.groupBy("request_id").agg(F.count(F.lit(1)).alias("n"))
    return requests.join(n, "request_id", "left").select(
        "request_id", F.lit(tool).alias("tool"),
        F.to_json(F.struct(*arguments)).alias("arguments"),
        F.coalesce("n", F.lit(0)).alias("result_count"),
    )
