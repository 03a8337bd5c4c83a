"""Full-text search: inverted index, ranked search, suggestions, highlights.

Scores are standard BM25 (k1 = 1.2, b = 0.75); idf = ln(1 + (N - n + 0.5) / (n + 0.5)). Inside a field
the terms add up, a field's boost multiplies its sum, and the best field decides.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayspark.functions.columns import blank_to_null, clamp, has_text
from stayspark.functions.skew import top_n_per_key
from stayspark.functions.text import STOP_WORDS, is_stop_word, pairs, pairs_of, prefixes, shingles, stem, stem_of, words
from stayspark.operators.filters import hotels_matching_batch
from stayspark.session import stored
from stayspark.sources import snapshots
from stayspark.sources.tables import dealt_by_text

K1, B = 1.2, 0.75
ENGLISH_FIELDS = ("name", "city", "description", "amenities")
OTHER_FIELDS = ("name_alt", "city_alt", "description_alt")

# Field boosts by locale, for search and for suggestions (field, words, boost).
SEARCH_BOOSTS = {
    "en": {
        "name": 4.0, "city": 3.0, "description": 3.0, "amenities": 1.0,
        "name_alt": 1.5, "city_alt": 1.0, "description_alt": 1.0,
    },
    "th": {
        "name_alt": 4.0, "city_alt": 3.0, "description_alt": 3.0,
        "name": 1.5, "city": 1.0, "description": 1.0, "amenities": 0.5,
    },
}
SUGGEST_BOOSTS = {
    "en": (
        ("name", 1, 4.0), ("name", 2, 3.0), ("name", 3, 2.0), ("city", 1, 3.0), ("city", 2, 2.0),
        ("name_alt", 1, 1.2), ("city_alt", 1, 1.0),
    ),
    "th": (
        ("name_alt", 1, 4.0), ("name_alt", 2, 3.0), ("name_alt", 3, 2.0), ("city_alt", 1, 3.0),
        ("city_alt", 2, 2.0), ("name", 1, 1.2), ("city", 1, 1.0),
    ),
}
MAX_SUGGESTIONS = 12
FRAGMENT_CHARS = 120
#: Share of what a query's terms can add at most that is looked up for all documents.
HEAD = 0.65
#: Room for rounding between a floor and the scores compared with it (scores are rounded at 1e-6).
SLACK = 1e-5
Allowed = Callable[[DataFrame], DataFrame]

#: A batch that may travel with the tasks: queries, and their terms in all fields.
BATCH_QUERIES = 4096
BATCH_TERMS = 1024 * 1024
#: Queries and documents whose scores are made by one product of matrices.
TILE = 256
BLOCK = 512


def language(lang: Column) -> Column:
    """Anything starting with ``th`` (ignoring case and blanks) is ``th``; the rest, and null, ``en``."""
    return F.when(F.lower(F.trim(lang)).startswith("th"), "th").otherwise("en")


def project_documents(hotels: DataFrame) -> DataFrame:
    """Search document: analysed fields plus the copies the suggester reads."""
    kept = [
        c for c in (*ENGLISH_FIELDS, *OTHER_FIELDS, "image_url", "star_rating", "guest_rating",
                    "price_per_night") if c in hotels.columns
    ]
    copies = [
        F.col(c).alias(f"{c}_suggest")
        for c in ("name", "name_alt", "city", "city_alt") if c in hotels.columns
    ]
    return hotels.select("id", *kept, *copies)


# ---- index -----------------------------------------------------------------------------------
@dataclass
class Index:
    """postings(field, term, doc_id, tf, len); dictionary(field, term, df, top); stats(field, n_docs, avg_len);
    documents: the projection that was analysed; forward: a row per document, see ``forward_of``.

    ``top`` is the greatest share of its weight that a term reaches in any document.
    """

    postings: DataFrame
    dictionary: DataFrame
    stats: DataFrame
    documents: DataFrame
    forward: DataFrame


def _analysed(counted: DataFrame, key: str) -> DataFrame:
    """English fields drop stop words and stem; the others become character pairs."""
    w = F.col("word")
    english = F.when(is_stop_word(w), F.array().cast("array<string>")).otherwise(F.array(stem(w)))
    terms = F.when(F.col("field").isin(*ENGLISH_FIELDS), english).otherwise(pairs(w))
    return (
        counted.select(key, "field", F.explode(terms).alias("term"), "tf")
        .groupBy(key, "field", "term")
        .agg(F.sum("tf").alias("tf"))
    )


def _text_fields(columns: list[str]) -> tuple[str, ...]:
    return tuple(f for f in (*ENGLISH_FIELDS, *OTHER_FIELDS) if f in columns)


def forward_of(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id and, per text field, ``<field>_terms`` and ``<field>_tfs``, its terms and how often each
    occurs. Both lists are no longer than the text.

    The texts are dealt out by document once, so many characters per task; all else stays in the task. Texts of one id count as
    one. Words are those of ``words``; what they become is worked out once per distinct word of a batch.
    """
    fields = _text_fields(docs.columns)
    dealt = dealt_by_text(docs.select("id", *fields), "id", fields)
    whole = dealt.groupBy("id").agg(*[F.concat_ws(" ", F.collect_list(f)).alias(f) for f in fields])
    kind = docs.schema["id"].dataType.simpleString()
    lists = ", ".join(f"{f}_terms array<string>, {f}_tfs array<bigint>" for f in fields)

    def analyse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [x for f in fields for x in _counted(batch.column(f), f in ENGLISH_FIELDS)]
            names = ["doc_id", *[f"{f}_{x}" for f in fields for x in ("terms", "tfs")]]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names)

    return whole.select("id", *[words(F.col(f)).alias(f) for f in fields]).mapInArrow(analyse, f"doc_id {kind}, {lists}")


def _counted(texts: pa.ListArray, english: bool) -> tuple[pa.ListArray, pa.ListArray]:
    """Terms and their counts for each list of words."""
    found = texts.flatten().dictionary_encode()
    doc = pc.list_parent_indices(texts).to_numpy()
    known = found.dictionary.to_pylist()
    # Each word once per document with its count, then the terms of every distinct word.
    doc, word, n = _summed(doc, found.indices.to_numpy(), np.ones(len(doc), np.int64), len(known))
    terms = [([] if w in STOP_WORDS else [stem_of(w)]) if english else pairs_of(w) for w in known]
    coded = pa.array([t for ts in terms for t in ts], pa.string()).dictionary_encode()
    sizes = np.array([len(ts) for ts in terms], np.int64)
    starts, each = np.cumsum(sizes) - sizes, sizes[word]
    place = np.repeat(starts[word] - (np.cumsum(each) - each), each) + np.arange(each.sum())
    term = coded.indices.to_numpy()[place]
    doc, term, n = _summed(np.repeat(doc, each), term, np.repeat(n, each), len(coded.dictionary))
    ends = np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(ends, coded.dictionary.take(pa.array(term))), pa.ListArray.from_arrays(ends, pa.array(n))


def _summed(doc: np.ndarray, code: np.ndarray, n: np.ndarray, codes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (doc, code) in order, with the sum of their ``n``."""
    cells, at = np.unique(doc.astype(np.int64) * max(codes, 1) + code, return_inverse=True)
    return cells // max(codes, 1), cells % max(codes, 1), np.bincount(at, n, len(cells)).astype(np.int64)


def postings_in(forward: DataFrame) -> DataFrame:
    """(doc_id, field, term, tf, len) of all terms of the forward rows."""
    fields = [c.removesuffix("_terms") for c in forward.columns if c.endswith("_terms")]
    total = lambda f: F.aggregate(f"{f}_tfs", F.lit(0).cast("long"), lambda t, x: t + x)
    field = lambda f: F.struct(F.lit(f).alias("field"), F.col(f"{f}_terms").alias("terms"), F.col(f"{f}_tfs").alias("tfs"), total(f).alias("len"))
    rows = forward.select("doc_id", F.explode(F.array(*map(field, fields))).alias("f"))
    return rows.select("doc_id", "f.field", F.inline(F.arrays_zip("f.terms", "f.tfs")).alias("term", "tf"), "f.len")


def postings_of(docs: DataFrame) -> DataFrame:
    """(doc_id, field, term, tf, len) of every text field of every document, whole texts."""
    return postings_in(forward_of(docs))


def _saturation() -> Column:
    """Share of its weight that a term reaches in a document."""
    tf = F.col("tf")
    return tf / (tf + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * F.col("len") / F.col("avg_len")))


def _stats(forward: DataFrame) -> DataFrame:
    """(field, n_docs, avg_len) over the documents that have a term in the field."""
    fields = [c.removesuffix("_tfs") for c in forward.columns if c.endswith("_tfs")]
    total = lambda f: F.aggregate(f"{f}_tfs", F.lit(0).cast("long"), lambda t, x: t + x)
    lengths = forward.select(F.inline(F.array(*[F.struct(F.lit(f).alias("field"), total(f).alias("len")) for f in fields])))
    return lengths.filter("len > 0").groupBy("field").agg(F.count(F.lit(1)).alias("n_docs"), F.avg("len").alias("avg_len"))


def _dictionary(forward: DataFrame, stats: DataFrame) -> DataFrame:
    """(field, term, df, top); terms are counted per batch of documents first."""
    fields = [c.removesuffix("_terms") for c in forward.columns if c.endswith("_terms")]
    lengths = stats.agg(*[F.max(F.when(F.col("field") == f, F.col("avg_len"))).alias(f"{f}_avg") for f in fields])
    rows = forward.drop("doc_id").crossJoin(F.broadcast(lengths))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in fields:
                lists, tf = batch.column(f"{f}_terms"), batch.column(f"{f}_tfs").flatten().to_numpy()
                if not len(tf):
                    continue
                doc, found = pc.list_parent_indices(lists).to_numpy(), lists.flatten().dictionary_encode()
                share = _share(tf, np.bincount(doc, tf)[doc], batch.column(f"{f}_avg")[0].as_py())
                term, top = found.indices.to_numpy(), np.zeros(len(found.dictionary))
                np.maximum.at(top, term, share)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f] * len(top), pa.string()), found.dictionary, pa.array(np.bincount(term)), pa.array(top)], ["field", "term", "df", "top"])

    counted = rows.mapInArrow(count, "field string, term string, df bigint, top double")
    return counted.groupBy("field", "term").agg(F.sum("df").alias("df"), F.max("top").alias("top"))


def _share(tf: np.ndarray, length: np.ndarray, avg_len: float) -> np.ndarray:
    """``_saturation`` inside a task."""
    return tf / (tf + K1 * (1 - B + B * length / avg_len))


def build_index(docs: DataFrame) -> Index:
    """The index as a plan; ``publish_index`` stores it."""
    forward = forward_of(docs)
    postings, stats = postings_in(forward), _stats(forward)
    return Index(postings, _dictionary(forward, stats), stats, docs, forward)


def write_index(docs: DataFrame, folder: str) -> None:
    """Analyse the documents once and write the index. Postings are read from the forward rows, which have columns per field,
    so that a query batch reads the fields its boosts name and no texts at all."""
    spark = docs.sparkSession
    docs.write.mode("overwrite").parquet(f"{folder}/documents")
    documents = spark.read.schema(docs.schema).parquet(f"{folder}/documents")
    made = forward_of(documents)
    made.write.mode("overwrite").parquet(f"{folder}/forward")
    forward = spark.read.schema(made.schema).parquet(f"{folder}/forward")
    _stats(forward).coalesce(1).write.mode("overwrite").parquet(f"{folder}/stats")
    stats = spark.read.schema(_STATS).parquet(f"{folder}/stats")
    _dictionary(forward, stats).write.mode("overwrite").partitionBy("field").parquet(f"{folder}/dictionary")


_STATS = "field string, n_docs long, avg_len double"


def read_index(spark: SparkSession, folder: str) -> Index:
    forward = spark.read.parquet(f"{folder}/forward")
    return Index(
        postings_in(forward),
        spark.read.schema("term string, df long, top double, field string").parquet(f"{folder}/dictionary"),
        spark.read.schema(_STATS).parquet(f"{folder}/stats"),
        spark.read.parquet(f"{folder}/documents"),
        forward,
    )


def publish_index(docs: DataFrame, root: str) -> Index:
    """Full rebuild: analyse into a new version, then swap the pointer that readers follow."""
    spark = docs.sparkSession
    return read_index(spark, snapshots.publish_folder(spark, root, lambda folder: write_index(docs, folder)))


def current_index(spark: SparkSession, root: str) -> Index:
    """The published index."""
    folder = snapshots.current_folder(spark, root)
    if folder is None:
        raise FileNotFoundError(f"nothing published under {root}")
    return read_index(spark, folder)


# ---- ranked search -----------------------------------------------------------------------------
def _boosts(lang: Column) -> Column:
    def table(code):
        return F.array(
            *[
                F.struct(F.lit(f).alias("field"), F.lit(b).alias("boost"))
                for f, b in SEARCH_BOOSTS[code].items()
            ]
        )

    return F.when(lang == "th", table("th")).otherwise(table("en"))


def query_terms(queries: DataFrame) -> DataFrame:
    """(query_id, field, term, qtf, boost) of the queries that have text."""
    texts = queries.filter(has_text(F.col("q"))).select(
        "query_id", language(F.col("lang")).alias("lang"), F.col("q")
    )
    boosted = texts.select("query_id", "q", F.explode(_boosts(F.col("lang"))).alias("f"))
    boosts = texts.select("query_id", F.explode(_boosts(F.col("lang"))).alias("f")).select(
        "query_id", "f.field", "f.boost"
    )
    counted = (
        boosted.select("query_id", "f.field", F.explode(words(F.col("q"))).alias("word"))
        .groupBy("query_id", "field", "word")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    terms = _analysed(counted, "query_id").withColumnRenamed("tf", "qtf")
    return terms.join(boosts, ["query_id", "field"])


def _weights(index: Index, queries: DataFrame) -> DataFrame:
    """(query_id, field, term, avg_len, weight, most): a term's weight in a query, and the most it adds to any document."""
    n, df = F.col("n_docs"), F.col("df")
    idf = F.log(F.lit(1.0) + (n - df + 0.5) / (df + 0.5))
    weight = F.col("qtf") * F.col("boost") * idf
    return (
        query_terms(queries)
        .join(index.dictionary, ["field", "term"])
        .join(index.stats, "field")
        .select("query_id", "field", "term", "avg_len", weight.alias("weight"), (weight * F.col("top")).alias("most"))
    )


def _sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy("query_id", "doc_id", "field").agg(F.sum(F.col("weight") * _saturation()).alias("field_score"))


class _Batch:
    """The weights of a batch of queries, as what the tasks multiply with: per ``TILE`` queries and field, the terms and a
    matrix (term, query). ``ids``: the queries by their places in the tiles."""

    def __init__(self, weights: pa.Table):
        coded = weights.column("query_id").combine_chunks().dictionary_encode()
        self.ids, query = coded.dictionary, coded.indices.to_numpy()
        fields, value = weights.column("field").to_numpy(), weights.column("weight").to_numpy()
        lengths = weights.column("avg_len").to_numpy()
        self.terms, self.avg_len, placed = {}, {}, {}
        for f in sorted(set(fields)):
            rows = np.flatnonzero(fields == f)
            known = weights.column("term").combine_chunks().take(pa.array(rows)).dictionary_encode()
            self.terms[f], self.avg_len[f] = known.dictionary, lengths[rows[0]]
            placed[f] = rows, known.indices.to_numpy()
        self.tiles, self.block = [], BLOCK
        for first in range(0, len(self.ids), TILE):
            tile = {}
            for f, (rows, term) in placed.items():
                inside = (query[rows] >= first) & (query[rows] < first + TILE)
                used, at = np.unique(term[inside], return_inverse=True)
                if not len(used):
                    continue
                column = np.full(len(self.terms[f]), -1)
                column[used] = np.arange(len(used))
                matrix = np.zeros((len(used), min(TILE, len(self.ids) - first)))
                np.add.at(matrix, (at, query[rows][inside] - first), value[rows][inside])
                tile[f] = column, matrix
            self.tiles.append((first, tile))

    def found(self, batch: pa.RecordBatch) -> dict:
        """field -> (doc, term, saturation) of the postings that some query asks for."""
        out = {}
        for f, terms in self.terms.items():
            if f"{f}_terms" not in batch.schema.names:
                continue
            lists, tf = batch.column(f"{f}_terms"), batch.column(f"{f}_tfs").flatten().to_numpy()
            doc = pc.list_parent_indices(lists).to_numpy()
            total = np.bincount(doc, tf, batch.num_rows)
            term = pc.fill_null(pc.index_in(lists.flatten(), terms), -1).to_numpy()
            known = term >= 0
            doc, tf = doc[known], tf[known]
            out[f] = doc, term[known], _share(tf, total[doc], self.avg_len[f])
        return out

    def scores(self, batch: pa.RecordBatch) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
        """(first query, field -> matrix of field scores (document, query)) for each tile; ``BLOCK`` documents a product."""
        found = self.found(batch)
        for first, tile in self.tiles:
            out = {}
            for f, (column, matrix) in tile.items():
                if f not in found:
                    continue
                doc, term, share = found[f]
                used = column[term] >= 0
                doc, term, share = doc[used], column[term[used]], share[used]
                scores = np.zeros((batch.num_rows, matrix.shape[1]))
                for low in range(0, batch.num_rows, self.block):
                    a, b = np.searchsorted(doc, [low, low + self.block])
                    if a < b:
                        part = np.zeros((min(self.block, batch.num_rows - low), len(matrix)))
                        part[doc[a:b] - low, term[a:b]] = share[a:b]
                        scores[low : low + self.block] = part @ matrix
                out[f] = scores
            yield first, out


def _travelling(weights: DataFrame) -> _Batch | None:
    """The weights, stored before, if they are few enough to travel with the tasks."""
    size = weights.agg(F.count(F.lit(1)).alias("terms"), F.countDistinct("query_id").alias("queries")).first()
    fits = size["queries"] <= BATCH_QUERIES and size["terms"] <= BATCH_TERMS
    return _Batch(weights.select("query_id", "field", "term", "avg_len", "weight").toArrow()) if fits else None


def _lists_of(forward: DataFrame, fields: list[str]) -> list[str]:
    return [c for f in fields for c in (f"{f}_terms", f"{f}_tfs") if c in forward.columns]


def field_scores(index: Index, queries: DataFrame) -> DataFrame:
    """(query_id, doc_id, field, field_score) of every document that has a term of the query: BM25 sum per field times
    its boost. Ranked search does not need all of them, see ``bounded_hits``."""
    return _sums(index.postings.join(_weights(index, queries), ["field", "term"]))


def best_fields(scores: DataFrame) -> DataFrame:
    return scores.groupBy("query_id", "doc_id").agg(F.max("field_score").alias("score"))


def bounded_hits(index: Index, weights: DataFrame, k: int, allowed: Allowed | None = None) -> DataFrame:
    """(query_id, doc_id, score): all documents that can be among the k best of a query, with exact scores; for batches too large
    to travel with the tasks.

    ``weights``: see ``_weights``, stored. ``allowed`` restricts rows (query_id, doc_id, ...) to the documents that a query admits.

    1. The terms of a query's field are ordered by the most they can add, rare ones first, and only the head that makes up
       ``HEAD`` of the sum is looked up for all documents.
    2. The documents that lead so far are scored in full; the k-th of these scores is a floor for the query.
    3. A document stays only if its head's score and the most that the tail could add reach the floor; it is scored in full
       from its own postings. Documents without any term of the head need no look unless the tail alone reaches
       the floor; such fields, few, are scored for all their documents.
    """
    ranked = Window.partitionBy("query_id", "field").orderBy(F.desc("most"), "term")
    whole = Window.partitionBy("query_id", "field")
    before = F.sum("most").over(ranked.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("most")
    weights = weights.withColumn("head", before < HEAD * F.sum("most").over(whole))
    weights = weights.withColumn("tail", F.sum(F.when(F.col("head"), 0.0).otherwise(F.col("most"))).over(whole))
    weights = stored(weights, "query-weights")
    allowed = allowed or (lambda rows: rows)
    looked_up = index.postings.join(weights.filter("head").drop("tail"), ["field", "term"])
    heads = stored(allowed(_sums(looked_up)), "query-heads")
    leading = top_n_per_key(best_fields(heads), ["query_id"], [F.desc("score"), F.asc("doc_id")], 2 * k, "turn")
    exact = best_fields(_from_documents(index, weights, leading.select("query_id", "doc_id")))
    floors = top_n_per_key(exact, ["query_id"], [F.desc("score")], k, "turn").groupBy("query_id").agg(
        F.when(F.count(F.lit(1)) == k, F.min("score") - SLACK).otherwise(F.lit(0.0)).alias("floor")
    )
    tails = weights.groupBy("query_id", "field").agg(F.first("tail").alias("tail"))
    limits = stored(tails.join(floors, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(0.0))), "query-limits")
    open_fields = limits.filter("tail > 0 and tail >= floor").select("query_id", "field")
    wide = weights.join(open_fields, ["query_id", "field"], "left_semi")
    everywhere = allowed(_sums(index.postings.join(wide, ["field", "term"])))
    near = heads.join(limits.filter("tail = 0 or tail < floor"), ["query_id", "field"])
    near = near.filter("field_score + tail >= floor")
    done = near.filter("tail = 0").select("query_id", "doc_id", "field", "field_score")
    rest = _from_documents(index, weights, near.filter("tail > 0").select("query_id", "doc_id", "field").distinct())
    return best_fields(everywhere.unionByName(done).unionByName(rest))


def _from_documents(index: Index, weights: DataFrame, asked: DataFrame) -> DataFrame:
    """Field scores of the asked (query_id, doc_id[, field]) from all postings of those documents."""
    keys = [c for c in ("doc_id", "field") if c in asked.columns]
    return _sums(index.postings.join(asked, keys).join(weights, ["query_id", "field", "term"]))


def block_hits(index: Index, batch: _Batch, weights: DataFrame, k: int, facts: DataFrame | None = None, bounds: pa.Table | None = None,
               cities: _Batch | None = None) -> DataFrame:
    """(query_id, doc_id, score): the k best documents of each query among those of every batch of forward rows, with exact
    scores at six decimals; nothing is shuffled for them.

    ``facts`` and ``bounds``: documents with their price, and rows of (query_id, min_price, max_price, _asked), one of which must
    admit the document; ``cities``: the terms asked for in the city fields.
    """
    forward = index.forward.select("doc_id", *_lists_of(index.forward, sorted({*batch.terms, *(cities.terms if cities else ())})))
    forward = forward.filter("doc_id is not null")
    if facts is not None:
        forward = forward.join(facts.select("doc_id", "price_per_night"), "doc_id")
    kinds = {f.name: f.dataType.simpleString() for f in (*weights.schema, *index.forward.schema)}
    admits = _admitted(batch.ids, bounds, cities)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            turn = pc.rank(rows.column("doc_id"), tiebreaker="dense").to_numpy()
            admitted = admits(rows)
            for first, fields in batch.scores(rows):
                if not fields:
                    continue
                scores = np.round(np.maximum.reduce(list(fields.values())), 6)
                # A score that rounds to nothing is still a hit.
                keep = np.logical_or.reduce([x > 0 for x in fields.values()])
                if admitted is not None:
                    keep &= admitted[:, first : first + scores.shape[1]]
                ranked = np.where(keep, scores, -1.0)
                if len(ranked) > k and turn.max() == len(ranked):
                    keep &= ranked >= np.partition(ranked, len(ranked) - k, axis=0)[len(ranked) - k]
                doc, query = np.nonzero(keep)
                order = np.lexsort((turn[doc], -scores[doc, query], query))
                doc, query = doc[order], query[order]
                again = (turn[doc[1:]] == turn[doc[:-1]]) & (query[1:] == query[:-1])  # ids with several prices
                doc, query = doc[np.r_[True, ~again][: len(doc)]], query[np.r_[True, ~again][: len(query)]]
                nth = np.arange(len(query)) - np.searchsorted(query, query)
                doc, query = doc[nth < k], query[nth < k]
                yield pa.RecordBatch.from_arrays(
                    [batch.ids.take(pa.array(first + query)), rows.column("doc_id").take(pa.array(doc)), pa.array(scores[doc, query])],
                    ["query_id", "doc_id", "score"])

    hits = forward.mapInArrow(best, f"query_id {kinds['query_id']}, doc_id {kinds['doc_id']}, score double")
    return hits if facts is None else best_fields(hits.withColumnRenamed("score", "field_score"))


def _admitted(ids: pa.Array, bounds: pa.Table | None, cities: _Batch | None):
    """From forward rows to a matrix (document, query) of what price and city admit, None if nothing is asked."""
    if bounds is None:
        return lambda rows: None
    query = pc.index_in(bounds.column("query_id").combine_chunks(), ids)
    bounds = bounds.append_column("query", query).filter(pc.is_valid(query))
    query = bounds.column("query").to_numpy()
    least, most = (bounds.column(c).cast(pa.float64()).to_numpy() for c in ("min_price", "max_price"))
    anywhere = np.zeros(len(ids), bool)
    anywhere[query[bounds.column("_asked").is_null().to_numpy()]] = True

    def admitted(rows: pa.RecordBatch) -> np.ndarray:
        fit = np.zeros((rows.num_rows, len(ids)), bool)
        price = rows.column("price_per_night").cast(pa.float64()).to_numpy(zero_copy_only=False)[:, None] if "price_per_night" in rows.schema.names else None
        for at in range(0, len(query), TILE):
            q, low, high = query[at : at + TILE], least[at : at + TILE], most[at : at + TILE]
            inside = np.ones((rows.num_rows, len(q)), bool) if price is None else (np.isnan(low) | (price >= low)) & (np.isnan(high) | (price <= high))
            np.logical_or.at(fit, (slice(None), q), inside)
        place = np.broadcast_to(anywhere, fit.shape).copy()
        for first, fields in cities.scores(rows) if cities else ():
            for scores in fields.values():
                met = pc.fill_null(pc.index_in(cities.ids.slice(first, scores.shape[1]), ids), -1).to_numpy()
                place[:, met[met >= 0]] |= scores[:, met >= 0] > 0
        return fit & place

    return admitted


def _city_terms(queries: DataFrame) -> DataFrame:
    """(query_id, field, term) of the city arguments, analysed as either city field is."""
    asked = queries.filter(has_text(F.col("city"))).select("query_id", F.col("city").alias("text"))
    both = asked.select(
        "query_id", F.explode(F.array(F.lit("city"), F.lit("city_alt"))).alias("field"), "text"
    )
    counted = both.select("query_id", "field", F.explode(words(F.col("text"))).alias("word"), F.lit(1).alias("tf"))
    return _analysed(counted, "query_id").select("query_id", "field", "term")


def city_matches(index: Index, queries: DataFrame) -> DataFrame:
    """(query_id, doc_id) where the city argument matches either city field, analysed."""
    cities = index.postings.filter(F.col("field").isin("city", "city_alt"))
    return cities.join(_city_terms(queries), ["field", "term"]).select("query_id", "doc_id").distinct()


def search(
    index: Index, docs: DataFrame, queries: DataFrame, k: int = 20
) -> DataFrame:
    """Top-k (query_id, rank, doc_id, score) per query, by (score desc, id asc).

    queries: query_id, q, lang and optionally city, min_price, max_price. Filters exclude documents
    before anything is scored in full; a blank query matches everything with score 1.
    """
    facts = docs.select(F.col("id").alias("doc_id"), "city", "price_per_night")
    full = queries
    for c in ("city", "min_price", "max_price"):
        if c not in full.columns:
            full = full.withColumn(c, F.lit(None).cast("string" if c == "city" else "double"))
    bounds = full.select("query_id", "min_price", "max_price", blank_to_null(F.col("city")).alias("_asked"))
    price = F.col("price_per_night")

    def in_city(rows: DataFrame) -> DataFrame:
        matched = city_matches(index, full).withColumn("_in_city", F.lit(True))
        joined = rows.join(bounds.select("query_id", "_asked"), "query_id").join(matched, ["query_id", "doc_id"], "left")
        return joined.filter("_asked is null or _in_city").select(*rows.columns)

    def in_price(rows: DataFrame) -> DataFrame:
        joined = rows.join(bounds.select("query_id", "min_price", "max_price"), "query_id").join(facts.drop("city"), "doc_id")
        least = F.col("min_price").isNull() | (price >= F.col("min_price"))
        return joined.filter(least & (F.col("max_price").isNull() | (price <= F.col("max_price")))).select(*rows.columns)

    def allowed(rows: DataFrame) -> DataFrame:
        rows = in_price(rows) if {"min_price", "max_price"} & set(queries.columns) else rows
        return in_city(rows) if "city" in queries.columns else rows

    blank = _all_documents(facts, full.filter(~has_text(F.col("q"))))
    blank = in_city(blank) if "city" in queries.columns else blank
    weights = stored(_weights(index, queries), "query-weights")
    batch = _travelling(weights)
    if batch is None:
        hits = bounded_hits(index, weights, k, allowed)
    else:
        priced = facts if {"min_price", "max_price"} & set(queries.columns) else None
        asked = bounds.toArrow() if {"city", "min_price", "max_price"} & set(queries.columns) else None
        named = _city_terms(full).select("*", F.lit(1.0).alias("avg_len"), F.lit(1.0).alias("weight")).toArrow() if "city" in queries.columns else None
        hits = block_hits(index, batch, weights, k, priced, asked, _Batch(named) if named is not None else None)
    hits = hits.unionByName(blank)
    rounded = hits.withColumn("score", F.round("score", 6))
    return top_n_per_key(rounded, ["query_id"], [F.desc("score"), F.asc("doc_id")], k).select(
        "query_id", "rank", "doc_id", "score"
    )


def _all_documents(facts: DataFrame, blank: DataFrame) -> DataFrame:
    """Blank queries match every document inside their price window (a range join on the price)."""
    asked = blank.select(
        F.col("query_id").alias("request_id"), F.lit(None).cast("string").alias("city"),
        "min_price", "max_price",
    )
    matched = hotels_matching_batch(facts, asked)
    return matched.select(
        F.col("request_id").alias("query_id"), "doc_id", F.lit(1.0).alias("score")
    )


def explain_search(index: Index, queries: DataFrame) -> DataFrame:
    """``explain_fields`` of all field scores of a batch. Those of a batch that travels with the tasks are counted where they
    are made, a row per query and field for each batch of documents goes on."""
    weights = stored(_weights(index, queries), "query-weights")
    batch = _travelling(weights)
    if batch is None:
        return explain_fields(field_scores(index, queries))
    forward = index.forward.select("doc_id", *_lists_of(index.forward, list(batch.terms)))
    kind = weights.schema["query_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for first, fields in batch.scores(rows):
                for f, scores in fields.items():
                    n = np.count_nonzero(scores > 0, axis=0)
                    some = np.flatnonzero(n)
                    best = scores.max(axis=0, initial=0.0)
                    yield pa.RecordBatch.from_arrays(
                        [batch.ids.take(pa.array(first + some)), pa.array([f] * len(some), pa.string()), pa.array(n[some]), pa.array(best[some])],
                        ["query_id", "field", "n", "best"])

    counted = forward.mapInArrow(count, f"query_id {kind}, field string, n bigint, best double")
    return counted.groupBy("query_id", "field").agg(F.sum("n").alias("n_docs"), F.round(F.max("best"), 6).alias("best_score"))


def explain_fields(scores: DataFrame) -> DataFrame:
    """Per query and field: how many documents it scored and its best score."""
    return scores.groupBy("query_id", "field").agg(
        F.count(F.lit(1)).alias("n_docs"), F.round(F.max("field_score"), 6).alias("best_score")
    )


# ---- highlights ----------------------------------------------------------------------------------
#: Scripts that write words without spaces between them, as regular-expression classes.
UNSPACED = r"\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsHan}\p{IsHiragana}\p{IsKatakana}"
_WORD = r"\p{L}\p{M}\p{N}"


def _pattern(tokens: Column, english: bool) -> Column:
    """What marks the query words in a text, null if nothing can.

    Whole words, with the word forms that the stemmer folds together. In second-locale fields also runs of the query's
    character pairs, as these fields are indexed, where a script has no spaces: each place of the run begins a pair, so overlapping
    pairs are one hit.
    """
    if english:
        stems = F.array_distinct(
            F.transform(F.filter(tokens, lambda w: ~is_stop_word(w)), lambda w: stem(w))
        )
        forms = F.transform(
            stems,
            lambda t: F.when(
                t.endswith("y"), F.concat(t, F.lit("s?|"), F.left(t, F.length(t) - 1), F.lit("ies"))
            ).otherwise(F.concat(t, F.lit("s?"))),
        )
        unspaced = F.array().cast("array<string>")
    else:
        forms = F.array_distinct(tokens)
        unspaced = F.array_distinct(F.flatten(F.transform(F.filter(tokens, lambda w: w.rlike(f"^[{UNSPACED}]{{2,}}$")), pairs)))
    whole = F.concat(F.lit(f"(?<![{_WORD}])(?:"), F.array_join(forms, "|"), F.lit(f")(?![{_WORD}])"))
    runs = F.concat(F.lit("(?:(?="), F.array_join(unspaced, "|"), F.lit(").)+."))
    body = F.when(F.size(unspaced) > 0, F.concat(runs, F.lit("|"), whole)).otherwise(whole)
    return F.when(F.size(forms) > 0, F.concat(F.lit("(?iu)("), body, F.lit(")")))


def _at_borders(text: Column, start: Column) -> Column:
    """``FRAGMENT_CHARS`` characters from ``start``, without the parts of words that the cut left at either end (words of up
    to 20 characters; longer runs, as in scripts without spaces, stay)."""
    cut = F.substring(text, start, F.lit(FRAGMENT_CHARS))
    inside = (start > 1) & F.substring(text, start - 1, F.lit(1)).rlike(f"[{_WORD}]")
    cut = F.when(inside, F.regexp_replace(cut, f"^[{_WORD}]{{1,20}}(?![{_WORD}])", "")).otherwise(cut)
    goes_on = F.substring(text, start + FRAGMENT_CHARS, F.lit(1)).rlike(f"[{_WORD}]")
    return F.trim(F.when(goes_on, F.regexp_replace(cut, f"(?<![{_WORD}])[{_WORD}]{{1,20}}$", "")).otherwise(cut))


def highlights(hits: DataFrame, docs: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, doc_id, field, fragment) for the ranked hits only: hits wrapped in ``<mark>``,
    one fragment of 120 characters per matching field."""
    fields = [f for f in ("name", "name_alt", "city", "city_alt", "description", "description_alt")
              if f in docs.columns]
    texts = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields])
    tokens = queries.select("query_id", words(F.col("q")).alias("_tokens")).select(
        "query_id",
        _pattern(F.col("_tokens"), True).alias("_english"),
        _pattern(F.col("_tokens"), False).alias("_plain"),
    )
    rows = (
        hits.select("query_id", "doc_id")
        .join(docs.withColumnRenamed("id", "doc_id"), "doc_id")
        .select("query_id", "doc_id", F.explode(texts).alias("f"))
        .filter("f.text is not null")
        .join(tokens, "query_id")
        .select(
            "query_id", "doc_id", F.col("f.field").alias("field"), F.col("f.text").alias("text"),
            F.when(F.col("f.field").isin(*ENGLISH_FIELDS), F.col("_english"))
            .otherwise(F.col("_plain")).alias("pattern"),
        )
        .filter(F.col("pattern").isNotNull())
    )
    first = F.regexp_instr("text", "pattern")
    start = F.greatest(F.lit(1), F.col("first") - FRAGMENT_CHARS // 2)
    cut = _at_borders(F.col("text"), start)
    return (
        rows.withColumn("first", first)
        .filter("first > 0")
        .select(
            "query_id", "doc_id", "field",
            F.regexp_replace(cut, F.col("pattern"), F.lit("<mark>$1</mark>")).alias("fragment"),
        )
    )


# ---- suggestions -----------------------------------------------------------------------------------
@dataclass
class SuggestIndex:
    """postings(field, n, term, doc_id, tf, len); dictionary(field, n, term, df); stats(field, n, ...)."""

    postings: DataFrame
    dictionary: DataFrame
    stats: DataFrame


def build_suggest_index(docs: DataFrame) -> SuggestIndex:
    """Words and 2- and 3-word shingles of the name and city fields."""
    slots = F.array(
        *[
            F.struct(
                F.lit(f).alias("field"),
                F.lit(n).alias("n"),
                shingles(_suggest_words(F.col(f), f in ENGLISH_FIELDS), n).alias("terms"),
            )
            for f, n in _suggest_slots() if f in docs.columns
        ]
    )
    tf = (
        docs.select(F.col("id").alias("doc_id"), F.explode(slots).alias("s"))
        .select("doc_id", "s.field", "s.n", F.explode("s.terms").alias("term"))
        .groupBy("field", "n", "term", "doc_id")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    lengths = tf.groupBy("field", "n", "doc_id").agg(F.sum("tf").alias("len"))
    stats = lengths.groupBy("field", "n").agg(
        F.count(F.lit(1)).alias("n_docs"), F.avg("len").alias("avg_len")
    )
    dictionary = tf.groupBy("field", "n", "term").agg(F.count(F.lit(1)).alias("df"))
    return SuggestIndex(tf.join(lengths, ["field", "n", "doc_id"]), dictionary, stats)


def _suggest_words(text: Column, english: bool) -> Column:
    """English copies drop stop words and stem; the others keep their words."""
    if not english:
        return words(text)
    return F.transform(F.filter(words(text), lambda w: ~is_stop_word(w)), lambda w: stem(w))


def _suggest_slots() -> list[tuple[str, int]]:
    return sorted({(f, n) for table in SUGGEST_BOOSTS.values() for f, n, _ in table})


def suggest(index: SuggestIndex, queries: DataFrame, max_size: int = MAX_SUGGESTIONS) -> DataFrame:
    """Top suggestions per typed text: (query_id, rank, doc_id, score).

    queries: query_id, q, lang, size. In every slot all words (or shingles) but the last must occur
    as they are and score by BM25; the last counts as a prefix with constant score 1. A slot's sum
    times its boost adds up over slots. Blank input suggests nothing.
    """
    def table(code):
        return F.array(
            *[
                F.struct(F.lit(f).alias("field"), F.lit(n).alias("n"), F.lit(b).alias("boost"))
                for f, n, b in SUGGEST_BOOSTS[code]
            ]
        )

    lang = language(F.col("lang"))
    typed = queries.filter(has_text(F.col("q"))).select(
        "query_id",
        _suggest_words(F.col("q"), True).alias("_english"),
        _suggest_words(F.col("q"), False).alias("_plain"),
        F.explode(F.when(lang == "th", table("th")).otherwise(table("en"))).alias("s"),
    )
    english = F.col("s.field").isin(*ENGLISH_FIELDS)
    typed = typed.withColumn("w", F.when(english, F.col("_english")).otherwise(F.col("_plain")))
    n = F.col("s.n")
    terms = F.when(n == 1, F.col("w")).when(n == 2, shingles(F.col("w"), 2)).otherwise(
        shingles(F.col("w"), 3)
    )
    slots = typed.select("query_id", "s.field", "s.n", "s.boost", terms.alias("terms")).filter(
        F.size("terms") > 0
    )
    whole = slots.select(
        "query_id", "field", "n", "boost",
        F.explode(F.slice("terms", F.lit(1), F.size("terms") - 1)).alias("term"),
    )
    last = slots.select(
        "query_id", "field", "n", "boost", F.element_at("terms", -1).alias("prefix")
    )
    nd, df, tf = F.col("n_docs"), F.col("df"), F.col("tf")
    idf = F.log(F.lit(1.0) + (nd - df + 0.5) / (df + 0.5))
    bm25 = idf * tf / (
        tf + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * F.col("len") / F.col("avg_len"))
    )
    slot = ["field", "n"]
    exact = (
        whole.join(index.dictionary, [*slot, "term"])
        .join(index.stats, slot)
        .join(index.postings, [*slot, "term"])
        .select("query_id", "doc_id", (F.col("boost") * bm25).alias("part"))
    )
    # The prefixes of the distinct terms, not of their postings, meet the typed prefix.
    starts = index.dictionary.select(*slot, "term", F.explode(prefixes(F.col("term"))).alias("prefix"))
    begun = (
        last.join(starts, [*slot, "prefix"])
        .join(index.postings, [*slot, "term"])
        .select("query_id", "field", "n", "boost", "doc_id")
        .distinct()
        .select("query_id", "doc_id", F.col("boost").alias("part"))
    )
    sizes = queries.select("query_id", clamp(F.col("size"), 1, max_size).alias("_size"))
    scored = (
        exact.unionByName(begun)
        .groupBy("query_id", "doc_id")
        .agg(F.round(F.sum("part"), 6).alias("score"))
    )
    ranked = top_n_per_key(scored, ["query_id"], [F.desc("score"), F.asc("doc_id")], max_size)
    return ranked.join(sizes, "query_id").filter("rank <= _size").select(
        "query_id", "rank", "doc_id", "score"
    )


def indexed_ids(index: Index) -> DataFrame:
    """Ids of the documents that have postings."""
    return index.postings.select(F.col("doc_id").alias("id")).distinct()


def index_status(table: DataFrame, index: Index) -> DataFrame:
    """One row: documents in the table, in the index, and whether they agree."""
    t = table.agg(F.count(F.lit(1)).alias("n")).scalar()
    i = indexed_ids(index).agg(F.count(F.lit(1)).alias("n")).scalar()
    both = table.sparkSession.range(1).select(t.alias("in_table"), i.alias("in_index"))
    return both.withColumn("in_sync", F.col("in_table") == F.col("in_index"))
