"""Language of a document by the nearest of several centroids per language.

A text is lower-cased, everything but letters becomes one space, and its runs of one to three characters are
counted in ``BUCKETS`` hashed places. The vector is the logarithm of 1 + count times the inverse document
frequency, of unit length. Document frequencies are counted over all documents that may be learned from.
Centroids come from a bounded sample, about ``SAMPLE`` documents of each language with the least hashes of id and
text, rows equal in both taken once, by spherical k-means with ``CENTROIDS`` centres. A document gets the language of the centroid with the greatest cosine. It is rejected,
as in none of the languages, if that cosine is below ``MARGIN`` times the 1 % quantile that the language's own
sample has.

A text that is null or has no letter is ``und`` with score 0, and so is every text if there is nothing to
learn from. Rows without a language teach nothing. Repeated rows are predicted each. An empty table gives
no rows. The model on the driver has one row per centroid: its size depends on the number of languages, not
of documents.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayspark.llm.common import whole

BUCKETS = 4096
SAMPLE = 1500
CENTROIDS = 4
MARGIN = 0.5
BATCH = 128
#: Signs that Python counts to words and that are neither letters nor digits: powers, fractions, numbers in circles, ...
NUMERALS = frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if c.isnumeric() and not c.isalpha() and not c.isdecimal())
NOT_LETTERS = re.compile(r"[\W\d_]+")


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text is ``fold`` modulo ``folds``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == fold


def counts(text: str) -> np.ndarray | None:
    """Hashed counts of the runs of letters, none for a text without a letter."""
    text = text.lower()
    # In a pattern every letter would be held against each of the numerals; few texts have any.
    for sign in NUMERALS.intersection(text):
        text = text.replace(sign, " ")
    letters = NOT_LETTERS.sub(" ", text).strip(" ")
    if not letters:
        return None
    c = np.frombuffer(f" {letters} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    mixed = [c * np.uint32(2654435761)]
    mixed.append(mixed[0][:-1] * np.uint32(31) + c[1:] * np.uint32(2246822519))
    mixed.append(mixed[1][:-1] * np.uint32(31) + c[2:] * np.uint32(3266489917))
    return np.bincount(np.concatenate(mixed) >> np.uint32(20), minlength=BUCKETS)


def vectors(texts: list[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of the texts that have letters, and which those are."""
    found, rows = [], []
    for i, text in enumerate(texts):
        n = counts(text)
        if n is not None:
            found.append(np.log1p(n.astype(np.float32)) * idf)
            rows.append(i)
    if not found:
        return np.empty((0, BUCKETS), np.float32), np.array(rows, int)
    x = np.stack(found)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9), np.array(rows, int)


def cluster(x: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, float]:
    """Unit centroids by spherical k-means from farthest-first starts, and the 1 % quantile of the cosine."""
    centres = x.mean(axis=0, keepdims=True)
    centres /= max(float(np.linalg.norm(centres)), 1e-9)
    while len(centres) < min(k, len(x)):
        centres = np.vstack([centres, x[np.argmin((x @ centres.T).max(axis=1))]])
    for _ in range(rounds):
        own = np.argmax(x @ centres.T, axis=1)
        sums = np.stack([x[own == i].sum(axis=0) if (own == i).any() else centres[i] for i in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return centres, float(np.quantile((x @ centres.T).max(axis=1), 0.01))


class Model:
    """Inverse document frequencies, centroids, their languages and the languages' quantiles."""

    def __init__(self, idf: np.ndarray, centres: np.ndarray, names: list[str], floors: np.ndarray):
        self.idf, self.centres, self.names, self.floors = idf, centres, names, floors

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        names, score, rejected = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        if len(self.names):
            x, rows = vectors(texts, self.idf)
            cosine = x @ self.centres.T
            best = np.argmax(cosine, axis=1)
            score[rows] = np.clip(cosine[np.arange(len(rows)), best], 0, 1)
            rejected[rows] = score[rows] < MARGIN * self.floors[best]
            for i, b in zip(rows, best, strict=True):
                names[i] = self.names[b]
        return names, score, rejected


def fit(learn: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of (doc_id, text, lang) rows."""
    learn = learn.where(F.col("lang").isNotNull() & F.col("text").isNotNull())

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                c = counts(text)
                if c is not None:
                    df += c > 0
                    n += 1
        yield pd.DataFrame({"bucket": np.arange(-1, BUCKETS), "n": np.r_[n, df]})

    df = learn.select("text").mapInPandas(frequencies, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    table = {r["bucket"]: r["n"] for r in df.collect()}  # one row per bucket
    idf = np.log((1 + table.get(-1, 0)) / (1 + np.array([table.get(b, 0) for b in range(BUCKETS)]))).astype(np.float32) + np.float32(0.1)

    # By id and text, so that rows of one id are spread, and equal rows are one, so that none fills the sample.
    placed = learn.select("doc_id", "text", "lang", F.xxhash64("doc_id", "text").alias("place"))
    sizes = placed.groupBy("lang").agg(F.approx_count_distinct("place", 0.02).alias("lang_rows"))
    share = F.pmod("place", F.lit(1 << 30)) / float(1 << 30)
    chosen = placed.join(F.broadcast(sizes), "lang").where(share * F.col("lang_rows") < sample)
    chosen = chosen.select("doc_id", "text", "lang").dropDuplicates()

    def centroids(group: pd.DataFrame) -> pd.DataFrame:
        x, _ = vectors(group.sort_values(["doc_id", "text"])["text"].tolist(), idf)
        if not len(x):
            return pd.DataFrame({"lang": [], "centre": [], "floor": []})
        centres, floor = cluster(x, CENTROIDS)
        return pd.DataFrame({"lang": group["lang"].iloc[0], "centre": list(centres), "floor": floor})

    found = chosen.groupBy("lang").applyInPandas(centroids, "lang string, centre array<float>, floor double").collect()
    found.sort(key=lambda r: (r["lang"], r["centre"]))
    centres = np.array([r["centre"] for r in found], np.float32).reshape(len(found), BUCKETS)
    return Model(idf, centres, [r["lang"] for r in found], np.array([r["floor"] for r in found]))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) per row."""
    sent = docs.sparkSession.sparkContext.broadcast((model.idf, model.centres, model.names, model.floors))

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Model(*sent.value)
        for batch in batches:
            for at in range(0, len(batch), BATCH):
                part = batch.iloc[at : at + BATCH]
                names, score, rejected = model.predict(part["text"].tolist())
                yield pd.DataFrame({"doc_id": part["doc_id"], "lang_pred": names, "score": score, "rejected": rejected})

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", whole().alias("text"))
    return rows.mapInPandas(predict, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def predict_languages(docs: DataFrame, folds: int = 3, fold: int = 1, sample: int = SAMPLE) -> DataFrame:
    """Every row with its language, learned from the rows outside the fold."""
    model = fit(docs.where(~held_out("doc_id", folds, fold)), sample)
    return identify(docs, model).withColumn("held_out", held_out("doc_id", folds, fold))
