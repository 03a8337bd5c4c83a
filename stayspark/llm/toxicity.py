"""Toxicity by subword-bag embeddings and a linear softmax, trained together in numpy.

A word, lower-cased and without ASCII punctuation at its ends, is the mean of the vectors of its hashed
character runs of 3 to 5 (with ``<`` and ``>`` at its ends) and of the word itself; a misspelling that was
never seen shares most of these. A document is the mean of its words and of
``PRIOR_WORDS`` zero vectors, times ``SCALE``, and two linear outputs
go through a softmax. Vectors and outputs are learned together by Adagrad on the log loss.

Training takes a bounded sample of labelled rows: all of a class up to about ``SAMPLE`` rows, beyond that those
with the least hashes of the id. The sample changes the ratio of the classes, so each row learned from weighs as
many labelled rows as its class has for each one sampled; offset and threshold hold for the ratio of all labelled rows. It runs in one task; scoring runs everywhere with the model (two megabytes)
broadcast. Labels, language, source and id are never inputs of a score.

Null and empty texts, and texts of punctuation only, get the score that the offsets alone give. Without
labelled rows, or with one class only, every score is the share of toxic rows among them, or 0. Repeated rows
are scored each. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayspark.llm.common import whole
from stayspark.llm.language import held_out

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
LONGEST_RUN = 5
SIZE = 8
SAMPLE = 2000
SCALE = 40.0
#: Words of vector zero that every document is averaged with, so that a few words alone weigh little.
PRIOR_WORDS = 20
EPOCHS = 12
#: Batches at least; small samples are gone through more often.
BATCHES = 750
BATCH = 64
RATE = 0.4
CACHE_WORDS = 500_000
#: Texts that are scored together, and new words that are hashed together.
TEXTS = 64
NEW_WORDS = 20_000
HASH = np.uint32(2654435761)
PUNCTUATION = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~' + "'"


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all runs of cleaned words, word after word within each length, and the place of the word of each.

    Runs of a length are hashed together, for all words at once; the last ones are the words themselves.
    """
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    c = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(words)), sizes)
    starts = np.cumsum(sizes) - sizes
    run, runs, owners = c * HASH, [], []
    for n in range(2, LONGEST_RUN + 1):
        run = (run[:-1] ^ run[:-1] >> np.uint32(15)) * HASH + c[n - 1 :]
        if n > 2:
            inside = owner[: len(run)] == owner[n - 1 :]
            runs.append(run[inside])
            owners.append(owner[: len(run)][inside])
    powers = np.cumprod(np.full(int(sizes.max(initial=1)), HASH, np.uint32), dtype=np.uint32)
    place = np.arange(len(c)) - np.repeat(starts, sizes)
    runs.append(np.add.reduceat(c * powers[place], starts, dtype=np.uint32) if len(words) else np.empty(0, np.uint32))
    owners.append(np.arange(len(words)))
    mixed = np.concatenate(runs)
    mixed = (mixed ^ mixed >> np.uint32(15)) * HASH
    return mixed >> np.uint32(32 - BUCKET_BITS), np.concatenate(owners)


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares of the mean."""
    times = Counter(word.strip(PUNCTUATION) for word in text.lower().split())
    times.pop("", None)
    if not times:
        return np.empty(0, np.int64), np.empty(0, np.float32)
    index, owner = subwords(list(times))
    of_word = np.fromiter(times.values(), np.float64, len(times)) / np.bincount(owner) / (times.total() + PRIOR_WORDS)
    places, where = np.unique(index, return_inverse=True)
    return places.astype(np.int64), np.bincount(where, of_word[owner]).astype(np.float32)


def train(texts: list[str], labels: np.ndarray, weights: np.ndarray | None = None, seed: int = 7) -> tuple[np.ndarray, float]:
    """(score of each bucket, offset): the log-odds of a text are SCALE times the mean of its words' means.
    ``weights`` are the rows that each text stands for, one each if not given."""
    weights = np.ones(len(labels)) if weights is None or not len(weights) else weights / weights.mean()
    positive = float(np.average(labels, weights=weights)) if len(labels) else 0.0
    if positive in (0.0, 1.0):
        return np.zeros(BUCKETS, np.float32), 60.0 * (2 * positive - 1)
    bags = [bag(t) for t in texts]
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (SIZE, BUCKETS)).astype(np.float32)
    outputs = rng.normal(0, 0.3, (SIZE, 2)).astype(np.float32)
    offsets = np.log(np.array([1 - positive, positive], np.float32))
    seen = [np.full_like(a, 1e-6) for a in (vectors, outputs, offsets)]
    target = np.stack([1 - labels, labels], axis=1).astype(np.float32)
    heavy = weights.astype(np.float32)[:, None]
    epochs = max(EPOCHS, -(-BATCHES * BATCH // len(bags)))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            index = np.concatenate([bags[r][0] for r in rows])
            weight = np.concatenate([bags[r][1] for r in rows])
            owner = np.repeat(np.arange(len(rows)), [len(bags[r][0]) for r in rows])
            docs = np.stack([np.bincount(owner, weight * v[index], len(rows)) for v in vectors], axis=1) * SCALE
            logits = docs @ outputs + offsets
            logits -= logits.max(axis=1, keepdims=True)
            p = np.exp(logits)
            error = (p / p.sum(axis=1, keepdims=True) - target[rows]) * heavy[rows] / len(rows)
            back = error @ outputs.T * SCALE
            for v, s, of_doc in zip(vectors, seen[0], back.T, strict=True):
                step = np.bincount(index, of_doc[owner] * weight, BUCKETS).astype(np.float32)
                s += step**2
                v -= rate * step / np.sqrt(s)
            seen[1] += (g := docs.T @ error) ** 2
            seen[2] += (h := error.sum(axis=0)) ** 2
            outputs -= rate * g / np.sqrt(seen[1])
            offsets -= rate * h / np.sqrt(seen[2])
    return ((outputs[:, 1] - outputs[:, 0]) @ vectors).astype(np.float32), float(offsets[1] - offsets[0])


class Scorer:
    """Scores of texts; the score of a word is looked up after its first time."""

    def __init__(self, buckets: np.ndarray, offset: float):
        self.buckets, self.offset, self.cache = buckets, offset, {}

    def learn(self, new: list[str]) -> None:
        """Put the words' means into the table, not a number for punctuation."""
        for at in range(0, len(new), NEW_WORDS):
            raw = new[at : at + NEW_WORDS]
            clean = [w.strip(PUNCTUATION) for w in raw]
            index, owner = subwords(clean)
            n = len(raw)
            means = np.bincount(owner, self.buckets[index], n) / np.bincount(owner, minlength=n)
            means[[not w for w in clean]] = np.nan
            self.cache.update(zip(raw, means.tolist(), strict=True))

    def scores(self, texts: list[str]) -> list[float]:
        """Scores of texts that are held in memory together."""
        split = [t.lower().split() for t in texts]
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        self.learn(sorted(set().union(*split).difference(self.cache)))
        out = []
        for words in split:
            values = np.fromiter(map(self.cache.__getitem__, words), float, len(words))
            values = values[~np.isnan(values)]
            odds = self.offset + (SCALE * float(values.sum()) / (len(values) + PRIOR_WORDS) if len(values) else 0.0)
            out.append(1.0 / (1.0 + float(np.exp(-np.clip(odds, -60, 60)))))
        return out


def sampled(known: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """About ``sample`` rows of each class of (doc_id, toxic), by the hash of the id, with the rows of its class
    that each stands for."""
    sizes = known.groupBy("toxic").agg(F.count(F.lit(1)).alias("class_rows"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    taken = known.join(F.broadcast(sizes), "toxic").where(place * F.col("class_rows") < sample)
    weights = taken.groupBy("toxic").agg((F.first("class_rows") / F.count(F.lit(1))).alias("stands_for"))
    return taken.join(F.broadcast(weights), "toxic").select("doc_id", "toxic", "stands_for")


def fit(docs: DataFrame, known: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Model of documents and their (doc_id, toxic) rows. The sampled ids are sent to the documents, so
    that no text is moved but those learned from. Where many documents share an id, about ``2 * sample`` of a
    class are learned from, and stand for the others."""
    ids = sampled(known, sample)
    labelled = docs.select("doc_id").join(F.broadcast(ids), "doc_id").groupBy("toxic").agg(F.count(F.lit(1)).alias("found_rows"))
    chosen = docs.select("doc_id", whole().alias("text"), F.monotonically_increasing_id().alias("row"))
    chosen = chosen.join(F.broadcast(ids), "doc_id").join(F.broadcast(labelled), "toxic")
    place = F.pmod(F.xxhash64("doc_id", "text", "row"), F.lit(1 << 30)) / float(1 << 30)
    chosen = chosen.where(place * F.col("found_rows") < 2 * sample)
    chosen = chosen.select(F.lit(0).alias("one"), "doc_id", "text", "toxic", "stands_for", "found_rows")

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "text", "toxic"])
        weights = group["stands_for"] * group["found_rows"] / group.groupby("toxic")["toxic"].transform("size")
        buckets, offset = train(group["text"].tolist(), group["toxic"].to_numpy(np.float32), weights.to_numpy(float))
        return pd.DataFrame({"buckets": [buckets.tobytes()], "offset": [offset]})

    row = chosen.groupBy("one").applyInPandas(learn, "buckets binary, offset double").first()
    if row is None:
        return np.zeros(BUCKETS, np.float32), -60.0
    return np.frombuffer(row["buckets"], np.float32), row["offset"]


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """(doc_id, score, predicted) per row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(*sent.value)
        for batch in batches:
            texts = batch["text"].tolist()
            s = np.array([x for at in range(0, len(texts), TEXTS) for x in scorer.scores(texts[at : at + TEXTS])], float)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": s, "predicted": (s >= 0.5).astype(np.int32)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", whole().alias("text")).mapInPandas(run, f"doc_id {kind}, score double, predicted int")


def predict_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, sample: int = SAMPLE) -> DataFrame:
    """Every row with its score, learned from labelled rows outside the fold."""
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out("doc_id", folds, fold)).select("doc_id", "toxic").distinct()
    return score(docs, fit(docs, known, sample)).withColumn("held_out", held_out("doc_id", folds, fold))
