"""Quality rules: fixed base rules, then robust multivariate outliers per language and source.

A document's statistics are turned into a vector: logarithm of the mean word length, logarithm of 1 + symbols
per word, share of words in repeated three-word windows, share of duplicate lines. For each language and
source the centre and scatter of the documents that pass the base rules come from the minimum covariance
determinant: starting from medians and interquartile ranges, concentration steps refit mean and covariance
to the ``SUBSET`` share of documents with the least distances. The scatter is corrected for the missing tails
and gets the variances ``FLOOR`` on its diagonal, so that a statistic that is constant in clean text doesn't make
every deviation an outlier. A document is kept if its squared Mahalanobis distance is at most ``CUTOFF``.

Languages and sources with fewer than ``MIN_GROUP`` documents are pooled by language, and languages that are
still too small together; a pool of fewer than ``MIN_FIT`` documents rejects nothing. A group is never gathered:
its moments are sums, its quantiles come from counts in fixed bins, which makes reruns agree.

Null text is empty and has no words; such documents fail the base rules. Null languages and sources form
groups of their own. Repeated rows are judged each. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayspark.llm.common import whole, words, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SUBSET = 0.75
STEPS = 4
MIN_GROUP = 200
MIN_FIT = 20
#: Rejected keys that are broadcast at most: two longs and a flag each.
BROADCAST_ROWS = 500_000
#: Standard deviations that are taken for granted, per statistic.
FLOOR = (0.05, 0.03, 0.12, 0.10)
#: Scatter of the central 75 % of a four-dimensional normal distribution, inverted.
CORRECTION = 1.49
#: Chi-square quantile for four dimensions and 1 in 10 million.
CUTOFF = 38.2
D = len(FLOOR)
X = [f"x{i}" for i in range(D)]


def statistics(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the base statistics and the vector."""
    text = whole()
    out = docs.withColumn("qr_words", words(text))
    n = F.size("qr_words")
    i = F.sequence(F.lit(0), n - 3)
    hashed = F.transform(i, lambda k: F.xxhash64(F.get("qr_words", k), F.get("qr_words", k + 1), F.get("qr_words", k + 2)))
    out = out.withColumn("qr_windows", F.when(n >= 3, hashed).otherwise(F.array().cast("array<bigint>")))
    # Windows beside their places, equal ones together; only for texts that repeat any.
    pairs = F.array_sort(F.transform("qr_windows", lambda h, k: F.struct(h.alias("h"), k.alias("k"))))
    out = out.withColumn("qr_pairs", F.when(F.size(F.array_distinct("qr_windows")) < F.size("qr_windows"), pairs))
    same = F.filter("qr_pairs", lambda p, k: (p["h"] == F.get("qr_pairs", k - 1)["h"]) | (p["h"] == F.get("qr_pairs", k + 1)["h"]))
    places = F.array_sort(F.transform(same, lambda p: p["k"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, k: F.struct((k + 3).alias("end"), (acc["n"] + (k + 3) - F.greatest(k, acc["end"])).cast("long").alias("n")),
        lambda acc: acc["n"],
    )
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    out = out.withColumn("qr_lines", lines)
    count = n.cast("long")
    out = out.withColumns(
        {
            "n_words": count,
            "word_chars": F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
            "n_dup_lines": (F.size("qr_lines") - F.size(F.array_distinct("qr_lines"))).cast("long"),
            "qr_n_lines": F.size("qr_lines").cast("long"),
            "n_repeat_words": F.coalesce(covered, F.lit(0).cast("long")),
        }
    ).drop("qr_words", "qr_windows", "qr_pairs", "qr_lines")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    each = F.greatest("n_words", F.lit(1))
    vector = (
        F.log(F.greatest(F.lit(1), "word_chars") / each),
        F.log1p(F.col("n_symbols") / each),
        F.col("n_repeat_words") / each,
        F.col("n_dup_lines") / F.greatest("qr_n_lines", F.lit(1)),
    )
    return out.withColumns({"base_failed": failed, **{x: F.round(v, 6) for x, v in zip(X, vector, strict=True)}}).drop("qr_n_lines")


def _pools(stats: DataFrame) -> DataFrame:
    """(qr_lang, qr_source, pool): the pool that estimates for each language and source."""
    counts = stats.where(~F.col("base_failed")).groupBy("qr_lang", "qr_source").agg(F.count(F.lit(1)).alias("n"))
    small = F.col("n") < MIN_GROUP
    left = F.sum(F.when(small, F.col("n")).otherwise(0)).over(Window.partitionBy("qr_lang"))
    pool = F.when(~small, F.concat_ws("\x01", F.lit("both"), "qr_lang", "qr_source")).when(left >= MIN_GROUP, F.concat_ws("\x01", F.lit("lang"), "qr_lang"))
    return counts.select("qr_lang", "qr_source", F.coalesce(pool, F.lit("all")).alias("pool"))


def _bin_at(counted: DataFrame, by: list[str], share: float, name: str) -> DataFrame:
    """Least bin of each group at which ``share`` of the group's count is reached."""
    up = F.sum("n").over(Window.partitionBy(*by).orderBy("bin"))
    total = F.sum("n").over(Window.partitionBy(*by))
    reached = counted.withColumn("enough", up >= F.ceil(F.lit(share) * total))
    return reached.groupBy(*by).agg(F.min(F.when(F.col("enough"), F.col("bin"))).alias(name))


def _factor(params: DataFrame) -> DataFrame:
    """Cholesky factor l{i}{j} of the scatter s{i}{j}."""
    for i in range(D):
        for j in range(i + 1):
            rest = F.col(f"s{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            value = F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}")
            params = params.withColumn(f"l{i}{j}", value)
    return params.select("pool", "n_fit", *[f"m{i}" for i in range(D)], *[f"l{i}{j}" for i in range(D) for j in range(i + 1)])


def _distance(rows: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance d2 of rows that have the parameters beside the vector."""
    for i in range(D):
        y = F.col(X[i]) - F.col(f"m{i}")
        for k in range(i):
            y = y - F.col(f"l{i}{k}") * F.col(f"y{k}")
        rows = rows.withColumn(f"y{i}", y / F.col(f"l{i}{i}"))
    return rows.withColumn("d2", sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(D)), F.lit(0.0)))


def _start(fit: DataFrame) -> DataFrame:
    """Medians and squared interquartile ranges, from counts in bins of 1/200."""
    long = fit.select("pool", F.posexplode(F.array(*X)).alias("i", "x"))
    counted = long.groupBy("pool", "i", F.round(F.col("x") * 200).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    counted = written(counted, "quality-bins")
    q = None
    for share, name in ((0.25, "a"), (0.5, "b"), (0.75, "c")):
        part = _bin_at(counted, ["pool", "i"], share, name)
        q = part if q is None else q.join(part, ["pool", "i"])
    spread = (F.col("c") - F.col("a")) / 200 / 1.349
    q = q.select("pool", "i", (F.col("b") / 200).alias("m"), (spread * spread).alias("s"))
    sizes = counted.where("i = 0").groupBy("pool").agg(F.sum("n").alias("n_fit"))
    picks = [F.max(F.when(F.col("i") == i, F.col(c))).alias(f"{c}{i}{i if c == 's' else ''}") for i in range(D) for c in ("m", "s")]
    start = q.groupBy("pool").agg(*picks).join(sizes, "pool")
    for i in range(D):
        start = start.withColumn(f"s{i}{i}", F.col(f"s{i}{i}") + FLOOR[i] ** 2)
        for j in range(i):
            start = start.withColumn(f"s{i}{j}", F.lit(0.0))
    return _factor(start)


def estimates(stats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pools, parameters per pool) from the statistics of all documents."""
    pools = written(_pools(stats), "quality-pools")
    fit = stats.where(~F.col("base_failed")).join(pools, ["qr_lang", "qr_source"]).select("pool", *X)
    params = written(_start(fit), "quality-start")
    bin_of = F.floor(16 * F.log(F.col("d2") + 1e-4)).cast("int")
    for step in range(STEPS):
        near = _distance(fit.join(params, "pool")).select("pool", *X, bin_of.alias("bin"))
        counted = near.groupBy("pool", "bin").agg(F.count(F.lit(1)).alias("n"))
        cut = written(_bin_at(counted, ["pool"], SUBSET, "cut"), f"quality-cut-{step}")
        inside = near.join(cut, "pool").where("bin <= cut")
        sums = [F.avg(x).alias(f"m{i}") for i, x in enumerate(X)]
        sums += [F.avg(F.col(X[i]) * F.col(X[j])).alias(f"p{i}{j}") for i in range(D) for j in range(i + 1)]
        moments = inside.groupBy("pool").agg(*sums).join(params.select("pool", "n_fit"), "pool")
        for i in range(D):
            for j in range(i + 1):
                cov = CORRECTION * (F.col(f"p{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}"))
                moments = moments.withColumn(f"s{i}{j}", cov + (FLOOR[i] ** 2 if i == j else 0.0))
        params = written(_factor(moments), f"quality-fit-{step}")
    return pools, params


def _named(docs: DataFrame) -> DataFrame:
    # A null is told apart from every value by its first character.
    mark = {f"qr_{c}": F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-")) for c in ("lang", "source")}
    return docs.withColumns(mark)


def judge(docs: DataFrame) -> DataFrame:
    """(doc_id, qr_tie, base statistics, vector, base_failed, distance, kept) per row."""
    rows = _named(docs.select("doc_id", "text", "lang", "source"))
    rows = rows.withColumn("qr_tie", F.xxhash64("text", "qr_lang", "qr_source"))
    stats = written(statistics(rows).drop("text", "lang", "source"), "quality-statistics")
    pools, params = estimates(stats)
    judged = stats.join(pools, ["qr_lang", "qr_source"], "left").join(params, "pool", "left")
    judged = _distance(judged)
    fits = (F.col("d2") <= CUTOFF) | (F.col("n_fit") < MIN_FIT)
    kept = ~F.col("base_failed") & F.coalesce(fits, F.lit(True))
    return judged.select(
        "doc_id", "qr_tie", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.round("d2", 3).alias("distance"), kept.alias("kept")
    )


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns.

    Up to ``BROADCAST_ROWS`` rejected keys (of fixed width, some 20 MB) go to the texts; more of them meet the texts in a shuffle.
    """
    rejected = judge(docs).where(~F.col("kept"))
    rejected = rejected.select(F.coalesce("doc_id", F.lit(0)).alias("qr_id"), F.col("doc_id").isNull().alias("qr_null"), "qr_tie").distinct()
    rejected = written(rejected, "quality-rejected")
    if rejected.count() <= BROADCAST_ROWS:
        rejected = F.broadcast(rejected)
    marked = _named(docs).withColumns(
        {"qr_id": F.coalesce("doc_id", F.lit(0)), "qr_null": F.col("doc_id").isNull(), "qr_tie": F.xxhash64("text", "qr_lang", "qr_source")}
    )
    return marked.join(rejected, ["qr_id", "qr_null", "qr_tie"], "left_anti").select(*docs.columns)
