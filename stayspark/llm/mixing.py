"""Mixing sources to target weights as a time-varying curriculum.

Source ``s`` (by code point, null last) has the final weight 1, 2, 3, repeating, and a rate that changes
linearly over the training time ``t`` in [0, 1]: ``rate(t) = target * (1 + a * (2t - 1))`` with ``a`` from
``SLOPES`` by weight, so light sources come early and heavy ones late. Its integral is the cumulative
demand ``D(t) = target * (t + a * (t*t - t))``, with ``D(1) = target``. A document copy that covers the
words [u, v) of its source's stream stands at ``D^-1((u + v) / 2)``, and the mix is range-sorted by that.

The stream of a source is its documents in the order of md5(doc_id), over and over, until the target is
reached; the last copy is cut to whole words. So the words taken are the target rounded down.

Running sums never gather a source: a source is cut into buckets by the first digits of the md5, one row
per bucket is summed up, and only the documents of one bucket are ordered together. The table of sources
itself is ordered in one task; it has one row per source.

Null text has size 0 and is never taken. Null ids are ordered by md5 of the empty string. Rows that tie in
the id are ordered by md5 of the text; identical rows are separate documents. An empty table gives no
rows. Columns of the input are kept; those added start with ``mix_``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayspark.llm.common import whole, words, written

MAX_REPEATS = 3
WEIGHT_CYCLE = 3
#: Slope of the rate by weight 1, 2, 3.
SLOPES = (-0.5, 0.0, 0.5)
BUCKET_ROWS = 20_000


def source_targets(sizes: DataFrame) -> DataFrame:
    """Target words per source from (mix_source, mix_null, source_size): the level at which the capped
    shares add up to all words, found in closed form over the sources in the order of cap per weight."""
    by_name = Window.orderBy("mix_null", "mix_source")
    weighed = sizes.withColumn("weight", F.pmod(F.row_number().over(by_name) - 1, F.lit(WEIGHT_CYCLE)) + 1)
    weighed = weighed.withColumn("cap", F.lit(MAX_REPEATS) * F.col("source_size"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "mix_null", "mix_source")
    everything = Window.partitionBy(F.lit(1))
    level = (F.sum("source_size").over(everything) - (F.sum("cap").over(by_cap) - F.col("cap"))) / (
        F.sum("weight").over(everything) - (F.sum("weight").over(by_cap) - F.col("weight"))
    )
    found = weighed.withColumn("level", level)
    final = F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(everything)
    found = found.withColumn("final", final)
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("final"), F.lit(0.0)) * F.col("weight"))
    slope = F.element_at(F.array(*[F.lit(x) for x in SLOPES]), F.col("weight").cast("int"))
    return found.select("mix_source", "mix_null", "source_size", target.alias("target"), slope.alias("slope"))


def assign(docs: DataFrame) -> DataFrame:
    """Each row with mix_size, mix_source_size, mix_target, mix_taken and mix_copies: one entry
    (copy, words, position) per time that the mix takes it, position in words from 0 on."""
    n = docs.count()
    digits = max(1, math.ceil(math.log(max(n, 1) / BUCKET_ROWS, 16))) if n > BUCKET_ROWS else 1
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    base = docs.withColumns(
        {
            "mix_size": F.size(words(whole())).cast("long"),
            "mix_source": F.coalesce("source", F.lit("")),
            "mix_null": F.col("source").isNull(),
            "mix_key": key,
            "mix_bucket": F.substring(key, 1, digits),
            "mix_tie": F.md5(whole().cast("binary")),
        }
    )
    of = ["mix_source", "mix_null"]
    sums = written(base.groupBy(*of, "mix_bucket").agg(F.sum("mix_size").alias("bucket_size")), "mix-sums")
    before = Window.partitionBy(*of).orderBy("mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*of, "mix_bucket", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("mix_offset"))
    targets = source_targets(sums.groupBy(*of).agg(F.sum("bucket_size").alias("source_size")))
    total = sums.agg(F.coalesce(F.sum("bucket_size"), F.lit(0)).alias("t")).first()["t"]
    plan = offsets.join(targets, of).select(
        *of,
        "mix_bucket",
        "mix_offset",
        F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"),
        F.col("slope").alias("mix_slope"),
    )
    within = (
        Window.partitionBy(*of, "mix_bucket")
        .orderBy("mix_key", F.col("doc_id").asc_nulls_last(), "mix_tie")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = base.join(plan, [*of, "mix_bucket"]).withColumn(
        "mix_start", F.col("mix_offset") + F.coalesce(F.sum("mix_size").over(within), F.lit(0))
    )
    size, start, all_words = F.col("mix_size"), F.col("mix_start"), F.col("mix_source_size")
    passes = F.when(all_words > 0, F.floor(F.col("mix_target") / all_words)).otherwise(F.lit(0)).cast("int")
    rows = rows.withColumn("mix_passes", passes)
    left = F.floor(F.col("mix_target") - F.col("mix_passes") * all_words)
    rows = rows.withColumn("mix_part", F.greatest(F.lit(0), F.least(size, left - start)).cast("long"))

    def placed(copy):
        taken = F.when(copy < F.col("mix_passes"), size).otherwise(F.col("mix_part"))
        u = (copy * all_words + start + taken / 2) / F.greatest("mix_target", F.lit(1e-9))
        a = F.col("mix_slope")
        t = 2 * u / ((1 - a) + F.sqrt((1 - a) * (1 - a) + 4 * a * u))
        return F.struct(copy.alias("copy"), taken.alias("words"), (t * F.lit(float(total))).alias("position"))

    every = F.transform(F.sequence(F.lit(0), F.col("mix_passes")), placed)
    rows = rows.withColumn("mix_copies", F.filter(every, lambda c: c["words"] > 0))
    rows = rows.withColumn("mix_taken", size * F.col("mix_passes") + F.col("mix_part"))
    return rows.drop("mix_source", "mix_null", "mix_key", "mix_bucket", "mix_tie", "mix_offset", "mix_slope", "mix_start", "mix_passes", "mix_part")


def mix(docs: DataFrame) -> DataFrame:
    """The mixed rows in training order: one row per copy with the columns of the input, the text of a cut
    copy ending after its last taken word, and n_chars (where the input has it) as long as its text."""
    taken = assign(docs).select("*", F.explode("mix_copies").alias("mix_copy"))
    each = F.regexp_extract_all("text", F.lit("[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+"), F.lit(0))
    cut = F.array_join(F.slice(each, F.lit(1), F.col("mix_copy.words").cast("int")), "")
    text = F.when(F.col("mix_copy.words") == F.col("mix_size"), F.col("text")).otherwise(cut)
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("mix_copy.words") == F.col("mix_size"), F.col("n_chars")).otherwise(F.length(text))
    out = taken.withColumns(changed).withColumn("mix_position", F.col("mix_copy.position"))
    # One value in every n-th of the positions is one task's share: no key is hot.
    out = out.orderBy("mix_position", F.col("doc_id").asc_nulls_last(), F.col("mix_copy.copy"))
    return out.select(*docs.columns, "mix_position")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS s, source IS NULL AS nul,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS k, md5(coalesce(text, '')) AS tie
  FROM documents),
src AS (SELECT s, nul, sum(size)::BIGINT AS source_size FROM d GROUP BY s, nul),
w AS (SELECT *, 1 + (row_number() OVER (ORDER BY nul, s) - 1) % 3 AS weight, 3 * source_size AS cap FROM src),
lev AS (
  SELECT a.s, a.nul, ((SELECT sum(source_size) FROM w)
      - coalesce((SELECT sum(b.cap) FROM w b WHERE b.cap::DOUBLE / b.weight < a.cap::DOUBLE / a.weight), 0))::DOUBLE
      / (SELECT sum(b.weight) FROM w b WHERE b.cap::DOUBLE / b.weight >= a.cap::DOUBLE / a.weight) AS level,
      a.cap, a.weight FROM w a),
fin AS (SELECT max(level) AS f FROM lev WHERE level * weight <= cap),
t AS (SELECT w.s, w.nul, source_size, least(cap::DOUBLE, coalesce(f, 0) * weight) AS target,
             CASE weight WHEN 1 THEN -0.5 WHEN 2 THEN 0.0 ELSE 0.5 END AS a FROM w, fin),
p AS (
  SELECT doc_id, size, source_size, target, a,
         CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes,
         coalesce(sum(size) OVER (PARTITION BY d.s, d.nul ORDER BY k, doc_id NULLS LAST, tie
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t ON d.s = t.s AND d.nul = t.nul),
q AS (SELECT *, greatest(0, least(size, floor(target - passes * source_size)::BIGINT - start)) AS part FROM p),
u AS (SELECT *, (start + (CASE WHEN passes > 0 THEN size ELSE part END) / 2.0) / target AS u,
             (CASE WHEN passes > 0 THEN size ELSE part END) > 0 AS used FROM q)
SELECT doc_id, size, source_size, round(target, 3) AS target, (size * passes + part)::BIGINT AS taken,
       CASE WHEN used THEN round(2 * u / ((1 - a) + sqrt((1 - a) * (1 - a) + 4 * a * u))
            * (SELECT sum(source_size) FROM src), 2) END AS first_position
FROM u
"""
