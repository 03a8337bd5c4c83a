"""Line dedup by a suffix array over line ids.

Every line that is not blank is one symbol, its id the 64-bit hash of the line; a document is the sequence of
its symbols, and documents stand in the order of doc_id (nulls last). A *run* is a sequence of lines that
occurs more than once; runs of fewer than ``min_chars`` characters do not count. Of every run the first
occurrence stays and later ones are deleted, whole documents included; blank lines stay as they are.

Suffixes are ranked by distributed prefix doubling: the rank of the first 2^(k+1) lines is the place of the
pair (rank of the first 2^k lines, rank of the 2^k lines after them) among all sorted pairs. A pair list is
range-sorted, so the place of a pair comes from its partition and the row there. Only repeated lines take
part; all others end the common prefix of the suffixes around them.

An interval of suffixes that share their first m lines is the longest-common-prefix interval of length m at
least; it is named by two overlapping power-of-two ranks and its first member is the copy that stays. It is
enough to look at the shortest prefixes that reach ``min_chars``, and at the shortest stretches that reach it
going backwards: a repeated run is the union of such stretches (one that starts at a line of the run, or
ends at it, or spans it from the run's start fits in the run), so the union of the later ones is what the
maximal runs delete. As a line has a character at least, ranks are needed for min_chars lines at most, five
rounds for 24 characters, whatever the length of the documents.

Null text stays null. A text of blank lines stays. Repeated rows (same id and text) count as one document and
get the same result; rows that share an id but not the text are told apart by the text's hash. An empty
table gives no rows. Other columns pass through; those added start with ``dedup_``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayspark.llm.common import WORD_GAP, written

MIN_CHARS = 24
#: A document is known by these: id (0 for null), whether it is null, hash of the text.
KEY = ("dedup_id", "dedup_null", "dedup_hash")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns(
        {"dedup_null": F.col("doc_id").isNull(), "dedup_id": F.coalesce("doc_id", F.lit(0)), "dedup_hash": F.xxhash64("text")}
    )


def _line_rows(docs: DataFrame) -> DataFrame:
    """One row per line that is not blank: place in the text and in the sequence, id, characters."""
    lines = F.split("text", "\n")
    described = F.transform(
        lines, lambda x, i: F.struct(i.alias("line"), F.xxhash64(x).alias("id"), F.length(F.trim(x)).cast("long").alias("chars"))
    )
    kept = F.filter(described, lambda x: x["chars"] > 0)
    rows = docs.where(F.col("text").isNotNull()).select(*KEY, F.posexplode(kept).alias("seq", "x"))
    return rows.select(*KEY, F.col("seq").cast("long").alias("seq"), "x.line", "x.id", "x.chars")


def deleted_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(KEY, line): numbers of the lines that are later copies."""
    keyed = _keyed(docs)
    rows = written(_line_rows(keyed.select(*KEY, "text")).distinct(), "lines")
    repeated = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")
    # As a table of its own, so that a line which stands in most documents is a skewed join that can be split.
    repeated = written(repeated, "repeated-ids")
    by_document = Window.partitionBy(*KEY).orderBy("seq")
    active = rows.join(repeated, "id", "left_semi")
    # Stretches of repeated lines without a gap share seq - row number.
    active = active.withColumn("island", F.col("seq") - F.row_number().over(by_document))
    island = Window.partitionBy(*KEY, "island")
    upto = F.sum("chars").over(island.orderBy("seq"))
    active = active.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("chars"))
    everything = F.max("upto").over(island)
    ahead = island.orderBy("before").rangeBetween(Window.currentRow, min_chars - 1)
    behind = island.orderBy("upto").rangeBetween(1 - min_chars, Window.currentRow)
    active = active.select(
        *KEY,
        "seq",
        "line",
        "island",
        F.col("id").alias("r0"),
        F.when(everything - F.col("before") >= min_chars, F.count(F.lit(1)).over(ahead)).alias("ahead"),
        F.when(F.col("upto") >= min_chars, F.count(F.lit(1)).over(behind)).alias("behind"),
    )
    active = written(active, "repeated-lines")
    longest = active.agg(F.max(F.greatest("ahead", "behind"))).first()[0] or 1
    levels = int(math.log2(longest))
    along = Window.partitionBy(*KEY, "island").orderBy("seq")
    for k in range(levels):
        pairs = active.withColumn("next", F.lead(f"r{k}", 1 << k).over(along))
        places = pairs.where("next is not null").select(f"r{k}", "next").distinct().orderBy(f"r{k}", "next")
        places = written(places.withColumn(f"r{k + 1}", F.monotonically_increasing_id()), f"ranks-{k + 1}")
        active = written(pairs.join(places, [f"r{k}", "next"], "left").drop("next"), f"suffixes-{k + 1}")

    # An interval is (lines, rank of the first power of two, rank of the last one).
    level = sum(((F.col("lines") >= (1 << k)).cast("int") for k in range(1, levels + 1)), F.lit(0))

    forward = active.where("ahead is not null").withColumn("lines", F.col("ahead")).withColumn("level", level)
    stretches = []
    for k in range(levels + 1):
        # The last power of two of a stretch starts lines - 2^k later.
        later = active.select(*KEY, "island", F.col("seq").alias("last"), F.col(f"r{k}").alias("b"))
        own = forward.where(F.col("level") == k).select(*KEY, "island", "seq", "line", "lines", F.col(f"r{k}").alias("a"), (F.col("seq") + F.col("lines") - (1 << k)).alias("last"))
        back = active.where("behind is not null").withColumn("lines", F.col("behind")).withColumn("level", level).where(F.col("level") == k)
        back = back.select(*KEY, "island", (F.col("seq") - F.col("lines") + 1).alias("seq"), "lines", (F.col("seq") - (1 << k) + 1).alias("last"))
        if k == 0:  # one line: start and end are the same rank
            stretches.append(own.select(*KEY, "seq", "lines", "a", F.col("a").alias("b")))
            single = active.where("behind = 1").select(*KEY, "seq", F.col("behind").alias("lines"), F.col("r0").alias("a"), F.col("r0").alias("b"))
            stretches.append(single)
            continue
        stretches.append(own.join(later, [*KEY, "island", "last"]).select(*KEY, "seq", "lines", "a", "b"))
        first = active.select(*KEY, "island", "seq", F.col(f"r{k}").alias("a"))
        stretches.append(back.join(first, [*KEY, "island", "seq"]).join(later, [*KEY, "island", "last"]).select(*KEY, "seq", "lines", "a", "b"))
    found = stretches[0]
    for more in stretches[1:]:
        found = found.unionByName(more)
    found = written(found.distinct(), "intervals")
    place = F.struct("dedup_null", "dedup_id", "dedup_hash", "seq")
    heads = found.groupBy("lines", "a", "b").agg(F.min(place).alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # A table of its own as well: a run that stands in most documents is then a skewed join that can be split.
    heads = written(heads, "run-heads")
    later = found.join(heads, ["lines", "a", "b"]).where(place > F.col("head"))
    covered = later.select(*KEY, F.explode(F.sequence("seq", F.col("seq") + F.col("lines") - 1)).alias("seq")).distinct()
    return covered.join(active.select(*KEY, "seq", "line"), [*KEY, "seq"]).select(*KEY, "line")


def deduplicate(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The rows with their texts rid of later copies; dedup_lines and dedup_removed count lines."""
    gone = deleted_lines(docs, min_chars).groupBy(*KEY).agg(F.collect_list("line").alias("dedup_gone"))
    gone = written(gone, "deleted-lines")
    rows = _keyed(docs).join(gone, list(KEY), "left")
    rows = rows.withColumn("dedup_split", F.split("text", "\n"))
    n = F.size("dedup_split")
    left = F.array_except(F.sequence(F.lit(0), n - 1), F.col("dedup_gone"))
    text = F.array_join(F.transform(left, lambda i: F.get("dedup_split", i)), "\n")
    rows = rows.withColumns(
        {
            "dedup_lines": F.when(F.col("text").isNull(), F.lit(0)).otherwise(n).cast("long"),
            "dedup_removed": F.greatest(F.lit(0), F.size("dedup_gone")).cast("long"),
            "text": F.when(F.col("dedup_gone").isNull(), F.col("text")).otherwise(text),
        }
    )
    return rows.drop(*KEY, "dedup_split", "dedup_gone")


def remove_copies(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Documents without their later copies of line runs, n_chars as long as the text; documents that the
    deletion leaves without a word are dropped, all others stay."""
    rows = deduplicate(docs, min_chars)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col("dedup_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    bare = F.length(F.regexp_replace("text", WORD_GAP, "")) == 0
    return rows.where((F.col("dedup_removed") == 0) | ~bare).drop("dedup_lines", "dedup_removed")
