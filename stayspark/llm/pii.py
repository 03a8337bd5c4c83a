"""Information-theoretic removal of personal data.

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers, leftmost and without overlap
per kind. Each distinct value is a protected entity. A term near an entity (up to ``NEAR_WORDS`` words within
``NEAR_CHARS`` characters on either side) discloses it as far as the corpus says so: the pointwise mutual
information of term and entity over documents, as a share of the entity's information content,

    PMI(t; e) / IC(e) = ln(N c(t, e) / (c(t) c(e))) / ln(N / c(e)).

A share of 1 means that the term occurs nowhere else. Terms of at least ``GENERALISE`` are generalised,
those of at least ``REMOVE`` removed, wherever they occur. As one document proves nothing, only entities and
pairs that occur in ``SUPPORT`` different texts count. N and c(t) count all rows, c(e) the documents that hold
the entity, c(t, e) those where the term is near it. Terms are ASCII-lower-cased and cut at blanks and ASCII punctuation but for - and '.

Null text is empty. Repeated rows (same id and text) get the same result each and are one document in c(e) and
c(t, e). A
null id is a document like any other. An empty table gives no rows. Only doc_id and text are read; positions
are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayspark.llm.common import whole, words, written

KINDS = ("email", "ip", "card", "phone")
#: The patterns of the contract; possessive where nothing could be given back, so that Java does not recurse.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain to be searched for a kind at all.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
NEAR_WORDS = 5
NEAR_CHARS = 256
SUPPORT = 3
GENERALISE = 0.9
REMOVE = 0.97
LABELS = {**{k: f"[{k}]" for k in KINDS}, "generalise": "[term]", "remove": ""}
KEY = ("pii_id", "pii_null", "pii_hash")
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MARKS = '!"#$%&()*+,./:;<=>?@[\\]^_`{|}~'


def plain(text: Column) -> Column:
    """The text with ASCII small letters and blanks for punctuation, character for character."""
    return F.translate(text, CAPITALS + MARKS, SMALL + " " * len(MARKS))


def _valid(kind: str, match: Column) -> Column:
    digits = F.translate(match, " -().+", "")
    n = F.length(digits)
    if kind == "ip":
        short = F.transform(F.split(match, "\\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(short, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= F.lit("255"))))
    if kind == "card":
        value = lambda i: F.substring(digits, n - i, F.lit(1)).cast("int")  # noqa: E731  i-th digit from the right
        doubled = lambda i: F.when(i % 2 == 0, value(i)).otherwise(2 * value(i) - F.when(value(i) > 4, 9).otherwise(0))
        luhn = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda acc, i: (acc + doubled(i)).cast("int"))
        return F.when(n.between(14, 19), luhn % 10 == 0).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


def matches(text: Column, pattern: Column | str) -> Column:
    """(start, value) of all matches: what lies between them gives the places."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    gaps, values = F.split(text, pattern), F.regexp_extract_all(text, pattern, F.lit(0))
    one = F.struct(F.lit(0).alias("start"), F.lit("").alias("value"))
    start = F.struct(F.lit(0).alias("at"), F.filter(F.array(one), lambda x: F.lit(False)).alias("out"))

    def step(acc, x):
        here = acc["at"] + F.length(x["gap"])
        found = F.struct(here.alias("start"), x["value"].alias("value"))
        return F.struct((here + F.length(x["value"])).alias("at"), F.array_append(acc["out"], found).alias("out"))

    paired = F.zip_with(values, F.slice(gaps, F.lit(1), F.size(values)), lambda v, g: F.struct(v.alias("value"), g.alias("gap")))
    return F.aggregate(paired, start, step, lambda acc: acc["out"])


def _spans_of(text: Column, kind: str) -> Column:
    """Valid spans of one kind, null for texts that cannot have any."""
    found = F.filter(matches(text, PATTERNS[kind]), lambda m: _valid(kind, m["value"]))
    made = F.transform(
        found,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), (m["start"] + F.length(m["value"])).alias("end"), F.lit(kind).alias("kind"), m["value"].alias("value")
        ),
    )
    return F.when(text.rlike(NEEDS[kind]), made)


def _has_kind(kind: str) -> Column:
    return F.size(F.filter("pii_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def base_spans(docs: DataFrame) -> DataFrame:
    """(KEY, doc_id, pii_base): spans with kind, hash of the value, and the terms near by."""
    text = whole()
    rows = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(0)).alias("pii_id"), F.col("doc_id").isNull().alias("pii_null"), F.xxhash64("text").alias("pii_hash"))
    for kind in KINDS:
        rows = rows.withColumn(f"pii_{kind}", _spans_of(text, kind))
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,value:string>>")
    rows = rows.withColumn("pii_found", F.array_sort(F.concat(*[F.coalesce(F.col(f"pii_{k}"), none) for k in KINDS])))

    def near(s):
        before = F.substring(text, F.greatest(F.lit(1), s["start"] + 1 - NEAR_CHARS), F.least(s["start"], F.lit(NEAR_CHARS)))
        after = F.substring(text, s["end"] + 1, F.lit(NEAR_CHARS))
        left, right = words(plain(before)), words(plain(after))
        last = F.slice(left, F.greatest(F.lit(1), F.size(left) - (NEAR_WORDS - 1)), F.lit(NEAR_WORDS))
        return F.array_distinct(F.concat(last, F.slice(right, 1, NEAR_WORDS)))

    normal = lambda s: F.when(s["kind"] == "email", F.translate(s["value"], CAPITALS, SMALL)).otherwise(F.translate(s["value"], " -().", ""))
    full = F.transform(
        "pii_found",
        lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"), F.xxhash64(s["kind"], normal(s)).alias("entity"), near(s).alias("near")),
    )
    return rows.select("doc_id", *KEY, F.when(F.size("pii_found") > 0, full).otherwise(F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,entity:bigint,near:array<string>>>")).alias("pii_base"))


def disclosing_terms(docs: DataFrame, base: DataFrame) -> DataFrame:
    """(term, action): terms that disclose an entity."""
    seen = base.select(*KEY, F.explode("pii_base").alias("s")).select(*KEY, "s.entity", "s.near")
    texts, documents = F.count_distinct("pii_hash"), F.count(F.lit(1))
    entities = seen.select(*KEY, "entity").distinct().groupBy("entity").agg(documents.alias("c_e"), texts.alias("texts"))
    entities = entities.where(F.col("texts") >= SUPPORT).select("entity", "c_e")
    pairs = seen.join(entities, "entity").select(*KEY, "entity", "c_e", F.explode("near").alias("term"))
    pairs = pairs.where(F.col("term").rlike("^[\\p{L}\\p{M}][\\p{L}\\p{M}'-]{2,}$")).distinct()
    pairs = pairs.groupBy("term", "entity", "c_e").agg(documents.alias("c_te"), texts.alias("texts")).where(F.col("texts") >= SUPPORT)
    pairs = written(pairs.drop("texts"), "pii-pairs")
    # Summed up per task before anything is joined: a common term is one row of each task.
    hashed = F.transform(words(plain(whole())), lambda w: F.xxhash64(w))
    often = docs.select(F.explode(F.array_distinct(hashed)).alias("term_hash")).groupBy("term_hash").agg(documents.alias("c_t"))
    total = float(max(docs.count(), 1))
    share = F.log(F.lit(total) * F.col("c_te") / (F.col("c_t") * F.col("c_e"))) / F.greatest(F.log(F.lit(total) / F.col("c_e")), F.lit(1e-9))
    pairs = pairs.withColumn("term_hash", F.xxhash64("term"))
    found = pairs.join(often, "term_hash").withColumn("share", share).groupBy("term").agg(F.max("share").alias("share"))
    action = F.when(F.col("share") >= REMOVE, "remove").otherwise("generalise")
    return written(found.where(F.col("share") >= GENERALISE).select("term", action.alias("action")), "pii-disclosing")


def term_spans(docs: DataFrame, disclosing: DataFrame) -> DataFrame:
    """(KEY, pii_terms): spans of disclosing terms, a row per document that has any."""
    rows = docs.select("text", F.coalesce("doc_id", F.lit(0)).alias("pii_id"), F.col("doc_id").isNull().alias("pii_null"), F.xxhash64("text").alias("pii_hash"))
    inside = rows.select(*KEY, F.explode(F.array_distinct(words(plain(whole())))).alias("term")).join(disclosing, "term")
    inside = inside.groupBy(*KEY).agg(F.collect_set(F.struct("term", "action")).alias("pii_has"))
    inside = written(inside, "pii-documents")
    rows = rows.join(inside, list(KEY)).withColumn("pii_plain", plain(whole()))
    blank = "[\\x20\\x09-\\x0D]"

    def spans(t):
        pattern = F.concat(F.lit(f"(?:(?<={blank})|^)"), t["term"], F.lit(f"(?={blank}|$)"))
        made = lambda m: F.struct(m["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), (m["start"] + F.length(m["value"])).alias("end"), t["action"].alias("kind"))
        return F.transform(matches(F.col("pii_plain"), pattern), made)

    return rows.select(*KEY, F.array_sort(F.flatten(F.transform("pii_has", spans))).alias("pii_terms")).dropDuplicates(list(KEY))


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, KEY, pii_base, pii_spans) per row: base spans, and all spans, each by start and kind."""
    base = written(base_spans(docs), "pii-base")
    disclosing = disclosing_terms(docs, base)
    terms = written(term_spans(docs, disclosing), "pii-term-spans")
    slim = F.transform("pii_base", lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    rows = base.withColumn("pii_base", slim).join(terms, list(KEY), "left")
    return rows.select("doc_id", *KEY, "pii_base", F.array_sort(F.concat("pii_base", F.coalesce("pii_terms", none))).alias("pii_spans"))


def written_spans(spans: str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def summary(docs: DataFrame) -> DataFrame:
    """Counts per kind, hash of the base spans, and all spans."""
    rows = find(docs)
    return rows.select("doc_id", *[_has_kind(k) for k in KINDS], F.sha2(written_spans("pii_base").cast("binary"), 256).alias("base_sha256"), written_spans("pii_spans").alias("spans"))


def sanitise(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with every span replaced by its label; a span that begins within an earlier one
    is part of it."""
    found = find(docs).where(F.size("pii_spans") > 0).select(*KEY, "pii_spans").dropDuplicates(list(KEY))
    rows = docs.withColumns({"pii_id": F.coalesce("doc_id", F.lit(0)), "pii_null": F.col("doc_id").isNull(), "pii_hash": F.xxhash64("text")})
    rows = rows.join(found, list(KEY), "left")
    labels = F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        put = F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), F.element_at(labels, s["kind"]))
        return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), put.alias("out"))).otherwise(
            F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        )

    rest = lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text")))
    clean = F.when(F.col("pii_spans").isNull(), F.col("text")).otherwise(F.aggregate("pii_spans", start, step, rest))
    return rows.withColumn("text", clean).drop(*KEY, "pii_spans")
