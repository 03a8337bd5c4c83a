"""Full-text queries over the document catalogue."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from stayspark.functions.text import STOP_WORDS
from stayspark.operators import aggs, joins, search
from stayspark.plans.registry import Registry
from stayspark.session import session_folder, shared_folder
from stayspark.sources import snapshots
from stayspark.sources.views import Views

SEP = r"[^\p{L}\p{M}\p{N}]+"
_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)


def _stem(w: str) -> str:
    return f"""case when {w} like '%ies' and {w} not like '%eies' and {w} not like '%aies'
          then left({w}, length({w}) - 3) || 'y'
        when {w} like '%es' and {w} not like '%aes' and {w} not like '%ees' and {w} not like '%oes'
          then left({w}, length({w}) - 1)
        when {w} like '%s' and {w} not like '%us' and {w} not like '%ss' then left({w}, length({w}) - 1)
        else {w} end"""


def _analysed(words: str) -> str:
    """words(key, field, word) -> (key, field, term), both analysers."""
    return f"""
        select key, field, {_stem('word')} term from {words}
        where field in ('name', 'city', 'description', 'amenities') and word not in ({_STOP})
        union all
        select key, field, case when length(word) = 1 then word else substr(word, i, 2) end term
        from (select key, field, word, unnest(range(1, greatest(length(word), 2))) i from {words}
              where field in ('name_alt', 'city_alt', 'description_alt')) p"""


_BOOST = "(values " + ", ".join(
    f"('{lang}', '{field}', {boost}e0)"
    for lang, table in search.SEARCH_BOOSTS.items() for field, boost in table.items()
) + ") bt(lang, field, boost)"
_SUGGEST = "(values " + ", ".join(
    f"('{lang}', '{field}', {n}, {boost}e0)"
    for lang, table in search.SUGGEST_BOOSTS.items() for field, n, boost in table
) + ") st(lang, field, n, boost)"
_LANG = "case when lower(trim(lang)) like 'th%' then 'th' else 'en' end"


def _suggest_terms(source: str, key: str, columns: list[tuple[str, str]]) -> str:
    parts = []
    for field, column in columns:
        tokens = f"list_filter(regexp_split_to_array(lower({column}), '{SEP}'), lambda x: x <> '')"
        if not field.endswith("_alt"):
            tokens = (
                f"list_transform(list_filter({tokens}, lambda x: x not in ({_STOP})), "
                f"lambda x: {_stem('x')})"
            )
        parts.append(f"select {key} key, '{field}' field, {tokens} w from {source} where {column} is not null")
    return " union all ".join(parts)


REG = Registry(
    {
        "doc_fields": " union all ".join(
            f"select id key, '{f}' field, \"{f}\" txt from search_docs where \"{f}\" is not null"
            for f in (*search.ENGLISH_FIELDS, *search.OTHER_FIELDS)
        ),
        "doc_words": f"""
            select key, field, word from (select key, field,
              unnest(regexp_split_to_array(lower(txt), '{SEP}')) word from doc_fields) u where word <> ''""",
        "doc_terms": _analysed("doc_words"),
        "postings": "select field, term, key doc_id, count(*) tf from doc_terms group by all",
        "doc_lens": "select field, doc_id, sum(tf) len from postings group by all",
        "field_stats": "select field, count(*) n_docs, avg(len) avg_len from doc_lens group by all",
        "term_dict": "select field, term, count(*) df from postings group by all",
        "query_fields": f"""
            select query_id key, bt.field, q txt, bt.boost from search_queries
            join {_BOOST} on bt.lang = {_LANG.replace('lang', 'search_queries.lang', 1)}""",
        "query_words": f"""
            select key, field, word from (select key, field,
              unnest(regexp_split_to_array(lower(txt), '{SEP}')) word from query_fields) u where word <> ''""",
        "query_term_list": _analysed("query_words"),
        "scored_fields": """
            select q.key query_id, p.doc_id, p.field,
                   f.boost * sum(q.qtf * ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf
                       / (tf + 1.2e0 * (0.25e0 + 0.75e0 * len / avg_len))) field_score
            from (select key, field, term, count(*) qtf from query_term_list group by all) q
            join query_fields f on f.key = q.key and f.field = q.field
            join postings p on p.field = q.field and p.term = q.term
            join term_dict d on d.field = q.field and d.term = q.term
            join field_stats s on s.field = q.field
            join doc_lens l on l.field = q.field and l.doc_id = p.doc_id
            group by q.key, p.doc_id, p.field, f.boost""",
        "doc_scores": """
            select query_id, doc_id, round(max(field_score), 6) score from scored_fields
            group by query_id, doc_id""",
        "city_asks": """
            select query_id key, field, case when query_id % 3 = 0 then cast(query_id % 25 as varchar)
                   else 'c' || (query_id % 10) end word
            from search_queries, (values ('city'), ('city_alt')) f(field) where query_id % 3 <> 2""",
        "city_terms": _analysed("city_asks"),
        "typed_names": """
            select query_id, q, case when q > 'm' then 'th' else 'en' end lang, 3 + query_id % 12 size
            from (select min(p_partkey) query_id, left(p_name, length(p_name) - 1) q from part group by 2) t""",
        "suggest_docs": _suggest_terms(
            "search_docs", "id",
            [("name", '"name"'), ("city", "city"), ("name_alt", "name_alt"), ("city_alt", "city_alt")],
        ),
        "suggest_asks": _suggest_terms(
            "typed_names", "query_id", [("name", "q"), ("city", "q"), ("name_alt", "q"), ("city_alt", "q")]
        ),
    }
)
query = REG.query


SOURCES = ("documents", "part", "nation")


def index_of(v: Views) -> search.Index:
    """The published index of the catalogue; rebuilt only when a source table has other files than it was made from."""
    root = session_folder(v.spark, f"search-index/{hashlib.sha256(v.folder.encode()).hexdigest()[:16]}")
    signed = snapshots.signature(v.spark, *[f"{v.folder}/{t}.parquet" for t in SOURCES])
    docs = search.project_documents(v.search_docs())
    folder = snapshots.current_or_rebuilt(v.spark, root, signed, lambda to: search.write_index(docs, to))
    return search.read_index(v.spark, folder)


_SHINGLES = """
    select key, field, n, i, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') term, len(w) - n + 1 last_i
    from (select key, field, w, n, unnest(range(1, len(w) - n + 2)) i
          from {src}, (values (1), (2), (3)) g(n) where len(w) >= n) x
    where (field in ('name', 'name_alt') or n <= 2)"""


@query("src9_index_rebuild", """
    select id, "name", city, amenities, name_alt, city_alt, "name" name_suggest, city city_suggest,
           price_per_night, length(coalesce(description, description_alt)) n_text from search_docs""")
def _(v: Views):
    """Two rebuilds, the second of the whole catalogue; what readers of the pointer find afterwards."""
    root = shared_folder(v.spark, "rebuilt")
    docs = search.project_documents(v.search_docs())
    snapshots.publish(docs.filter("price_per_night < 1000"), root)
    snapshots.publish(docs, root)
    return snapshots.read_current(v.spark, root, docs.schema).select(
        "id", "name", "city", "amenities", "name_alt", "city_alt", "name_suggest", "city_suggest",
        "price_per_night", F.length(F.coalesce("description", "description_alt")).alias("n_text"),
    )


@query("txt1_document_projection", """
    select id, "name", city, description, amenities, name_alt, city_alt, description_alt, price_per_night,
           "name" name_suggest, name_alt name_alt_suggest, city city_suggest, city_alt city_alt_suggest
    from search_docs""")
def _(v: Views):
    return search.project_documents(v.search_docs())


@query("txt2_postings", "select field, term, p.doc_id, tf, len from postings p join doc_lens l using (field, doc_id)")
def _(v: Views):
    return search.build_index(v.search_docs()).postings.select("field", "term", "doc_id", "tf", "len")


@query("txt2_field_stats", """
    select field, n_docs, round(avg_len, 6) avg_len, n_terms, n_postings from field_stats join (
      select field, count(*) n_terms, sum(df) n_postings from term_dict group by field) t using (field)""")
def _(v: Views):
    index = index_of(v)
    terms = index.dictionary.groupBy("field").agg(
        F.count(F.lit(1)).alias("n_terms"), F.sum("df").alias("n_postings")
    )
    return index.stats.join(terms, "field")


@query("txt3_ranked_search", """
    select query_id, "rank", doc_id, score from (
      select *, row_number() over (partition by query_id order by score desc, doc_id) "rank" from doc_scores) r
    where "rank" <= 20""")
def _(v: Views):
    docs = v.search_docs()
    return search.search(index_of(v), docs, v.search_queries())


@query("txt4_city_filter", """
    select query_id, "rank", doc_id, score from (
      select s.query_id, s.doc_id, s.score,
             row_number() over (partition by s.query_id order by s.score desc, s.doc_id) "rank"
      from doc_scores s
      where s.query_id % 3 = 2 or exists (
        select 1 from city_terms c join postings p on p.field = c.field and p.term = c.term
        where c.key = s.query_id and p.doc_id = s.doc_id)) r
    where "rank" <= 20""")
def _(v: Views):
    """A third of the queries names a city, a third a second-locale city, a third none."""
    q = F.col("query_id")
    asked = v.search_queries().withColumn(
        "city",
        F.when(q % 3 == 0, (q % 25).cast("string")).when(
            q % 3 == 1, F.concat(F.lit("c"), q % 10)
        ).otherwise(" "),
    )
    docs = v.search_docs()
    return search.search(index_of(v), docs, asked)


@query("txt5_price_filter", """
    select query_id, "rank", doc_id, score from (
      select s.query_id, s.doc_id, s.score,
             row_number() over (partition by s.query_id order by s.score desc, s.doc_id) "rank"
      from (select * from doc_scores where query_id % 4 <> 0
            union all select query_id, id, 1.0 from search_queries, search_docs where query_id % 4 = 0) s
      join search_docs d on d.id = s.doc_id
      where d.price_per_night >= 920 and (s.query_id % 2 = 0 or d.price_per_night <= 980)) r
    where "rank" <= 20""")
def _(v: Views):
    """Every fourth query is blank and matches everything; odd ones have an upper bound too."""
    q = F.col("query_id")
    asked = v.search_queries().select(
        "query_id", F.when(q % 4 == 0, F.lit("  ")).otherwise(F.col("q")).alias("q"), "lang",
        F.lit(920.0).alias("min_price"), F.when(q % 2 == 1, F.lit(980.0)).alias("max_price"),
    )
    docs = v.search_docs()
    return search.search(index_of(v), docs, asked)


@query("txt6_highlights")
def _(v: Views):
    docs, asked = v.search_docs(), v.search_queries()
    hits = search.search(index_of(v), docs, asked, k=10)
    return search.highlights(hits, docs, asked)


@query("txt7_suggestions", f"""
    with dt as ({_SHINGLES.format(src='suggest_docs')}),
    qt as ({_SHINGLES.format(src='suggest_asks')}),
    p as (select field, n, term, key doc_id, count(*) tf from dt group by all),
    l as (select field, n, doc_id, sum(tf) len from p group by all),
    s as (select field, n, count(*) n_docs, avg(len) avg_len from l group by all),
    d as (select field, n, term, count(*) df from p group by all),
    slots as (select query_id, field, n, boost from typed_names t join {_SUGGEST} on st.lang = t.lang),
    parts as (
      select q.key query_id, p.doc_id, boost * ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf
               / (tf + 1.2e0 * (0.25e0 + 0.75e0 * len / avg_len)) part
      from qt q join slots b on b.query_id = q.key and b.field = q.field and b.n = q.n
      join p on p.field = q.field and p.n = q.n and p.term = q.term
      join l on l.field = q.field and l.n = q.n and l.doc_id = p.doc_id
      join s on s.field = q.field and s.n = q.n join d on d.field = q.field and d.n = q.n and d.term = q.term
      where q.i < q.last_i
      union all
      select distinct on (q.key, q.field, q.n, p.doc_id) q.key, p.doc_id, boost
      from qt q join slots b on b.query_id = q.key and b.field = q.field and b.n = q.n
      join p on p.field = q.field and p.n = q.n and starts_with(p.term, q.term)
      where q.i = q.last_i),
    r as (select query_id, doc_id, round(sum(part), 6) score from parts group by all)
    select query_id, "rank", doc_id, score from (
      select r.*, size, row_number() over (partition by r.query_id order by score desc, doc_id) "rank"
      from r join typed_names t on t.query_id = r.query_id) x
    where "rank" <= least(size, 12)""")
def _(v: Views):
    """Every part name as it looks one keystroke before its end, in either locale."""
    typed = F.left("p_name", F.length("p_name") - 1)
    names = v.table("part").groupBy(typed.alias("q")).agg(F.min("p_partkey").alias("query_id"))
    asked = names.select(
        "query_id", "q", F.when(F.col("q") > "m", "th").otherwise("en").alias("lang"),
        (F.lit(3) + F.col("query_id") % 12).alias("size"),
    )
    return search.suggest(search.build_suggest_index(v.search_docs()), asked)


def old_index(v: Views) -> search.Index:
    """An index that was published when only the labelled documents were there, and some that are gone by now."""
    docs = search.project_documents(v.search_docs())
    labelled = v.table("labels").select(F.col("doc_id").alias("id"))
    gone = docs.filter("id % 9 = 4").withColumn("id", -F.col("id"))
    return search.publish_index(docs.join(labelled, "id", "left_semi").unionByName(gone), shared_folder(v.spark, "old-index"))


@query("txt9_index_status", """
    select in_table, in_index, in_table = in_index in_sync from (
      select (select count(*) from search_docs) in_table,
             (select count(*) from search_docs where id in (select doc_id from labels))
             + (select count(*) from search_docs where id % 9 = 4) in_index) c""")
def _(v: Views):
    """Counts of the catalogue and of the documents that an older index holds postings of."""
    return search.index_status(v.search_docs(), old_index(v))


@query("txt9_index_drift", """
    select id, 'missing in index' drift from search_docs where id not in (select doc_id from labels)
    union all select -id, 'missing in table' from search_docs where id % 9 = 4""")
def _(v: Views):
    return aggs.index_drift(v.search_docs().select("id"), search.indexed_ids(old_index(v)))


@query("txt10_explain_fields", """
    select query_id, field, count(*) n_docs, round(max(field_score), 6) best_score
    from scored_fields group by query_id, field""")
def _(v: Views):
    return search.explain_search(index_of(v), v.search_queries())


@query("join8_hit_details", """
    select query_id, id, score, "name", city, price_per_night, amenities amenity_list from (
      select *, row_number() over (partition by query_id order by score desc, doc_id) rn from doc_scores) r
    join search_docs d on d.id = r.doc_id where rn <= 5""")
def _(v: Views):
    docs = v.search_docs()
    hits = search.search(index_of(v), docs, v.search_queries(), k=5)
    return joins.hit_details(
        hits.select("query_id", F.col("doc_id").alias("id"), "score"), docs
    )
