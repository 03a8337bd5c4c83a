"""Vector and prompt queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayspark.functions.text import SEPARATORS
from stayspark.operators import aggs, filters, vectors
from stayspark.operators.retrieval import hybrid_retrieval
from stayspark.plans.registry import Registry, sql_date
from stayspark.plans.relational import REG as RELATIONAL
from stayspark.plans.relational import stock
from stayspark.session import shared_folder, stored
from stayspark.sources.tables import spread
from stayspark.sources.views import Views

DIM = 64
#: A label's mean lies far from each of its members.
CENTROID_SCORE = 0.1
#: Least cosine of the neighbours that vectors ask for.
NEAR = 0.2
TEMPLATE = "Context:\n{context}\n\nQuestion: {question}"
DEFAULT_QUESTION = "Find hotels near the beach under $100"


def _bag(source: str, key: str, text: str) -> str:
    """(id, embedding) by hashed words, the same rule as the native embedder."""
    return f"""
        select k.{key} id, list_transform(range({DIM}), lambda i:
                 case when m.hits is null then case when i = 0 then 1.0e0 else 0.0e0 end
                      else cast(coalesce(m.hits[i], 0) as double) end) embedding
        from {source} k left join (
          select id, map_from_entries(list((b, n))) hits from (
            select id, cast(('0x' || substr(md5(word), 1, 8)) as bigint) % {DIM} b, count(*) n
            from (select {key} id, unnest(regexp_split_to_array(lower({text}), '{SEPARATORS}')) word from {source}) w
            where word <> '' group by 1, 2) h group by id) m on m.id = k.{key}"""


def _cos(a: str, b: str) -> str:
    return f"""round(coalesce(list_dot_product(cast({a} as double[]), cast({b} as double[])) / nullif(
        sqrt(list_dot_product(cast({a} as double[]), cast({a} as double[])))
        * sqrt(list_dot_product(cast({b} as double[]), cast({b} as double[]))), 0), 0), 6)"""


def _hits(asked: str) -> str:
    return f"""
        select * from (select query_id, id, score, row_number() over (partition by query_id
                         order by score desc, id) "rank" from (
          select a.id query_id, h.id, {_cos('a.embedding', 'h.embedding')} score
          from {asked} a, hotel_vectors h) s where score > 0.5) r"""


def _contexts(hits: str) -> str:
    return f"""
        select query_id, string_agg(d.text, chr(10) || chr(10) order by "rank") context,
               string_agg(cast(d.doc_id as varchar), ',' order by "rank") sources
        from {hits} r join hotel_docs d on d.doc_id = r.id where "rank" <= 4 group by query_id"""


REG = Registry(
    {
        "stock": RELATIONAL.views["stock"],
        "hotel_docs": """
            select doc_id, id hotel_id, "name", city, price_per_night,
                   substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-3' || substr(h, 14, 3) || '-'
                     || case substr(h, 17, 1) when '0' then '8' when '4' then '8' when '8' then '8' when 'c' then '8'
                          when '1' then '9' when '5' then '9' when '9' then '9' when 'd' then '9'
                          when '2' then 'a' when '6' then 'a' when 'a' then 'a' when 'e' then 'a' else 'b' end
                     || substr(h, 18, 3) || '-' || substr(h, 21, 12) id,
                   "name" || ' in ' || city || '.' || chr(10) || 'Price: $' || price_per_night || ' per night.' || chr(10)
                     || description || chr(10) || 'Amenities: ' || coalesce(amenities, 'not listed') || '.' text
            from (select *, md5('hotel-' || doc_id) h from described_hotels where description is not null) x""",
        "hotel_vectors": _bag("hotel_docs", "doc_id", "text"),
        "doc_vectors": _bag("documents", "doc_id", "text"),
        "ask_vectors": _bag("benchmark", "item_id", "text"),
        "centroids": f"""
            select label query_id, list(v order by i) embedding from (
              select label, i, avg(cast(embedding[i] as double)) v
              from embeddings, (select unnest(range(1, {DIM + 1})) i) g group by label, i) c group by label""",
        "centroid_hits": f"""
            select * from (select query_id, id, score, row_number() over (partition by query_id
                             order by score desc, id) "rank" from (
              select query_id, v.id, {_cos('c.embedding', 'v.embedding')} score
              from centroids c, vectors v where price_per_night < 300) s where score > {CENTROID_SCORE}) r
            where "rank" <= 4""",
        "last_questions": f"""
            select conv_id, case when trim(coalesce(q, '')) = '' then '{DEFAULT_QUESTION}' else q end question
            from (select conv_id, arg_max(text, turn) filter (where role = 'user') q from conversations group by conv_id) t""",
        "talk_vectors": _bag("last_questions", "conv_id", "question"),
        "hotel_hits": _hits("ask_vectors"),
        "talk_hits": _hits("talk_vectors"),
        "contexts": _contexts("hotel_hits"),
        "talk_contexts": _contexts("talk_hits"),
    }
)
query = REG.query


def centroids(v: Views):
    """One query vector per label: the mean of its vectors, taken position by position."""
    means = (
        v.table("embeddings")
        .select("label", F.posexplode("embedding").alias("i", "x"))
        .groupBy("label", "i")
        .agg(F.avg(F.col("x").cast("double")).alias("v"))
    )
    # At most one entry per dimension is gathered per label.
    return means.groupBy(F.col("label").cast("long").alias("query_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda s: s["v"]).alias("embedding")
    )


def hotel_documents(v: Views):
    docs = vectors.retrieval_documents(v.described_hotels(), key="doc_id")
    return docs.withColumn("doc_id", F.col("metadata.doc_id"))


def hotel_vectors(v: Views):
    return vectors.embed_words(hotel_documents(v), "doc_id", "text", DIM).withColumnRenamed("doc_id", "id")


def questions(v: Views):
    return v.table("benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("question")
    )


def hits_of(v: Views, asked, k: int = 4):
    """Documents nearest to the questions (query_id, question)."""
    vector = vectors.embed_words(asked, "query_id", "question", DIM)
    return vectors.similarity_search(hotel_vectors(v), vector, k=k)


def hotel_texts(v: Views):
    return hotel_documents(v).select(F.col("doc_id").alias("id"), "text")


@query("vec1_retrieval_documents", """
    select id, text, doc_id, hotel_id, "name", city, price_per_night from hotel_docs""")
def _(v: Views):
    """Every document, as a description of its hotel."""
    m = F.col("metadata")
    return hotel_documents(v).select(
        "doc_id",
        "id", "text", m["hotelId"].alias("hotel_id"), m["name"].alias("name"),
        m["city"].alias("city"), m["pricePerNight"].alias("price_per_night"),
    )


@query("vec3_embed_documents", """
    select id doc_id, array_to_string(list_transform(embedding, lambda x: cast(cast(x as bigint) as varchar)), '|') embedding
    from doc_vectors""")
def _(v: Views):
    made = vectors.embed_words(spread(v.table("documents").select("doc_id", "text")), "doc_id", "text", DIM)
    return made.select("doc_id", F.col("embedding").cast("array<bigint>").alias("embedding"))


@query("vec4_similarity_search", """select query_id, "rank", id, score from centroid_hits""")
def _(v: Views):
    """The four nearest affordable vectors of every label's mean."""
    return vectors.similarity_search(
        v.vectors(), centroids(v), threshold=CENTROID_SCORE, condition=("pricePerNight", "<", 300.0)
    )


def list_index(v: Views) -> vectors.ListIndex:
    return vectors.build_lists(v.vectors(), shared_folder(v.spark, "vector-lists"))


def vector_questions(v: Views):
    """Every twentieth vector asks for what is near it."""
    return v.vectors().filter("id % 20 = 0").select(F.col("id").alias("query_id"), "embedding")


@query("vec4_approximate_search")
def _(v: Views):
    """The nearest vectors by the inverted lists."""
    return vectors.approximate_search(list_index(v), vector_questions(v), threshold=NEAR)


@query("vec4_approximate_recall", f"""
    select count(*) n_exact, count(distinct query_id) n_queries, true nine_in_ten from (
      select *, row_number() over (partition by query_id order by score desc, id) "rank" from (
        select q.id query_id, v.id, {_cos('q.embedding', 'v.embedding')} score from vectors q, vectors v where q.id % 20 = 0) s
      where score > {NEAR}) r where "rank" <= 4""")
def _(v: Views):
    """How many of the exact neighbours the inverted lists find."""
    exact = vectors.similarity_search(v.vectors(), vector_questions(v), threshold=NEAR).select("query_id", "id")
    found = vectors.approximate_search(list_index(v), vector_questions(v), threshold=NEAR)
    both = exact.join(found.select("query_id", "id", F.lit(1).alias("hit")), ["query_id", "id"], "left")
    return both.agg(
        F.count(F.lit(1)).alias("n_exact"), F.countDistinct("query_id").alias("n_queries"),
        (F.count("hit") >= 0.9 * F.count(F.lit(1))).alias("nine_in_ten"),
    )


@query("vec5_pair_similarity", f"""
    select p.left_id, p.right_id, {_cos('a.embedding', 'b.embedding')} similarity, false rejected
    from (select min(vec_id) over (partition by label) left_id, vec_id right_id from embeddings) p
    join embeddings a on a.vec_id = p.left_id join embeddings b on b.vec_id = p.right_id""")
def _(v: Views):
    """Every vector against the first vector of its label."""
    e = v.table("embeddings")
    anchors = e.groupBy("label").agg(F.min("vec_id").alias("left_id"))
    pairs = e.select("label", F.col("vec_id").alias("right_id")).join(anchors, "label").select(
        "left_id", "right_id"
    )
    store = e.select(F.col("vec_id").alias("id"), "embedding")
    return vectors.pair_similarity(pairs, store, store)


@query("vec6_upsert", """
    select doc_id id, case when manager_id is null then 'old' else 'new' end version, length("name") n
    from described_hotels where description is not null or manager_id is not null""")
def _(v: Views):
    """The store of described hotels takes in a fresh batch of the managed ones."""
    hotels = v.described_hotels().select(F.col("doc_id").alias("id"), "name", "manager_id", "description")
    old = hotels.filter("description is not null").select(
        "id", F.lit("old").alias("version"), F.length("name").alias("n")
    )
    fresh = hotels.filter("manager_id is not null").select(
        "id", F.lit("new").alias("version"), F.length("name").alias("n")
    )
    return vectors.upsert(old, fresh)


@query("vec7_rag_prompts", """
    select b.item_id query_id, 'Context:' || chr(10) || coalesce(context, '') || chr(10) || chr(10)
             || 'Question: ' || b.text prompt, coalesce(sources, '') sources
    from benchmark b left join contexts c on c.query_id = b.item_id""")
def _(v: Views):
    asked = questions(v)
    return vectors.rag_prompts(asked, hits_of(v, asked), hotel_texts(v), TEMPLATE, DEFAULT_QUESTION)


@query("vec7_template_defaults", """
    select id request_id, 'City: ' || case when id % 2 = 0 then city else 'Lisbon' end || chr(10)
           || 'Nightly budget: ' || case when saas_plan = 'FREE' then 100.0e0 else price_per_night end || ' USD' || chr(10)
           || 'Preferred vibe: ' || coalesce(amenities, 'close to the beach') prompt from hotels""")
def _(v: Views):
    asked = v.hotels().select(
        F.col("id").alias("request_id"),
        F.when(F.col("id") % 2 == 0, F.col("city")).otherwise(" ").alias("city"),
        F.when(F.col("saas_plan") != "FREE", F.col("price_per_night")).alias("budget"),
        F.col("amenities").alias("vibe"),
    )
    return vectors.suggestion_prompts(asked)


@query("vec9_conversation_prompts", """
    select q.conv_id, memory || chr(10) || coalesce(context, '') || chr(10) || q.question prompt
    from last_questions q
    join (select conv_id, string_agg(role || ': ' || text, chr(10) order by turn) memory from (
            select *, row_number() over (partition by conv_id order by turn desc) rn from conversations) t
          where rn <= 20 group by 1) m on m.conv_id = q.conv_id
    left join talk_contexts c on c.query_id = q.conv_id""")
def _(v: Views):
    """Each conversation's last question with its memory and what that question retrieves."""
    turns = v.table("conversations")
    last = vectors.last_questions(turns, DEFAULT_QUESTION)
    hits = hits_of(v, last.withColumnRenamed("conv_id", "query_id"))
    return vectors.conversation_prompts(last, turns, hits, hotel_texts(v))


@query("vec10_call_trace", """
    select r.request_id, 'searchHotels' tool,
           '{"city":"' || r.city || '","max_price":' || r.max_price || '}' arguments,
           (select count(*) from hotels h where lower(h.city) = lower(r.city)
              and h.price_per_night <= r.max_price) result_count
    from (select c_custkey request_id, n_name city, 200.0e0 + c_nationkey * 5 max_price
          from customer join nation on n_nationkey = c_nationkey) r""")
def _(v: Views):
    """One hotel search per customer, in the own nation and budget."""
    asked = v.table("customer").join(v.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("request_id"), F.col("n_name").alias("city"),
        F.lit(None).cast("double").alias("min_price"),
        (F.lit(200.0) + F.col("c_nationkey") * 5).alias("max_price"),
    )
    hotels = v.hotels().select(F.col("id").alias("hotel_id"), "city", "price_per_night")
    found = filters.matching_counts(hotels, asked)
    return vectors.call_trace(asked, found, "searchHotels", ["city", "max_price"])


@query("vec10_availability_trace", """
    select b.id request_id, 'checkAvailability' tool, '{"hotel_id":' || b.hotel_id || '}' arguments,
           count(s.hotel_id) result_count
    from bookings b left join stock s on s.hotel_id = b.hotel_id and s.room_type = b.room_type
      and s.inventory_date >= b.check_in and s.inventory_date < b.check_out
    group by b.id, b.hotel_id""")
def _(v: Views):
    asked = v.bookings().select(
        F.col("id").alias("request_id"), "hotel_id", "room_type", "check_in", "check_out"
    )
    nightly = aggs.nightly_availability(asked, stock(v))
    return vectors.call_trace(asked, nightly, "checkAvailability", ["hotel_id"])


@query("join11_hybrid_retrieval", f"""
    select h.query_id, h.hotel_id, h.score, p.price_per_night, {sql_date("a.check_in")} check_in
    from (select query_id, d.hotel_id, max(score) score from hotel_hits r join hotel_docs d on d.doc_id = r.id
          where "rank" <= 10 group by 1, 2) h
    join hotels p on p.id = h.hotel_id
    join (select item_id, date '2026-02-01' + cast(item_id as int) check_in,
                 date '2026-02-03' + cast(item_id as int) check_out from benchmark) a on a.item_id = h.query_id
    where p.price_per_night <= 400 and (
      select count(distinct inventory_date) from stock s where s.hotel_id = h.hotel_id and s.available_rooms > 0
        and s.room_type = 'SUITE' and s.inventory_date >= a.check_in and s.inventory_date < a.check_out) = 2""")
def _(v: Views):
    """Hotels of each passage's ten nearest descriptions that are in budget and have a suite for both nights.

    The hits are stored, as several steps read them; stock is worked out for their hotels only.
    """
    day = F.col("item_id").cast("int")
    stays = v.table("benchmark").select(
        F.col("item_id").alias("query_id"), F.lit("SUITE").alias("room_type"),
        F.lit(None).cast("string").alias("city"), F.lit(None).cast("double").alias("min_price"),
        F.lit(400.0).alias("max_price"),
        F.date_add(F.lit("2026-02-01").cast("date"), day).alias("check_in"),
        F.date_add(F.lit("2026-02-03").cast("date"), day).alias("check_out"),
    )
    hotel_of = hotel_documents(v).select(F.col("doc_id").alias("id"), F.col("metadata.hotelId").alias("hotel_id"))
    hits = hits_of(v, questions(v), 10).join(hotel_of, "id").groupBy("query_id", F.col("hotel_id").alias("id")).agg(
        F.max("score").alias("score"), F.min("rank").alias("rank")
    )
    hits = stored(hits, "hybrid-hits")
    return hybrid_retrieval(hits, stays, v.hotels(), stock(v, hits.select(F.col("id").alias("hotel_id")))).select(
        "query_id", "hotel_id", "score", "price_per_night", "check_in"
    )


@query("vec9_memory_windows", """
    select conv_id, string_agg(role || ': ' || text, chr(10) order by turn) memory from (
      select *, row_number() over (partition by conv_id order by turn desc) rn from conversations) t
    where rn <= 4 group by conv_id""")
def _(v: Views):
    """A window of four so that the bound is met by the given conversations."""
    return vectors.memory_window(v.table("conversations"), 4)


