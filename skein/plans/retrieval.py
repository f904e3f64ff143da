"""Registered search and embedding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import round4
from ..operators import language, search, threads
from ..session import cut_lineage, scratch_path, stored
from ..streaming import ingest
from .fixtures import fixture, sql_with
from .registry import register

QV = "(select embedding from embeddings where vec_id = 0)"


def _dist_sql(q: str = QV) -> str:
    return f"list_distance(cast(embedding as double[]), cast({q} as double[]))"


#: A chats view that lacks some chats: their messages must not take places among the k.
SOME_CHATS_SQL = "somechats as (select * from chats where chat_id % 3 <> 1)"


def _some_chats(f):
    return f.chats.filter(F.col("chat_id") % 3 != 1)


@register("vector_search", sql_with(["message_vectors", "chats"], f"""
select m.chat_id, m.message_id, c.title, m.date, m.text, round({_dist_sql()} + 1e-9, 4) as distance
from message_vectors m join somechats c using (chat_id)
where embedding is not null order by {_dist_sql()}, m.chat_id, m.message_id limit 10""", extra=SOME_CHATS_SQL))
def q_vector_search(spark, sf_dir):
    f = fixture(spark, sf_dir)
    r = search.vector_search(f.message_vectors, _some_chats(f), f.query_vector(0), k=10)
    return r.withColumn("distance", round4("distance"))


@register("vector_search_filtered", sql_with(["message_vectors", "chats"], f"""
select m.chat_id, m.message_id, c.title, m.date, m.text, round({_dist_sql()} + 1e-9, 4) as distance
from message_vectors m join somechats c using (chat_id)
where embedding is not null and date > timestamp '2024-01-05' and date < timestamp '2024-01-20' and c.title like '%news%'
order by {_dist_sql()}, m.chat_id, m.message_id limit 25""", extra=SOME_CHATS_SQL))
def q_vector_search_filtered(spark, sf_dir):
    f = fixture(spark, sf_dir)
    r = search.vector_search(f.message_vectors, _some_chats(f), f.query_vector(0), k=25, chatname="news",
                             after="2024-01-05", before="2024-01-20")
    return r.withColumn("distance", round4("distance"))


@register("top_k_vector", sql_with(["message_vectors"], f"""
select chat_id, message_id, round({_dist_sql('(select embedding from embeddings where vec_id = 7)')} + 1e-9, 4)
  as distance from message_vectors where embedding is not null
order by {_dist_sql('(select embedding from embeddings where vec_id = 7)')}, chat_id, message_id limit 10"""))
def q_top_k_vector(spark, sf_dir):
    f = fixture(spark, sf_dir)
    m = f.message_vectors.filter(F.col("embedding").isNotNull())
    d = search.l2_distance("embedding", f.query_vector(7))
    top = m.select("chat_id", "message_id", d.alias("d")).orderBy("d", "chat_id", "message_id").limit(10)
    return top.select("chat_id", "message_id", round4("d").alias("distance"))


@register("like_search", sql_with(["message_vectors", "chats"], """
select m.chat_id, m.message_id, c.title, m.date, m.text from message_vectors m join somechats c using (chat_id)
where embedding is not null and text like '%heor%' order by date desc, m.chat_id, m.message_id limit 10""", extra=SOME_CHATS_SQL))
def q_like_search(spark, sf_dir):
    f = fixture(spark, sf_dir)
    return search.like_search(f.message_vectors, _some_chats(f), "heor", k=10)


@register("search_join", sql_with(["message_vectors", "chats"], """
select m.chat_id, m.message_id, c.title, m.date, m.text from message_vectors m join somechats c using (chat_id)
where m.embedding is not null and m.text like '%heor%' and c.title like '%سلام%'""", extra=SOME_CHATS_SQL))
def q_search_join(spark, sf_dir):
    f = fixture(spark, sf_dir)
    return search.like_search(f.message_vectors, _some_chats(f), "heor", k=None, chatname="سلام")


@register("optional_filters", sql_with(["messages"], """
select chat_id, message_id, date from messages where chat_id = 12 and date > timestamp '2024-01-15'"""))
def q_optional_filters(spark, sf_dir):
    m = search.optional_filters(fixture(spark, sf_dir).messages, chat_id=12, after="2024-01-15")
    return m.select("chat_id", "message_id", "date")


@register("open_range_filter", sql_with(["messages"], """
select chat_id, message_id, date from messages where date > timestamp '2024-01-10 06:00:00'
  and date < timestamp '2024-01-12 18:00:00'"""))
def q_open_range_filter(spark, sf_dir):
    m = search.optional_filters(fixture(spark, sf_dir).messages, after="2024-01-10 06:00:00",
                                before="2024-01-12 18:00:00")
    return m.select("chat_id", "message_id", "date")


@register("like_filter", sql_with(["messages", "chats"], """
select chat_id, title from chats where title like '%news%'
union all select chat_id, title from chats where title ilike '%NEWS 1%'"""))
def q_like_filter(spark, sf_dir):
    c = fixture(spark, sf_dir).chats
    return (search.find_chats(c, "news").select("chat_id", "title")
            .unionByName(search.find_chats(c, "NEWS 1", case_insensitive=True).select("chat_id", "title")))


@register("limit_rows", sql_with(["messages"], """
select chat_id, message_id, date from messages order by date desc, chat_id, message_id limit 10"""))
def q_limit_rows(spark, sf_dir):
    m = fixture(spark, sf_dir).messages.select("chat_id", "message_id", "date")
    return search.limit_rows(m, 10, [F.col("date").desc(), "chat_id", "message_id"])


# chains + embeddings ------------------------------------------------------------

CHAIN_EMB_SQL = """cemb as (select w.chat_id, w.leaf as last_message_id,
  case when e.label = 0 then null else e.embedding end as embedding
  from (select distinct chat_id, leaf from w) w join embeddings e
  on e.vec_id = (w.leaf * 40 + w.chat_id) % (select count(*) from embeddings)
  where (w.leaf + w.chat_id) % 3 = 0)"""


def _chain_embeddings(f, chains):
    emb = f.table("embeddings")
    n = emb.select(F.count(F.lit(1))).scalar()
    c = (chains.select("chat_id", "last_message_id")
         .filter((F.col("last_message_id") + F.col("chat_id")) % 3 == 0)
         .withColumn("_vk", (F.col("last_message_id") * 40 + F.col("chat_id")) % n))
    e = emb.select(F.col("vec_id").alias("_vk"),
                   F.when(F.col("label") == 0, F.lit(None)).otherwise(F.col("embedding")).alias("embedding"))
    return c.join(e, "_vk").drop("_vk")


def _chain_sql_prefix():
    from .chains import CHAIN_SQL
    return CHAIN_SQL


@register("anti_pending", sql_with(["messages", "chats"], """
select chat_id, leaf as last_message_id from w
where not exists (select 1 from messages p where p.chat_id = w.chat_id and p.message_id = w.parent)
  and not exists (select 1 from cemb e where e.chat_id = w.chat_id and e.last_message_id = w.leaf
                  and e.embedding is not null)""", extra=_chain_sql_prefix() + ",\n" + CHAIN_EMB_SQL, recursive=True))
def q_anti_pending(spark, sf_dir):
    f = fixture(spark, sf_dir)
    # used twice below; of the chains just their keys are kept, so no text is gathered
    chains = stored(threads.message_chain(f.messages, f.chats).select("chat_id", "last_message_id"))
    return search.pending_chains(chains, _chain_embeddings(f, chains)).select("chat_id", "last_message_id")


@register("channel_response_filter", sql_with(["messages", "chats"], """
select chat_id, leaf as last_message_id, n as chain_len from w
where not exists (select 1 from lm p where p.chat_id = w.chat_id and p.message_id = w.parent)
  and flag and n > 5 and chat_id in (select chat_id from chats where regexp_matches(title, '[\\x{0590}-\\x{05FF}]'))""",
    extra=_chain_sql_prefix(), recursive=True))
def q_channel_response_filter(spark, sf_dir):
    f = fixture(spark, sf_dir)
    chains = threads.message_chain(f.messages, f.chats)
    hebrew = language.chats_in(f.chats.withColumn("sample_count", F.lit(None).cast("bigint"))
                               .withColumn("hebrew_count", F.lit(None).cast("bigint")), "hebrew")
    return search.channel_responses(chains, hebrew, 5).select("chat_id", "last_message_id", "chain_len")


def _embed_summary(df, key_cols, vec="embedding"):
    norm = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return df.select(*key_cols, F.size(vec).alias("dim"), round4(norm).alias("norm"))


WORDS = r"regexp_matches(lower(coalesce({c}, '')), '[\p{{L}}\p{{N}}]')"


@register("embed_batch", sql_with(["messages"], f"""
select chat_id, message_id, 64 as dim, cast(case when {WORDS.format(c='text')} then 1.0 else 0.0 end as double) as norm
from messages"""))
def q_embed_batch(spark, sf_dir):
    m = fixture(spark, sf_dir).messages.select("chat_id", "message_id", "text")
    return _embed_summary(search.embed(m, "text", "embedding", search.hashing_encoder(64)), ["chat_id", "message_id"])


@register("embed_doc", sql_with(["raw_docs"], f"""
select struct_extract(chat, 'id') as cid, id as mid, 32 as dim, cast(1.0 as double) as norm
from raw_docs where (text is not null or caption is not null) and reply_to_message_id is null
  and reactions is not null and forwards is not null
  and (len(struct_extract(reactions, 'reactions')) = 0 or list_bool_and(list_transform(
       struct_extract(reactions, 'reactions'), lambda r: struct_extract(r, 'emoji') is not null)))"""))
def q_embed_doc(spark, sf_dir):
    from ..operators import normalize
    d = normalize.reaction_text(normalize.doc_select(fixture(spark, sf_dir).raw_docs)).filter(
        F.col("text").isNotNull())
    return _embed_summary(search.embed(d, "text", "embedding", search.hashing_encoder(32)), ["cid", "mid"])


@register("embed_pending_loop", sql_with(["messages", "chats"], """
select chat_id, last_message_id, 64 as dim from (
  select chat_id, leaf as last_message_id, chain from w
  where not exists (select 1 from lm p where p.chat_id = w.chat_id and p.message_id = w.parent)) c
where chain is not null or exists (select 1 from cemb e where e.chat_id = c.chat_id
  and e.last_message_id = c.last_message_id and e.embedding is not null)""",
    extra=_chain_sql_prefix() + ",\n" + CHAIN_EMB_SQL, recursive=True))
def q_embed_pending_loop(spark, sf_dir):
    f = fixture(spark, sf_dir)
    # places, not texts, are kept and meet the store; the pending chains' texts are read when they are encoded
    chains = stored(threads.message_chain(f.placed, f.chats, read=f.read, items=True))
    store = cut_lineage(_chain_embeddings(f, chains).filter(F.col("embedding").isNotNull()))
    once = search.embed_pending(chains, store, 64, search.placed_encoder(lambda rows: threads.chain_texts(rows, f.read), search.hashing_encoder(64)))
    return once.select("chat_id", "last_message_id", F.size("embedding").alias("dim"))


@register("embed_chain_stream", sql_with(["messages", "chats"], """
select chat_id, leaf as last_message_id, 64 as dim from w
where not exists (select 1 from lm p where p.chat_id = w.chat_id and p.message_id = w.parent) and chain is not null""",
    extra=_chain_sql_prefix(), recursive=True))
def q_embed_chain_stream(spark, sf_dir):
    """V05 as a stream: some chains, then all (the first ones again), then a run with nothing new."""
    f = fixture(spark, sf_dir)
    kept = stored(threads.message_chain(f.placed, f.chats, read=f.read, items=True).select("chat_id", "last_message_id", "chain"))
    landing, store, ckpt = (scratch_path(spark, n) for n in ("chains", "vectors", "ckpt"))
    for part in (kept.filter("last_message_id % 2 = 0"), kept, None):
        if part is not None:
            chains = threads.chain_texts(part, f.read)  # the texts are put into the landed files only
            chains.write.mode("append").option("compression", "zstd").parquet(landing)
        ingest.embed_stream(spark.readStream.schema(chains.schema).parquet(landing), store, ckpt, 64).awaitTermination()
    return ingest.embedded(spark, store).select("chat_id", "last_message_id", F.size("embedding").alias("dim"))


@register("poll_option_vectors", sql_with(["raw_docs"], """
select distinct struct_extract(chat, 'id') as chat_id, id as message_id, struct_extract(o, 'text') as poll_option_text,
  16 as dim, cast(1.0 as double) as norm from (select *, unnest(struct_extract(poll, 'options')) as o from raw_docs
  where not coalesce(outgoing, false) and struct_extract(chat, 'id') is not null and id is not null)"""))
def q_poll_option_vectors(spark, sf_dir):
    from ..operators import normalize
    p = normalize.explode_poll(fixture(spark, sf_dir).raw_docs)
    v = search.embed(p, "poll_option_text", "embedding", search.hashing_encoder(16))
    return _embed_summary(v, ["chat_id", "message_id", "poll_option_text"])


@register("sink_embeddings", sql_with(["messages", "chats"], """
select chat_id, last_message_id from cemb where embedding is not null""",
    extra=_chain_sql_prefix() + ",\n" + CHAIN_EMB_SQL, recursive=True))
def q_sink_embeddings(spark, sf_dir):
    f = fixture(spark, sf_dir)
    chains = threads.message_chain(f.messages, f.chats)
    new = cut_lineage(_chain_embeddings(f, chains))
    empty = new.limit(0)
    appended = search.append_embeddings(empty, new.filter(F.col("embedding").isNotNull()), 64)
    # appending the same batch again is a no-op (idempotent sink)
    return search.append_embeddings(appended, new.filter(F.col("embedding").isNotNull()), 64).select(
        "chat_id", "last_message_id")
