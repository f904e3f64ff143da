"""Registered raw-document queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..functions import scalars as S
from ..operators import normalize, tables
from ..session import scratch_path
from ..sources import readers
from .fixtures import fixture, sql_with
from .registry import register


def sx(col: str, *fields: str) -> str:
    out = col
    for f in fields:
        out = f"struct_extract({out}, '{f}')"
    return out


OK_SQL = f"""ok as (select * from raw_docs where not coalesce(outgoing, false) and {sx('chat', 'id')} is not null
  and id is not null)"""
RITEMS_SQL = OK_SQL + f""",
rx as (select {sx('chat', 'id')} as chat_id, id as message_id, unnest({sx('reactions', 'reactions')}) as r,
  generate_subscripts({sx('reactions', 'reactions')}, 1) as pos from ok),
ritems as (select chat_id, message_id, coalesce({sx('r', 'emoji')}, cast({sx('r', 'custom_emoji_id')} as varchar))
  as reaction, arg_max({sx('r', 'count')}, pos) as votes_abs, min(pos) as first_pos from rx group by all),
px as (select {sx('chat', 'id')} as chat_id, id as message_id, unnest({sx('poll', 'options')}) as o,
  generate_subscripts({sx('poll', 'options')}, 1) as pos from ok),
pitems as (select chat_id, message_id, {sx('o', 'text')} as poll_option_text, min(pos) as first_pos,
  arg_max({sx('o', 'voter_count')}, pos) as votes_abs from px group by all),
rtot as (select chat_id, message_id, cast(sum(votes_abs) as int) as total from ritems group by all),
ptot as (select chat_id, message_id, cast(sum(votes_abs) as int) as total from pitems group by all)"""

MEDIA_SQL_KIND = "case " + " ".join(f"when {m} is not null then '{m}'" for m in schemas.MEDIA_KINDS) + " end"
MEDIA_SQL_FID = "case " + " ".join(f"when {m} is not null then {sx(m, 'file_id')}" for m in schemas.MEDIA_KINDS) + " end"
MEDIA_SQL_FUID = "case " + " ".join(f"when {m} is not null then {sx(m, 'file_unique_id')}"
                                    for m in schemas.MEDIA_KINDS) + " end"
TEXT_SQL = (f"case when coalesce(text, '') <> '' then text when coalesce(caption, '') <> '' then caption "
            f"when poll is not null then {sx('poll', 'question')} end")
FLAT_SQL = RITEMS_SQL + f""",
flat as (select {sx('chat', 'id')} as chat_id, id as message_id,
  coalesce({sx('from_user', 'id')}, {sx('sender_chat', 'id')}) as sender_id, {TEXT_SQL} as text, date, views,
  forwards, coalesce({sx('forward_from_chat', 'id')}, {sx('forward_from', 'id')}) as forward_from_chat_id,
  forward_from_message_id, reply_to_message_id, p.total as poll_vote_count, r.total as reactions_vote_count,
  {MEDIA_SQL_KIND} as media_type, {MEDIA_SQL_FID} as file_id, {MEDIA_SQL_FUID} as file_unique_id
  from ok left join rtot r on r.chat_id = {sx('ok.chat', 'id')} and r.message_id = ok.id
  left join ptot p on p.chat_id = {sx('ok.chat', 'id')} and p.message_id = ok.id)"""


def _flat(f):
    return normalize.flatten_messages(f.raw_docs)


@register("scan_raw_messages", sql_with(["raw_docs"], f"""
select id, {sx('chat', 'id')} as chat_id, date, text, caption, views, {sx('from_user', 'first_name')} as first_name,
  cast(len({sx('reactions', 'reactions')}) as int) as n_reactions, {sx('poll', 'question')} as question from raw_docs"""))
def q_scan_raw_messages(spark, sf_dir):
    """Documents written as JSON lines to the shared scratch folder, read back with the schema."""
    f = fixture(spark, sf_dir)
    path = scratch_path(spark, "raw-messages")
    readers.write_raw_messages(f.raw_docs.drop("_arrival"), path)
    r = readers.read_raw_messages(spark, path)
    return r.select("id", F.col("chat.id").alias("chat_id"), "date", "text", "caption", "views",
                    F.col("from_user.first_name").alias("first_name"),
                    F.size("reactions.reactions").alias("n_reactions"), F.col("poll.question").alias("question"))


@register("flatten_message", sql_with(["raw_docs"], "select * from flat", extra=FLAT_SQL))
def q_flatten_message(spark, sf_dir):
    return _flat(fixture(spark, sf_dir))


@register("message_text", sql_with(["raw_docs"], f"select {sx('chat', 'id')} as chat_id, id as message_id, "
                                   f"{TEXT_SQL} as text from ok", extra=OK_SQL))
def q_message_text(spark, sf_dir):
    r = normalize._keep(fixture(spark, sf_dir).raw_docs)
    return r.select(F.col("chat.id").alias("chat_id"), F.col("id").alias("message_id"),
                    normalize.message_text().alias("text"))


@register("message_media", sql_with(["raw_docs"], f"select {sx('chat', 'id')} as chat_id, id as message_id, "
                                    f"{MEDIA_SQL_KIND} as media_type, {MEDIA_SQL_FID} as file_id, "
                                    f"{MEDIA_SQL_FUID} as file_unique_id from ok", extra=OK_SQL))
def q_message_media(spark, sf_dir):
    r = normalize._keep(fixture(spark, sf_dir).raw_docs)
    return r.select(F.col("chat.id").alias("chat_id"), F.col("id").alias("message_id"), *normalize.message_media())


EMOJI_SQL = RITEMS_SQL + """,
emoji_map as (select cast(row_number() over (order by reaction) as int) as reaction_id, reaction
  from (select distinct reaction from ritems))"""


def _emoji_map(spark, f):
    items = normalize._reaction_items(normalize._keep(f.raw_docs))
    empty = spark.createDataFrame([], "reaction_id int, reaction string, is_custom boolean")
    return tables.dictionary_encode(items, "reaction", empty)


@register("explode_reactions", sql_with(["raw_docs"], """
select i.chat_id, i.message_id, e.reaction_id,
  round(case when coalesce(t.total, 0) <> 0 then cast(i.votes_abs as double) / t.total else 0 end + 1e-9, 4)
    as reaction_votes_norm, i.votes_abs as reaction_votes_abs
from ritems i join rtot t using (chat_id, message_id) left join emoji_map e using (reaction)""", extra=EMOJI_SQL))
def q_explode_reactions(spark, sf_dir):
    f = fixture(spark, sf_dir)
    r = normalize.explode_reactions(f.raw_docs, _emoji_map(spark, f))
    return r.withColumn("reaction_votes_norm", S.round4("reaction_votes_norm"))


POLL_SQL = RITEMS_SQL + """,
polls as (select i.chat_id, i.message_id,
  cast(rank() over (partition by i.chat_id, i.message_id order by i.first_pos) - 1 as int) as poll_option_id,
  i.poll_option_text, case when coalesce(t.total, 0) <> 0 then cast(i.votes_abs as double) / t.total else 0 end
    as votes_norm, i.votes_abs
  from pitems i join ptot t using (chat_id, message_id))"""


@register("explode_poll", sql_with(["raw_docs"], "select chat_id, message_id, poll_option_id, poll_option_text, "
                                  "round(votes_norm + 1e-9, 4) as votes_norm, votes_abs from polls", extra=POLL_SQL))
def q_explode_poll(spark, sf_dir):
    r = normalize.explode_poll(fixture(spark, sf_dir).raw_docs)
    return r.withColumn("votes_norm", S.round4("votes_norm"))


@register("vote_totals_raw", sql_with(["raw_docs"], """
select chat_id, message_id, poll_vote_count, reactions_vote_count from flat
where poll_vote_count is not null or reactions_vote_count is not null""", extra=FLAT_SQL))
def q_vote_totals_raw(spark, sf_dir):
    m = _flat(fixture(spark, sf_dir))
    return m.filter(F.col("poll_vote_count").isNotNull() | F.col("reactions_vote_count").isNotNull()).select(
        "chat_id", "message_id", "poll_vote_count", "reactions_vote_count")


CHAT_ROWS_SQL = OK_SQL + f""",
chat_rows as (select {sx('chat', 'id')} as chat_id, {sx('chat', 'title')} as title,
  {sx('chat', 'username')} as username, lower({sx('chat', 'type')}) as type,
  {sx('chat', 'members_count')} as members_count, {sx('chat', 'is_scam')} as is_scam,
  {sx('chat', 'is_fake')} as is_fake, {sx('chat', 'linked_chat', 'id')} as linked_chat_id, _arrival from ok),
merged as (select chat_id, {', '.join(f"arg_max({c}, case when {c} is not null then _arrival end) as {c}"
                                     for c in ('title', 'username', 'type', 'members_count', 'is_scam', 'is_fake',
                                               'linked_chat_id'))}
  from chat_rows group by chat_id)"""
CHAT_COLS = ["chat_id", "title", "username", "type", "members_count", "is_scam", "is_fake", "linked_chat_id"]


def _chat_rows(f):
    return normalize.extract_chats(f.raw_docs, carry=["_arrival"]).select(*CHAT_COLS, "_arrival")


@register("extract_chat", sql_with(["raw_docs"], "select " + ", ".join(CHAT_COLS) + " from chat_rows",
                                   extra=CHAT_ROWS_SQL))
def q_extract_chat(spark, sf_dir):
    return normalize.extract_chats(fixture(spark, sf_dir).raw_docs).select(*CHAT_COLS)


@register("merge_non_null", sql_with(["raw_docs"], "select * from merged", extra=CHAT_ROWS_SQL))
def q_merge_non_null(spark, sf_dir):
    return normalize.merge_non_null(_chat_rows(fixture(spark, sf_dir)), "chat_id", "_arrival").select(*CHAT_COLS)


@register("extract_user", sql_with(["raw_docs"], f"""
select {sx('from_user', 'id')} as sender_id, {sx('from_user', 'first_name')} as first_name,
  {sx('from_user', 'last_name')} as last_name, {sx('from_user', 'username')} as username,
  {sx('from_user', 'is_bot')} as is_bot from ok where from_user is not null""", extra=OK_SQL))
def q_extract_user(spark, sf_dir):
    return normalize.extract_users(fixture(spark, sf_dir).raw_docs).select(
        "sender_id", "first_name", "last_name", "username", "is_bot")


@register("presence_flags", sql_with(["raw_docs"], """
select chat_id, message_id, poll_vote_count is not null as has_poll, reactions_vote_count is not null as has_reactions,
  text is not null as has_text, media_type is not null as has_media from flat""", extra=FLAT_SQL))
def q_presence_flags(spark, sf_dir):
    m = normalize.presence_flags(_flat(fixture(spark, sf_dir)))
    return m.select("chat_id", "message_id", "has_poll", "has_reactions", "has_text", "has_media")


@register("check_constraints", sql_with(["stocks"], """
select symbol, granularity, date, coalesce(open >= 0, true) and coalesce(close >= 0, true)
  and coalesce(volume >= 0, true) and coalesce(open < 1500, true) as valid from stocks"""))
def q_check_constraints(spark, sf_dir):
    s = fixture(spark, sf_dir).stocks
    # the stored rule set plus one extra bound to produce rejected rows on the fixture
    ok = normalize.check_rules(s, "stocks") & F.coalesce(F.col("open") < 1500, F.lit(True))
    return s.select("symbol", "granularity", "date", ok.alias("valid"))


@register("enum_domain", sql_with(["raw_docs"], f"""
select chat_id, coalesce(type in ('private', 'bot', 'group', 'supergroup', 'channel'), true)
  and coalesce(granularity in ('1m', '2m', '5m', '15m', '30m', '60m', '90m', '1d'), true) as valid
from (select chat_id, type, case when members_count % 4 = 0 then '4h' else '1m' end as granularity from chat_rows)""",
    extra=CHAT_ROWS_SQL))
def q_enum_domain(spark, sf_dir):
    c = _chat_rows(fixture(spark, sf_dir)).select(
        "chat_id", "type", F.when(F.col("members_count") % 4 == 0, "4h").otherwise("1m").alias("granularity"))
    return c.select("chat_id", normalize.enum_ok(c).alias("valid"))


@register("type_codes", sql_with(["raw_docs"], f"""
select chat_id, message_id, case media_type {' '.join(f"when '{k}' then {v}" for k, v in S.MEDIA_TYPE_CODES.items())}
  end as media_code from flat""", extra=FLAT_SQL))
def q_type_codes(spark, sf_dir):
    m = _flat(fixture(spark, sf_dir))
    return m.select("chat_id", "message_id", S.type_code("media_type", S.MEDIA_TYPE_CODES).alias("media_code"))


@register("chat_type_codes", sql_with(["raw_docs"], f"""
select chat_id, case type {' '.join(f"when '{k}' then {v}" for k, v in S.CHAT_TYPE_CODES.items())} end as type_code
from merged""", extra=CHAT_ROWS_SQL))
def q_chat_type_codes(spark, sf_dir):
    c = normalize.merge_non_null(_chat_rows(fixture(spark, sf_dir)), "chat_id", "_arrival")
    return c.select("chat_id", S.type_code("type", S.CHAT_TYPE_CODES).alias("type_code"))


@register("nest_unnest", sql_with(["raw_docs"], """
select f.chat_id, f.message_id, r.reaction_ids, r.reaction_abs, p.poll_texts from flat f
left join (select chat_id, message_id, list(reaction_id order by reaction_id) as reaction_ids,
  list(reaction_votes_abs order by reaction_id) as reaction_abs from reac group by all) r using (chat_id, message_id)
left join (select chat_id, message_id, list(poll_option_text order by poll_option_id) as poll_texts
  from polls group by all) p using (chat_id, message_id)""",
    extra=POLL_SQL + ",\n" + EMOJI_SQL[len(RITEMS_SQL) + 2:] + ",\n" + FLAT_SQL[len(RITEMS_SQL) + 2:] + """,
reac as (select i.chat_id, i.message_id, e.reaction_id, i.votes_abs as reaction_votes_abs
  from ritems i left join emoji_map e using (reaction))"""))
def q_nest_unnest(spark, sf_dir):
    f = fixture(spark, sf_dir)
    n = normalize.nest(_flat(f), normalize.explode_reactions(f.raw_docs, _emoji_map(spark, f)),
                       normalize.explode_poll(f.raw_docs))
    return n.select("chat_id", "message_id",
                    F.transform("reactions", lambda s: s.getField("id")).alias("reaction_ids"),
                    F.transform("reactions", lambda s: s.getField("abs")).alias("reaction_abs"),
                    F.transform("poll", lambda s: s.getField("text")).alias("poll_texts"))


@register("unnest_roundtrip", sql_with(["raw_docs"], """
select chat_id, message_id, reaction_id, round(reaction_votes_norm + 1e-9, 4) as reaction_votes_norm,
  reaction_votes_abs from reac2""", extra=EMOJI_SQL + """,
reac2 as (select i.chat_id, i.message_id, e.reaction_id,
  case when coalesce(t.total, 0) <> 0 then cast(i.votes_abs as double) / t.total else 0 end as reaction_votes_norm,
  i.votes_abs as reaction_votes_abs from ritems i join rtot t using (chat_id, message_id)
  left join emoji_map e using (reaction))"""))
def q_unnest_roundtrip(spark, sf_dir):
    f = fixture(spark, sf_dir)
    reac = normalize.explode_reactions(f.raw_docs, _emoji_map(spark, f))
    n = normalize.nest(_flat(f), reac, normalize.explode_poll(f.raw_docs))
    u = normalize.unnest_reactions(n)
    return u.withColumn("reaction_votes_norm", S.round4("reaction_votes_norm"))


@register("doc_select", sql_with(["raw_docs"], f"""
select {sx('chat', 'id')} as cid, id as mid, text, caption, forwards from raw_docs
where (text is not null or caption is not null) and reply_to_message_id is null"""))
def q_doc_select(spark, sf_dir):
    return normalize.doc_select(fixture(spark, sf_dir).raw_docs).drop("reactions")


@register("reaction_text", sql_with(["raw_docs"], f"""
select {sx('chat', 'id')} as cid, id as mid,
  '<<TEXT>>' || replace(coalesce(text, caption), chr(10) || chr(10) || 'כדי להגיב לכתבה לחצו כאן', '')
  || '<<REACTIONS>>' || case when {sx('reactions', 'reactions')} is not null then rtrim(list_reduce(list_prepend('', list_transform({sx('reactions', 'reactions')},
     lambda r: {sx('r', 'emoji')} || ':' || cast({sx('r', 'count')} as varchar) || ', ')), lambda a, b: a || b), ', ') end
  || '<<FORWARDS>>' || cast(forwards as varchar) as text
from raw_docs where (text is not null or caption is not null) and reply_to_message_id is null"""))
def q_reaction_text(spark, sf_dir):
    return normalize.reaction_text(normalize.doc_select(fixture(spark, sf_dir).raw_docs))


@register("doc_any_text", sql_with(["raw_docs"], f"""
select {sx('chat', 'id')} as "from", date, coalesce(text, caption, {sx('poll', 'question')}) as text,
  cast(len({sx('poll', 'options')}) as int) as n_responses, cast(len({sx('reactions', 'reactions')}) as int) as n_reactions,
  id as message_id
from raw_docs where text is not null or caption is not null or {sx('poll', 'question')} is not null"""))
def q_doc_any_text(spark, sf_dir):
    d = normalize.doc_any_text(fixture(spark, sf_dir).raw_docs)
    return d.select("from", "date", "text", F.size("responses").alias("n_responses"),
                    F.size("reactions").alias("n_reactions"), "message_id")


LINKS_SQL = """links as (select chat_id as channel_id, linked_chat_id as group_id from merged
  where type = 'channel' and linked_chat_id is not null)"""


def _links(c):
    return (c.filter((F.col("type") == "channel") & F.col("linked_chat_id").isNotNull())
            .select(F.col("chat_id").alias("channel_id"), F.col("linked_chat_id").alias("group_id")))


@register("channel_group_link", sql_with(["raw_docs"], """
select channel_id as chat_id, group_id as linked_id, 'group' as role from links
union all select group_id, channel_id, 'channel' from links""", extra=CHAT_ROWS_SQL + ",\n" + LINKS_SQL))
def q_channel_group_link(spark, sf_dir):
    from ..operators import planning
    c = normalize.merge_non_null(_chat_rows(fixture(spark, sf_dir)), "chat_id", "_arrival")
    return planning.channel_group_link(c)


@register("normalize_chat", sql_with(["raw_docs"], f"""
select m.chat_id, case m.type {' '.join(f"when '{k}' then {v}" for k, v in S.CHAT_TYPE_CODES.items())} end as type,
  m.title, m.username, case when m.is_scam then true else m.is_fake end as is_scam, m.members_count,
  g.channel_id, c.group_id
from merged m left join links g on g.group_id = m.chat_id left join links c on c.channel_id = m.chat_id""",
    extra=CHAT_ROWS_SQL + ",\n" + LINKS_SQL))
def q_normalize_chat(spark, sf_dir):
    c = normalize.merge_non_null(_chat_rows(fixture(spark, sf_dir)), "chat_id", "_arrival")
    return normalize.normalize_chat(c, _links(c))


@register("json_reaction_list", sql_with(["raw_docs"], f"""
select id as message_id, {sx('chat', 'id')} as chat_id,
  list_transform({sx('reactions', 'reactions')}, lambda r: {sx('r', 'emoji')}) as emojis,
  list_transform({sx('reactions', 'reactions')}, lambda r: {sx('r', 'count')}) as counts
from raw_docs where reactions is not null"""))
def q_json_reaction_list(spark, sf_dir):
    r = fixture(spark, sf_dir).raw_docs.filter(F.col("reactions").isNotNull())
    legacy = r.select("id", "chat", F.to_json("reactions.reactions").alias("reactions_text"))
    parsed = legacy.select(F.col("id").alias("message_id"), F.col("chat.id").alias("chat_id"),
                           S.json_reaction_list("reactions_text").alias("l"))
    return parsed.select("message_id", "chat_id", F.transform("l", lambda s: s.getField("emoji")).alias("emojis"),
                         F.transform("l", lambda s: s.getField("count")).alias("counts"))


_FREE_SQL = """free as (select event_id as id, k % 40 as chat, k, event_id % 97 as m, event_id % 101 as x from raw)"""


@register("scan_free_documents", sql_with(["raw"], """
select id, cast(chat as bigint) as chat_id, cast(case when k % 3 > 0 then k end as bigint) as b, case when k % 3 = 0 then 1 else 2 end as n_fields, 'kept' as status
from free where m <> 0 and x <> 0
union all select id, null, null, null, 'rejected' from free where m = 0 or x = 0""", extra=_FREE_SQL))
def q_scan_free_documents(spark, sf_dir):
    """Documents with fields that no schema declares, some too deep, some cut off, stored as VARIANT and read back."""
    r = fixture(spark, sf_dir).raw.select(F.col("event_id").alias("id"), "k")
    deep = F.when(F.col("id") % 97 == 0, 24).otherwise(23)  # lists around a number at level 3 + deep
    inner = F.concat(F.lit('{"name":"say \\"a\\":null,","b":'), F.when(F.col("k") % 3 > 0, F.col("k").cast("string")).otherwise(F.lit("null")), F.lit("}"))
    line = F.concat(F.lit('{"id":'), "id", F.lit(',"gone":null,"chat":{"id":'), F.col("k") % 40, F.lit(',"title":null},"extra":'), inner,
                    F.lit(',"list":[null,{"x":null}],"deep":'), F.repeat(F.lit("["), deep), F.lit("1"), F.repeat(F.lit("]"), deep),
                    F.when(F.col("id") % 101 == 0, F.lit("")).otherwise(F.lit("}")))
    landing, store = scratch_path(spark, "free"), scratch_path(spark, "free-store")
    r.select(line.alias("value")).write.text(landing)
    docs, rejects = readers.read_free_documents(spark, landing)
    docs.write.parquet(store)
    stored_docs = spark.read.schema("doc variant").parquet(store)
    extra = F.variant_get("doc", "$.extra", "map<string,variant>")
    kept = stored_docs.select(F.variant_get("doc", "$.id", "bigint").alias("id"), F.variant_get("doc", "$.chat.id", "bigint").alias("chat_id"),
                              F.variant_get("doc", "$.extra.b", "bigint").alias("b"), F.size(extra).alias("n_fields"), F.lit("kept").alias("status"))
    lost = rejects.select(F.regexp_extract("line", r'^\{"id":(\d+)', 1).cast("bigint").alias("id"), F.lit(None).cast("bigint").alias("chat_id"),
                          F.lit(None).cast("bigint").alias("b"), F.lit(None).cast("int").alias("n_fields"), F.lit("rejected").alias("status"))
    return kept.unionByName(lost)
