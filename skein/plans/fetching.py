"""Registered ingestion-planning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import round4
from ..operators import planning, tables
from .fixtures import fixture, sql_with
from .registry import register

NOW = "2024-01-31 00:00:00"
DIALOGS_SQL = """dialogs as (select c.chat_id, case c.chat_id % 3 when 0 then 'channel' when 1 then 'supergroup'
  else 'group' end as type, c.chat_id % 9 = 0 as is_restricted,
  case when c.chat_id % 13 <> 0 then t.top end as top_message_id, c.title
  from chats c join (select chat_id, max(message_id) as top from messages group by chat_id) t using (chat_id)),
offsets as (select m.chat_id, min(m.message_id) as "offset" from messages m join chats c using (chat_id)
  where c.top_message_id is null or m.message_id > c.top_message_id group by m.chat_id),
lefts as (select d.chat_id, d.type, coalesce(c.top_message_id, -1) as committed,
  coalesce(o."offset", d.top_message_id) as available,
  coalesce(o."offset", d.top_message_id) - coalesce(c.top_message_id, -1) as leftovers,
  o."offset" is not null as has_offset
  from dialogs d left join chats c using (chat_id) left join offsets o using (chat_id))"""


def _dialogs(f):
    c, m = f.chats, f.messages
    tops = m.groupBy("chat_id").agg(F.max("message_id").alias("_top"))
    cid = F.col("chat_id")
    return c.join(tops, "chat_id").select(
        "chat_id", F.when(cid % 3 == 0, "channel").when(cid % 3 == 1, "supergroup").otherwise("group").alias("type"),
        (cid % 9 == 0).alias("is_restricted"), F.when(cid % 13 != 0, F.col("_top")).alias("top_message_id"), "title")


def _leftovers(f):
    return planning.leftovers(_dialogs(f), f.chats, planning.resume_offsets(f.chats, f.messages))


@register("eligible_dialogs", sql_with(["messages", "chats"], """
select chat_id, type from dialogs where top_message_id is not null and not coalesce(is_restricted, false)
  and (type = 'channel' or chat_id in (4, 8) or type in ('group', 'supergroup'))""", extra=DIALOGS_SQL))
def q_eligible_dialogs(spark, sf_dir):
    f = fixture(spark, sf_dir)
    full = f.chats.select("chat_id").filter(F.col("chat_id").isin(4, 8))
    return planning.eligible_dialogs(_dialogs(f), full, fetch_groups=True).select("chat_id", "type")


@register("eligible_channels", sql_with(["messages", "chats"], """
select chat_id, type from dialogs where top_message_id is not null and not coalesce(is_restricted, false)
  and (type = 'channel' or chat_id in (4, 8))""", extra=DIALOGS_SQL))
def q_eligible_channels(spark, sf_dir):
    f = fixture(spark, sf_dir)
    full = f.chats.select("chat_id").filter(F.col("chat_id").isin(4, 8))
    return planning.eligible_dialogs(_dialogs(f), full, fetch_groups=False).select("chat_id", "type")


@register("correlated_min", sql_with(["messages", "chats"], 'select chat_id, "offset" from offsets', extra=DIALOGS_SQL))
def q_correlated_min(spark, sf_dir):
    f = fixture(spark, sf_dir)
    return planning.resume_offsets(f.chats, f.messages)


@register("leftovers", sql_with(["messages", "chats"], "select * from lefts where leftovers > 0", extra=DIALOGS_SQL))
def q_leftovers(spark, sf_dir):
    return planning.pending(_leftovers(fixture(spark, sf_dir)))


@register("worklist_order", sql_with(["messages", "chats"], """
select chat_id, leftovers, row_number() over (order by has_offset desc, leftovers asc nulls last, chat_id asc)
  as position
from lefts""", extra=DIALOGS_SQL))
def q_worklist_order(spark, sf_dir):
    ordered = planning.worklist_order(_leftovers(fixture(spark, sf_dir)))
    return tables.dense_index(ordered, planning.worklist_keys(), name="position").select(
        "chat_id", "leftovers", "position")


@register("fetch_window", sql_with(["messages", "chats"], f"""
select m.chat_id, m.message_id, m.date from messages m join lefts l using (chat_id)
where m.message_id > l.committed and m.message_id <= l.available
  and m.date >= case when l.type in ('group', 'supergroup') and l.chat_id not in (4)
    then timestamp '{NOW}' - interval 14 day else timestamp '1970-01-01' end""", extra=DIALOGS_SQL))
def q_fetch_window(spark, sf_dir):
    import datetime as dt
    f = fixture(spark, sf_dir)
    w = planning.fetch_window(f.messages, _leftovers(f), NOW, full_ids=[4], group_lookback=dt.timedelta(days=14))
    return w.select("chat_id", "message_id", "date")


@register("refresh_window", sql_with(["messages", "chats"], f"""
select m.chat_id, m.message_id, m.views from messages m
join (select chat_id, max(message_id) as top_message_id from messages group by chat_id) c using (chat_id)
where c.top_message_id is not null and m.date >= timestamp '{NOW}' - interval 7 day - interval 30 hour
  and m.date < timestamp '{NOW}' - interval 7 day and m.message_id <= c.top_message_id"""))
def q_refresh_window(spark, sf_dir):
    f = fixture(spark, sf_dir)
    committed = tables.advance_top_message(f.chats, f.messages)
    return planning.refresh_window(f.messages, committed, NOW).select("chat_id", "message_id", "views")


@register("fetch_progress", sql_with(["messages", "chats"], """
select total_left, saved, round(rate + 1e-9, 4) as rate, round(remaining_seconds + 1e-9, 4) as remaining_seconds
from (select cast(sum(leftovers) as bigint) as total_left,
  (select count(*) from messages where date >= timestamp '2024-01-30') as saved from lefts),
  lateral (select cast(saved as double) / 3600.0 as rate),
  lateral (select case when rate <> 0 then cast(total_left - saved as double) / rate end as remaining_seconds)""",
    extra=DIALOGS_SQL))
def q_fetch_progress(spark, sf_dir):
    f = fixture(spark, sf_dir)
    saved = (f.messages.filter(F.col("date") >= F.lit("2024-01-30").cast("timestamp_ntz"))
             .groupBy("chat_id").agg(F.count(F.lit(1)).alias("saved")))
    p = planning.fetch_progress(_leftovers(f), saved, 3600.0)
    return p.select("total_left", "saved", round4("rate").alias("rate"),
                    round4("remaining_seconds").alias("remaining_seconds"))


@register("dialog_message_sum", sql_with(["messages", "chats"], "select cast(sum(top_message_id) as bigint) as message_upper_bound "
                                         "from dialogs", extra=DIALOGS_SQL))
def q_dialog_message_sum(spark, sf_dir):
    return planning.dialog_message_sum(_dialogs(fixture(spark, sf_dir)))


@register("kicked_chats", sql_with(["messages", "chats"], """
select c.chat_id, coalesce(c.title, 'UNKNOWN TITLE') as title from chats c
where c.chat_id not in (select chat_id from dialogs where top_message_id is not null)""", extra=DIALOGS_SQL))
def q_kicked_chats(spark, sf_dir):
    f = fixture(spark, sf_dir)
    current = _dialogs(f).filter(F.col("top_message_id").isNotNull())
    return planning.kicked_chats(f.chats, current)


@register("restrict_to_set", sql_with(["messages", "chats"], """
select chat_id, type from dialogs where chat_id in (select chat_id from messages where date >= timestamp '2024-01-30'
  and sender_id % 10 = 3)""", extra=DIALOGS_SQL))
def q_restrict_to_set(spark, sf_dir):
    f = fixture(spark, sf_dir)
    backup = f.messages.filter((F.col("date") >= F.lit("2024-01-30").cast("timestamp_ntz"))
                               & (F.col("sender_id") % 10 == 3))
    return planning.restrict_to_set(_dialogs(f), backup).select("chat_id", "type")


@register("duplicate_keys", sql_with(["messages"], """
select chat_id, sender_id, count(*) as n from messages group by all having count(*) > 1"""))
def q_duplicate_keys(spark, sf_dir):
    """Keys that are not unique."""
    return planning.duplicate_keys(fixture(spark, sf_dir).messages, ["chat_id", "sender_id"])


@register("max_id_left_title", sql_with(["messages", "chats"], """
select m.chat_id, max(m.message_id) as max_message_id, c.title from messages m left join chats c using (chat_id)
group by m.chat_id, c.title"""))
def q_max_id_left_title(spark, sf_dir):
    f = fixture(spark, sf_dir)
    return planning.max_id_with_title(f.messages, f.chats)


@register("top_channels", sql_with(["messages", "chats"], """
select chat_id, title, top_message_id, row_number() over (order by top_message_id desc nulls last, chat_id)
  as position from chats"""))
def q_top_channels(spark, sf_dir):
    t = planning.top_channels(fixture(spark, sf_dir).chats)
    return tables.dense_index(t, [F.col("top_message_id").desc_nulls_last(), F.col("chat_id")], name="position")


RECON_SQL = DIALOGS_SQL + """,
stored as (select chat_id, case when chat_id % 5 = 2 then null else title end as title,
  case when chat_id % 4 = 0 then concat('chat', cast(chat_id as varchar)) end as username,
  case when chat_id % 6 = 1 then concat('https://t.me/+', cast(chat_id as varchar)) end as invite_link from chats),
joined as (select chat_id from dialogs where type = 'channel'),
extra as (select chat_id, concat('enc ', cast(chat_id as varchar)) as title from chats where chat_id % 7 = 3
  union all select chat_id + 1000, concat('enc ', cast(chat_id + 1000 as varchar)) from chats where chat_id % 10 = 0),
linked as (select distinct c.linked_chat_id as chat_id from chats c join joined j using (chat_id)
  where c.linked_chat_id is not null),
u as (select coalesce(s.chat_id, j.chat_id, e.chat_id, l.chat_id) as chat_id, s.chat_id is not null as st,
  j.chat_id is not null as jn, e.title as et, l.chat_id is not null as lk, s.title, s.username, s.invite_link
  from stored s full join joined j on s.chat_id = j.chat_id
  full join extra e on e.chat_id = coalesce(s.chat_id, j.chat_id)
  full join linked l on l.chat_id = coalesce(s.chat_id, j.chat_id, e.chat_id)),
recon as (select chat_id,
  case when jn then null
       when st and (coalesce(username, '') <> '' or coalesce(invite_link, '') <> '') then 'invite'
       when lk then 'invite'
       when et is not null or (st and coalesce(title, '') <> '') then 'title'
       when st then 'nothing' end as status,
  case when st and (coalesce(username, '') <> '' or coalesce(invite_link, '') <> '')
         then coalesce(case when coalesce(username, '') <> '' then username end,
                       case when coalesce(invite_link, '') <> '' then invite_link end)
       when lk then cast(chat_id as varchar) end as invite,
  coalesce(et, title) as title from u)"""


def _recon_inputs(f):
    c = f.chats
    cid = F.col("chat_id")
    stored = c.select("chat_id", F.when(cid % 5 == 2, F.lit(None).cast("string")).otherwise(F.col("title")).alias("title"),
                      F.when(cid % 4 == 0, F.concat(F.lit("chat"), cid.cast("string"))).alias("username"),
                      F.when(cid % 6 == 1, F.concat(F.lit("https://t.me/+"), cid.cast("string"))).alias("invite_link"))
    joined = _dialogs(f).filter(F.col("type") == "channel").select("chat_id")
    extra = (c.filter(cid % 7 == 3).select("chat_id")
             .unionByName(c.filter(cid % 10 == 0).select((cid + 1000).alias("chat_id"))))
    extra = extra.select("chat_id", F.concat(F.lit("enc "), cid.cast("string")).alias("title"))
    linked = (c.join(joined, "chat_id").filter(F.col("linked_chat_id").isNotNull())
              .select(F.col("linked_chat_id").alias("chat_id")).distinct())
    return stored, joined, extra, linked


@register("reconcile_dialogs", sql_with(["messages", "chats"], "select * from recon where status is not null",
                                        extra=RECON_SQL))
def q_reconcile_dialogs(spark, sf_dir):
    return planning.reconcile_dialogs(*_recon_inputs(fixture(spark, sf_dir)))


@register("join_candidates", sql_with(["messages", "chats"], """
select chat_id, coalesce(invite, cast(chat_id as varchar)) as invite from recon where status = 'invite'""",
    extra=RECON_SQL))
def q_join_candidates(spark, sf_dir):
    return planning.join_candidates(planning.reconcile_dialogs(*_recon_inputs(fixture(spark, sf_dir))))


@register("refresh_gate", sql_with(["messages", "chats"], f"""
select project, cast(l.value as timestamp) as last_run,
  l.value is null or cast(l.value as timestamp) < timestamp '{NOW}' - interval 1 day as due
from (select event_type as project, arg_max(cast(ts as varchar), event_id) as value from events group by event_type) l"""))
def q_refresh_gate(spark, sf_dir):
    """I04 gate, for a project per event type: a refresh runs only if the last recorded run is more
    than a day old."""
    ev = fixture(spark, sf_dir).table("events")
    log = ev.select(F.col("event_type").alias("project"), F.lit("last_run").alias("key"), F.col("ts").cast("string").alias("value"),
                    F.col("event_id").alias("seq"), F.lit("set").alias("op"))
    return planning.refresh_due(tables.latest_setting(log), NOW)


@register("refresh_upsert", sql_with(["messages", "chats"], f"""
select m.chat_id, m.message_id, m.text, case when m.date >= timestamp '{NOW}' - interval 7 day - interval 30 hour
  and m.date < timestamp '{NOW}' - interval 7 day and m.message_id % 4 <> 0 then m.views + 100 else m.views end as views,
  '{NOW}' as last_run from messages m"""))
def q_refresh_upsert(spark, sf_dir):
    """I04 end to end: window, upsert of the fetched views (null: unchanged), then the setting."""
    f = fixture(spark, sf_dir)
    committed = tables.advance_top_message(f.chats, f.messages)
    fetched = f.messages.select("chat_id", "message_id", F.when(F.col("message_id") % 4 != 0, F.col("views") + 100).alias("views"))
    none = spark.createDataFrame([], "project string, key string, value string")
    now, settings = planning.refresh(f.messages, committed, fetched, none, NOW)
    run = settings.select(F.max("value")).scalar()
    return now.select("chat_id", "message_id", "text", "views", run.alias("last_run"))
