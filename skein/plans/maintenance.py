"""Registered table-maintenance queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import tables
from ..session import scratch_path
from ..sources import buckets
from .fixtures import fixture, sql_with
from .registry import register

# A batch of user updates derived from orders: several rows per key (first by
# order key wins), nulls that must not erase, and new keys for pending orders.
UPD_SQL = """upd as (select case when o_orderstatus = 'P' then o_custkey + 100000 else o_custkey end as sender_id,
  case when o_orderstatus = 'F' then null else concat('N', cast(o_orderkey as varchar)) end as first_name,
  case when o_orderpriority like '1%' then o_orderpriority end as last_name, o_orderkey from orders),
u1 as (select * from (select *, row_number() over (partition by sender_id order by o_orderkey) as rn from upd)
  where rn = 1)"""


def _updates(f):
    o = f.table("orders")
    return o.select(
        F.when(F.col("o_orderstatus") == "P", F.col("o_custkey") + 100000).otherwise(F.col("o_custkey"))
         .alias("sender_id"),
        F.when(F.col("o_orderstatus") == "F", F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("N"), F.col("o_orderkey").cast("string"))).alias("first_name"),
        F.when(F.col("o_orderpriority").startswith("1"), F.col("o_orderpriority")).alias("last_name"),
        "o_orderkey")


@register("upsert_coalesce", sql_with(["users"], """
select coalesce(o.sender_id, n.sender_id) as sender_id, coalesce(n.first_name, o.first_name) as first_name,
  coalesce(n.last_name, o.last_name) as last_name, o.phone_number
from users o full join u1 n on o.sender_id = n.sender_id""", extra=UPD_SQL))
def q_upsert_coalesce(spark, sf_dir):
    f = fixture(spark, sf_dir)
    return tables.upsert_coalesce(f.users, _updates(f), ["sender_id"], order=["o_orderkey"])


STORE_BUCKETS = 16


@register("upsert_bucketed", sql_with(["users"], """
select coalesce(o.sender_id, n.sender_id) as sender_id, coalesce(n.first_name, o.first_name) as first_name,
  coalesce(case when o.sender_id % 97 = 0 then 'second' end, n.last_name, o.last_name) as last_name, o.phone_number
from users o full join u1 n on o.sender_id = n.sender_id""", extra=UPD_SQL))
def q_upsert_bucketed(spark, sf_dir):
    """D01 on a stored table: two merges that rewrite just the buckets they touch."""
    f = fixture(spark, sf_dir)
    root, schema = scratch_path(spark, "users-store"), "sender_id long, first_name string, last_name string, phone_number string"
    buckets.create_store(f.users.select("sender_id", "first_name", "last_name", "phone_number"), root, ["sender_id"], STORE_BUCKETS)
    updates = tables.dedupe_first_by_key(_updates(f), ["sender_id"], ["o_orderkey"]).drop("o_orderkey")
    buckets.merge_store(updates, root, schema, ["sender_id"], STORE_BUCKETS)
    few = f.users.filter("sender_id % 97 = 0").select("sender_id", F.lit("second").alias("last_name"))
    buckets.merge_store(few, root, schema, ["sender_id"], STORE_BUCKETS)
    return buckets.read_store(spark, root, schema)


@register("dedupe_first_by_key", sql_with([], "select sender_id, first_name, last_name, o_orderkey from u1",
                                          extra=UPD_SQL))
def q_dedupe_first_by_key(spark, sf_dir):
    f = fixture(spark, sf_dir)
    return tables.dedupe_first_by_key(_updates(f), ["sender_id"], ["o_orderkey"])


@register("upsert_overwrite", sql_with(["users"], """
select coalesce(o.sender_id, n.sender_id) as sender_id,
  case when n.sender_id is not null then n.first_name else o.first_name end as first_name,
  case when n.sender_id is not null then n.last_name else o.last_name end as last_name, o.phone_number
from users o full join u1 n on o.sender_id = n.sender_id""", extra=UPD_SQL))
def q_upsert_overwrite(spark, sf_dir):
    f = fixture(spark, sf_dir)
    u = tables.dedupe_first_by_key(_updates(f), ["sender_id"], ["o_orderkey"]).drop("o_orderkey")
    return tables.upsert_overwrite(f.users, u, ["sender_id"], "*")


# Bars merge: old = 1m bars, new = 2m bars relabelled as 1m one hour earlier
# (so they collide with the 1m bars of the same part and day).
BARS_SQL = """old as (select symbol, granularity, date, max(open) as open, max(close) as close, max(volume) as volume
  from stocks group by all),
new as (select symbol, granularity, date - interval 1 hour as date, max(open) as open, max(close) as close,
  max(volume) as volume from stocks group by all)"""


def _bars_old_new(f):
    s = f.stocks
    k = ["symbol", "granularity", "date"]
    agg = [F.max("open").alias("open"), F.max("close").alias("close"), F.max("volume").alias("volume")]
    old = s.groupBy(*k).agg(*agg)
    new = (s.select("symbol", "granularity", (F.col("date") - F.expr("INTERVAL 1 HOUR")).alias("date"),
                   "open", "close", "volume").groupBy(*k).agg(*agg))
    return old, new


@register("combine_first", sql_with(["stocks"], """
select coalesce(o.symbol, n.symbol) as symbol, coalesce(o.granularity, n.granularity) as granularity,
  coalesce(o.date, n.date) as date, coalesce(o.open, n.open) as open, coalesce(o.close, n.close) as close,
  coalesce(o.volume, n.volume) as volume
from old o full join new n on o.symbol = n.symbol and o.granularity = n.granularity and o.date = n.date""",
    extra=BARS_SQL))
def q_combine_first(spark, sf_dir):
    old, new = _bars_old_new(fixture(spark, sf_dir))
    return tables.combine_first(old, new, ["symbol", "granularity", "date"])


@register("upsert_bars", sql_with(["stocks"], """
select coalesce(o.symbol, n.symbol) as symbol, coalesce(o.granularity, n.granularity) as granularity,
  coalesce(o.date, n.date) as date, coalesce(n.open, o.open) as open, coalesce(n.close, o.close) as close,
  coalesce(n.volume, o.volume) as volume
from old o full join new n on o.symbol = n.symbol and o.granularity = n.granularity and o.date = n.date""",
    extra=BARS_SQL))
def q_upsert_bars(spark, sf_dir):
    old, new = _bars_old_new(fixture(spark, sf_dir))
    return tables.upsert_coalesce(old, new, ["symbol", "granularity", "date"])


@register("delete_range", sql_with(["messages"], """
select chat_id, message_id, sender_id, reply_to_message_id from messages
where not coalesce(chat_id = 5 and message_id >= 20 and message_id <= 120, false)"""))
def q_delete_range(spark, sf_dir):
    m = fixture(spark, sf_dir).messages.select("chat_id", "message_id", "sender_id", "reply_to_message_id")
    return tables.delete_range(m, 5, 20, 120)


@register("delete_channel", sql_with(["messages"], """
select chat_id, message_id, sender_id from messages where not coalesce(chat_id = 7, false)"""))
def q_delete_channel(spark, sf_dir):
    m = fixture(spark, sf_dir).messages.select("chat_id", "message_id", "sender_id")
    return tables.delete_channel(m, 7)


def _store(f) -> dict:
    return {"messages": f.messages, "reactions": f.reactions, "polls": f.polls, "chats": f.chats}


def _left(store: dict):
    """Rows left per table, chat and (for message tables) message."""
    parts = [df.select(F.lit(name).alias("kept_in"), "chat_id",
                       (F.col("message_id") if "message_id" in df.columns else F.lit(None).cast("bigint")).alias("message_id"))
             for name, df in store.items()]
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


def _left_sql(message_rule: str, chat_rule: str) -> str:
    return f"""
select 'messages' as kept_in, chat_id, message_id from messages where not ({message_rule})
union all select 'reactions', chat_id, message_id from reactions where not ({message_rule})
union all select 'polls', chat_id, message_id from polls where not ({message_rule})
union all select 'chats', chat_id, cast(null as bigint) from chats where not ({chat_rule})"""


POLLS_SQL = "polls as (select chat_id, message_id, event_type as poll_option_text, cast(floor(value) as int) as votes_abs from raw)"


@register("delete_range_everywhere", sql_with(["messages", "reactions", "chats", "raw"],
                                              _left_sql("chat_id = 5 and message_id > 20 and message_id <= 120", "false"), extra=POLLS_SQL))
def q_delete_range_everywhere(spark, sf_dir):
    """The `(min, max]` form over all message tables."""
    return _left(tables.delete_range_everywhere(_store(fixture(spark, sf_dir)), 5, 20, 120, inclusive_low=False))


@register("delete_channel_everywhere", sql_with(["messages", "reactions", "chats", "raw"], _left_sql("chat_id = 7", "chat_id = 7"),
                                                extra=POLLS_SQL))
def q_delete_channel_everywhere(spark, sf_dir):
    """A chat removed from every table."""
    return _left(tables.delete_channel_everywhere(_store(fixture(spark, sf_dir)), 7))


@register("advance_watermark", sql_with(["messages", "chats"], """
select coalesce(c.chat_id, t.chat_id) as chat_id, c.title, c.linked_chat_id,
  case when t.chat_id is not null then t.top_message_id else c.top_message_id end as top_message_id
from chats c full join (select chat_id, max(message_id) as top_message_id from messages group by chat_id) t
  on c.chat_id = t.chat_id"""))
def q_advance_watermark(spark, sf_dir):
    f = fixture(spark, sf_dir)
    return tables.advance_top_message(f.chats, f.messages)


@register("top_message_check", sql_with(["messages", "chats"], """
select m.chat_id, min(m.message_id) as first_violation, count(*) as n_violations
from messages m join chats c on c.chat_id = m.chat_id
where c.top_message_id is not null and m.message_id > c.top_message_id group by m.chat_id"""))
def q_top_message_check(spark, sf_dir):
    f = fixture(spark, sf_dir)
    return tables.top_message_violations(f.chats, f.messages)


@register("set_flag", sql_with(["messages", "chats"], """
select c.chat_id, c.title, c.linked_chat_id, c.top_message_id,
  case when f.chat_id is not null then true else null end as ongoing_write
from chats c left join (select distinct chat_id from messages where date > timestamp '2024-01-29') f using (chat_id)"""))
def q_set_flag(spark, sf_dir):
    f = fixture(spark, sf_dir)
    flags = (f.messages.filter(F.col("date") > F.lit("2024-01-29").cast("timestamp_ntz"))
             .select("chat_id").distinct().withColumn("ongoing_write", F.lit(True)))
    return tables.set_flag(f.chats, flags, "ongoing_write")


DICT_SQL = """vals as (select event_type as reaction, ts from raw union all select cast(k as varchar), ts from raw),
m0 as (select cast(row_number() over (order by reaction) as int) as reaction_id, reaction,
  regexp_full_match(reaction, '-?[0-9]+') as is_custom
  from (select distinct reaction from vals where ts < timestamp '2024-01-10')),
newv as (select distinct reaction from vals where reaction not in (select reaction from m0))"""


def _dict_values(f):
    r = f.raw
    return (r.select(F.col("event_type").alias("reaction"), "ts")
            .unionByName(r.select(F.col("k").cast("string").alias("reaction"), "ts")))


@register("dictionary_encode", sql_with(["raw"], """
select * from m0 union all
select cast((select max(reaction_id) from m0) + row_number() over (order by reaction) as int), reaction,
  regexp_full_match(reaction, '-?[0-9]+') from newv""", extra=DICT_SQL))
def q_dictionary_encode(spark, sf_dir):
    f = fixture(spark, sf_dir)
    vals = _dict_values(f)
    early = vals.filter(F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz"))
    empty = spark.createDataFrame([], "reaction_id int, reaction string, is_custom boolean")
    m0 = tables.dictionary_encode(early, "reaction", empty)
    return tables.dictionary_encode(vals, "reaction", m0)


LOG_SQL = """log as (select event_type as project, concat('u', cast(user_id % 7 as varchar)) as key,
  cast(value as varchar) as value, event_id as seq, case when k % 10 = 0 then 'unset' else 'set' end as op from raw)"""


def _settings_log(f):
    r = f.raw
    return r.select(F.col("event_type").alias("project"),
                    F.concat(F.lit("u"), (F.col("user_id") % 7).cast("string")).alias("key"),
                    F.col("value").cast("string").alias("value"), F.col("event_id").alias("seq"),
                    F.when(F.col("k") % 10 == 0, "unset").otherwise("set").alias("op"))


@register("latest_setting", sql_with(["raw"], """
select project, key, l.value as value, l.seq as last_updated from (
  select project, key, arg_max({'op': op, 'value': value, 'seq': seq}, seq) as l from log group by all)
where l.op <> 'unset'""", extra=LOG_SQL))
def q_latest_setting(spark, sf_dir):
    return tables.latest_setting(_settings_log(fixture(spark, sf_dir)))


@register("setting_or_default", sql_with(["raw"], """
select q.project, q.key, coalesce(case when s.op <> 'unset' then s.value end, 'default') as value
from (select distinct event_type as project, concat('u', cast(user_id % 9 as varchar)) as key from raw) q
left join (select project, key, arg_max(op, seq) as op, arg_max(value, seq) as value from log group by all) s using (project, key)""",
    extra=LOG_SQL))
def q_setting_or_default(spark, sf_dir):
    """D10 get: set, unset and unknown keys read with a default."""
    f = fixture(spark, sf_dir)
    wanted = f.raw.select(F.col("event_type").alias("project"),
                          F.concat(F.lit("u"), (F.col("user_id") % 9).cast("string")).alias("key")).distinct()
    return tables.get_setting(tables.latest_setting(_settings_log(f)), wanted, "default").select("project", "key", "value")


LINK_SQL = """lc as (select *, case when chat_id % 3 = 0 then null when chat_id % 3 = 1 then ''
  else concat('https://t.me/+', cast(chat_id as varchar)) end as invite_link from chats),
links as (select chat_id, case when chat_id % 4 = 0 then null else concat('L', cast(chat_id as varchar)) end
  as invite_link from chats)"""


def _link_chats(f):
    c = f.chats
    m3 = F.col("chat_id") % 3
    lc = c.withColumn("invite_link", F.when(m3 == 0, F.lit(None).cast("string")).when(m3 == 1, F.lit(""))
                      .otherwise(F.concat(F.lit("https://t.me/+"), F.col("chat_id").cast("string"))))
    links = c.select("chat_id", F.when(F.col("chat_id") % 4 == 0, F.lit(None).cast("string"))
                     .otherwise(F.concat(F.lit("L"), F.col("chat_id").cast("string"))).alias("invite_link"))
    return lc, links


@register("fill_invite_links", sql_with(["messages", "chats"], """
select lc.chat_id, lc.title, lc.linked_chat_id, lc.top_message_id,
  case when lc.invite_link is null then coalesce(l.invite_link, '') else lc.invite_link end as invite_link
from lc left join links l using (chat_id)""", extra=LINK_SQL))
def q_fill_invite_links(spark, sf_dir):
    lc, links = _link_chats(fixture(spark, sf_dir))
    return tables.fill_invite_links(lc, links)


@register("committed_dialogs", sql_with(["messages", "chats"], """
select chat_id, title, top_message_id, cast(null as varchar) as username, invite_link from lc""", extra=LINK_SQL))
def q_committed_dialogs(spark, sf_dir):
    lc, _ = _link_chats(fixture(spark, sf_dir))
    return tables.committed_dialogs(lc)


CONFIGURED = ["BTC-USD", "Brand#4", "^TA125.TA"]


@register("distinct_symbols_union", sql_with(["stocks"], """
select symbol from stocks union select * from (values ('BTC-USD'), ('Brand#4'), ('^TA125.TA')) v(symbol)"""))
def q_distinct_symbols_union(spark, sf_dir):
    f = fixture(spark, sf_dir)
    conf = spark.createDataFrame([(s,) for s in CONFIGURED], "symbol string")
    return tables.distinct_union(f.stocks, "symbol", conf)


@register("distinct_chats", sql_with(["reactions"], "select distinct chat_id from reactions"))
def q_distinct_chats(spark, sf_dir):
    return fixture(spark, sf_dir).reactions.select("chat_id").distinct()


@register("dedupe_rows", sql_with(["stocks"], "select distinct symbol, granularity, date, open, close, volume from stocks"))
def q_dedupe_rows(spark, sf_dir):
    return tables.dedupe_rows(fixture(spark, sf_dir).stocks)
