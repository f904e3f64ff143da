"""Registered thread queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import threads
from .fixtures import fixture, sql_with
from .registry import register

WALK = """t(chat_id, start_id, cur, reply_to_message_id, msg_chain) as (
  select chat_id, message_id, message_id, reply_to_message_id, [message_id] from messages
  union all
  select m.chat_id, t.start_id, m.message_id, m.reply_to_message_id, list_append(t.msg_chain, m.message_id)
  from messages m join t on m.chat_id = t.chat_id and m.message_id = t.reply_to_message_id)"""


@register("chain_steps", sql_with(["messages"], """
select chat_id, cur as message_id, reply_to_message_id, msg_chain from t""", extra=WALK, recursive=True))
def q_chain_steps(spark, sf_dir):
    return threads.chain_steps(fixture(spark, sf_dir).messages)


@register("chain_steps_by_start", sql_with(["messages"], """
select chat_id, start_id as message_id, reply_to_message_id, msg_chain from t""", extra=WALK, recursive=True))
def q_chain_steps_by_start(spark, sf_dir):
    return threads.chain_steps_by_start(fixture(spark, sf_dir).messages)


ROOTS = "roots as (select chat_id, cur as first_msg_id, start_id as last_msg_id, msg_chain from t " \
        "where reply_to_message_id is null)"


@register("chains_to_root", sql_with(["messages"], "select * from roots", extra=WALK + ",\n" + ROOTS,
                                     recursive=True))
def q_chains_to_root(spark, sf_dir):
    return threads.chains_to_root(fixture(spark, sf_dir).messages)


@register("chains_text", sql_with(["messages"], """
select r.chat_id, r.last_msg_id, r.msg_chain, g.text_chain from roots r join (
  select chat_id, last_msg_id, list(text order by pos) as text_chain from (
    select x.chat_id, x.last_msg_id, x.pos, m.text from (
      select chat_id, last_msg_id, unnest(msg_chain) as mid, generate_subscripts(msg_chain, 1) as pos from roots) x
    left join messages m on m.chat_id = x.chat_id and m.message_id = x.mid)
  group by chat_id, last_msg_id) g on g.chat_id = r.chat_id and g.last_msg_id = r.last_msg_id""",
    extra=WALK + ",\n" + ROOTS, recursive=True))
def q_chains_text(spark, sf_dir):
    f = fixture(spark, sf_dir)
    return threads.chains_text(f.placed, f.read)


@register("maximal_chains", sql_with(["messages"], """
select r.chat_id, r.first_msg_id as root_id, r.last_msg_id as leaf_id, list_reverse(r.msg_chain) as msg_chain
from roots r left join messages c on c.chat_id = r.chat_id and c.reply_to_message_id = r.last_msg_id
where c.message_id is null""", extra=WALK + ",\n" + ROOTS, recursive=True))
def q_maximal_chains(spark, sf_dir):
    return threads.maximal_chains(fixture(spark, sf_dir).messages)


@register("anti_prefix_rows", sql_with(["messages"], """
select r.chat_id, r.first_msg_id, r.last_msg_id, cast(len(r.msg_chain) as int) as chain_len from roots r
where not exists (select 1 from messages c where c.chat_id = r.chat_id and c.reply_to_message_id = r.last_msg_id)""",
    extra=WALK + ",\n" + ROOTS, recursive=True))
def q_anti_prefix_rows(spark, sf_dir):
    f = fixture(spark, sf_dir)
    c = threads.anti_prefix_rows(threads.chains_to_root(f.messages), f.messages)
    return c.select("chat_id", "first_msg_id", "last_msg_id", F.size("msg_chain").alias("chain_len"))


@register("leaf_flags", sql_with(["messages"], """
select m.chat_id, m.message_id, not exists (select 1 from messages c where c.chat_id = m.chat_id
  and c.reply_to_message_id = m.message_id) as leaf from messages m"""))
def q_leaf_flags(spark, sf_dir):
    return threads.leaf_flags(fixture(spark, sf_dir).messages)


@register("linked_sender", sql_with(["messages", "chats"], """
select m.chat_id, m.message_id, m.sender_id, coalesce(m.sender_id = c.linked_chat_id, false) as sent_by_linked_chat
from messages m left join chats c using (chat_id)"""))
def q_linked_sender(spark, sf_dir):
    f = fixture(spark, sf_dir)
    return threads.linked_sender(f.messages, f.chats).select("chat_id", "message_id", "sender_id",
                                                             "sent_by_linked_chat")


def chain_sql(source: str = "messages", tag: str = "") -> str:
    """Walks up from the leaves of `source` with the text joined on the way."""
    return f"""lm{tag} as (select m.*, coalesce(m.sender_id = c.linked_chat_id, false) as f
  from {source} m left join chats c using (chat_id)),
lv{tag} as (select * from lm{tag} l where not exists (select 1 from lm{tag} c where c.chat_id = l.chat_id
  and c.reply_to_message_id = l.message_id)),
w{tag}(chat_id, leaf, cur, parent, chain, n, flag) as (
  select chat_id, message_id, message_id, reply_to_message_id, text, 1, f from lv{tag}
  union all
  select w.chat_id, w.leaf, p.message_id, p.reply_to_message_id, w.chain || '<<NEXTMSG>>' || p.text, w.n + 1,
    w.flag or p.f
  from w{tag} w join lm{tag} p on p.chat_id = w.chat_id and p.message_id = w.parent)"""


CHAIN_SQL = chain_sql()


@register("message_chain", sql_with(["messages", "chats"], """
select chat_id, flag as sent_by_linked_chat, cur as first_message_id, leaf as last_message_id, chain, n as chain_len
from w where not exists (select 1 from lm p where p.chat_id = w.chat_id and p.message_id = w.parent)""",
    extra=CHAIN_SQL, recursive=True))
def q_message_chain(spark, sf_dir):
    f = fixture(spark, sf_dir)
    return threads.message_chain(f.placed, f.chats, read=f.read)


THREAD_START, THREAD_END = "2024-01-08 00:00:00", "2024-01-22 12:00:00"
#: The ancestor relation inside the window, closed once; then roots, leaves and texts as rules on it.
THREADS_SQL = f"""wm as materialized (select * from messages where date between timestamp '{THREAD_START}' and timestamp '{THREAD_END}'),
anc(chat_id, low, high, up) as (
  select chat_id, message_id, message_id, 0 from wm
  union all
  select a.chat_id, a.low, m.reply_to_message_id, a.up + 1 from anc a
  join wm m on m.chat_id = a.chat_id and m.message_id = a.high
  where exists (select 1 from wm p where p.chat_id = m.chat_id and p.message_id = m.reply_to_message_id)),
rooted as (select a.chat_id, a.low from anc a join wm r on r.chat_id = a.chat_id and r.message_id = a.high
  where r.reply_to_message_id is null),
whole as (select * from rooted x where not exists (select 1 from wm c join rooted y on y.chat_id = c.chat_id and y.low = c.message_id
  where c.chat_id = x.chat_id and c.reply_to_message_id = x.low)),
threads as (select x.chat_id, x.low, list(a.high order by a.up desc) as ids, list(m.sender_id order by a.up desc) as senders,
    list(m.text order by a.up desc) as texts
  from whole x join anc a on a.chat_id = x.chat_id and a.low = x.low join wm m on m.chat_id = a.chat_id and m.message_id = a.high
  group by x.chat_id, x.low)"""


@register("message_threads", sql_with(["messages"], """
select chat_id, ids as msg_id_chain, senders as sender_id_chain, texts as text_chain from threads""",
    extra=THREADS_SQL, recursive=True))
def q_message_threads(spark, sf_dir):
    f = fixture(spark, sf_dir)
    return threads.message_threads(f.placed, THREAD_START, THREAD_END, read=f.read)


@register("anti_prefix_threads", sql_with(["messages"], """
select chat_id, low as last_msg_id, cast(len(ids) as int) as chain_len from threads""", extra=THREADS_SQL, recursive=True))
def q_anti_prefix_threads(spark, sf_dir):
    t = threads.message_threads(fixture(spark, sf_dir).messages, THREAD_START, THREAD_END)
    return t.select("chat_id", F.element_at("msg_id_chain", -1).alias("last_msg_id"),
                    F.size("msg_id_chain").alias("chain_len"))


@register("thread_text_gather", sql_with(["messages"], """
select r.chat_id, r.last_msg_id, g.sender_chain, g.text_chain from roots r join (
  select chat_id, last_msg_id, list(sender_id order by pos) as sender_chain, list(text order by pos) as text_chain
  from (select x.chat_id, x.last_msg_id, x.pos, m.text, m.sender_id from (
      select chat_id, last_msg_id, unnest(msg_chain) as mid, generate_subscripts(msg_chain, 1) as pos from roots) x
    left join messages m on m.chat_id = x.chat_id and m.message_id = x.mid)
  group by chat_id, last_msg_id) g on g.chat_id = r.chat_id and g.last_msg_id = r.last_msg_id""",
    extra=WALK + ",\n" + ROOTS, recursive=True))
def q_thread_text_gather(spark, sf_dir):
    f = fixture(spark, sf_dir)
    c = threads.chains_to_root(f.placed)
    g = threads.gather(c, f.placed, ["chat_id", "last_msg_id"], "msg_chain", ["sender_id", "text"], "first_msg_id", read=f.read)
    return g.select("chat_id", "last_msg_id", F.col("sender_id_chain").alias("sender_chain"), "text_chain")


@register("reply_self_join", sql_with(["messages"], """
select m.chat_id, m.message_id, m.reply_to_message_id, p.sender_id as parent_sender_id, p.date as parent_date
from messages m join messages p on p.chat_id = m.chat_id and p.message_id = m.reply_to_message_id"""))
def q_reply_self_join(spark, sf_dir):
    return threads.reply_pairs(fixture(spark, sf_dir).messages)


@register("reply_or_forward_join", sql_with(["messages"], """
select mt.chat_id as child_chat_id, mt.message_id as child_id, m.chat_id as src_chat_id, m.message_id as src_id
from messages m join messages mt on (m.chat_id = mt.chat_id and m.message_id = mt.reply_to_message_id)
  or (m.chat_id = mt.forward_from_chat_id and m.message_id = mt.forward_from_message_id)"""))
def q_reply_or_forward_join(spark, sf_dir):
    return threads.reply_or_forward_pairs(fixture(spark, sf_dir).messages)


SEED_START, SEED_END = "2024-01-10", "2024-01-20"
CLOSURE_COLS = ("chat_id, message_id, sender_id, text, reply_to_message_id, forward_from_chat_id, "
                "forward_from_message_id")


def _seed(f):
    m = f.messages
    s = m.filter(F.col("date").between(F.lit(SEED_START).cast("timestamp_ntz"), F.lit(SEED_END).cast("timestamp_ntz"))
                 & F.col("text").isNotNull())
    return s.join(f.chats.select("chat_id"), "chat_id", "left_semi")


def _closure_sql(cond: str, union: str) -> str:
    cols_m = ", ".join(f"m.{c.strip()}" for c in CLOSURE_COLS.split(","))
    return sql_with(["messages", "chats"], f"select {CLOSURE_COLS} from tree", extra=f"""tree as (
  select {CLOSURE_COLS} from messages where date between timestamp '{SEED_START}' and timestamp '{SEED_END}'
    and chat_id in (select chat_id from chats) and text is not null
  {union}
  select {cols_m} from messages m join tree mt on {cond})""", recursive=True)


@register("ancestor_closure", _closure_sql("m.chat_id = mt.chat_id and m.message_id = mt.reply_to_message_id",
                                           "union all"))
def q_ancestor_closure(spark, sf_dir):
    f = fixture(spark, sf_dir)
    return threads.ancestor_closure(_seed(f), f.messages, late=f.late)


@register("ancestor_closure_distinct", _closure_sql(
    "(m.chat_id = mt.chat_id and m.message_id = mt.reply_to_message_id) or "
    "(m.chat_id = mt.forward_from_chat_id and m.message_id = mt.forward_from_message_id)", "union"))
def q_ancestor_closure_distinct(spark, sf_dir):
    f = fixture(spark, sf_dir)
    return threads.ancestor_closure(_seed(f), f.messages, replies=True, forwards=True, distinct=True, late=f.late)


@register("union_all_recursive", _closure_sql(
    "(m.chat_id = mt.chat_id and m.message_id = mt.reply_to_message_id) or "
    "(m.chat_id = mt.forward_from_chat_id and m.message_id = mt.forward_from_message_id)", "union all"))
def q_union_all_recursive(spark, sf_dir):
    f = fixture(spark, sf_dir)
    return threads.ancestor_closure(_seed(f), f.messages, replies=True, forwards=True, distinct=False, late=f.late)


@register("sort_array_position", sql_with(["messages"], """
select r.chat_id, r.last_msg_id as leaf_id, g.sender_chain from roots r join (
  select chat_id, last_msg_id, list(sender_id order by pos) as sender_chain
  from (select x.chat_id, x.last_msg_id, x.pos, m.sender_id from (
      select chat_id, last_msg_id, unnest(list_reverse(msg_chain)) as mid,
        generate_subscripts(msg_chain, 1) as pos from roots) x
    left join messages m on m.chat_id = x.chat_id and m.message_id = x.mid)
  group by chat_id, last_msg_id) g on g.chat_id = r.chat_id and g.last_msg_id = r.last_msg_id
where not exists (select 1 from messages c where c.chat_id = r.chat_id and c.reply_to_message_id = r.last_msg_id)""",
    extra=WALK + ",\n" + ROOTS, recursive=True))
def q_sort_array_position(spark, sf_dir):
    """Senders of each maximal chain ordered by their position in the (root-first) chain."""
    m = fixture(spark, sf_dir).messages
    c = threads.maximal_chains(m)
    g = threads.gather(c, m, ["chat_id", "leaf_id"], "msg_chain", ["sender_id"], "root_id")
    return g.select("chat_id", "leaf_id", F.col("sender_id_chain").alias("sender_chain"))


@register("order_chain", sql_with(["messages"], """
select chat_id, first_msg_id, last_msg_id,
  row_number() over (order by first_msg_id desc, chat_id, last_msg_id) as position from roots""",
    extra=WALK + ",\n" + ROOTS, recursive=True))
def q_order_chain(spark, sf_dir):
    """Root-reaching chains ordered by root id descending (ties by chat and start id)."""
    from ..operators import tables
    c = threads.chains_to_root(fixture(spark, sf_dir).messages).select("chat_id", "first_msg_id", "last_msg_id")
    return tables.dense_index(c, [F.col("first_msg_id").desc(), F.col("chat_id"), F.col("last_msg_id")],
                              name="position")
