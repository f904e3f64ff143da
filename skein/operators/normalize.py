"""Raw message documents -> normalised tables (messages, reactions, polls, chats, users).

The reference normalises one Python dict at a time; here each rule is a
column expression over the declared nested schema (`schemas.RAW_MESSAGE`),
so a batch of any size is one projection: list-valued parts (reactions,
poll options) are resolved inside the row with higher-order functions, so
normalisation shuffles nothing.  Nulls are pruned implicitly by the struct
schema.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.scalars import type_code, CHAT_TYPE_CODES
from . import tables


def _keep(raw: DataFrame) -> DataFrame:
    """P01 guards: drop outgoing messages and rows without chat or message id."""
    return raw.filter(~F.coalesce(F.col("outgoing"), F.lit(False))
                      & F.col("chat.id").isNotNull() & F.col("id").isNotNull())


def message_text() -> Column:
    """First truthy of text, caption, poll question (empty counts as absent;
    the poll question is taken as it is once reached)."""
    t, c = F.col("text"), F.col("caption")
    return (F.when(F.coalesce(t, F.lit("")) != "", t)
            .when(F.coalesce(c, F.lit("")) != "", c)
            .when(F.col("poll").isNotNull(), F.col("poll.question")))


def message_media() -> list[Column]:
    """(media_type, file_id, file_unique_id) of the first present media kind."""
    kind = None
    for m in schemas.MEDIA_KINDS:
        kind = (F.when(F.col(m).isNotNull(), F.lit(m)) if kind is None
                else kind.when(F.col(m).isNotNull(), F.lit(m)))
    fid = None
    fuid = None
    for m in schemas.MEDIA_KINDS:
        present = F.col(m).isNotNull()
        fid = F.when(present, F.col(f"{m}.file_id")) if fid is None else fid.when(present, F.col(f"{m}.file_id"))
        fuid = (F.when(present, F.col(f"{m}.file_unique_id")) if fuid is None
                else fuid.when(present, F.col(f"{m}.file_unique_id")))
    return [kind.alias("media_type"), fid.alias("file_id"), fuid.alias("file_unique_id")]


def _reaction_key(r: Column) -> Column:
    """Reaction key of one list element: the emoji, else the custom emoji id as text."""
    return F.coalesce(r.getField("emoji"), r.getField("custom_emoji_id").cast("string"))


def _option_key(o: Column) -> Column:
    return o.getField("text")


def _last_wins(arr: Column, key_of, value_field: str) -> Column:
    """Dict semantics inside the row: distinct keys in first-occurrence order, each
    with the value of its last occurrence -> array<struct<pos, key, value>>.

    Evaluated per row with higher-order functions (lists are short), so the
    normalisation needs no shuffle at all.
    """
    keys = F.array_distinct(F.transform(arr, key_of))
    return F.transform(keys, lambda k, i: F.struct(
        i.alias("pos"), k.alias("key"),
        F.element_at(F.filter(arr, lambda x: key_of(x).eqNullSafe(k)), -1).getField(value_field).alias("value")))


def _total(items: Column) -> Column:
    return F.aggregate(items, F.lit(0), lambda acc, x: acc + x.getField("value"))


def _reaction_list() -> Column:
    return _last_wins(F.col("reactions.reactions"), _reaction_key, "count")


def _poll_list() -> Column:
    return _last_wins(F.col("poll.options"), _option_key, "voter_count")


def _explode_items(raw: DataFrame, items: Column, key_name: str) -> DataFrame:
    x = raw.select(F.col("chat.id").alias("chat_id"), F.col("id").alias("message_id"), items.alias("_items"))
    x = x.select("chat_id", "message_id", _total("_items").alias("_total"), F.explode("_items").alias("_it"))
    return x.select("chat_id", "message_id", F.col("_it.key").alias(key_name), F.col("_it.value").alias("votes_abs"),
                    F.col("_it.pos").alias("first_pos"), "_total")


def _reaction_items(raw: DataFrame) -> DataFrame:
    """One row per (message, reaction key) with the last count of equal keys."""
    return _explode_items(raw, _reaction_list(), "reaction").drop("_total")


def _poll_items(raw: DataFrame) -> DataFrame:
    """One row per (message, option text): position among distinct texts, last count."""
    return _explode_items(raw, _poll_list(), "poll_option_text").drop("_total")


def flatten_messages(raw: DataFrame) -> DataFrame:
    """P01 (+P02, P03, A13): one `messages` row per raw document, a pure projection.

    reactions_vote_count: null without reactions or with an empty list;
    poll_vote_count: null without options; equal keys count once with their
    last value (as the reference's dicts do).
    """
    r = _keep(raw)
    reac, poll = _reaction_list(), _poll_list()
    out = r.select(
        F.col("chat.id").alias("chat_id"), F.col("id").alias("message_id"),
        F.coalesce(F.col("from_user.id"), F.col("sender_chat.id")).alias("sender_id"),
        message_text().alias("text"), "date", "views", "forwards",
        F.coalesce(F.col("forward_from_chat.id"), F.col("forward_from.id")).alias("forward_from_chat_id"),
        "forward_from_message_id", "reply_to_message_id",
        F.when(F.size("poll.options") > 0, _total(poll)).cast("int").alias("poll_vote_count"),
        F.when(F.size("reactions.reactions") > 0, _total(reac)).cast("int").alias("reactions_vote_count"),
        *message_media())
    return out.select(*[f.name for f in schemas.MESSAGES.fields])


def _norm(value: str, total: str) -> Column:
    return F.when(F.coalesce(F.col(total), F.lit(0)) != 0,
                  F.col(value).cast("double") / F.col(total).cast("double")).otherwise(F.lit(0.0))


def explode_reactions(raw: DataFrame, emoji_map: DataFrame) -> DataFrame:
    """(chat_id, message_id, reaction_id, reaction_votes_norm, reaction_votes_abs).

    Explode + in-row totals; the only join is with the emoji dictionary."""
    items = _explode_items(_keep(raw), _reaction_list(), "reaction")
    enc = tables.encode(items, "reaction", emoji_map)
    return enc.select("chat_id", "message_id", "reaction_id", _norm("votes_abs", "_total").alias("reaction_votes_norm"),
                      F.col("votes_abs").alias("reaction_votes_abs"))


def explode_poll(raw: DataFrame) -> DataFrame:
    """Option id = position of the option's text among distinct texts (first occurrence)."""
    items = _explode_items(_keep(raw), _poll_list(), "poll_option_text")
    return items.select("chat_id", "message_id", F.col("first_pos").cast("int").alias("poll_option_id"),
                        "poll_option_text", _norm("votes_abs", "_total").alias("votes_norm"), "votes_abs")


def extract_chats(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Chat rows from the documents (one per document; merge with `merge_non_null`).

    `carry` passes document columns through (e.g. the arrival order)."""
    r = _keep(raw)
    return r.select(*carry,
        F.col("chat.id").alias("chat_id"), F.col("chat.title").alias("title"),
        F.col("chat.first_name").alias("first_name"), F.col("chat.last_name").alias("last_name"),
        F.col("chat.username").alias("username"), F.col("chat.invite_link").alias("invite_link"),
        F.lower(F.col("chat.type")).alias("type"), F.col("chat.members_count").alias("members_count"),
        *[F.col(f"chat.{c}").alias(c) for c in ("is_verified", "is_restricted", "is_scam", "is_fake", "is_support")],
        F.col("chat.linked_chat.id").alias("linked_chat_id"), F.col("chat.phone_number").alias("phone_number"))


def extract_users(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """User rows from `from_user`."""
    r = _keep(raw).filter(F.col("from_user").isNotNull())
    return r.select(*carry, F.col("from_user.id").alias("sender_id"),
                    *[F.col(f"from_user.{f.name}").alias(f.name) for f in schemas.RAW_USER.fields if f.name != "id"])


def merge_non_null(rows: DataFrame, key: str, order: str, known: DataFrame | None = None) -> DataFrame:
    """Many partial rows per key in a batch -> the last non-null value per column.

    `known` keys (already stored) are skipped.  One keyed aggregation with
    `max_by(col, order)` restricted to rows where the column is not null.
    """
    if known is not None:
        rows = rows.join(known.select(key), key, "left_anti")
    cols = [c for c in rows.columns if c not in (key, order)]
    return rows.groupBy(key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in cols])


def presence_flags(messages: DataFrame) -> DataFrame:
    """Generated has_* columns."""
    return messages.select("*", F.col("poll_vote_count").isNotNull().alias("has_poll"),
                           F.col("reactions_vote_count").isNotNull().alias("has_reactions"),
                           F.col("text").isNotNull().alias("has_text"),
                           F.col("media_type").isNotNull().alias("has_media"))


NON_NEGATIVE = {
    "messages": ("views", "forwards", "poll_vote_count", "reactions_vote_count"),
    "chats": ("members_count", "sample_count", "arabic_count", "hebrew_count", "english_count"),
    "stocks": ("open", "high", "low", "close", "volume", "adj_close"),
    "reactions": ("reaction_votes_norm", "reaction_votes_abs"),
    "polls": ("votes_norm", "votes_abs"),
}


def check_rules(df: DataFrame, table: str) -> Column:
    """P10: CHECK clauses as one boolean; a null comparison passes (as in SQL CHECK)."""
    ok = F.lit(True)
    for c in NON_NEGATIVE.get(table, ()):
        if c in df.columns:
            ok = ok & F.coalesce(F.col(c) >= 0, F.lit(True))
    if "yyyymm" in df.columns:
        ok = ok & F.coalesce(F.col("yyyymm").between(180001, 999912), F.lit(True))
    if "chain_len" in df.columns:
        ok = ok & F.coalesce(F.col("chain_len") >= 1, F.lit(True))
    return ok


def split_valid(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """P10 + P11: (valid, rejected) by CHECK rules and enum domains."""
    ok = check_rules(df, table) & enum_ok(df)
    flagged = df.withColumn("_ok", ok)
    return flagged.filter("_ok").drop("_ok"), flagged.filter(~F.col("_ok")).drop("_ok")


def enum_ok(df: DataFrame) -> Column:
    """Enum columns hold a domain value or null."""
    ok = F.lit(True)
    domains = {"media_type": schemas.MEDIA_TYPES, "type": schemas.CHAT_TYPES, "granularity": schemas.GRANULARITIES}
    for c, dom in domains.items():
        if c in df.columns:
            ok = ok & F.coalesce(F.col(c).isin(list(dom)), F.lit(True))
    return ok


def nest(messages: DataFrame, reactions: DataFrame, polls: DataFrame) -> DataFrame:
    """Reactions and polls as arrays of structs on the message row (sorted by id)."""
    r = reactions.groupBy("chat_id", "message_id").agg(F.array_sort(F.collect_list(F.struct(
        F.col("reaction_id").alias("id"), F.col("reaction_votes_norm").alias("norm"),
        F.col("reaction_votes_abs").alias("abs")))).alias("reactions"))
    p = polls.groupBy("chat_id", "message_id").agg(F.array_sort(F.collect_list(F.struct(
        F.col("poll_option_id").alias("id"), F.col("poll_option_text").alias("text"),
        F.col("votes_norm").alias("norm"), F.col("votes_abs").alias("abs")))).alias("poll"))
    return messages.join(r, ["chat_id", "message_id"], "left").join(p, ["chat_id", "message_id"], "left")


def unnest_reactions(nested: DataFrame) -> DataFrame:
    """P13 inverse for reactions."""
    x = nested.select("chat_id", "message_id", F.explode("reactions").alias("r"))
    return x.select("chat_id", "message_id", F.col("r.id").alias("reaction_id"),
                    F.col("r.norm").alias("reaction_votes_norm"), F.col("r.abs").alias("reaction_votes_abs"))


def unnest_polls(nested: DataFrame) -> DataFrame:
    x = nested.select("chat_id", "message_id", F.explode("poll").alias("p"))
    return x.select("chat_id", "message_id", F.col("p.id").alias("poll_option_id"),
                    F.col("p.text").alias("poll_option_text"), F.col("p.norm").alias("votes_norm"),
                    F.col("p.abs").alias("votes_abs"))


# P17 / P18 / P19 / P20 --------------------------------------------------------

BOILERPLATE = "\n\nכדי להגיב לכתבה לחצו כאן"  # fixed value: footer removed before embedding


def doc_select(raw: DataFrame, chat_ids: Sequence[int] | None = None) -> DataFrame:
    """Documents of the chats with text or caption that are not replies."""
    r = raw
    if chat_ids is not None:
        r = r.filter(F.col("chat.id").isin(list(chat_ids)))
    r = r.filter((F.col("text").isNotNull() | F.col("caption").isNotNull()) & F.col("reply_to_message_id").isNull())
    return r.select(F.col("chat.id").alias("cid"), F.col("id").alias("mid"), "text", "caption", "reactions",
                    "forwards")


def reaction_text(selected: DataFrame) -> DataFrame:
    """P19: "<<TEXT>>text<<REACTIONS>>e:n, e:n<<FORWARDS>>f"; any null part -> null."""
    items = F.transform(F.col("reactions.reactions"), lambda r: F.concat(
        r.getField("emoji"), F.lit(":"), r.getField("count").cast("string"), F.lit(", ")))
    joined = F.aggregate(items, F.lit(""), lambda acc, x: F.concat(acc, x))
    rstr = F.expr("trim(TRAILING ', ' FROM _rs)")
    body = F.replace(F.coalesce(F.col("text"), F.col("caption")), F.lit(BOILERPLATE), F.lit(""))
    return (selected.withColumn("_rs", joined)
            .select("cid", "mid", F.concat(F.lit("<<TEXT>>"), body, F.lit("<<REACTIONS>>"), rstr,
                                           F.lit("<<FORWARDS>>"), F.col("forwards").cast("string")).alias("text")))


def doc_any_text(raw: DataFrame, chat_id: int | None = None, first: bool = False) -> DataFrame:
    """Documents with any of text / caption / poll question; first non-null as text.

    `first=True` is the document store's `find_one`: one matching document,
    made deterministic by taking the smallest message id (a top-1, no sort of the table).
    """
    r = raw.filter(F.col("text").isNotNull() | F.col("caption").isNotNull() | F.col("poll.question").isNotNull())
    if chat_id is not None:
        r = r.filter(F.col("chat.id") == chat_id)
    out = r.select(F.col("chat.id").alias("from"), "date",
                   F.coalesce("text", "caption", "poll.question").alias("text"),
                   F.col("poll.options").alias("responses"), F.col("reactions.reactions").alias("reactions"),
                   F.col("id").alias("message_id"))
    return out.orderBy("message_id", "from").limit(1) if first else out


def normalize_chat(chats: DataFrame, links: DataFrame) -> DataFrame:
    """P20: type code, is_scam = is_scam OR is_fake, channel/group ids by lookup (J11 pairs)."""
    ch = links.select(F.col("group_id").alias("chat_id"), F.col("channel_id"))
    gr = links.select(F.col("channel_id").alias("chat_id"), F.col("group_id"))
    return (chats.join(ch, "chat_id", "left").join(gr, "chat_id", "left")
            .select("chat_id", type_code("type", CHAT_TYPE_CODES).alias("type"), "title", "username",
                    # Python `a or b`: a when truthy, else b (so False or None -> None)
                    F.when(F.col("is_scam"), F.lit(True)).otherwise(F.col("is_fake")).alias("is_scam"),
                    "members_count",
                    "channel_id", "group_id"))
