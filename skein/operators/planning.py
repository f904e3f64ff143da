"""Ingestion planning: which chats to fetch, from where, and in what order.

The reference computes these with dicts over a few thousand dialogs; here
they are joins of the dialog table with per-chat aggregates of the message
table, so they run unchanged when both are large.  Per-chat bounds are a
dimension-sized table; the message side is only ever scanned with a
join + filter (no per-chat driver loop).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import pretty_duration
from . import tables

GROUP_LOOKBACK = dt.timedelta(weeks=12)   # fixed value: groups are fetched back 12 weeks (4 in the pool variant)
EPOCH = "1970-01-01 00:00:00"


def eligible_dialogs(dialogs: DataFrame, full_ids: DataFrame | None = None, fetch_groups: bool = False) -> DataFrame:
    """Has a top message, not restricted, and (channel, or in the full list,
    or groups enabled and group/supergroup)."""
    d = dialogs
    in_full = F.lit(False)
    if full_ids is not None:
        d = d.join(full_ids.select("chat_id").distinct().withColumn("_full", F.lit(True)), "chat_id", "left")
        in_full = F.coalesce(F.col("_full"), F.lit(False))
    kind = (F.col("type") == "channel") | in_full
    if fetch_groups:
        kind = kind | F.col("type").isin("group", "supergroup")
    ok = F.col("top_message_id").isNotNull() & ~F.coalesce(F.col("is_restricted"), F.lit(False)) & kind
    return d.filter(ok).drop("_full") if full_ids is not None else d.filter(ok)


def resume_offsets(chats: DataFrame, messages: DataFrame) -> DataFrame:
    """Per chat the smallest stored message id above its committed top
    (all ids when the top is null); chats without such a message are absent."""
    c = chats.select("chat_id", F.col("top_message_id").alias("_top"))
    j = messages.select("chat_id", "message_id").join(c, "chat_id")
    j = j.filter(F.col("_top").isNull() | (F.col("message_id") > F.col("_top")))
    return j.groupBy("chat_id").agg(F.min("message_id").alias("offset"))


def leftovers(dialogs: DataFrame, stored: DataFrame, offsets: DataFrame) -> DataFrame:
    """Available (resume offset, else the dialog's top) minus committed (stored top or -1)."""
    s = stored.select("chat_id", F.col("top_message_id").alias("_committed"))
    j = (dialogs.select("chat_id", "type", F.col("top_message_id").alias("_dialog_top"))
         .join(s, "chat_id", "left").join(offsets, "chat_id", "left"))
    committed = F.coalesce(F.col("_committed"), F.lit(-1))
    available = F.coalesce(F.col("offset"), F.col("_dialog_top"))
    return j.select("chat_id", "type", committed.alias("committed"), available.alias("available"),
                    (available - committed).alias("leftovers"), F.col("offset").isNotNull().alias("has_offset"))


def pending(left: DataFrame) -> DataFrame:
    return left.filter(F.col("leftovers") > 0)


def worklist_keys() -> list[Column]:
    return [F.col("has_offset").desc(), F.col("leftovers").asc_nulls_last(), F.col("chat_id").asc()]


def worklist_order(left: DataFrame) -> DataFrame:
    """Chats with a resume offset first, then by leftovers ascending (unknown last, ties by id)."""
    return left.orderBy(*worklist_keys())


def fetch_window(messages: DataFrame, bounds: DataFrame, now: str, full_ids: Sequence[int] = (),
                 group_lookback: dt.timedelta = GROUP_LOOKBACK) -> DataFrame:
    """Per chat keep committed < id <= available and date >= min_date
    (groups: now - lookback unless in the full list; others: 1970)."""
    lookback_s = int(group_lookback.total_seconds())
    is_group = F.col("type").isin("group", "supergroup") & ~F.col("chat_id").isin(list(full_ids))
    min_date = F.when(is_group, F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(secs=F.lit(lookback_s))) \
        .otherwise(F.lit(EPOCH).cast("timestamp_ntz"))
    # a few numbers per chat: sent to the messages when small, so that a hot chat is not one task
    b = tables.if_small(bounds.select("chat_id", "committed", "available", min_date.alias("min_date")))
    j = messages.join(b, "chat_id")
    return j.filter((F.col("message_id") > F.col("committed")) & (F.col("message_id") <= F.col("available"))
                    & (F.col("date") >= F.col("min_date"))).drop("committed", "available", "min_date")


REFRESH_AGE, REFRESH_SPAN = dt.timedelta(days=7), dt.timedelta(hours=30)


def _dated(now: str, age: dt.timedelta = REFRESH_AGE, span: dt.timedelta = REFRESH_SPAN) -> Column:
    hi = F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(secs=F.lit(int(age.total_seconds())))
    lo = hi - F.make_dt_interval(secs=F.lit(int(span.total_seconds())))
    return (F.col("date") >= lo) & (F.col("date") < hi)


def refresh_window(messages: DataFrame, chats: DataFrame, now: str, age: dt.timedelta = REFRESH_AGE,
                   span: dt.timedelta = REFRESH_SPAN) -> DataFrame:
    """Messages dated in [now - age - span, now - age) with id <= the chat's committed top."""
    c = chats.filter(F.col("top_message_id").isNotNull()).select("chat_id", F.col("top_message_id").alias("_top"))
    m = messages.filter(_dated(now, age, span))
    return m.join(c, "chat_id").filter(F.col("message_id") <= F.col("_top")).drop("_top")


def refresh(messages: DataFrame, chats: DataFrame, fetched: DataFrame, settings: DataFrame, now: str,
            project: str = "refresh", key: str = "last_run") -> tuple[DataFrame, DataFrame]:
    """The messages with the newly fetched values of the refresh window upserted (null keeps the
    stored value; rows outside the window are not touched), and the settings with this run.  Rows of other dates stay
    where they are, unless one repeats a key of the window."""
    ids = ["chat_id", "message_id"]
    window = refresh_window(messages, chats, now).select(*ids)
    new = fetched.join(window, ids, "left_semi")
    dated = F.coalesce(_dated(now), F.lit(False))
    others = messages.filter(~dated)
    repeats = tables.if_small(others.select(*ids).join(new.select(*ids), ids, "left_semi").distinct())
    meets = messages.filter(dated).unionByName(others.join(repeats, ids, "left_semi"))
    run = settings.sparkSession.range(1).select(F.lit(project).alias("project"), F.lit(key).alias("key"), F.lit(now).alias("value"))
    return (tables.upsert_coalesce(meets, new, ids).unionByName(others.join(repeats, ids, "left_anti").select(*messages.columns)),
            tables.upsert_overwrite(settings.select("project", "key", "value"), run, ["project", "key"], ["value"]))


def refresh_due(settings: DataFrame, now: str, key: str = "last_run", min_gap: dt.timedelta = dt.timedelta(days=1)) -> DataFrame:
    """I04 gate: per project, due when the last run recorded in the settings is older than `min_gap`."""
    last = settings.filter(F.col("key") == key).select("project", F.col("value").cast("timestamp_ntz").alias("last_run"))
    limit = F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(secs=F.lit(int(min_gap.total_seconds())))
    return last.select("project", "last_run", (F.col("last_run").isNull() | (F.col("last_run") < limit)).alias("due"))


def fetch_progress(left: DataFrame, saved: DataFrame, elapsed_seconds: float) -> DataFrame:
    """Total leftovers, messages saved so far, rate and remaining time."""
    tot = left.agg(F.sum("leftovers").alias("total_left"))
    saved_total = saved.select(F.coalesce(F.sum("saved"), F.lit(0))).scalar()  # scalar subquery, one value
    rate = F.col("saved").cast("double") / F.lit(float(elapsed_seconds))
    remaining = F.when(rate != 0, (F.col("total_left") - F.col("saved")).cast("double") / rate)
    j = tot.withColumn("saved", saved_total)
    return j.select("total_left", "saved", rate.alias("rate"), remaining.alias("remaining_seconds"),
                    pretty_duration(remaining).alias("remaining"))


def dialog_message_sum(dialogs: DataFrame) -> DataFrame:
    """Sum of top message ids over dialogs (upper estimate of messages)."""
    return dialogs.agg(F.sum("top_message_id").alias("message_upper_bound"))


def kicked_chats(stored: DataFrame, current: DataFrame) -> DataFrame:
    """Stored dialogs that are no longer current."""
    return (stored.join(current.select("chat_id"), "chat_id", "left_anti")
            .select("chat_id", F.coalesce("title", F.lit("UNKNOWN TITLE")).alias("title")))


def restrict_to_set(current: DataFrame, allowed: DataFrame) -> DataFrame:
    """Current dialogs that are in the allowed (backup) set."""
    return current.join(allowed.select("chat_id").distinct(), "chat_id", "left_semi")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """U09 uniqueness check: keys that occur more than once (empty when unique)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def max_id_with_title(messages: DataFrame, chats: DataFrame) -> DataFrame:
    """max(message_id) per chat, left join of the chat title."""
    m = messages.groupBy("chat_id").agg(F.max("message_id").alias("max_message_id"))
    return m.join(chats.select("chat_id", "title"), "chat_id", "left")


def top_channels(chats: DataFrame) -> DataFrame:
    """Chats by top message id, descending (ties by id)."""
    return chats.select("chat_id", "title", "top_message_id").orderBy(
        F.col("top_message_id").desc_nulls_last(), F.col("chat_id"))


def channel_group_link(chats: DataFrame) -> DataFrame:
    """Symmetric channel <-> discussion-group map from linked ids."""
    ch = chats.filter((F.col("type") == "channel") & F.col("linked_chat_id").isNotNull())
    a = ch.select("chat_id", F.col("linked_chat_id").alias("linked_id"), F.lit("group").alias("role"))
    b = ch.select(F.col("linked_chat_id").alias("chat_id"), F.col("chat_id").alias("linked_id"),
                  F.lit("channel").alias("role"))
    return a.unionByName(b)


def _truthy(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


def reconcile_dialogs(stored: DataFrame, joined: DataFrame, extra_titles: DataFrame | None = None,
                      linked: DataFrame | None = None) -> DataFrame:
    """Classify dialogs we are not in: `invite` (username or link), `title`, `nothing`.

    Precedence as in the reference: extra titles fill in ids that are neither
    joined nor with an invite (and lift `nothing`); ids linked to a joined
    chat leave `title`/`nothing` and count as `invite` (by id) when they have
    no invite of their own.  Joined ids are excluded.  One full outer join
    of the three inputs on chat_id.
    """
    j = joined.select("chat_id").distinct().withColumn("_joined", F.lit(True))
    s = stored.select("chat_id", "title", "username", "invite_link").withColumn("_stored", F.lit(True))
    d = s.join(j, "chat_id", "full")
    if extra_titles is not None:
        d = d.join(extra_titles.select("chat_id", F.col("title").alias("_extra_title")), "chat_id", "full")
    else:
        d = d.withColumn("_extra_title", F.lit(None).cast("string"))
    if linked is not None:
        d = d.join(linked.select("chat_id").distinct().withColumn("_linked", F.lit(True)), "chat_id", "full")
    else:
        d = d.withColumn("_linked", F.lit(None).cast("boolean"))
    joined_ = F.coalesce(F.col("_joined"), F.lit(False))
    has_invite = F.coalesce(F.col("_stored"), F.lit(False)) & (_truthy(F.col("username")) | _truthy(F.col("invite_link")))
    has_title = F.coalesce(F.col("_stored"), F.lit(False)) & _truthy(F.col("title"))
    extra = F.col("_extra_title").isNotNull()
    lnk = F.coalesce(F.col("_linked"), F.lit(False))
    status = (F.when(joined_, F.lit(None))
              .when(has_invite, F.lit("invite"))
              .when(lnk, F.lit("invite"))
              .when(extra | has_title, F.lit("title"))
              .when(F.coalesce(F.col("_stored"), F.lit(False)), F.lit("nothing")))
    invite = (F.when(has_invite, F.coalesce(F.when(_truthy(F.col("username")), F.col("username")),
                                            F.when(_truthy(F.col("invite_link")), F.col("invite_link"))))
              .when(lnk, F.col("chat_id").cast("string")))
    return (d.select("chat_id", status.alias("status"), invite.alias("invite"),
                     F.coalesce(F.col("_extra_title"), F.col("title")).alias("title"))
            .filter(F.col("status").isNotNull()))


def join_candidates(reconciled: DataFrame) -> DataFrame:
    """Missing dialogs with an invite; invite = username, else link, else the id."""
    return (reconciled.filter(F.col("status") == "invite")
            .select("chat_id", F.coalesce("invite", F.col("chat_id").cast("string")).alias("invite")))
