"""Message counts, hourly activity profiles and top-N senders.

`chat_stats` (the reference's `ChatStats(chat, n)`) and `profile` take an
optional chat / sender: with none given one pass serves every chat, with
the chat id added to every group and window key.  Windows are always
partitioned (by chat and hour), never global, so no step funnels all rows
into one task; rank <= n filters become `WindowGroupLimit` (a partial top-k
before the shuffle).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import full_name, hour_shift


def count_messages(messages: DataFrame) -> DataFrame:
    """count(*), max(date)."""
    return messages.agg(F.count(F.lit(1)).alias("n_messages"), F.max("date").alias("max_date"))


def count_dialogs(chats: DataFrame) -> DataFrame:
    """A02."""
    return chats.agg(F.count(F.lit(1)).alias("n_dialogs"))


def last_message_age(messages: DataFrame, now: dt.datetime | str) -> DataFrame:
    """Newest message date and seconds since then, relative to a given `now`."""
    n = F.lit(str(now)).cast("timestamp_ntz")
    # wall-clock difference of zone-less timestamps (independent of the session zone)
    return messages.agg(F.max("date").alias("max_date")).select(
        "max_date", (F.timestamp_diff("MICROSECOND", F.col("max_date"), n).cast("double") / 1e6).alias("age_seconds"))


def group_max_first(messages: DataFrame, chats: DataFrame) -> DataFrame:
    """Per chat the max message id and the title seen with its first message."""
    m = messages.select("chat_id", "message_id").join(chats.select("chat_id", "title"), "chat_id", "left")
    return m.groupBy("chat_id").agg(F.max("message_id").alias("max_id"),
                                    F.min_by("title", "message_id").alias("title"))


def min_max_count(df: DataFrame) -> DataFrame:
    """Count, max id, min id per chat."""
    return df.groupBy("chat_id").agg(F.count(F.lit(1)).alias("cnt"), F.max("message_id").alias("max_msg"),
                                     F.min("message_id").alias("min_msg"))


def backup_diff(backup: DataFrame, live: DataFrame, chats: DataFrame) -> DataFrame:
    """Chats whose live row count fell below the backup's (or vanished)."""
    b = backup.groupBy("chat_id").agg(F.count(F.lit(1)).alias("cnt_bak"))
    diff = b.join(min_max_count(live), "chat_id", "left").filter(
        F.col("cnt").isNull() | (F.col("cnt") < F.col("cnt_bak")))
    c = chats.filter(F.col("top_message_id").isNotNull()).select("chat_id", "top_message_id")
    return diff.join(c, "chat_id").select("chat_id", "top_message_id", "max_msg", "min_msg", "cnt", "cnt_bak")


def hourly_counts(messages: DataFrame, chat_id: int | None = None) -> DataFrame:
    """Message count per (chat, shifted hour, sender); a null sender is its own group."""
    m = messages if chat_id is None else messages.filter(F.col("chat_id") == chat_id)
    return (m.select("chat_id", hour_shift("date").alias("hour"), "sender_id")
            .groupBy("chat_id", "hour", "sender_id").agg(F.count(F.lit(1)).alias("message_count")))


def ranked_senders(hourly: DataFrame) -> DataFrame:
    """W01 + W02: rank within (chat, hour) by count desc, and the hour's total.

    The total (`SUM() OVER (PARTITION BY hour)`) is computed as a grouped
    aggregate joined back (chats x 24 rows), so the window holds only `rank`
    and a following `rank <= n` filter becomes a `WindowGroupLimit` (top n per
    partition before the shuffle) even when one chat-hour has very many senders.
    """
    totals = hourly.groupBy("chat_id", "hour").agg(F.sum("message_count").alias("total_messages_per_hour"))
    w = Window.partitionBy("chat_id", "hour").orderBy(F.col("message_count").desc())
    return hourly.withColumn("rank", F.rank().over(w)).join(totals, ["chat_id", "hour"])


def sender_ranks(hourly: DataFrame) -> DataFrame:
    """W01 for all senders: one more than the number of senders with more messages.

    Equal counts share a rank, so only the distinct counts of a chat-hour are ordered (a few rows),
    not its senders."""
    ties = hourly.groupBy("chat_id", "hour", "message_count").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy("chat_id", "hour").orderBy(F.col("message_count").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranks = ties.select("chat_id", "hour", "message_count", (F.coalesce(F.sum("_n").over(ahead), F.lit(0)) + 1).cast("int").alias("rank"))
    return hourly.join(ranks, ["chat_id", "hour", "message_count"])


def top_senders(ranked: DataFrame, n: int = 3) -> DataFrame:
    """Rank <= n (ties can exceed n)."""
    return ranked.filter(F.col("rank") <= n)


def chat_stats(messages: DataFrame, users: DataFrame, chat_id: int | None = None, n: int = 3) -> DataFrame:
    """L04 `ChatStats`: per (chat, hour) the share of the top-n senders and their
    ids and display names in rank order (ties broken by sender id)."""
    top = top_senders(ranked_senders(hourly_counts(messages, chat_id)), n)
    u = users.select("sender_id", full_name("first_name", "last_name").alias("name"))
    t = top.join(u, "sender_id", "left")
    g = t.groupBy("chat_id", "hour", "total_messages_per_hour").agg(
        F.sum("message_count").alias("_top"),
        F.array_sort(F.collect_list(F.struct("rank", "sender_id", "name"))).alias("_items"))
    return g.select(
        "chat_id", "hour",
        F.coalesce(F.col("_top").cast("double") / F.col("total_messages_per_hour").cast("double"), F.lit(0.0))
         .alias("activity_fraction"),
        F.transform("_items", lambda s: s.getField("sender_id")).alias("most_active_sender_ids"),
        F.transform("_items", lambda s: s.getField("name")).alias("most_active_names"))


def profile(messages: DataFrame, chat_id: int | None = None, sender_id: int | None = None) -> DataFrame:
    """A09 + W04: hour histogram of a sender in a chat and each hour's share.

    Without arguments every (chat, sender) pair gets its own profile; the
    share is taken within the pair (a partitioned window, not a global one).
    """
    m = messages
    if chat_id is not None:
        m = m.filter(F.col("chat_id") == chat_id)
    if sender_id is not None:
        m = m.filter(F.col("sender_id") == sender_id)
    c = (m.select("chat_id", "sender_id", F.hour("date").alias("h"))
         .groupBy("chat_id", "sender_id", "h").agg(F.count(F.lit(1)).alias("cnt")))
    w = Window.partitionBy("chat_id", "sender_id")
    return c.select("chat_id", "sender_id", ((F.col("h") + 3) % 24).alias("hour"),
                    (F.col("cnt").cast("double") / F.sum("cnt").over(w).cast("double")).alias("normalized_cnt"))


def join_user_chat(messages: DataFrame, users: DataFrame, chats: DataFrame) -> DataFrame:
    """Messages of senders with a phone number, with chat title."""
    u = users.filter(F.col("phone_number").isNotNull()).select("sender_id", "phone_number")
    c = chats.select("chat_id", "title")
    return messages.join(u, "sender_id").join(c, "chat_id").select("title", "date", "phone_number", "text")


def vote_totals(reactions: DataFrame, polls: DataFrame) -> DataFrame:
    """Total reaction and poll votes per message (missing side -> null)."""
    r = reactions.groupBy("chat_id", "message_id").agg(F.sum("votes_abs").cast("bigint").alias("reactions_vote_count"))
    p = polls.groupBy("chat_id", "message_id").agg(F.sum("votes_abs").cast("bigint").alias("poll_vote_count"))
    return r.join(p, ["chat_id", "message_id"], "full")
