"""Explicit schemas, keys, enum domains and check rules of the domain tables.

Readers always pass one of these schemas (no per-run inference).
"""

from __future__ import annotations

from pyspark.sql import types as T

L, I, S, B, D = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType(), T.DoubleType()
TS = T.TimestampNTZType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


ID = _struct(("id", L))
FILE = _struct(("file_id", S), ("file_unique_id", S))
REACTION_ITEM = _struct(("emoji", S), ("custom_emoji_id", L), ("count", I))
POLL_OPTION = _struct(("text", S), ("voter_count", I))
MEDIA_KINDS = ("document", "audio", "voice", "video", "sticker", "animation", "video_note", "photo",
               "new_chat_photo")

RAW_CHAT = _struct(
    ("id", L), ("type", S), ("title", S), ("first_name", S), ("last_name", S), ("username", S),
    ("invite_link", S), ("members_count", I), ("is_verified", B), ("is_restricted", B), ("is_scam", B),
    ("is_fake", B), ("is_support", B), ("phone_number", S), ("linked_chat", ID))
RAW_USER = _struct(
    ("id", L), ("first_name", S), ("last_name", S), ("username", S), ("phone_number", S), ("is_verified", B),
    ("is_restricted", B), ("is_scam", B), ("is_fake", B), ("is_support", B), ("is_bot", B))

# One raw message document (enums already as names, nulls pruned).
RAW_MESSAGE = _struct(
    ("id", L), ("outgoing", B), ("date", TS), ("text", S), ("caption", S), ("views", I), ("forwards", I),
    ("chat", RAW_CHAT), ("from_user", RAW_USER), ("sender_chat", ID), ("forward_from", ID),
    ("forward_from_chat", ID), ("forward_from_message_id", L), ("reply_to_message_id", L),
    ("reactions", _struct(("reactions", T.ArrayType(REACTION_ITEM)))),
    ("poll", _struct(("question", S), ("options", T.ArrayType(POLL_OPTION)))),
    *[(m, FILE) for m in MEDIA_KINDS])

MESSAGES = _struct(
    ("chat_id", L), ("message_id", L), ("sender_id", L), ("text", S), ("date", TS), ("views", I), ("forwards", I),
    ("forward_from_chat_id", L), ("forward_from_message_id", L), ("reply_to_message_id", L),
    ("poll_vote_count", I), ("reactions_vote_count", I), ("media_type", S), ("file_id", S), ("file_unique_id", S))

MESSAGE_CHAIN = _struct(
    ("chat_id", L), ("last_message_id", L), ("chain_len", I), ("first_message_id", L),
    ("sent_by_linked_chat", B), ("chain", S))

BARS = _struct(("symbol", S), ("granularity", S), ("date", TS), ("open", D), ("high", D), ("low", D),
               ("close", D), ("volume", D), ("adj_close", D))

# CSV bars as delivered by the sheet export
BARS_CSV = _struct(("Name", S), ("Interval", S), ("Date", S), ("Open", S), ("High", S), ("Low", S),
                   ("Close", S), ("Volume", S))

KEYS = {
    "messages": ("chat_id", "message_id"),
    "reactions": ("chat_id", "message_id", "reaction_id"),
    "polls": ("chat_id", "message_id", "poll_option_id"),
    "chats": ("chat_id",),
    "users": ("sender_id",),
    "message_chain": ("chat_id", "last_message_id"),
    "chain_embeddings": ("chat_id", "last_message_id"),
    "stocks": ("symbol", "granularity", "date"),
    "emoji_map": ("reaction_id",),
    "configurations": ("project", "key"),
}

# Enum domains (fixed values)
CHAT_TYPES = ("private", "bot", "group", "supergroup", "channel")
MEDIA_TYPES = ("document", "audio", "voice", "video", "sticker", "animation", "new_chat_photo", "video_note",
               "photo")
GRANULARITIES = ("1m", "2m", "5m", "15m", "30m", "60m", "90m", "1d")

# Generated columns of messages (never written by an upsert)
GENERATED = {"messages": ("has_poll", "has_reactions", "has_text", "has_media"),
             "chats": ("pct_arabic", "pct_hebrew", "pct_english")}
