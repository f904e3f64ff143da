"""Script statistics per chat and the language views over chats.

`chat_counts` = A07 (conditional counts per chat); `sample_first_n` = W03;
`update` = D08 (the stored procedure: sample, count, set four columns on
chats that have messages); `chats_in` = L01-L03.  Conditional counts are
`count_if`, evaluated in one partially pre-aggregated pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import SCRIPT_RANGES, has_script, language_pct

STAT_COLS = ("sample_count", "arabic_count", "hebrew_count", "english_count")


def sample_first_n(messages: DataFrame, n: int = 10) -> DataFrame:
    """First n messages per chat by message id (the reference's order is arbitrary)."""
    w = Window.partitionBy("chat_id").orderBy("message_id")
    return messages.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def chat_counts(messages: DataFrame) -> DataFrame:
    """Per chat, non-empty texts and texts with Arabic / Hebrew / Latin letters."""
    t = F.coalesce(F.col("text"), F.lit(""))
    # Hebrew and Arabic letters are adjacent blocks: one scan for "any of them"
    # guards both specific tests (`And` short-circuits), so a text with neither
    # script (the common case) is scanned once instead of twice.
    semitic = t.rlike(f"[{SCRIPT_RANGES['hebrew'][0]}-{SCRIPT_RANGES['arabic'][-1]}]")
    return messages.groupBy("chat_id").agg(
        F.count_if(F.length(t) > 0).alias("sample_count"),
        F.count_if(semitic & has_script(t, "arabic")).alias("arabic_count"),
        F.count_if(semitic & has_script(t, "hebrew")).alias("hebrew_count"),
        F.count_if(has_script(t, "english")).alias("english_count"))


def signed_counts(rows: DataFrame) -> DataFrame:
    """A07 as a sum: per chat the number of messages and the four counts of `rows`, each row taken `sign` times."""
    t = F.coalesce(F.col("text"), F.lit(""))
    semitic = t.rlike(f"[{SCRIPT_RANGES['hebrew'][0]}-{SCRIPT_RANGES['arabic'][-1]}]")
    tests = (F.length(t) > 0, semitic & has_script(t, "arabic"), semitic & has_script(t, "hebrew"), has_script(t, "english"))
    sign = F.col("sign").cast("long")
    return rows.groupBy("chat_id").agg(F.sum(sign).alias("messages"), *(
        F.sum(F.when(test, sign).otherwise(0)).alias(c) for test, c in zip(tests, STAT_COLS)))


def signed_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Change rows `(chat_id, text, sign)`: versions that go (`old`: changed and deleted messages as they were) and
    versions that come (`new`: inserted and changed ones as they are)."""
    side = lambda df, s: df.select("chat_id", "text", F.lit(s).alias("sign"))
    return side(old, -1).unionByName(side(new, 1))


def add_counts(stored: DataFrame, changes: DataFrame) -> DataFrame:
    """Stored counts plus the signed counts of changes; chats without messages go.  With `buckets.merge_store` just
    the buckets of changed chats are read and written; the messages themselves are not read again."""
    both = stored.unionByName(changes)
    return (both.groupBy("chat_id").agg(*(F.sum(c).alias(c) for c in ("messages", *STAT_COLS))).filter("messages > 0"))


def update(chats: DataFrame, messages: DataFrame, sample: int = 10) -> DataFrame:
    """Chats with the four counts set from a sample of their messages.

    Chats without messages keep their current values (null when absent).
    Returns the chats table with `pct_*` derived columns (P09).
    """
    counts = chat_counts(sample_first_n(messages, sample))
    base = chats
    for c in STAT_COLS:
        if c not in base.columns:
            base = base.withColumn(c, F.lit(None).cast("bigint"))
    renamed = counts.select("chat_id", *[F.col(c).alias(f"_n_{c}") for c in STAT_COLS],
                            F.lit(True).alias("_hit"))
    j = base.join(renamed, "chat_id", "left")
    out = j.select(*[F.when(F.col("_hit"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) if c in STAT_COLS
                     else F.col(c) for c in base.columns])
    return out.select("*", *[language_pct(f"{s}_count", "sample_count").alias(f"pct_{s}")
                             for s in ("arabic", "hebrew", "english")])


def chats_in(chats: DataFrame, language: str) -> DataFrame:
    """The hebrew / arabic / english chat views (a chat can be in several)."""
    t = F.col("title")
    he, ar, en = has_script(t, "hebrew"), has_script(t, "arabic"), has_script(t, "english")
    sample = F.col("sample_count").cast("double")
    known = F.col("sample_count").isNotNull()
    if language == "hebrew":
        cond = he | (known & (F.col("hebrew_count").cast("double") > sample * 0.5))
    elif language == "arabic":
        cond = (ar & ~he) | (known & (F.col("arabic_count").cast("double") > sample * 0.7))
    elif language == "english":
        cond = (en & ~he & ~ar) | (known & (F.col("english_count").cast("double") > sample * 0.7))
    else:
        raise ValueError(language)
    return chats.filter(F.coalesce(cond, F.lit(False)))
