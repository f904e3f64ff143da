"""Table maintenance without MERGE: keyed upserts, deletes, dictionaries, settings.

Parquet has no in-place update, so every maintenance operator is a pure
function `old table(s) -> new table`; the caller writes the result to a new
location (or overwrites touched partitions dynamically), never over the
path the same plan reads.  Upserts are one full outer join on the key:
one shuffle of both sides, or none for the base when it is stored
bucketed by the key.  Keys are unique on each side (in-batch duplicates are
collapsed first), so the join has no skew even when one chat dominates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEQ = "_seq"


def _nsafe_key_join(keys: Sequence[str]) -> Column:
    cond = None
    for k in keys:
        c = F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}"))
        cond = c if cond is None else cond & c
    return cond


def dedupe_first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Within a batch keep the first row per key by arrival `order`.

    With column names or `(name, descending, nulls_last)` specs this is one
    aggregation, `min_by(row, sort_key)`, which is combined map-side, so a key
    holding a large share of the rows is reduced before the shuffle.  Other
    `Column` sort expressions use a row_number window.
    """
    if all(isinstance(o, (str, tuple)) for o in order):
        rest = [c for c in df.columns if c not in keys]
        if set(order) == set(rest) and rest:
            # the order holds the whole row: it is carried and compared once
            g = df.groupBy(*keys).agg(F.min(sort_key(df, order)).alias("_first"))
            at = {c: i for i, c in enumerate(order)}
            return g.select(*[F.col(c) if c in keys else F.col(f"_first._v{at[c]}").alias(c) for c in df.columns])
        g = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), sort_key(df, order)).alias("_first"))
        return g.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest]).select(*df.columns)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def sort_key(df: DataFrame, order: Sequence[str | tuple]) -> Column:
    """A struct whose natural (ascending) order is the requested sort order.

    Items are column names (ascending, nulls first) or `(name, descending,
    nulls_last)` tuples; descending works for numeric columns (negated).
    Used with `min_by`, it turns "first row by order" into an aggregate.
    """
    fields = []
    for i, o in enumerate(order):
        name, desc, nulls_last = (o, False, False) if isinstance(o, str) else o
        c = F.col(name)
        if desc:
            if not isinstance(df.schema[name].dataType, (T.NumericType,)):
                raise TypeError(f"descending sort key needs a numeric column: {name}")
            c = -c
        fields += [(c.isNull() if nulls_last else c.isNotNull()).alias(f"_n{i}"), c.alias(f"_v{i}")]
    return F.struct(*fields)


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Drop fully equal rows."""
    return df.dropDuplicates()


def upsert_coalesce(base: DataFrame, updates: DataFrame, keys: Sequence[str],
                    order: Sequence[str | Column] | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """Insert new keys; on conflict a non-null new value wins, else the old is kept.

    `exclude` names generated columns that the upsert must not write (they
    keep the old value).  With `order`, in-batch duplicates keep the first row
    (U05) before merging.
    """
    if order is not None:
        updates = dedupe_first_by_key(updates, keys, order)
    cols = base.columns
    o, n = base.alias("o"), updates.alias("n")
    j = o.join(n, _nsafe_key_join(keys), "full")
    out = []
    for c in cols:
        if c in keys:
            out.append(F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c))
        elif c in exclude or c not in updates.columns:
            out.append(F.col(f"o.{c}").alias(c))
        else:
            out.append(F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c))
    return j.select(*out)


def upsert_apart(base: DataFrame, updates: DataFrame, keys: Sequence[str], nulls: dict[str, str] | None = None) -> DataFrame:
    """`upsert_coalesce` of wide rows, mostly new: a new row moves only if a stored one must fill it or comes several
    times, a stored row only if no new one takes its place in full.  Which rows these are is found from the keys and from
    the columns' nulls; `nulls` names, for a column, the marker of both tables that tells its nulls without reading it."""
    nulls = nulls or {}
    values = [c for c in base.columns if c not in keys and c not in nulls.values()]
    is_null = lambda c: F.col(nulls[c]) if c in nulls else F.col(c).isNull()
    per_key = lambda df, flags: df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *flags)
    old = per_key(base, [F.max(~is_null(c)).alias(f"_has_{c}") for c in values])
    new = per_key(updates, [F.max(is_null(c)).alias(f"_gap_{c}") for c in values])
    met = old.alias("o").join(new.alias("n"), _nsafe_key_join(keys), "left")
    mixed = F.col("n._rows").isNull() | (F.col("o._rows") > 1)
    for c in values:
        mixed = mixed | (F.col(f"o._has_{c}") & F.col(f"n._gap_{c}"))
    mixed = if_small(met.filter(mixed).select(*[F.col(f"o.{k}").alias(k) for k in keys]))
    cols = [c for c in base.columns if c not in nulls.values()]
    part = lambda df, how: df.alias("o").join(mixed.alias("n"), _nsafe_key_join(keys), how).select(*cols)
    return part(updates, "left_anti").unionByName(upsert_coalesce(part(base, "left_semi"), part(updates, "left_semi"), keys))


def upsert_overwrite(base: DataFrame, updates: DataFrame, keys: Sequence[str],
                     columns: Sequence[str] | str = "*") -> DataFrame:
    """Insert; on conflict set `columns` (all non-keys for "*") to the new
    value, nulls included; other columns keep the old value."""
    cols = base.columns
    setc = [c for c in cols if c not in keys and c in updates.columns] if columns == "*" else list(columns)
    o = base.alias("o")
    n = updates.withColumn("_new", F.lit(True)).alias("n")
    j = o.join(n, _nsafe_key_join(keys), "full")
    is_new = F.col("n._new").isNotNull()
    old_exists = F.lit(False)
    for k in keys:
        old_exists = old_exists | F.col(f"o.{k}").isNotNull()
    out = []
    for c in cols:
        if c in keys:
            out.append(F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c))
        elif c in setc:
            out.append(F.when(is_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
        elif c in updates.columns:
            # inserted rows take every given column; conflicting rows keep the old value
            out.append(F.when(is_new & ~old_exists, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
        else:
            out.append(F.col(f"o.{c}").alias(c))
    return j.select(*out)


def combine_first(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge rows by key, an old non-null value wins, new fills gaps."""
    o, n = old.alias("o"), new.alias("n")
    j = o.join(n, _nsafe_key_join(keys), "full")
    cols = list(dict.fromkeys(list(old.columns) + [c for c in new.columns if c not in old.columns]))
    out = []
    for c in cols:
        parts = [F.col(f"{s}.{c}") for s, df in (("o", old), ("n", new)) if c in df.columns]
        out.append((F.coalesce(*parts) if len(parts) > 1 else parts[0]).alias(c))
    return j.select(*out)


def delete_range(df: DataFrame, chat_id: int, lo: int, hi: int, inclusive_low: bool = True) -> DataFrame:
    """Remove ids of one chat in [lo, hi] ((lo, hi] for the document store variant)."""
    if lo > hi:
        raise ValueError("lo must not exceed hi")
    low = (F.col("message_id") >= lo) if inclusive_low else (F.col("message_id") > lo)
    hit = (F.col("chat_id") == chat_id) & low & (F.col("message_id") <= hi)
    return df.filter(~F.coalesce(hit, F.lit(False)))


def delete_channel(df: DataFrame, chat_id: int) -> DataFrame:
    """Remove one chat (rows with a null chat id stay)."""
    return df.filter(~F.coalesce(F.col("chat_id") == chat_id, F.lit(False)))


def delete_range_everywhere(store: dict[str, DataFrame], chat_id: int, lo: int, hi: int,
                            inclusive_low: bool = True) -> dict[str, DataFrame]:
    """D04 over every table of a store that is keyed by message (polls, reactions, messages, ...)."""
    return {name: delete_range(df, chat_id, lo, hi, inclusive_low) if "message_id" in df.columns else df
            for name, df in store.items()}


def delete_channel_everywhere(store: dict[str, DataFrame], chat_id: int) -> dict[str, DataFrame]:
    """D05 over every table of a store that has a chat."""
    return {name: delete_channel(df, chat_id) if "chat_id" in df.columns else df for name, df in store.items()}


def advance_top_message(chats: DataFrame, messages: DataFrame) -> DataFrame:
    """Chats.top_message_id := max(message_id) of its messages (upsert)."""
    tops = messages.groupBy("chat_id").agg(F.max("message_id").alias("top_message_id"))
    return upsert_overwrite(chats, tops, ["chat_id"], ["top_message_id"])


def top_message_violations(chats: DataFrame, messages: DataFrame) -> DataFrame:
    """D06 check: messages newer than the chat's announced top message id."""
    c = chats.filter(F.col("top_message_id").isNotNull()).select("chat_id", "top_message_id")
    return (messages.join(c, "chat_id").filter(F.col("message_id") > F.col("top_message_id"))
            .groupBy("chat_id").agg(F.min("message_id").alias("first_violation"),
                                    F.count(F.lit(1)).alias("n_violations")))


def set_flag(chats: DataFrame, flags: DataFrame, column: str) -> DataFrame:
    """Upsert of one column (e.g. ongoing_write)."""
    base = chats if column in chats.columns else chats.withColumn(column, F.lit(None).cast(flags.schema[column].dataType))
    return upsert_overwrite(base, flags.select("chat_id", column), ["chat_id"], [column])


def dense_index(df: DataFrame, order: Sequence[str], start: int | Column = 1, name: str = "idx") -> DataFrame:
    """Consecutive ids in global `order` without pulling rows into one task.

    Sort (range-partitioned), tag each row with `monotonically_increasing_id`
    (partition id in the upper bits, position in the lower bits), count the
    rows per partition (one tiny row per partition), turn the counts into
    offsets and add them back with a broadcast of that tiny table.
    """
    from ..session import cut_lineage
    s = df.orderBy(*order).withColumn("_mono", F.monotonically_increasing_id())
    s = s.withColumn("_part", F.shiftright("_mono", 33)).withColumn("_pos", F.col("_mono").bitwiseAND((1 << 33) - 1))
    # Materialise once: counts and positions must come from the same range
    # partitioning (its bounds are sampled, so a re-run could cut differently).
    s = cut_lineage(s)
    counts = s.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    st = start if isinstance(start, Column) else F.lit(start)
    return (s.join(F.broadcast(offsets), "_part")
            .withColumn(name, (st + F.col("_off") + F.col("_pos")).cast("bigint"))
            .drop("_mono", "_part", "_pos", "_off"))


def dictionary_encode(values: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Extend `mapping(reaction_id, reaction, is_custom)` with unseen values.

    New values get ids after the current maximum in value order; is_custom
    marks values that are integers (custom emoji ids stored as strings).
    """
    new = (values.select(F.col(column).cast("string").alias("reaction")).filter(F.col("reaction").isNotNull())
           .distinct().join(mapping.select("reaction"), "reaction", "left_anti"))
    max_id = mapping.select(F.coalesce(F.max("reaction_id"), F.lit(0)).cast("bigint")).scalar()
    added = dense_index(new, ["reaction"], start=max_id + 1, name="reaction_id").select(
        F.col("reaction_id").cast("int").alias("reaction_id"), "reaction",
        F.col("reaction").rlike("^-?[0-9]+$").alias("is_custom"))
    return mapping.select("reaction_id", "reaction", "is_custom").unionByName(added)


#: Largest number of rows of a dimension that is sent to every task.
BROADCAST_ROWS = 200_000


def if_small(dimension: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a dimension of narrow rows whose counted size is small; else the frame as
    it is (a shuffled join, whose hot keys AQE splits)."""
    return F.broadcast(dimension) if dimension.limit(rows + 1).count() <= rows else dimension


def encode(values: DataFrame, column: str, mapping: DataFrame, id_col: str = "reaction_id") -> DataFrame:
    """Replace `column` by its dictionary id.  Most values are a few hot ones, so a dictionary of a
    checked size goes to the rows instead of the rows to it."""
    m = mapping.select(F.col("reaction").alias(column), F.col("reaction_id").alias(id_col))
    return values.join(if_small(m), column, "left")


def latest_setting(log: DataFrame) -> DataFrame:
    """Current `(project, key) -> value` from a change log `(project, key, value, seq, op)`.

    The newest entry per key wins; an `unset` tombstone removes the key.
    """
    last = log.groupBy("project", "key").agg(F.max_by(F.struct("op", "value", "seq"), "seq").alias("_l"))
    return (last.filter(F.col("_l.op") != "unset")
            .select("project", "key", F.col("_l.value").alias("value"), F.col("_l.seq").alias("last_updated")))


def get_setting(settings: DataFrame, requests: DataFrame, default: str | None = None) -> DataFrame:
    """D10 get: value for each requested (project, key), or the default."""
    r = requests.join(settings.select("project", "key", "value"), ["project", "key"], "left")
    return r.withColumn("value", F.coalesce(F.col("value"), F.lit(default)))


def pending_invite_links(chats: DataFrame, retry: bool = False) -> DataFrame:
    """Chats whose link is unknown (null); retry mode also revisits "" (fetched, none)."""
    cond = F.col("invite_link").isNull()
    if retry:
        cond = cond | (F.col("invite_link") == "")
    return chats.filter(cond)


def fill_invite_links(chats: DataFrame, links: DataFrame, retry: bool = False) -> DataFrame:
    """Upsert supplied links for pending chats ("" = fetched, no link)."""
    pending = pending_invite_links(chats, retry).select("chat_id")
    supplied = links.join(pending, "chat_id", "left_semi").select("chat_id", F.coalesce("invite_link", F.lit(""))
                                                                  .alias("invite_link"))
    return upsert_overwrite(chats, supplied, ["chat_id"], ["invite_link"])


def committed_dialogs(chats: DataFrame) -> DataFrame:
    """D14."""
    cols = [c if c in chats.columns else F.lit(None).cast("string").alias(c)
            for c in ("chat_id", "title", "top_message_id", "username", "invite_link")]
    return chats.select(*cols)


def distinct_union(stored: DataFrame, column: str, configured: DataFrame) -> DataFrame:
    """Distinct stored values united with a configured list."""
    return stored.select(column).unionByName(configured.select(column)).distinct()
