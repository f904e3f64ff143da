"""Reply threads and message chains (the recursive operators).

The reference walks reply links with a recursive CTE (one join per depth)
or a pandas loop.  Here every walk is built from one distributed
pointer-doubling pass (`paths`): each message keeps a pointer to its next
unresolved ancestor and the path covered so far; each round joins the
state with itself on `(chat_id, ptr) = (chat_id, id)`, so the covered
distance doubles and a thread of depth D is resolved in about log2(D)
rounds.  Every round is cut with a reliable checkpoint into the session's
checkpoint folder, so the plan stays small and a lost executor only
recomputes one round.  Texts and senders are gathered once at the end
(`gather`), never carried through the rounds.

All functions take the whole messages table and serve every chat at once;
the reference restricts them to one chat per call.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, cut_lineage_counting, scratch_path, stored
from .tables import if_small

MAX_ROUNDS = 64
#: Chain rows of one tree that are put together in one task; larger trees are dealt to several.
TREE_ROWS = 50_000
NEXT_MSG = "<<NEXTMSG>>"


class Late(NamedTuple):
    """Messages whose texts are kept elsewhere: `headers` have the other columns and `keys`, by which `with_text` adds
    the texts to the rows that are wanted, so that texts need not move to the links first."""
    headers: DataFrame
    keys: Sequence[str]
    with_text: Callable[[DataFrame], DataFrame]


#: Reads the texts of messages: `read(rows, places, out)` gives `rows` (with `chat_id`) with the texts at the column `places`,
#: an array of places, as `out` in its stead.  Messages then have the column `place` (null: no text) in place of `text`.
Read = Callable[[DataFrame, str, str], DataFrame]


def _read_items(chains: DataFrame, items: str, read: Read, descending: bool = False) -> DataFrame:
    """`chains` with the array `items` of (pos, place) as the texts in order, those of one pos by themselves."""
    rows = read(chains.withColumn("_pos", F.transform(items, _field("pos"))).withColumn("_places", F.transform(items, _field("place"))).drop(items),
                "_places", "_texts")
    both = F.zip_with("_pos", "_texts", lambda p, t: F.struct(p.alias("pos"), t.alias("text")))
    both = F.sort_array(both, asc=False) if descending else F.array_sort(both)
    return rows.withColumn(items, F.transform(both, _field("text"))).drop("_pos", "_texts")


def _edges(messages: DataFrame, parent: str = "reply_to_message_id") -> DataFrame:
    return messages.select("chat_id", F.col("message_id").alias("id"), F.col(parent).alias("ptr"))


def paths(messages: DataFrame, parent: str = "reply_to_message_id", max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """Walk every message towards its root while the parent exists.

    Returns `(chat_id, id, ptr, path, cycle)`: `path` is root side first and
    ends with `id`; `ptr` is null when a root was reached, else the id of a
    parent that is missing from the input (orphan).  `cycle` marks walks
    stopped because they met themselves (possible only with forward links).

    Each round joins the still-active walks with the current state of every
    node: settled nodes (root reached, orphan, cycle) are written once and
    then only read, so a round writes just the walks that are still moving.
    """
    state = cut_lineage(_edges(messages, parent).select(
        "chat_id", "id", "ptr", F.array("id").alias("path"), F.lit(False).alias("cycle")))
    settled = [state.filter(F.col("ptr").isNull())]
    active = state.filter(F.col("ptr").isNotNull())
    for _ in range(max_rounds):
        current = active
        for part in settled:
            current = current.unionByName(part)
        b = current.select(F.col("chat_id").alias("b_chat"), F.col("id").alias("b_id"),
                           F.col("ptr").alias("b_ptr"), F.col("path").alias("b_path"))
        j = active.join(b, (F.col("chat_id") == F.col("b_chat")) & (F.col("ptr") == F.col("b_id")), "left")
        hit = F.col("b_id").isNotNull()
        cyc = hit & F.arrays_overlap(F.col("b_path"), F.col("path"))
        ext = hit & ~cyc
        stepped = j.select(
            "chat_id", "id",
            F.when(ext, F.col("b_ptr")).otherwise(F.col("ptr")).alias("ptr"),
            F.when(ext, F.concat("b_path", "path")).otherwise(F.col("path")).alias("path"),
            cyc.alias("cycle"),
            # still walking: moved this round and has a further parent to look up
            (ext & F.col("b_ptr").isNotNull()).alias("_go"),
        )
        stepped, moving = cut_lineage_counting(stepped, F.col("_go"))
        # no match means the parent is missing (orphan): final, like roots and cycles
        settled.append(stepped.filter(~F.col("_go")).drop("_go"))
        active = stepped.filter(F.col("_go")).drop("_go")
        if moving == 0:
            out = settled[0]
            for part in settled[1:]:
                out = out.unionByName(part)
            return out
    raise RuntimeError(f"reply walk did not settle within {max_rounds} doubling rounds")


def jump_tables(messages: DataFrame, parent: str = "reply_to_message_id") -> tuple[list[DataFrame], DataFrame | None]:
    """Tables `(chat_id, id, up)`: table k leads from a message 2**k existing links up.

    Table k + 1 is table k joined with itself, so only messages that deep are left in it and a
    thread of depth D takes log2(D) rounds without any arrays.  Messages whose walk never ends
    (links in a circle) are returned as a second table `(chat_id, id)`: they are still there
    when the jump is longer than the number of links.
    """
    ids = messages.select("chat_id", F.col("message_id").alias("up"))
    edges = _edges(messages, parent).filter(F.col("ptr").isNotNull()).withColumnRenamed("ptr", "up")
    step, left = cut_lineage_counting(
        edges.join(ids, ["chat_id", "up"], "left_semi").select("chat_id", "id", "up"), F.lit(True))
    links, tables = left, []
    while left:
        if 2 ** len(tables) > links:
            return tables, step.select("chat_id", "id")
        tables.append(step)
        over = step.select("chat_id", F.col("id").alias("up"), F.col("up").alias("_up"))
        step, left = cut_lineage_counting(
            step.join(over, ["chat_id", "up"]).select("chat_id", "id", F.col("_up").alias("up")), F.lit(True))
    return tables, None


def paths_from(starts: DataFrame, tables: list[DataFrame], endless: DataFrame | None = None) -> DataFrame:
    """`(chat_id, start, id, pos)`: the walk of each start, `pos` links above it.

    Every number of links has one binary form, so taking each jump or not, the longest first,
    meets every ancestor of a start once: D rows for a walk of depth D.  Starts on endless walks
    are left out.
    """
    cur = starts.select("chat_id", F.col("message_id").alias("start"), F.col("message_id").alias("id"), F.lit(0).alias("pos"))
    if endless is not None:
        cur = cur.join(endless, ["chat_id", "id"], "left_anti").select("chat_id", "start", "id", "pos")
    for k in reversed(range(len(tables))):
        here = F.struct("id", "pos")
        there = F.struct(F.col("up").alias("id"), (F.col("pos") + F.lit(2 ** k)).cast("int").alias("pos"))
        cur = (cur.join(tables[k], ["chat_id", "id"], "left")
               .select("chat_id", "start", F.explode(F.when(F.col("up").isNull(), F.array(here)).otherwise(F.array(here, there))).alias("_s"))
               .select("chat_id", "start", "_s.id", "_s.pos"))
    return cur


def leaf_walks(messages: DataFrame) -> DataFrame:
    """`paths_from` every leaf: nothing is built for other messages."""
    tables, endless = jump_tables(messages)
    return paths_from(leaves(messages), tables, endless)


def _with_tops(walks: DataFrame) -> DataFrame:
    """One row per start: `(chat_id, start, top, walk)`, the end of its walk and the walk's (pos, id)."""
    return walks.groupBy("chat_id", "start").agg(F.max_by("id", "pos").alias("top"),
                                                 F.sort_array(F.collect_list(F.struct("pos", "id")), asc=False).alias("walk"))


def _to_root(walks: DataFrame, messages: DataFrame) -> DataFrame:
    """`_with_tops` of the walks that end at a message without a parent."""
    roots = messages.filter(F.col("reply_to_message_id").isNull()).select("chat_id", F.col("message_id").alias("top"))
    return _with_tops(walks).join(roots, ["chat_id", "top"], "left_semi")


def _steps(chains: DataFrame, walk: str = "walk") -> DataFrame:
    return chains.select("chat_id", "start", "top", F.explode(walk).alias("_s")).select("chat_id", "start", "top", "_s.pos", "_s.id")


def _in_trees(steps: DataFrame, messages: DataFrame, keys: Sequence[str], cols: Sequence[str], how: str = "inner",
              tree_rows: int = TREE_ROWS, late: Late | None = None) -> DataFrame:
    """`steps` (`chat_id`, `top`, `id`, `keys`, ...) joined with the message columns `cols`, and `_part`.

    A message goes to its tree (`top`), once however many chains of the tree hold it, and meets the chains there: the
    rows are hashed by `(chat_id, top, _part)`, and so is whatever groups by these and more.  A tree of more than
    `tree_rows` steps is dealt to several tasks by its chains (`_part`).  With `late` a text goes to its tree straight
    from where it is kept.  The column `no_text` may be asked for: it is known without carrying texts."""
    steps = stored(steps, "steps")  # ids only, read several times
    large = (steps.groupBy("chat_id", "top").agg(F.ceil(F.count(F.lit(1)) / tree_rows).alias("_parts")).filter("_parts > 1"))
    dealt = (steps.join(large, ["chat_id", "top"], "left")
             .withColumn("_part", F.coalesce(F.pmod(F.xxhash64(*keys), F.col("_parts")), F.lit(0).cast("long"))).drop("_parts"))
    place = ["chat_id", "top", "_part"]
    needed = dealt.select(*place, "id").distinct()
    stays = [c for c in cols if c not in ("text", "no_text")]
    if late is None:
        held = _no_text(messages.withColumnRenamed("message_id", "id")).select("chat_id", "id", *cols).join(needed, ["chat_id", "id"])
    else:
        found = late.headers.select("chat_id", F.col("message_id").alias("id"), *stays, *late.keys).join(needed, ["chat_id", "id"])
        held = _no_text(late.with_text(found)).select(*place, "id", *cols)
    both = dealt.withColumn("_held", F.lit(False)).unionByName(held.withColumn("_held", F.lit(True)), allowMissingColumns=True)
    # a window and not a join: it keeps the rows where they are, also for the grouping that follows
    w = Window.partitionBy(*place, "id")
    # a task sorts the texts of about `tree_rows` steps, however few partitions the session has
    parts = math.ceil(steps.count() / tree_rows)
    dealt_out = both.repartition(parts, *place) if parts > int(steps.sparkSession.conf.get("spark.sql.shuffle.partitions")) else both.repartition(*place)
    mine = dealt_out.select(
        *steps.columns, "_part", "_held", F.count_if("_held").over(w).cast("int").alias("_n"),
        *[F.collect_list(F.when(F.col("_held"), F.struct(c))).over(w).alias(f"_h_{c}") for c in cols]).filter(~F.col("_held"))
    each = F.sequence(F.lit(0), F.col("_n") - 1)
    none = F.array(F.lit(None).cast("int")) if how == "left" else F.array().cast("array<int>")
    mine = mine.withColumn("_i", F.explode(F.when(F.col("_n") > 0, each).otherwise(none)))
    return mine.select(*steps.columns, "_part", *[F.get(f"_h_{c}", F.col("_i")).getField(c).alias(c) for c in cols])


def _no_text(messages: DataFrame) -> DataFrame:
    for c in ("text", "place"):
        if c in messages.columns:
            return messages.withColumn("no_text", F.col(c).isNull())
    return messages


def gather(chains: DataFrame, messages: DataFrame, keys: Sequence[str], chain_col: str,
           cols: Sequence[str], tree: str | None = None, tree_rows: int = TREE_ROWS, read: Read | None = None) -> DataFrame:
    """For each chain of ids, arrays of `cols` in chain order (nulls kept).  With `read` a text moves as its place.

    `posexplode` the chain, meet the messages on `(chat_id, message_id)` in the chains' trees, then collect
    `(pos, col)` per chain key and sort by position.  Ids missing from `messages` yield nulls.  `keys` hold the
    chat and tell chains apart; `tree` names the column with the root that chains of one tree share (without
    it the chain's last id counts as such).
    """
    cols = [c if read is None or c != "text" else "place" for c in cols]
    top = F.col(tree) if tree else F.element_at(chain_col, -1)
    x = chains.select(*keys, top.alias("top"), F.posexplode(chain_col).alias("pos", "id"))
    j = _in_trees(x, messages, keys, cols, "left", tree_rows)
    at = lambda c: F.array_sort(F.collect_list(F.struct("pos", c)))
    # one list per column, so that those nobody asks for are never moved
    g = j.groupBy(*dict.fromkeys([*keys, "chat_id", "top", "_part"])).agg(at("id").alias("_id"), *[at(c).alias(f"_l_{c}") for c in cols])
    # the id chain is rebuilt from the gathered items, so callers need no join back
    if "place" not in cols:
        return g.select(*keys, F.transform("_id", _field("id")).alias(chain_col),
                        *[F.transform(f"_l_{c}", _field(c)).alias(f"{c}_chain") for c in cols])
    g = g.select(*dict.fromkeys([*keys, "chat_id"]), F.transform("_id", _field("id")).alias("_ids"),
                 *[("_l_place" if c == "place" else F.transform(f"_l_{c}", _field(c)).alias(f"_l_{c}")) for c in cols])
    return _read_items(g, "_l_place", read).select(
        *keys, F.col("_ids").alias(chain_col), *[F.col(f"_l_{c}").alias(f"{'text' if c == 'place' else c}_chain") for c in cols])


def _field(name: str):
    return lambda s: s.getField(name)


# G07 / J10 ------------------------------------------------------------------

def leaf_flags(messages: DataFrame) -> DataFrame:
    """leaf = no message of the same chat replies to it."""
    parents = (messages.filter(F.col("reply_to_message_id").isNotNull())
               .select("chat_id", F.col("reply_to_message_id").alias("message_id"))
               .distinct().withColumn("_has_child", F.lit(True)))
    return (messages.select("chat_id", "message_id").join(parents, ["chat_id", "message_id"], "left")
            .select("chat_id", "message_id", F.col("_has_child").isNull().alias("leaf")))


def leaves(messages: DataFrame) -> DataFrame:
    # distinct parents: a message with very many replies becomes one row before the shuffle
    parents = messages.select("chat_id", F.col("reply_to_message_id").alias("message_id")).distinct()
    return messages.join(parents, ["chat_id", "message_id"], "left_anti")


def linked_sender(messages: DataFrame, chats: DataFrame) -> DataFrame:
    """sent_by_linked_chat = sender_id == chats.linked_chat_id, null -> false."""
    c = if_small(chats.select("chat_id", "linked_chat_id"))  # texts need not move for it
    return (messages.join(c, "chat_id", "left")
            .withColumn("sent_by_linked_chat",
                        F.coalesce(F.col("sender_id") == F.col("linked_chat_id"), F.lit(False)))
            .drop("linked_chat_id"))


# G01 / G02 / G03 / G04 / G05 -------------------------------------------------

def _walks(p: DataFrame) -> DataFrame:
    """Every prefix of every walk: (chat_id, start, step, ancestor, ancestor_parent, chain start-first)."""
    rev = F.reverse("path")
    x = p.select("chat_id", F.col("id").alias("start"), "ptr", rev.alias("rev"),
                 F.posexplode(rev).alias("step", "ancestor"))
    n = F.size("rev")
    return x.select(
        "chat_id", "start", "step", "ancestor",
        F.when(F.col("step") + 1 < n, F.element_at("rev", F.col("step") + 2)).otherwise(F.col("ptr"))
         .alias("ancestor_parent"),
        F.slice("rev", 1, F.col("step") + 1).alias("msg_chain"),
    )


def chain_steps(messages: DataFrame) -> DataFrame:
    """Every partial walk; (chat_id, message_id = ancestor, its reply_to, chain start-first)."""
    w = _walks(paths(messages))
    return w.select("chat_id", F.col("ancestor").alias("message_id"),
                    F.col("ancestor_parent").alias("reply_to_message_id"), "msg_chain")


def chain_steps_by_start(messages: DataFrame) -> DataFrame:
    """As G01 but reporting the start id."""
    w = _walks(paths(messages))
    return w.select("chat_id", F.col("start").alias("message_id"),
                    F.col("ancestor_parent").alias("reply_to_message_id"), "msg_chain")


def chains_to_root(messages: DataFrame, p: DataFrame | None = None) -> DataFrame:
    """Walks that reached a root: (chat_id, first_msg_id = root, last_msg_id = start, chain start-first)."""
    p = paths(messages) if p is None else p
    r = p.filter(F.col("ptr").isNull() & ~F.col("cycle"))
    return r.select("chat_id", F.col("path")[0].alias("first_msg_id"), F.col("id").alias("last_msg_id"),
                    F.reverse("path").alias("msg_chain"))


def chains_text(messages: DataFrame, read: Read | None = None) -> DataFrame:
    """G03 plus the texts in chain order (`read`: as in `gather`)."""
    c = chains_to_root(messages)
    g = gather(c, messages, ["chat_id", "last_msg_id"], "msg_chain", ["text"], "first_msg_id", read=read)
    return g.select("chat_id", "last_msg_id", "msg_chain", "text_chain")


def anti_prefix_rows(chains: DataFrame, messages: DataFrame) -> DataFrame:
    """Drop chains whose start message is replied to by some message."""
    r = messages.select("chat_id", F.col("reply_to_message_id").alias("last_msg_id")).distinct()
    return chains.join(r, ["chat_id", "last_msg_id"], "left_anti")


def maximal_chains(messages: DataFrame) -> DataFrame:
    """Root-first chains that reach a root and end at a leaf."""
    g = _to_root(leaf_walks(messages), messages)
    return g.select("chat_id", F.col("top").alias("root_id"), F.col("start").alias("leaf_id"), F.transform("walk", _field("id")).alias("msg_chain"))


# G06 ----------------------------------------------------------------------

def message_threads(messages: DataFrame, start, end=None, chat_ids: Sequence[int] | None = None, read: Read | None = None) -> DataFrame:
    """G06 `get_message_threads`: walks restricted to the inclusive date window at
    every step, kept only if they reach a root inside it; threads extended by
    another kept thread are dropped; ids, senders and texts root first.  With `read` a text moves as its place."""
    text = "text" if read is None else "place"
    m = messages.filter(F.col("date") >= F.lit(str(start)).cast("timestamp_ntz"))
    if end is not None:
        m = m.filter(F.col("date") <= F.lit(str(end)).cast("timestamp_ntz"))
    if chat_ids is not None:
        m = m.filter(F.col("chat_id").isin(list(chat_ids)))
    # A thread extended by another kept thread ends at a message with a reply in the window,
    # and every thread through that reply is kept as well; so the maximal threads end at leaves
    x = _in_trees(_steps(_to_root(leaf_walks(m), m)), m, ["chat_id", "start"], ["sender_id", text])
    at = lambda c: F.sort_array(F.collect_list(F.struct("pos", c)), asc=False)
    g = x.groupBy("chat_id", "start", "top", "_part").agg(at("id").alias("_id"), at("sender_id").alias("_sender"), at(text).alias("_text"))
    g = g.select("chat_id", F.transform("_id", _field("id")).alias("msg_id_chain"),
                 F.transform("_sender", _field("sender_id")).alias("sender_id_chain"), F.col("_text").alias("text_chain"))
    if read is None:
        return g.withColumn("text_chain", F.transform("text_chain", _field("text")))
    return _read_items(g, "text_chain", read, descending=True)


# G08 ----------------------------------------------------------------------

def message_chain(messages: DataFrame, chats: DataFrame, late: Late | None = None, mark: bool = False, read: Read | None = None,
                  items: bool = False) -> DataFrame:
    """One row per leaf; walk up while the parent exists (root or orphan).

    chain = texts leaf first joined by `<<NEXTMSG>>` (null if any text is
    null); first_message_id = last ancestor found; sent_by_linked_chat = OR of
    the per-message flag along the chain.  `mark` adds `no_chain`, whether the chain is null, which is known
    without texts.  With `read` a text moves as its place; with `items` the chain is left as its (pos, place), for `chain_texts`.
    """
    text = "text" if read is None else "place"
    m = linked_sender(messages, chats)
    steps = _steps(_with_tops(leaf_walks(m)))
    if late is not None:
        late = late._replace(headers=linked_sender(late.headers, chats))
    x = _in_trees(steps, m, ["chat_id", "start"], [text, "no_text", "sent_by_linked_chat"], late=late)
    g = x.groupBy("chat_id", "start", "top", "_part").agg(
        F.max("sent_by_linked_chat").alias("sent_by_linked_chat"),
        F.max("no_text").alias("_null_text"), F.count(F.lit(1)).cast("int").alias("chain_len"),
        F.array_sort(F.collect_list(F.struct("pos", text))).alias("_items"))
    chain = F.array_join(F.transform("_items", _field("text")), NEXT_MSG) if read is None else F.col("_items")
    g = g.select("chat_id", "sent_by_linked_chat", F.col("top").alias("first_message_id"), F.col("start").alias("last_message_id"),
                 F.when(~F.col("_null_text"), chain).alias("chain"), "chain_len",
                 *([F.col("_null_text").alias("no_chain")] if mark else []))
    return g if read is None or items else chain_texts(g, read)


def chain_texts(chains: DataFrame, read: Read) -> DataFrame:
    """Chains of (pos, place) with their texts."""
    return _read_items(chains, "chain", read).withColumn("chain", F.array_join("chain", NEXT_MSG)).select(*chains.columns)


# J13 / J14 ---------------------------------------------------------------------

def reply_pairs(messages: DataFrame) -> DataFrame:
    """Child m ⋈ parent mt on m.chat_id = mt.chat_id and mt.message_id = m.reply_to."""
    parent = messages.select("chat_id", F.col("message_id").alias("reply_to_message_id"),
                             F.col("sender_id").alias("parent_sender_id"), F.col("date").alias("parent_date"))
    return messages.select("chat_id", "message_id", "reply_to_message_id").join(
        parent, ["chat_id", "reply_to_message_id"])


def reply_or_forward_pairs(messages: DataFrame) -> DataFrame:
    """Source m of child mt by reply OR forward, as a union of two equi-joins.

    A disjunctive join condition would become a nested-loop join; the second
    branch excludes pairs already produced by the first so that each pair
    appears once, as with the OR condition.
    """
    child = messages.select(F.col("chat_id").alias("child_chat_id"), F.col("message_id").alias("child_id"),
                            "reply_to_message_id", "forward_from_chat_id", "forward_from_message_id")
    src = messages.select(F.col("chat_id").alias("src_chat_id"), F.col("message_id").alias("src_id"))
    by_reply = child.join(src, (F.col("child_chat_id") == F.col("src_chat_id"))
                          & (F.col("reply_to_message_id") == F.col("src_id")))
    by_fwd = child.join(src, (F.col("forward_from_chat_id") == F.col("src_chat_id"))
                        & (F.col("forward_from_message_id") == F.col("src_id")))
    also_reply = (F.col("child_chat_id") == F.col("src_chat_id")) & (F.col("reply_to_message_id") == F.col("src_id"))
    by_fwd = by_fwd.filter(~F.coalesce(also_reply, F.lit(False)))
    cols = ["child_chat_id", "child_id", "src_chat_id", "src_id"]
    return by_reply.select(*cols).unionByName(by_fwd.select(*cols))


# G09 ----------------------------------------------------------------------

CLOSURE_COLS = ["chat_id", "message_id", "sender_id", "text", "reply_to_message_id",
                "forward_from_chat_id", "forward_from_message_id"]


#: Hash folders of the staged links, and steps after which links are squared instead.
LINK_FOLDERS = 64
DEEP = 16
_PAIR, _KEY = ["chat_id", "message_id", "to_chat", "to_id"], ["chat_id", "message_id"]


def _folder(chat: str, message: str):
    return F.pmod(F.xxhash64(chat, message), F.lit(LINK_FOLDERS)).cast("int")


def _folders(frontier: DataFrame) -> list[int]:
    return [r["f"] for r in frontier.select(_folder("chat_id", "message_id").alias("f")).distinct().collect()]  # at most LINK_FOLDERS


def _links(messages: DataFrame, replies: bool, forwards: bool) -> DataFrame | None:
    """Distinct links to messages that exist."""
    links = []
    if replies:
        links.append(messages.select("chat_id", "message_id", F.col("chat_id").alias("to_chat"),
                                     F.col("reply_to_message_id").alias("to_id")))
    if forwards:
        links.append(messages.select("chat_id", "message_id", F.col("forward_from_chat_id").alias("to_chat"),
                                     F.col("forward_from_message_id").alias("to_id")))
    if not links:
        return None
    # a source reached by both links counts once, as with an OR join
    edges = (links[0] if len(links) == 1 else links[0].unionByName(links[1])).filter("to_chat is not null and to_id is not null").distinct()
    there = messages.select(F.col("chat_id").alias("to_chat"), F.col("message_id").alias("to_id"))
    return edges.join(there, ["to_chat", "to_id"], "left_semi").select(*_PAIR)


def _ways(df: DataFrame, keys: list[str], n, distinct: bool) -> DataFrame:
    return df.groupBy(*keys).agg((F.max(F.lit(1).cast("long")) if distinct else F.sum(n)).alias("n"))


def _by_powers(reached: DataFrame, links: DataFrame, distinct: bool) -> DataFrame:
    """(1 + A)(1 + A^2)(1 + A^4).. times `reached`: the powers of the links are squared until none is left and the
    seed is multiplied through them, the longest first: 2 log2(depth) rounds over all links."""
    power, left = cut_lineage_counting(links.select(*_PAIR, F.lit(1).cast("long").alias("n")), F.lit(True))
    n_links, powers = left, []
    while left and 2 ** len(powers) <= n_links:
        powers.append(power)
        on = power.select(F.col("chat_id").alias("to_chat"), F.col("message_id").alias("to_id"), F.col("to_chat").alias("_chat"),
                          F.col("to_id").alias("_id"), F.col("n").alias("_n"))
        two = power.join(on, ["to_chat", "to_id"]).select(*_KEY, F.col("_chat").alias("to_chat"), F.col("_id").alias("to_id"), "n", "_n")
        power, left = cut_lineage_counting(_ways(two, _PAIR, F.col("n") * F.col("_n"), distinct), F.lit(True))
    if left and not distinct:
        raise RuntimeError("the links run in a circle: a closure with duplicates has no end")
    for power in reversed(powers):
        step = power.withColumnRenamed("n", "_n").join(reached, _KEY).select(
            F.col("to_chat").alias("chat_id"), F.col("to_id").alias("message_id"), (F.col("n") * F.col("_n")).alias("n"))
        reached = cut_lineage(_ways(reached.unionByName(step), _KEY, F.col("n"), distinct))
    return reached


def _by_steps(seed: DataFrame, edges: DataFrame, distinct: bool, deep: int) -> DataFrame:
    """Semi-naive: a step follows just what the last one reached for the first time (with duplicates: reached at
    all), through the hash folders of links that hold it; circles end since nothing in them is new.  A frontier that
    spreads over most folders, or is still there after `deep` steps, is left to `_by_powers`."""
    spark = seed.sparkSession
    frontier = seen = stored(seed)
    path, schema = None, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in edges.schema.fields) + ", folder int"
    for step in range(deep + 1):
        folders = _folders(frontier)
        if not folders:
            return _ways(seen, _KEY, F.col("n"), distinct)
        if 2 * len(folders) > LINK_FOLDERS or step == deep:
            break
        if path is None:
            path = scratch_path(spark, "links")
            (edges.withColumn("folder", _folder("chat_id", "message_id")).repartition(LINK_FOLDERS, "folder")
             .write.partitionBy("folder").parquet(path))
        links = spark.read.schema(schema).parquet(path).filter(F.col("folder").isin(folders))
        met = _ways(links.join(frontier, _KEY).select(F.col("to_chat").alias("chat_id"), F.col("to_id").alias("message_id"), "n"),
                    _KEY, F.col("n"), distinct)
        frontier = stored(met.join(seen.select(*_KEY), _KEY, "left_anti") if distinct else met)
        seen = seen.unionByName(frontier)
    rest = _by_powers(frontier, spark.read.schema(schema).parquet(path).select(*_PAIR) if path else edges, distinct)
    if path is None:
        return rest
    if not distinct:
        seen = seen.unionByName(frontier.withColumn("n", -F.col("n")))  # the frontier is counted by both
    return _ways(seen.unionByName(rest), _KEY, F.col("n"), distinct)


def ancestor_closure(seed: DataFrame, messages: DataFrame, replies: bool = True, forwards: bool = False,
                     distinct: bool = False, deep: int = DEEP, late: Late | None = None) -> DataFrame:
    """Seed rows plus their reply parents and/or forward sources, repeatedly.

    `distinct=False` keeps duplicates like UNION ALL (a message reachable from k seeds, or in k
    ways, appears k times); `distinct=True` returns each reachable message once and is safe on
    cyclic links (with duplicates a cycle has no end: an error).  `seed`: rows of `messages`.

    From a narrow seed each step follows only what the last one reached, through links staged in hash folders.  A
    wide frontier, and chains of more than `deep` links, are finished in a logarithmic number of rounds by squaring
    the links.  Numbers of ways are counted, not rows repeated.  With `late` what was reached is looked up among
    rows without texts, and these get theirs from where they are kept, so that no text of `messages` is moved to be met.
    """
    cols = [c for c in CLOSURE_COLS if c in messages.columns]
    reached = _ways(seed.select(*_KEY), _KEY, F.lit(1).cast("long"), distinct)
    edges = _links(messages, replies, forwards)
    if edges is not None:
        reached = _by_steps(reached, edges, distinct, deep)
    if late is None:
        rows = reached.join(messages.select(*cols), _KEY)
    else:
        rows = late.with_text(reached.join(late.headers.select(*[c for c in cols if c != "text"], *late.keys), _KEY))
    if not distinct:
        rows = rows.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("n").cast("int"))))
    return rows.select(*cols)
