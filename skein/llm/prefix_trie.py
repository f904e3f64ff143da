"""Prefix trie of conversations, packed per prefix shard into double arrays.

Method.  Every conversation becomes a path of turn digests (`turns`).  Paths are dealt by
range on (path, conversation), so a partition holds a contiguous piece of the sorted paths
and is cut into prefix shards of a bounded number of conversations and turns.  A shard
gives its turns dense ids and packs its trie into BASE and CHECK: the child of state s
under turn id t is cell BASE[s] + t, and CHECK of that cell is s.  Walking all paths level
by level through the arrays gathers members and smallest members; one pass from the
deepest level up gathers what a subtree holds.

Merging.  Only nodes on a shard's first and last path can be in another shard too.  Those
upper nodes' aggregates are merged globally, by the digest of their prefix.  Counts of
members and (members x words) add up; a node that an earlier shard has as well counts its
word and its edge once, and a last path that a later shard repeats or extends leaves the
leaf to that shard.

Scale.  Two shuffles of digests (no texts): by group of twenty conversations, and by range.
A first turn or a whole conversation that a third of all rows share is spread over as many
shards as its conversations need, since the range key ends with the conversation's id.
The ids that end at a shared node are joined per shard and digested in order by a stream.

Defined cases.  A null role or text counts as empty; null turns come first; rows of one
turn are ordered by their digest; repeated rows are turns like others.  Rows without a
conversation id are left out (no conversation to rebuild).  An empty table has no nodes,
not even a root.  Extra columns are not read."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.tables import if_small
from .common import batch_maker, staged
from .turns import WIDTH, WORD, path_of, turn_digest

#: A shard ends with this many conversations or turns (one longer conversation is a shard of its own).
SHARD_CONVS = 100_000
SHARD_TURNS = 400_000
#: Ids of a shared path's members that one row carries.
CHUNK_IDS = 20_000
#: Conversations whose first turns come from one donor, and the most turns taken.
DONOR_SPAN = 20
MAX_HEAD = 3

PARTS = ("kind string, shard long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "sum_nw long, sum_w long, word long, ends binary, key string, parent_key string, on_first boolean, on_last boolean, "
         "seq long, ids string")


def rebuilt_paths(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text", span: int = DONOR_SPAN, heads: int = MAX_HEAD + 1) -> DataFrame:
    """`conv_id, path, words`: every conversation after taking its first `crc32(id) % heads` turns from
    the conversation whose id is the next lower multiple of `span`.

    One shuffle: the rows are dealt by donor, which keeps a conversation's rows together as well."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    conv = F.col(conv_col).cast("long")
    rows = conversations.filter(conv.isNotNull()).select(
        conv.alias("conv_id"), (conv - conv % span).alias("donor"),
        F.struct(F.col(turn_col).alias("turn"), turn_digest(role, text).alias("key"),
                 F.regexp_count(text, F.lit(WORD)).alias("words")).alias("t"))
    own = (rows.repartition("donor").groupBy("donor", "conv_id")
           .agg(F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t.key.alias("key"), t.words.alias("words"))).alias("own")))
    first = F.when(F.col("conv_id") == F.col("donor"), F.slice("own", 1, heads - 1))
    given = own.withColumns({
        "head": F.first(first, ignorenulls=True).over(Window.partitionBy("donor")),
        "h": (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")})
    none = F.slice("own", 1, F.lit(0))
    turns = F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
                     F.slice("own", F.col("h") + 1, F.greatest(F.size("own") - F.col("h"), F.lit(0))))
    return (given.select("conv_id", turns.alias("turns"))
            .select("conv_id", path_of(F.transform("turns", lambda t: t.key)).alias("path"),
                    F.transform("turns", lambda t: t.words).alias("words")))


@dataclass
class Entry:
    """A distinct path of a shard: its turns' digests, their words, and the members that end here."""
    path: bytes
    turns: np.ndarray
    words: np.ndarray
    ids: list[int] = field(default_factory=list)


class DoubleArray:
    """A trie in two arrays: BASE and CHECK, over labels 0, 1, ..

    The root is state 0.  Nodes with several children are placed first, most children first, at
    the first place where all their cells are free (after a few tries: at the end); all single
    children then fill the cells that are left."""

    TRIES = 32

    def __init__(self, parent: np.ndarray, label: np.ndarray):
        """Node i + 1 has `parent[i]` and `label[i]`; a parent comes before its children; the root is node 0."""
        n = len(parent) + 1
        order = np.lexsort((label, parent))
        by_parent, labels = parent[order], label[order]
        starts = np.flatnonzero(np.concatenate(([True], by_parent[1:] != by_parent[:-1]))) if n > 1 else np.empty(0, np.int64)
        sizes = np.diff(np.append(starts, n - 1))
        free = np.ones(2 * n + int(label.max(initial=0)) + 2, bool)
        free[0] = False
        base = np.zeros(n, np.int64)
        cell = np.zeros(n, np.int64)
        cursor, end = 1, 1
        many = np.flatnonzero(sizes > 1)
        for i in many[np.argsort(-sizes[many], kind="stable")].tolist():
            span = slice(starts[i], starts[i] + sizes[i])
            want = labels[span]
            reach = want - want[0]
            while cursor < len(free) and not free[cursor]:
                cursor += 1
            at = end
            for place in cursor + np.flatnonzero(free[cursor:cursor + 4 * self.TRIES])[:self.TRIES]:
                cells = place + reach
                if cells[-1] < len(free) and free[cells].all():
                    at = int(place)
                    break
            cells = at + reach
            if cells[-1] >= len(free):
                free = np.concatenate((free, np.ones(int(cells[-1]) + len(free), bool)))
            free[cells] = False
            end = max(end, int(cells[-1]) + 1)
            base[by_parent[starts[i]]] = at - want[0]
            cell[order[span] + 1] = cells
        single = starts[sizes == 1]
        spots = np.flatnonzero(free)[:len(single)]
        if len(spots) < len(single):
            spots = np.concatenate((spots, len(free) + np.arange(len(single) - len(spots))))
        base[by_parent[single]] = spots - labels[single]
        cell[order[single] + 1] = spots
        size = int(cell.max(initial=0)) + 1
        self.base = np.zeros(size, np.int64)
        self.check = np.full(size, -1, np.int64)
        self.base[cell] = base
        self.check[cell[1:]] = cell[parent]
        self.check[0] = 0

    def step(self, state: np.ndarray, label: np.ndarray) -> np.ndarray:
        """The states reached from `state` under `label`; -1 where there is no such child."""
        to = self.base[state] + label
        inside = (to > 0) & (to < len(self.check))
        return np.where(inside & (self.check[np.where(inside, to, 0)] == state), to, -1)


def trie_edges(entries: list[Entry]) -> tuple[np.ndarray, np.ndarray]:
    """Parent and place of the turn (in the shard's joined turns) of every node below the root,
    nodes numbered in the order of the sorted paths."""
    parents, places = [], []
    stack, before, n, offset = np.zeros(1, np.int64), np.empty(0, f"S{WIDTH}"), 1, 0
    for e in entries:
        both = min(len(before), len(e.turns))
        differ = np.flatnonzero(before[:both] != e.turns[:both])
        same = int(differ[0]) if len(differ) else both
        new = np.arange(n, n + len(e.turns) - same)
        stack = np.concatenate((stack[:same + 1], new))
        parents.append(stack[same:-1])
        places.append(np.arange(offset + same, offset + len(e.turns)))
        n += len(new)
        offset += len(e.turns)
        before = e.turns
    return np.concatenate([np.empty(0, np.int64), *parents]), np.concatenate([np.empty(0, np.int64), *places])


def first_use(values: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each value (0, 1, ..) its rank by first use along `order`."""
    used, first = np.unique(values[order], return_index=True)
    rank = np.zeros(int(values.max(initial=0)) + 1, np.int64)
    rank[used[np.argsort(first, kind="stable")]] = np.arange(len(used))
    return rank


def prefix_keys(path: bytes) -> list[str]:
    """Digests of all prefixes of a path, from the root's on."""
    h = hashlib.md5(usedforsecurity=False)
    keys = [h.hexdigest()]
    for i in range(0, len(path), WIDTH):
        h.update(path[i:i + WIDTH])
        keys.append(h.hexdigest())
    return keys


def shard_rows(shard: int, entries: list[Entry]) -> Iterator[dict]:
    """Columns of the shard's nodes (complete ones, then those on its first and last path with ids)."""
    lengths = np.array([len(e.turns) for e in entries], np.int64)
    offsets = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    turns = np.concatenate([np.empty(0, f"S{WIDTH}"), *(e.turns for e in entries)])
    words = np.concatenate([np.empty(0, np.int64), *(e.words for e in entries)])
    members = np.array([len(e.ids) for e in entries], np.int64)
    least = np.array([e.ids[0] for e in entries], np.int64)

    # dense ids by first use from the top down: siblings get neighbouring ids
    names = np.unique(turns, return_inverse=True)[1].astype(np.int64)
    parent, place = trie_edges(entries)
    depth_of_place = np.arange(len(turns)) - np.repeat(offsets, lengths)
    dense = first_use(names, place[np.argsort(depth_of_place[place], kind="stable")])[names] if len(turns) else names
    trie = DoubleArray(parent, dense[place])

    # walk all paths through the arrays, a level at a time
    size = len(trie.check)
    n, low, word, level = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max), np.zeros(size, np.int64), np.full(size, -1, np.int64)
    longest = np.argsort(-lengths, kind="stable")
    state = np.zeros(len(entries), np.int64)
    n[0], low[0], level[0] = members.sum(), least.min(), 0
    active, levels = len(entries), []
    for d in range(int(lengths.max(initial=0))):
        while lengths[longest[active - 1]] <= d:
            active -= 1
        who = longest[:active]
        at = offsets[who] + d
        to = trie.step(state[who], dense[at])
        assert (to >= 0).all(), "a path is not in its own trie"
        state[who] = to
        np.add.at(n, to, members[who])
        np.minimum.at(low, to, least[who])
        word[to], level[to] = words[at], d + 1
        levels.append(np.unique(to))

    # what subtrees hold, from the deepest level up
    children = np.bincount(trie.check[1:][trie.check[1:] >= 0], minlength=size)
    leaves = ((children == 0) & (level >= 0)).astype(np.int64)
    sum_nw, sum_w = n * word, word.copy()
    for at in reversed(levels):
        up = trie.check[at]
        for total in (leaves, sum_nw, sum_w):
            np.add.at(total, up, total[at])

    ends: dict[int, Entry] = {int(s): e for s, e in zip(state, entries)}
    spine: dict[int, tuple[str, str | None, bool, bool]] = {}
    for e, first in ((entries[0], True), (entries[-1], False)):
        s = np.zeros(1, np.int64)
        keys = prefix_keys(e.path)
        for d, key in enumerate(keys):
            if d:
                s = trie.step(s, dense[offsets[0 if first else -1] + d - 1:][:1])
            was = spine.get(int(s[0]), (key, None, False, False))
            spine[int(s[0])] = (key, keys[d - 1] if d else None, was[2] or first, was[3] or not first)

    nodes = np.flatnonzero(level >= 0)
    kept = nodes[~np.isin(nodes, np.fromiter(spine, np.int64))]

    def columns(kind: str, at: np.ndarray) -> dict:
        up = trie.check[at]
        return {"kind": [kind] * len(at), "shard": np.full(len(at), shard), "conv_id": low[at], "depth": level[at],
                "parent_conv_id": low[up], "n_convs": n[at], "n_children": children[at], "n_leaves": leaves[at],
                "sum_nw": sum_nw[at], "sum_w": sum_w[at], "word": word[at]}

    out = columns("node", kept)
    out["ends"] = [ids_digest(ends[s].ids) if s in ends else None for s in kept.tolist()]
    out["parent_key"] = [spine[s][0] if s in spine else None for s in trie.check[kept].tolist()]
    yield out
    at = np.fromiter(spine, np.int64)
    out = columns("spine", at)
    for i, name in enumerate(("key", "parent_key", "on_first", "on_last")):
        out[name] = [spine[s][i] for s in at.tolist()]
    yield out
    chunks = [(spine[s][0], i, ends[s].ids[i:i + CHUNK_IDS]) for s in spine if s in ends for i in range(0, len(ends[s].ids), CHUNK_IDS)]
    if chunks:
        yield {"kind": ["ids"] * len(chunks), "shard": [shard] * len(chunks), "key": [c[0] for c in chunks],
               "seq": [c[1] for c in chunks], "ids": [",".join(map(str, c[2])) for c in chunks]}


def ids_digest(ids: list[int]) -> bytes:
    return hashlib.sha256(",".join(map(str, ids)).encode()).digest()


def shard_tries(paths: DataFrame, shard_convs: int = SHARD_CONVS, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of every prefix shard, dealt by range on (path, conversation)."""
    dealt = paths.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    as_batch = batch_maker(PARTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        entries: list[Entry] = []
        convs = turns = 0
        for batch in batches:
            column = batch.column(2)
            starts, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False).astype(np.int64)
            for conv_id, path, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), starts[:-1], starts[1:]):
                if convs and (convs >= shard_convs or turns + (b - a) > shard_turns):
                    yield from map(as_batch, shard_rows(shard, entries))
                    shard, entries, convs, turns = shard + 1, [], 0, 0
                raw = path.encode("ascii")
                if not entries or entries[-1].path != raw:
                    entries.append(Entry(raw, np.frombuffer(raw, f"S{WIDTH}"), flat[a:b].copy()))
                    turns += b - a
                entries[-1].ids.append(conv_id)
                convs += 1
        if entries:
            yield from map(as_batch, shard_rows(shard, entries))

    return dealt.select("conv_id", "path", "words").mapInArrow(run, PARTS)


def merged_upper_nodes(parts: DataFrame) -> DataFrame:
    """`key, parent_key` and the whole aggregates of the nodes on first and last paths of shards."""
    spine = parts.filter("kind = 'spine'")
    by_key, by_shard = Window.partitionBy("key"), Window.partitionBy("shard")
    below = by_shard.orderBy(F.desc("depth")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    child = by_shard.orderBy("depth").rangeBetween(1, 1)
    again = (F.col("on_first") & (F.col("shard") > F.col("first_shard"))).cast("long")
    marked = (spine.withColumns({"first_shard": F.min("shard").over(by_key), "last_shard": F.max("shard").over(by_key)})
              .withColumns({"again": again, "goes_on": (F.col("shard") < F.col("last_shard")).cast("long")})
              .withColumns({
                  "again_w": F.sum(F.col("again") * F.col("word")).over(below),
                  "again_child": F.coalesce(F.max("again").over(child), F.lit(0)),
                  "left_leaf": F.max_by(F.when(F.col("on_last"), F.col("goes_on")),
                                        F.when(F.col("on_last"), F.col("depth"))).over(by_shard)}))
    once = marked.withColumns({
        "w": F.col("sum_w") - F.when(F.col("on_first"), F.col("again_w")).otherwise(0),
        "c": F.col("n_children") - F.when(F.col("on_first"), F.col("again_child")).otherwise(0),
        "l": F.col("n_leaves") - F.when(F.col("on_last"), F.col("left_leaf")).otherwise(0)})
    return once.groupBy("key").agg(
        F.first("parent_key", ignorenulls=True).alias("parent_key"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        F.sum("n_convs").alias("n_convs"), F.sum("c").alias("n_children"), F.sum("l").alias("n_leaves"),
        (F.sum("sum_nw") - F.sum("w")).alias("saved_tokens"))


def streamed_digests(parts: DataFrame) -> DataFrame:
    """`key, ends`: the digest of the members that end at a node of several shards, fed in order."""
    dealt = parts.filter("kind = 'ids'").select("key", "shard", "seq", "ids").repartition("key").sortWithinPartitions("key", "shard", "seq")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(key, h):
            return pa.RecordBatch.from_arrays([pa.array([key]), pa.array([h.digest()], pa.binary())], names=["key", "ends"])

        now, h = None, None
        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                if key != now:
                    if h:
                        yield batch_of(now, h)
                    now, h = key, hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
        if h:
            yield batch_of(now, h)

    return dealt.mapInArrow(run, "key string, ends binary")


def trie_nodes(paths: DataFrame, shard_convs: int = SHARD_CONVS, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the prefix trie of `paths` (`conv_id, path, words`; one row per conversation)."""
    parts = staged(shard_tries(paths, shard_convs, shard_turns), "prefix-trie")
    upper = staged(merged_upper_nodes(parts).join(streamed_digests(parts), "key", "left"), "prefix-trie-upper")
    of_parent = if_small(upper.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("upper_parent")))
    inner = parts.filter("kind = 'node'").select(
        "conv_id", "depth", "parent_conv_id", "parent_key", "n_convs", "n_children", "n_leaves",
        (F.col("sum_nw") - F.col("sum_w")).alias("saved_tokens"), "ends")
    low = inner.filter("parent_key is null").drop("parent_key")
    high = inner.drop("parent_conv_id").filter("parent_key is not null").unionByName(
        upper.select("conv_id", "depth", "parent_key", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"))
    high = high.join(of_parent, "parent_key", "left").withColumn("parent_conv_id", F.col("upper_parent")).drop("parent_key", "upper_parent")
    none = F.sha2(F.lit("").cast("binary"), 256)
    return low.unionByName(high).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce(F.lower(F.hex("ends")), none).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, **columns: str) -> DataFrame:
    """The trie of the rebuilt conversations: `conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256`."""
    return trie_nodes(rebuilt_paths(conversations, **columns))
