import random

import pytest
from pyspark.sql import functions as F

from skein.operators import threads


def _chains(df, key_cols, chain_col):
    return {tuple(r[c] for c in key_cols): list(r[chain_col]) for r in df.collect()}


def test_maximal_chains_unit_fixture(chain_fixture):
    m, _ = chain_fixture
    got = _chains(threads.maximal_chains(m), ["chat_id", "leaf_id"], "msg_chain")
    assert got[(1, 0)] == [0]
    assert got[(1, 2)] == [1, 2]
    assert got[(1, 6)] == [3, 4, 5, 6]
    assert got[(1, 7)] == [3, 7]
    assert got[(1, 8)] == [1, 8]
    assert got[(1, 9)] == [3, 4, 9]
    assert got[(2, 0)] == [0] and got[(2, 1)] == [1]
    assert (3, 5) not in got  # orphan: never reaches a root


def test_message_chain_leaf_first_text(chain_fixture):
    m, chats = chain_fixture
    rows = {(r.chat_id, r.last_message_id): r for r in threads.message_chain(m, chats).collect()}
    r = rows[(1, 6)]
    assert r.chain == "1,6<<NEXTMSG>>1,5<<NEXTMSG>>1,4<<NEXTMSG>>1,3"
    assert r.chain_len == 4 and r.first_message_id == 3
    # 8 leaves of the two fixture chats, plus the orphan and the null-text chat
    assert len([k for k in rows if k[0] in (1, 2)]) == 8
    orphan = rows[(3, 5)]
    assert orphan.chain_len == 1 and orphan.first_message_id == 5 and orphan.chain == "3,5"
    null_text = rows[(4, 2)]
    assert null_text.chain is None and null_text.chain_len == 2
    assert null_text.sent_by_linked_chat is True
    assert rows[(1, 6)].sent_by_linked_chat is False


def test_leaf_flags_match_chain_leaves(chain_fixture):
    m, chats = chain_fixture
    leaves = {(r.chat_id, r.message_id) for r in threads.leaf_flags(m).filter("leaf").collect()}
    chain_leaves = {(r.chat_id, r.last_message_id) for r in threads.message_chain(m, chats).collect()}
    assert leaves == chain_leaves


def test_message_threads_window_drops_cut_threads(chain_fixture):
    m, _ = chain_fixture
    # window 2024-01-02 .. 2024-01-09 excludes message 0 of every chat (date 01-01)
    # and in chat 1 also keeps 1..8; message 9 (date 01-01) is out as well
    t = threads.message_threads(m, "2024-01-02", "2024-01-09", chat_ids=[1])
    got = sorted(list(r.msg_id_chain) for r in t.collect())
    assert [1, 2] in got and [3, 4, 5, 6] in got and [3, 7] in got and [1, 8] in got
    assert all(c[-1] != 9 for c in got)


def test_chain_steps_counts(chain_fixture):
    m, _ = chain_fixture
    steps = threads.chain_steps(m.filter(F.col("chat_id") == 1))
    # sum over messages of (number of existing ancestors + 1)
    assert steps.count() == 1 + 1 + 2 + 1 + 2 + 3 + 4 + 2 + 2 + 3


def _walk(parent, node):
    path = [node]
    while parent.get(path[-1]) is not None and parent[path[-1]] in parent:
        path.append(parent[path[-1]])
    return list(reversed(path)), parent.get(path[-1])


def test_path_doubling_equals_brute_force(spark):
    rnd = random.Random(42)
    rows, parents = [], {}
    for chat in range(3):
        par = {}
        for i in range(300):
            # replies point to earlier ids; some point below 0 (missing parent, orphan walk)
            p = None if rnd.random() < 0.2 or i == 0 else rnd.randrange(i - 40, i)
            par[i] = p
            rows.append((chat, i, p))
        parents[chat] = par
    df = spark.createDataFrame(rows, "chat_id long, message_id long, reply_to_message_id long")
    got = {(r.chat_id, r.id): (list(r.path), r.ptr) for r in threads.paths(df).collect()}
    for chat, par in parents.items():
        for node in par:
            path, ptr = _walk(par, node)
            g_path, g_ptr = got[(chat, node)]
            assert g_path == path and g_ptr == ptr, (chat, node)


def test_paths_stop_on_cycles(spark):
    rows = [(1, 1, 2), (1, 2, 3), (1, 3, 1), (1, 4, 1), (1, 5, 5)]
    df = spark.createDataFrame(rows, "chat_id long, message_id long, reply_to_message_id long")
    got = {r.id: r for r in threads.paths(df).collect()}
    assert all(r.cycle for r in got.values())
    assert all(len(set(r.path)) == len(r.path) for r in got.values())


def test_forward_cycle_closure_terminates(spark):
    rows = [(1, 1, None, 2, 1, "a", 1), (2, 1, None, 1, 1, "b", 2), (1, 2, 1, None, None, "c", 3)]
    m = spark.createDataFrame(rows, "chat_id long, message_id long, reply_to_message_id long, "
                                    "forward_from_chat_id long, forward_from_message_id long, text string, "
                                    "sender_id long")
    seed = m.filter((F.col("chat_id") == 1) & (F.col("message_id") == 2))
    out = threads.ancestor_closure(seed, m, replies=True, forwards=True, distinct=True)
    assert sorted((r.chat_id, r.message_id) for r in out.collect()) == [(1, 1), (1, 2), (2, 1)]


def test_reply_or_forward_pairs(chain_fixture):
    m, _ = chain_fixture
    pairs = {(r.child_chat_id, r.child_id, r.src_chat_id, r.src_id) for r in threads.reply_or_forward_pairs(m).collect()}
    assert (2, 0, 1, 2) in pairs and (1, 2, 1, 1) in pairs


def test_one_deep_thread(spark):
    """A single thread of 20,000 messages: one row per message of the leaf's walk, not one path per message."""
    n = 20_000
    m = spark.range(n).select(F.lit(1).cast("long").alias("chat_id"), F.col("id").alias("message_id"),
                              F.when(F.col("id") > 0, F.col("id") - 1).alias("reply_to_message_id"))
    r = threads.maximal_chains(m).first()
    assert (r.root_id, r.leaf_id) == (0, n - 1) and r.msg_chain == list(range(n))


def test_leaf_walks_equal_brute_force(spark):
    rnd = random.Random(5)
    rows = [(c, i, None if rnd.random() < 0.15 else rnd.randrange(i - 20, i)) for c in range(3) for i in range(200)]
    par = {(c, i): p for c, i, p in rows}
    m = spark.createDataFrame(rows, "chat_id long, message_id long, reply_to_message_id long")
    got = {}
    for r in threads.leaf_walks(m).collect():
        got.setdefault((r.chat_id, r.start), {})[r.pos] = r.id
    leaf = set(par) - {(c, p) for (c, _), p in par.items()}
    assert set(got) == leaf
    for c, i in leaf:
        walk = [i]
        while (c, par[(c, walk[-1])]) in par:
            walk.append(par[(c, walk[-1])])
        assert [got[(c, i)][k] for k in range(len(got[(c, i)]))] == walk


def test_leaves_above_a_circle_are_left_out(spark):
    rows = [(1, 1, 2), (1, 2, 3), (1, 3, 1), (1, 4, 1), (1, 5, 5), (1, 6, None), (1, 7, 6)]
    m = spark.createDataFrame(rows, "chat_id long, message_id long, reply_to_message_id long")
    assert {r.start for r in threads.leaf_walks(m).collect()} == {7}


def _linked(spark, rows):
    return spark.createDataFrame(rows, "chat_id long, message_id long, reply_to_message_id long, forward_from_chat_id long, "
                                       "forward_from_message_id long")


def test_closure_counts_every_way(spark):
    # 4 reaches 1 by its reply 3 and by its forward 2: UNION ALL keeps both ways, and all of 1's ancestors twice
    m = _linked(spark, [(1, 0, None, None, None), (1, 1, 0, None, None), (1, 2, 1, None, None), (1, 3, 1, None, None),
                        (1, 4, 3, 1, 2), (1, 5, 3, 1, 3)])
    seed = m.filter("message_id in (4, 5)")
    ways = {}
    for r in threads.ancestor_closure(seed, m, replies=True, forwards=True).collect():
        ways[r.message_id] = ways.get(r.message_id, 0) + 1
    # 5 replies to and forwards 3: one link
    assert ways == {4: 1, 5: 1, 3: 2, 2: 1, 1: 3, 0: 3}
    once = threads.ancestor_closure(seed, m, replies=True, forwards=True, distinct=True)
    assert sorted(r.message_id for r in once.collect()) == [0, 1, 2, 3, 4, 5]


def test_closure_deeper_than_ten_thousand(spark):
    n = 12_000
    m = spark.range(n).select(F.lit(1).cast("long").alias("chat_id"), F.col("id").alias("message_id"),
                              F.when(F.col("id") > 0, F.col("id") - 1).alias("reply_to_message_id"))
    assert threads.ancestor_closure(m.filter(F.col("message_id") == n - 1), m).count() == n


def test_closure_with_duplicates_refuses_a_circle(spark):
    import pytest
    m = _linked(spark, [(1, 1, 2, None, None), (1, 2, 1, None, None)])
    with pytest.raises(RuntimeError):
        threads.ancestor_closure(m, m)


@pytest.mark.parametrize("deep", [0, 2, 16])
def test_closure_from_the_seed_equals_plain_walks(spark, deep):
    """Two parents a message, several ways, at every limit between steps and squaring."""
    import random
    r = random.Random(7)
    parents = {i: sorted({r.randrange(i) for _ in range(r.randint(0, 2))}) if i else [] for i in range(60)}
    rows = [(1, i, p[0] if p else None, 1 if len(p) > 1 else None, p[1] if len(p) > 1 else None, f"t{i}", 5) for i, p in parents.items()]
    rows += [(2, i, i - 1 if i else None, None, None, "other chat", 6) for i in range(30)]
    m = spark.createDataFrame(rows, "chat_id long, message_id long, reply_to_message_id long, forward_from_chat_id long, "
                                    "forward_from_message_id long, text string, sender_id long")
    seed = m.filter("chat_id = 1 and message_id in (59, 58, 40)")
    counts, todo = {}, [59, 58, 40]
    while todo:
        x = todo.pop()
        counts[x] = counts.get(x, 0) + 1
        todo += parents[x]
    got = threads.ancestor_closure(seed, m, forwards=True, deep=deep).groupBy("chat_id", "message_id").count().collect()
    assert {x.message_id: x["count"] for x in got} == counts and {x.chat_id for x in got} == {1}
    once = threads.ancestor_closure(seed, m, forwards=True, distinct=True, deep=deep).collect()
    assert sorted(x.message_id for x in once) == sorted(counts)


def test_closure_reads_the_folders_it_needs(spark, monkeypatch):
    """A seed without parents reads no links, a short chain a few folders."""
    rows = [(1, i, i - 1 if i else None, "t", 5) for i in range(3)] + [(2, i, i - 1, "t", 5) for i in range(1, 400)]
    m = spark.createDataFrame(rows, "chat_id long, message_id long, reply_to_message_id long, text string, sender_id long")
    read = []
    real = threads._ways
    monkeypatch.setattr(threads, "_ways", lambda df, *a: read.append(df) or real(df, *a))
    out = threads.ancestor_closure(m.filter("chat_id = 1 and message_id = 2"), m)
    assert sorted(r.message_id for r in out.collect()) == [0, 1, 2]
    import re
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in read]
    filters = [f for p in plans for f in re.findall(r"PartitionFilters: \[([^\]]*folder[^\]]*)\]", p)]
    assert len(filters) == 3 and all(re.search(r"folder#\d+ = \d+\)", f) for f in filters)  # one folder a step


def test_texts_stay_behind_when_only_ids_are_asked_for(spark, chain_fixture):
    """neither pending chains nor the lengths of threads move a text."""
    m, chats = chain_fixture
    for df in (threads.message_threads(m, "2024-01-01").select("msg_id_chain"),
               threads.message_chain(m, chats).select("chat_id", "last_message_id"),
               threads.gather(threads.chains_to_root(m), m, ["chat_id", "last_msg_id"], "msg_chain", ["sender_id", "text"],
                              "first_msg_id").select("chat_id", "sender_id_chain")):
        assert "text" not in df._jdf.queryExecution().optimizedPlan().toString().split("LogicalRDD")[0].replace("text_chain", "")


def test_a_tree_is_one_place_for_its_texts_and_chains(spark, chain_fixture):
    """after a message's text went to its tree, chains are put together there; large trees are dealt to
    several tasks, and messages that come twice count twice, as in a join."""
    m, _ = chain_fixture
    m = m.unionByName(m.filter("chat_id = 1 and message_id = 3"))
    steps = threads.chains_to_root(m.dropDuplicates(["chat_id", "message_id"])).select(
        "chat_id", F.col("last_msg_id").alias("start"), F.col("first_msg_id").alias("top"), F.posexplode("msg_chain").alias("pos", "id"))
    steps = steps.unionByName(steps.limit(1).withColumn("id", F.lit(77).cast("long")))  # no such message
    for how in ("inner", "left"):
        plain = steps.join(m.select("chat_id", F.col("message_id").alias("id"), "text"), ["chat_id", "id"], how)
        for rows in (1, 3, 50_000):
            got = threads._in_trees(steps, m, ["chat_id", "start"], ["text"], how, rows).select("chat_id", "start", "top", "pos", "id", "text")
            assert sorted(map(str, got.collect())) == sorted(map(str, plain.select(*got.columns).collect()))
    g = threads._in_trees(steps, m, ["chat_id", "start"], ["text"]).groupBy("chat_id", "start", "top", "_part").agg(F.collect_list("text"))
    plan = g._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(chat_id" in plan and plan.index("Window") < plan.index("Exchange")  # none above the window
