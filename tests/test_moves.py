"""Which rows and texts are moved to be met."""

import random

from pyspark.sql import functions as F

from skein.operators import planning, tables, threads

MESSAGE = ("chat_id long, message_id long, reply_to_message_id long, forward_from_chat_id long, forward_from_message_id long, "
           "sender_id long, text string")


def _messages(spark, n=120, seed=5):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        chat, mid = i % 3, i // 3
        reply = mid - r.randint(1, 4) if r.random() < 0.7 else None
        fwd = ((chat + 1) % 3, mid - 3) if r.random() < 0.2 else (None, None)
        rows.append((chat, mid, reply, *fwd, r.randint(1, 5), None if r.random() < 0.1 else f"text {i}"))
    return spark.createDataFrame(rows + rows[10:13], MESSAGE)  # some messages twice


def _late(m):
    """Texts kept under a key of their own."""
    texts = m.select((F.col("chat_id") * 1000 + F.col("message_id")).alias("key"), "text").distinct()
    headers = m.drop("text").withColumn("key", F.col("chat_id") * 1000 + F.col("message_id"))
    return threads.Late(headers, ["key"], lambda h: h.join(texts, "key", "left").drop("key"))


def _rows(df):
    return sorted((str(r) for r in df.select(sorted(df.columns)).collect()))


def _untouched(m):
    return m.withColumn("text", F.when(F.col("chat_id") >= 0, F.raise_error(F.lit("a text was read"))).cast("string"))


def test_closure_reads_texts_of_what_it_reached_only(spark):
    """F22, F23, F24."""
    m = _messages(spark)
    seed = m.filter("message_id > 30")
    for forwards, distinct in ((False, False), (True, True), (True, False)):
        want = threads.ancestor_closure(seed, m, forwards=forwards, distinct=distinct)
        got = threads.ancestor_closure(seed, _untouched(m), forwards=forwards, distinct=distinct, late=_late(m))
        assert got.columns == want.columns
        assert _rows(got) == _rows(want)


def test_chains_take_texts_from_where_they_are_kept(spark):
    """as with texts in the messages; the marker tells null chains, without texts."""
    m = _messages(spark)
    chats = spark.createDataFrame([(0, 2), (1, None), (2, 3)], "chat_id long, linked_chat_id long")
    want = threads.message_chain(m, chats)
    got = threads.message_chain(_untouched(m), chats, _late(m), mark=True)
    assert got.columns == [*want.columns, "no_chain"]
    assert got.filter(F.col("no_chain") != F.col("chain").isNull()).count() == 0
    assert _rows(got.drop("no_chain")) == _rows(want)


def test_upsert_moves_only_rows_that_meet(spark, monkeypatch):
    """the same as one full outer join, keys null or repeated on either side included."""
    r = random.Random(7)
    value = lambda n: None if r.random() < 0.2 else r.randint(0, n)
    old = spark.createDataFrame([(value(2), value(30), value(9), value(9)) for _ in range(120)], "a long, b long, v long, w long")
    new = spark.createDataFrame([(value(2), value(30), value(9), value(9)) for _ in range(120)], "a long, b long, v long, w long")
    assert _rows(tables.upsert_apart(old, new, ["a", "b"])) == _rows(tables.upsert_coalesce(old, new, ["a", "b"]))
    flag = lambda df: df.withColumn("v_null", F.col("v").isNull())
    marked = tables.upsert_apart(flag(old), flag(new), ["a", "b"], {"v": "v_null"})
    assert _rows(marked) == _rows(tables.upsert_coalesce(old, new, ["a", "b"]))

    moved, plain = [], tables.upsert_coalesce
    monkeypatch.setattr(tables, "upsert_coalesce", lambda b, u, *a, **k: moved.append((b.count(), u.count())) or plain(b, u, *a, **k))
    old = spark.createDataFrame([(i, i, "old") for i in range(50)] + [(99, 1, "gone")], "a long, b long, v string")
    new = spark.createDataFrame([(i, i, "new" if i else None) for i in range(50)], "a long, b long, v string")
    got = {(x["a"], x["v"]) for x in tables.upsert_apart(old, new, ["a", "b"]).collect()}
    assert got == {(0, "old"), (99, "gone"), *((i, "new") for i in range(1, 50))}
    assert moved == [(2, 1)]


def test_refresh_leaves_rows_of_other_dates_where_they_are(spark, monkeypatch):
    """only messages of the window, and such as repeat one's key, are joined."""
    moved, plain = [], tables.upsert_coalesce
    monkeypatch.setattr(tables, "upsert_coalesce", lambda b, u, *a, **k: moved.append(b.count()) or plain(b, u, *a, **k))
    days = [(1, i, f"2024-01-{i:02d} 12:00:00", i) for i in range(1, 31)] + [(1, 23, "2024-01-02 00:00:00", 5), (1, 40, None, 6), (None, 23, "2024-01-03 00:00:00", 7)]
    m = spark.createDataFrame(days, "chat_id long, message_id long, date string, views int").withColumn("date", F.col("date").cast("timestamp_ntz"))
    chats = spark.createDataFrame([(1, 50)], "chat_id long, top_message_id long")
    fetched = m.filter("views > 8").select("chat_id", "message_id", (F.col("views") + 100).alias("views"))
    none = spark.createDataFrame([], "project string, key string, value string")
    now, _ = planning.refresh(m, chats, fetched, none, "2024-01-31 00:00:00")
    window = planning.refresh_window(m, chats, "2024-01-31 00:00:00").select("chat_id", "message_id")
    want = plain(m, fetched.join(window, ["chat_id", "message_id"], "left_semi"), ["chat_id", "message_id"])
    assert _rows(now) == _rows(want)
    assert sorted(x["views"] for x in now.filter("message_id = 23").collect()) == [7, 123, 123]
    assert moved == [window.count() + 1]


def test_a_task_gathers_a_bounded_number_of_texts(spark):
    """trees are dealt to as many tasks as their steps need, not to the session's number only."""
    m = _messages(spark).filter("text is not null").dropDuplicates(["chat_id", "message_id"])
    chains = threads.chains_to_root(m)

    def gather(n):
        return threads.gather(chains, m, ["chat_id", "last_msg_id"], "msg_chain", ["text"], "first_msg_id", tree_rows=n)

    assert _rows(gather(4)) == _rows(gather(50_000))
    assert "REPARTITION_BY_NUM" in gather(4)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" not in gather(50_000)._jdf.queryExecution().executedPlan().toString()
