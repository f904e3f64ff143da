"""Texts that are kept in files and read by place."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from skein.operators import threads
from skein.plans.catalog import QUERIES
from skein.session import scratch_path, stored
from skein.sources import texts

MESSAGE = "chat_id long, message_id long, reply_to_message_id long, sender_id long, date timestamp_ntz, text string"


def _messages(spark, n=150, seed=3):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        mid = i // 3
        reply = mid - r.randint(1, 4) if r.random() < 0.7 else None
        text = None if r.random() < 0.1 else r.choice(["", "אב", f"text {i}", "x" * r.randint(1, 9000)])
        rows.append((i % 3, mid, reply, r.randint(1, 5), dt.datetime(2024, 1, 1 + i % 20), text))
    rows += [(c, m, p, s, d, f"another {t}") for c, m, p, s, d, t in rows[20:24]]  # some ids twice, with other texts
    return spark.createDataFrame(rows, MESSAGE)


def _rows(df):
    return sorted(str(r) for r in df.select(sorted(df.columns)).collect())


def _placed(spark, m):
    path = scratch_path(spark, "texts")
    return stored(texts.put_texts(m, "text", path)), lambda rows, places, out: texts.with_texts(rows, places, out, path)


def test_texts_come_back_from_their_places(spark):
    m = _messages(spark).repartition(5)
    placed, read = _placed(spark, m)
    assert "text" not in placed.columns
    assert placed.filter("place is null").count() == m.filter("text is null").count() > 0
    assert _rows(read(placed, "place", "text")) == _rows(m)
    lists = placed.groupBy("chat_id").agg(F.sort_array(F.collect_list(F.struct("message_id", "place"))).alias("l"))
    lists = lists.select("chat_id", F.transform("l", lambda x: x.place).alias("p")).unionByName(
        lists.select((F.col("chat_id") + 10).alias("chat_id"), F.lit(None).cast(f"array<{texts.PLACE}>").alias("p")))
    got = {r.chat_id: r.t for r in read(lists, "p", "t").collect()}
    assert got[10] is None and got[11] is None
    for c in range(3):
        want = [r.text for r in m.filter(F.col("chat_id") == c).collect()]
        assert sorted(got[c], key=str) == sorted(want, key=str)


def test_chains_of_places_equal_chains_of_texts(spark):
    """repeated ids and null texts included."""
    m = _messages(spark)
    placed, read = _placed(spark, m)
    chats = spark.createDataFrame([(0, 2), (1, None), (2, 3)], "chat_id long, linked_chat_id long")
    assert _rows(threads.chains_text(placed, read)) == _rows(threads.chains_text(m))
    assert _rows(threads.message_chain(placed, chats, mark=True, read=read)) == _rows(threads.message_chain(m, chats, mark=True))
    args = ("2024-01-02", "2024-01-19")
    assert _rows(threads.message_threads(placed, *args, read=read)) == _rows(threads.message_threads(m, *args))
    c = threads.chains_to_root(m)
    keys, cols = ["chat_id", "last_msg_id"], ["sender_id", "text"]
    want = threads.gather(c, m, keys, "msg_chain", cols, "first_msg_id")
    got = threads.gather(c, placed, keys, "msg_chain", cols, "first_msg_id", read=read)
    assert got.columns == want.columns
    assert _rows(got) == _rows(want)


@pytest.fixture(scope="module")
def tables_dir(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    r = random.Random(1)
    events = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), r.randint(1, 30), r.choice(["view", "click"]), 1.5 * i, f'{{"k": {r.randint(0, 99)}}}') for i in range(400)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{at}/events.parquet")
    spark.createDataFrame([(i, f"document {i}" if i % 7 else None) for i in range(60)], "doc_id long, text string").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, f"name {i}", "AUTO") for i in range(1, 20)], "c_custkey long, c_name string, c_mktsegment string").write.parquet(f"{at}/customer.parquet")
    return at


@pytest.mark.parametrize("name", ["chains_text", "thread_text_gather", "message_chain", "message_threads", "message_template", "sink_chain"])
def test_rows_with_texts_are_not_moved(spark, tables_dir, name):
    """Texts are read behind the last shuffle and sort."""
    plan = QUERIES[name](spark, tables_dir)._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("MapInArrow")]
    assert not any(n in above for n in ("Exchange", "Sort", "Join", "Aggregate", "Window"))
    assert "text:string" not in plan  # nothing but the places of the texts is joined
