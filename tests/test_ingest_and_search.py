import pytest
from pyspark.sql import functions as F

from skein.operators import search
from skein.sources import readers
from skein.streaming import ingest


def _vectors(spark):
    rows = [(1, 1, "2024-01-01 00:00:00", "a", [0.0, 0.0]), (2, 1, "2024-01-02 00:00:00", "a b", [1.0, 0.0]),
            (3, 1, "2024-01-03 00:00:00", "a", [2.0, 0.0]), (3, 2, "2024-01-04 00:00:00", "a", None)]
    return spark.createDataFrame(rows, "chat_id long, message_id long, date string, text string, embedding array<double>").withColumn(
        "date", F.col("date").cast("timestamp_ntz"))


def test_messages_of_unknown_chats_take_no_place(spark):
    chats = spark.createDataFrame([(2, "two"), (3, "three")], "chat_id long, title string")
    near = search.vector_search(_vectors(spark), chats, [0.0, 0.0], k=2).collect()
    assert [(r.chat_id, r.title, r.distance) for r in near] == [(2, "two", 1.0), (3, "three", 2.0)]
    found = search.like_search(_vectors(spark), chats, "a", k=2).collect()
    assert [r.chat_id for r in found] == [3, 2]


def test_model_vector_of_another_length_fails(spark):
    enc = search.pandas_encoder(lambda: lambda texts: [[1.0, 2.0, 3.0]] * len(texts), dim=2)
    with pytest.raises(Exception, match="2 values"):
        enc(spark.createDataFrame([("x",)], "text string"), "text", "v").collect()


def test_malformed_lines_go_to_quarantine(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"id": 1, "chat": {"id": 7}, "text": "ok"}\n{"id": 2, "chat": {"id": 7}, "text": \n'
                                     '{"id": 3, "text": "no chat"}\nplain text\n')
    docs, rejects = readers.split_malformed(readers.read_raw_messages(spark, str(tmp_path)))
    assert [(r.id, r.chat.id) for r in docs.collect()] == [(1, 7)]
    lines = {r.line for r in rejects.collect()}
    assert len(lines) == 3 and "plain text" in lines and any('"id":3' in x.replace(" ", "") for x in lines)


def test_unknown_interval_or_symbol_fails(spark):
    cols = "Name string, Interval string, Date string, Open string, High string, Low string, Close string, Volume string"
    rest = ("2024-01-01", "1", "1", "1", "1", "1")
    assert readers.parse_bar_rows(spark.createDataFrame([("AAPL", "DAILY", *rest)], cols)).first().granularity == "1d"
    for row in (("AAPL", "WEEKLY?", *rest), ("XYZ:1", "DAILY", *rest)):
        with pytest.raises(Exception, match="unknown"):
            readers.parse_bar_rows(spark.createDataFrame([row], cols)).collect()


def test_vector_groups(spark):
    v = spark.createDataFrame([(1, i) for i in range(25)] + [(2, i) for i in range(9)] + [(3, i) for i in range(10)],
                              "chat_id long, last_message_id long")
    sizes = {(r.chat_id, r.group): r["count"] for r in ingest.vector_groups(v, 10).groupBy("chat_id", "group").count().collect()}
    assert sizes == {(1, 0): 10, (1, 1): 15, (2, None): 9, (3, 0): 10}


def test_each_vector_group_is_one_file(spark, tmp_path):
    """groups are written by the tasks, whole files only, and nothing over an existing path."""
    ids = [None, *range(24)]
    v = spark.createDataFrame([(1, i, [float(i or 0)]) for i in reversed(ids)] + [(2, 5, None)] * 10 + [(3, 1, [1.0])],
                              "chat_id long, last_message_id long, embedding array<float>").repartition(3)
    path = f"file:{tmp_path}/groups"
    rest = ingest.write_vector_groups(v, path, 10)
    assert [tuple(r) for r in rest.collect()] == [(3, 1, [1.0])]
    assert sorted(p.relative_to(tmp_path / "groups").as_posix() for p in tmp_path.rglob("*") if p.is_file()) == [
        "_SUCCESS", "chat_id=1/group=0/part-0.parquet", "chat_id=1/group=1/part-0.parquet", "chat_id=2/group=0/part-0.parquet"]
    r = spark.read.schema("last_message_id long, embedding array<float>, chat_id long, group long").parquet(path)
    assert [x.last_message_id for x in r.filter("chat_id = 1 and group = 0").collect()] == ids[:10]
    assert [x.embedding for x in r.filter("chat_id = 1 and group = 1").collect()] == [[float(i)] for i in range(9, 24)]
    assert r.filter("chat_id = 2 and embedding is null").count() == 10
    with pytest.raises(Exception, match="already exists"):
        ingest.write_vector_groups(v, path, 10)
    empty = f"{tmp_path}/none"
    assert ingest.write_vector_groups(v.filter("chat_id = 3"), empty, 10).count() == 1
    assert spark.read.schema(r.schema).parquet(empty).count() == 0


def test_text_objects_and_reaction_shapes(spark, tmp_path):
    one = '{"emoji": "👍", "count": 2}'
    rows = [f'{{"id": 1, "chat": {{"id": 7}}, "text": {{"markdown": "**hi**"}}, "reactions": [{one}]}}',
            f'{{"id": 2, "chat": {{"id": 7}}, "text": "plain", "reactions": {{"reactions": {{"reactions": [{one}, {one}]}}}}}}',
            '{"id": 3, "chat": {"id": 7}, "text": {"html": "x"}, "caption": {"markdown": "cap"}, "reactions": {"other": 1}}',
            '{"id": 4, "chat": {"id": 7}, "reactions": {"reactions": []}}']
    (tmp_path / "m.json").write_text("\n".join(rows))
    docs, rejects = readers.split_malformed(readers.read_raw_messages(spark, str(tmp_path)))
    got = {r.id: (r.text, r.caption, None if r.reactions is None else [(x.emoji, x["count"]) for x in r.reactions.reactions])
           for r in docs.collect()}
    assert got == {1: ("**hi**", None, [("👍", 2)]), 2: ("plain", None, [("👍", 2)] * 2), 3: (None, "cap", None), 4: (None, None, [])}
    assert rejects.count() == 0


def _plain_gate(mine, timers, watermark):
    """(firing, timed) of one chat's rows `(id, date, to_bot)` in order."""
    import datetime as dt
    fired, timed, last, waiting = [], [], None, None
    for r, (i, at, bot) in enumerate(mine, 1):
        if waiting and at and at >= waiting[1]:
            timed.append(waiting)
        due = None if last is None else last + dt.timedelta(seconds=1 if bot else 10)
        if due is None or (at and at >= due):
            fired.append((i, at))
        waiting = (i, due) if due and at and at < due else None
        if r >= 10 and r % 5 == 0 and at:
            last = at
    if waiting and waiting[1] < watermark:
        timed.append(waiting)
    return fired, timed if timers else []


@pytest.mark.parametrize("timers", [False, True])
def test_keyed_streams_carry_state_over_batches_and_a_restart(spark, tmp_path, timers):
    import datetime as dt
    start = dt.datetime(2024, 1, 1)
    cols = "chat_id long, message_id long, date timestamp_ntz, reply_sender long"
    rows = [(c, i, start + dt.timedelta(seconds=3 * i), 7 if i % 4 == 0 else 8) for c, n in ((1, 67), (2, 9), (3, 10), (4, 11)) for i in range(n)]
    if not timers:  # rows without a date have no event time
        rows += [(1, 100, None, 8), (2, 100, None, 7)]
    rows += [(9, 1, start + dt.timedelta(hours=3), 8)]  # moves the watermark past all of them
    ends = [10, 23, 28, 40, 50, 1000]
    parts = [[r for r in rows if (0 if k == 0 else ends[k - 1]) <= (999 if r[0] == 9 or r[2] is None else r[1]) < e] for k, e in enumerate(ends)]
    for go in (parts[:3], parts[3:]):  # two queries on one checkpoint
        for part in go:
            spark.createDataFrame(part, cols).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        read = lambda: spark.readStream.schema(cols).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        ingest.summary_stream(read(), str(tmp_path / "s"), str(tmp_path / "sc")).awaitTermination()
        q = ingest.reply_gate_stream(read(), 7, str(tmp_path / "g"), str(tmp_path / "gc"), timers=timers)
        q.awaitTermination()
        assert sum(p.numInputRows > 0 for p in q.recentProgress) == 3
    summaries, want = set(), set()
    for c in {r[0] for r in rows}:
        mine = [(r[1], r[2], r[3] == 7) for r in sorted((r for r in rows if r[0] == c), key=lambda r: (r[2] is None, r[2], r[1]))]
        summaries |= {(c, i, -(-r // 5)) for r, (i, _, _) in enumerate(mine, 1) if -(-r // 5) * 5 + 5 <= len(mine)}
        fired, timed = _plain_gate(mine, timers, start + dt.timedelta(hours=2))
        want |= {(c, *f, False) for f in fired} | {(c, *t, True) for t in timed}
    got = [tuple(r) for r in ingest.emitted(spark, str(tmp_path / "s"), ingest.SUMMARY_OUT).collect()]
    assert len(got) == len(summaries) and set(got) == summaries
    got = [tuple(r) for r in ingest.emitted(spark, str(tmp_path / "g"), ingest.GATE_OUT).collect()]
    assert len(got) == len(want) and set(got) == want
    assert any(g[3] for g in got) == timers


def _raw_batch(spark, tmp_path, name, ids, text):
    import json
    folder = tmp_path / name
    folder.mkdir()
    docs = [{"id": i, "chat": {"id": 7, "title": f"t {text}"}, "from_user": {"id": 5 + i, "first_name": text}, "text": text,
             "date": f"2024-01-0{1 + i % 9}T00:00:00", "reactions": {"reactions": [{"emoji": "👍", "count": i}]}} for i in ids]
    (folder / "m.json").write_text("\n".join(map(json.dumps, docs)))
    return readers.read_raw_messages(spark, str(folder))


def test_a_batch_is_seen_with_all_its_tables_or_not_at_all(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    ingest.write_batch(_raw_batch(spark, tmp_path, "a", range(3), "old"), 0, root)
    before = {n: sorted(map(str, t.collect())) for n, t in ingest.current_tables(spark, root).items()}
    real = ingest.normalise_batch

    def failing(docs):
        parts = real(docs)
        return parts | {"polls": parts["polls"].withColumn("chat_id", F.raise_error(F.lit("lost")).cast("long")),
                        "chats": parts["chats"].withColumn("title", F.raise_error(F.lit("lost")))}

    monkeypatch.setattr(ingest, "normalise_batch", failing)
    second = _raw_batch(spark, tmp_path, "b", range(2, 6), "new")
    with pytest.raises(Exception, match="lost"):
        ingest.write_batch(second, 1, root)
    assert (tmp_path / "store" / "messages" / "batch_id=1" / "_SUCCESS").exists()  # some tables were written
    assert ingest.committed(spark, root) == [0]
    assert {n: sorted(map(str, t.collect())) for n, t in ingest.current_tables(spark, root).items()} == before
    monkeypatch.setattr(ingest, "normalise_batch", real)
    ingest.write_batch(second, 1, root)  # the retry
    tables = ingest.current_tables(spark, root)
    assert {r.message_id: r.text for r in tables["messages"].collect()} == {0: "old", 1: "old", **{i: "new" for i in range(2, 6)}}
    assert tables["users"].count() == 6 and tables["chats"].first()["title"] == "t new"
    files = sorted((tmp_path / "store").rglob("batch_id=1/*.parquet"))
    ingest.write_batch(second, 1, root)  # committed: not written again
    assert sorted((tmp_path / "store").rglob("batch_id=1/*.parquet")) == files
    # a snapshot holds committed batches only, and an older moment can still be read
    assert ingest.compact(spark, root, "messages") == 1
    assert ingest.current_table(spark, root, "messages").count() == 6
    assert ingest.current_table(spark, root, "messages", [0]).count() == 3


def test_repeats_are_kept_out_with_a_bounded_state(spark, tmp_path):
    """Files land an hour apart: every document again each time, one of them changed.  The state holds about one
    window of digests, however many files have come, and the result is that of upserting everything."""
    import json
    import os
    landing, root = tmp_path / "in", str(tmp_path / "store")
    landing.mkdir()
    state, rows = [], []
    for k in range(5):
        docs = [{"id": i, "chat": {"id": 7}, "text": f"t{i}", "views": 100 + k if i == 3 else 1, "date": "2024-01-01T00:00:00"} for i in range(8)]
        docs.append({"id": 100 + k, "chat": {"id": 7}, "text": "late", "date": f"20{10 + k}-01-01T00:00:00"})  # years late
        (landing / f"f{k}.json").write_text("\n".join(map(json.dumps, docs + docs)))
        os.utime(landing / f"f{k}.json", (1_700_000_000 + 3600 * k,) * 2)
        stream = ingest.without_repeats(ingest.raw_stream(spark, str(landing), arrival=True), "90 minutes")
        q = ingest.ingest(stream, root, str(tmp_path / "ckpt"))
        q.awaitTermination()
        state.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
        rows.append(spark.read.parquet(f"{root}/messages/batch_id={ingest.committed(spark, root)[-1]}").count() if k == 0 else None)
    assert rows[0] == 9
    assert max(state) <= 2 * 9 + 8 and state[-1] <= state[1] + 9  # not 9 more with every file
    got = {r.message_id: r.views for r in ingest.current_table(spark, root, "messages").collect()}
    assert got == {**{i: 1 for i in range(8)}, 3: 104, **{100 + k: None for k in range(5)}}


def test_embedding_stream_follows_new_chains(spark, tmp_path):
    cols = "chat_id long, last_message_id long, chain string"
    landing, store = str(tmp_path / "in"), str(tmp_path / "store")

    def run(rows):
        if rows:
            spark.createDataFrame(rows, cols).coalesce(1).write.mode("append").parquet(landing)
        q = ingest.embed_stream(spark.readStream.schema(cols).parquet(landing), store, str(tmp_path / "ckpt"), 16)
        q.awaitTermination()
        return sum(p.numInputRows for p in q.recentProgress)

    assert run([(1, 1, "a b"), (1, 2, None), (1, 3, "c"), (1, 3, "c")]) == 4
    first = {(r.chat_id, r.last_message_id): r.embedding for r in ingest.embedded(spark, store).collect()}
    assert set(first) == {(1, 1), (1, 3)}
    files = sorted(tmp_path.rglob("store/**/*.parquet"))
    assert run([]) == 0 and sorted(tmp_path.rglob("store/**/*.parquet")) == files  # a rerun adds nothing
    assert run([(1, 3, "changed text"), (2, 1, "new")]) == 2  # work follows the new chains
    now = {(r.chat_id, r.last_message_id): r.embedding for r in ingest.embedded(spark, store).collect()}
    assert set(now) == {(1, 1), (1, 3), (2, 1)} and all(now[k] == first[k] for k in first)
